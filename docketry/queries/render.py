"""Portal pages written from one row of a table each: no grouping, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docketry.plans import layouts as at
from docketry.queries.common import day, text_of

ODD = "\n\t\u00a0\u2003 "


def labelled_row(label: str, value: Column | str) -> Column:
    return text_of(f"<tr class='fundo'>\n<td align=\"left\"><strong> {label}</strong>{ODD}", value, " </td></tr>\n")


def decision_block(number: Column | str, labelled: list[tuple[str, Column | str]], summary: Column | str) -> Column:
    title = text_of(f'<table class="r"><tr><td><a class="x" title="{at.FULL_TEXT_TITLE}" href="#"> ', number, " </a></td></tr>")
    rows = [labelled_row(label, value) for label, value in labelled]
    note = "<tr><td><table><tr><td>nota</td></tr></table></td></tr>"
    last = text_of(
        "<tr><td><div style='display:none'>curto</div>\n<div>", ODD, summary, f"<br>{ODD}<div>fim.</div></div></td></tr></table>"
    )
    return text_of(title, *rows, note, last)


def pager(kind: str, page: Column | str, has_next: Column) -> Column:
    shown = f'<span {at.CURRENT_PAGE_STYLE}>' if kind == at.FIRST_SEARCH else f'<span class="{at.CURRENT_PAGE_CLASS}">'
    link = F.when(has_next, text_of(f'<a href="#" {at.NEXT_PAGE_MARKER}>&gt;</a>')).otherwise(F.lit(""))
    return text_of(f'<div class="{at.PAGER_CLASS}">{shown} ', page, " </span>", link, "</div>")


def result_page(blocks: list[Column], *, anchored: bool, paging: Column | str = "") -> Column:
    outer = text_of("<table>", *[text_of("<tr><td>", b, "</td></tr>") for b in blocks], "</table>")
    head = text_of("<html><!-- <table><table>x</table></table> --><body><table><tr><td>menu</td></tr></table>", paging)
    if anchored:
        foot = "<table><tr><td><table><tr><td><div>rodapé</div></td></tr></table></td></tr></table>"
        return text_of(head, f'<div><td id="{at.RESULTS_ID}">', outer, f"</td></div>{foot}</body></html>")
    return outer


def first_decision_blocks() -> list[Column]:
    one = decision_block(
        F.col("o_orderkey"),
        [
            ("Classe:", F.col("o_orderstatus")),
            ("Assunto:", F.col("o_orderpriority")),
            ("Magistrado:", text_of("Juiz&nbsp;", F.col("o_custkey"))),
            ("Foro:", text_of("Foro ", F.col("o_custkey"))),
            ("Vara:", text_of(F.col("o_orderstatus"), "&ordf; Vara")),
            ("Data de Disponibilização:", day("o_orderdate")),
        ],
        text_of("Texto ", F.col("o_orderkey"), " &amp; ", F.col("o_orderpriority")),
    )
    two = decision_block(
        text_of(F.col("o_orderkey"), "-R"),
        [("Classe:", "Recurso"), ("Assunto:", text_of(F.col("o_orderpriority"), " / ", F.col("o_orderstatus")))],
        text_of("Recurso ", F.col("o_custkey")),
    )
    return [one, two]


def second_decision_blocks() -> list[Column]:
    one = decision_block(
        F.col("o_orderkey"),
        [
            ("Classe/Assunto:", text_of(F.col("o_orderstatus"), " / ", F.col("o_orderpriority"), " / ", F.col("o_custkey"))),
            ("Relator(a):", text_of("Des. ", F.col("o_custkey"))),
            ("Comarca:", text_of("Comarca ", F.col("o_custkey"))),
            ("Órgão julgador:", text_of(F.col("o_orderstatus"), " Câmara")),
            ("Data do julgamento:", day("o_orderdate")),
            ("Data de publicação:", day("o_orderdate")),
        ],
        text_of("EMENTA ", F.col("o_orderkey")),
    )
    two = decision_block(
        text_of(F.col("o_orderkey"), "-R"),
        [("Classe:", F.col("o_orderstatus")), ("Assunto:", F.col("o_orderpriority")), ("Comarca:", "")],
        F.col("o_orderpriority"),
    )
    return [one, two]


def span_anchor(element_id: str, value: Column | str) -> Column:
    return text_of(f'<div id="{element_id}" class="x">\n <span title="t">{ODD}', value, " </span></div>\n")


def own_anchor(element_id: str, value: Column | str) -> Column:
    return text_of(f'<div id="{element_id}" title="t">{ODD}', value, " </div>\n")


def party_cell(name: Column | str, lawyers: list[Column | str]) -> Column:
    labelled = [text_of("<br />\n<span class='m'>Advogado:&nbsp;</span>\n\t", lawyer) for lawyer in lawyers]
    return text_of(f'<td class="{at.PARTY_CLASS}" width="75%">\n\t', name, *labelled, "\n</td>")


def role_cell(role: Column | str) -> Column:
    return text_of(f'<span class="{" ".join(at.ROLE_CLASSES)}">\n', role, "&nbsp;</span>")


def labelled_container(container: str, label: str, value: Column | str) -> Column:
    return text_of(f'<div class="row {container}"><span class="{at.LABEL_CLASS}">{label}</span>', value, "</div>")


def movement_row(shown_day: Column | str, title: Column | str, description: Column | str, linked: bool) -> Column:
    heading = text_of('<a href="#d">\n', title, "</a>") if linked else text_of("\n", title)
    return text_of(
        f'<tr class="c"><td class="{at.MOVEMENTS["date_class"]}">\n', shown_day,
        f'</td>\n<td class="{at.MOVEMENTS["text_class"]}" >', heading,
        '<br><span style="font-style:italic;">', ODD, description, "</span></td></tr>\n",
    )


def movement_table(*rows: Column) -> Column:
    return text_of(f'<table><tbody id="{at.MOVEMENTS["table_id"]}">', *rows, "</tbody></table><table><tr><td>z</td></tr></table>")


def case_list(*codes: Column | str) -> Column:
    items = [
        text_of(f'<div class="{at.CASE_LIST_HEADER}"><input type="radio" id="{at.CASE_LIST_INPUT}" value="', c, '"></div>')
        for c in codes
    ]
    return text_of(f'<div class="modal {at.CASE_LIST_CLASS}">', *items, "</div>")


def document_link(document: Column | str, origin: Column | str, title: Column | str, description: Column | str) -> Column:
    at_link = at.DOCUMENT_LINKS
    return text_of(
        f'<tr><td class="{at_link["cell_class"]}"><a class="{at_link["link_class"]}" href="#" {at_link["document_attr"]}="', document,
        f'" {at_link["origin_attr"]}="', origin, '">\n', title, "</a><br/>\n<table><tr><td> </td></tr></table><span>", description, "</span></td></tr>",
    )


def first_instance_tables(*cells: Column | str) -> Column:
    filled = [text_of("<td>\n", c, " </td>") for c in cells]
    return text_of(
        f"<table><tr><th>{at.FIRST_INSTANCE_LABEL}</th></tr></table>\n<table id='t'><tr><th>h</th></tr><tr>", *filled, "</tr></table>"
    )


def viewer_page(parameters: Column) -> Column:
    return text_of(f'<html><script>var cfg={{"tipo":"x","{at.VIEWER_PARAM}":"', parameters, '"};</script></html>')

"""Generators: one page in, many rows out. All are narrow: no shuffle.

Result blocks and rows of movements, which may lie within one another, are cut by ``functions.scan`` in Arrow
batches; the others are column expressions over prepared pages. Rows carry ``seq``: the capture's position
times 2**28, plus the place in the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from docketry.functions import scan
from docketry.functions.markup import (
    attr_value,
    class_pattern,
    cells_of,
    first_row_with_cell,
    first_text,
    inner_text,
    nth_cell,
    table_after_label,
)
from docketry.functions.structure import inside
from docketry.functions.text import (
    before_paren,
    decode_entities,
    delete_chars,
    paren_text,
    strip_lawyer_label,
    strip_space,
)
from docketry.operators.scans import scanned

# The shortest row is nine characters and a string has fewer than 2**31, so a page
# has fewer than 2**28 rows. Capture positions must stay below 2**35; a larger one stops
# the job, in every SQL mode, instead of mixing up the order.
PLACES = 2**28
POSITIONS = 2**35


def place_in_page(seq: Column, place: Column) -> Column:
    fits = (seq < POSITIONS) & (seq >= -POSITIONS)
    stop = F.raise_error(F.concat(F.lit("overflow of a capture position: "), seq.cast("string"))).cast("bigint")
    return F.when(fits | seq.isNull(), F.try_add(F.try_multiply(seq, F.lit(PLACES)), place.cast("bigint"))).otherwise(stop)


def nested_tables(scope: str) -> list[str]:
    """Tables that lie inside another table, however deep, in page order."""
    return scan.deep_elements(scope, "table", 2)


def result_blocks(
    captures: DataFrame, results_id: str, names: list[str] | None = None, read: Callable[[str], list[str] | None] | None = None
) -> DataFrame:
    """One row per decision block of a result page, with the texts ``names`` that ``read`` takes from the block.

    A block for which ``read`` gives none has no row.

    The first page holds the blocks below the element ``results_id``; later pages
    come without it, and their whole body is searched. Bodies are as captured.
    """
    names = names or []

    def rows_of(body: str) -> Iterator[tuple]:
        page = scan.prepare(body)
        scope = scan.element(page, results_id) if f'id="{results_id}"' in page else page
        for place, block in enumerate(nested_tables(scope)):
            found = read(block) if read else []
            if found is not None:
                yield place, block, *found

    rest = [c for c in captures.columns if c not in ("body", "seq")]
    found = scanned(captures, "body", rows_of, ", ".join(["place int", "block string", *[f"{name} string" for name in names]]))
    return found.select(*rest, place_in_page(F.col("seq"), F.col("place")).alias("seq"), "block", *names)


def is_decision(block: Column | str, title: str) -> Column | bool:
    """Whether a block has the link of a decision or a summary's own element; a small table inside one has neither."""
    if isinstance(block, str):
        return f'title="{title}"' in block or "<div" in block
    return F.contains(block, F.lit(f'title="{title}"')) | F.contains(block, F.lit("<div"))


def table_rows(body: str, table_id: str) -> list[str]:
    """Rows of a table, those of tables inside its cells among them."""
    return scan.deep_elements(scan.closed_rows(scan.element(body, table_id)), "tr", 1)


def movements(captures: DataFrame, case: Column, layout: dict) -> DataFrame:
    """One row per row of the movements table; the title falls back to the cell's own text."""

    def rows_of(body: str) -> Iterator[tuple]:
        for place, row in enumerate(table_rows(body, layout["table_id"])):
            day, text = (scan.cell_of_class(row, layout[name]) for name in ("date_class", "text_class"))
            title = scan.first_text(text, r"<a\b[^>]*+>") or scan.own_text(text)
            yield place, scan.own_text(day), title, scan.first_text(text, r"<span\b[^>]*+>")

    pages = captures.select("seq", case.alias("numero_processo"), "body")
    found = scanned(pages, "body", rows_of, "place int, data string, titulo string, descricao string")
    return found.select(
        place_in_page(F.col("seq"), F.col("place")).alias("seq"), "numero_processo", "data", "titulo", "descricao"
    )


def parties(body: Column, party_class: str) -> Column:
    """Parties of a case page: names and lawyers of each, in page order.

    A party cell is cut at its line breaks while still markup, so a closing tag after
    the last break counts as a piece and leaves a blank lawyer, as the contract has it.
    """
    at_cell = rf"(?=<[a-z][a-z0-9]*+\b[^>]*?\s{class_pattern(party_class)})"
    cells = F.transform(
        F.slice(F.split(F.concat(F.lit(" "), body), at_cell), 2, 2**30),
        lambda c: F.concat(inside(F.regexp_replace(c, "^<[^>]*+>", ""), F.regexp_extract(c, "^<([a-z0-9]+)", 1)), F.lit("</td>")),
    )
    # In steps, so that each step names what the step before built instead of building it again.
    pieces = F.transform(cells, lambda cell: F.split(cell, r"<br\s*/?>"))
    texts = F.transform(
        pieces,
        lambda cell: F.transform(F.filter(cell, lambda p: strip_space(p) != ""), lambda p: F.regexp_replace(p, "<[^>]*>", "")),
    )
    clean = F.transform(
        texts, lambda cell: F.transform(cell, lambda t: delete_chars(strip_space(decode_entities(t))))
    )
    return F.transform(
        clean,
        lambda cell: F.struct(
            F.slice(cell, 1, 1).alias("nomes_parte"),
            F.transform(F.slice(cell, 2, F.greatest(F.size(cell), F.lit(1))), strip_lawyer_label).alias("advogados_parte"),
        ),
    )


def party_at(party_array: Column, place: int, field: str) -> Column:
    """Names or lawyers of one party joined by pipes; blank when there is no such party."""
    return F.coalesce(F.array_join(F.get(party_array, F.lit(place))[field], "|"), F.lit(""))


def document_links(captures: DataFrame, case: Column, layout: dict) -> DataFrame:
    """One row per document link of a second-degree page, with its case code."""
    code_tag = F.regexp_extract(F.col("body"), rf'<input\b[^>]*?\sname="{layout["code_input"]}"[^>]*+>', 0)
    at_cell = rf'(?=<[a-z][a-z0-9]*+\b[^>]*?\s{class_pattern(layout["cell_class"])})'
    cell_list = F.transform(
        F.slice(F.split(F.concat(F.lit(" "), F.col("body")), at_cell), 2, 2**30),
        lambda c: inside(F.regexp_replace(c, "^<[^>]*+>", ""), "td"),
    )
    link = rf'(?s)<a\b[^>]*?\s{class_pattern(layout["link_class"])}[^>]*+>.*?</a>'

    def links_of(cell: Column) -> Column:
        found = F.regexp_extract_all(cell, F.lit(link), F.lit(0))
        return F.transform(found, lambda x, n: F.struct(cell.alias("cell"), x.alias("link"), n.alias("link_no")))

    # Numbered over the whole page, so that two links of one cell have places of their own.
    links = captures.select(
        "seq", case.alias("numero_processo"), attr_value(code_tag, "value").alias("processo"),
        F.posexplode(F.flatten(F.transform(cell_list, links_of))).alias("place", "found"),
    ).select("seq", "place", "numero_processo", "processo", "found.*")
    return links.select(
        place_in_page(F.col("seq"), F.col("place")).alias("seq"),
        F.col("link_no").cast("bigint").alias("link_no"),
        "numero_processo",
        attr_value(F.col("link"), layout["document_attr"]).alias("documento"),
        first_text(F.col("link"), "^[^>]*+>").alias("titulo"),
        first_text(F.col("cell"), r"<span\b[^>]*+>").alias("descricao"),
        attr_value(F.col("link"), layout["origin_attr"]).alias("origem"),
        "processo",
    )


def first_instance(body: Column, label: str) -> dict[str, Column]:
    """Fields of the first-instance table; all blank when the page has none."""
    row = first_row_with_cell(table_after_label(body, label))
    cells = cells_of(row)
    number_and_type = F.coalesce(inner_text(F.get(cells, F.lit(0))), F.lit(""))
    return {
        "n_processo_1_instancia": before_paren(number_and_type),
        "tipo": paren_text(number_and_type),
        "foro": nth_cell(cells, 2),
        "vara": nth_cell(cells, 3),
        "juiz": nth_cell(cells, 4),
        "obs": nth_cell(cells, 5),
    }

"""Markup functions and row generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions import markup
from docketry.functions.links import host
from docketry.functions.text import normalise_space
from docketry.operators import blocks
from docketry.operators.aggregates import search_progress
from docketry.plans import layouts as at
from docketry.plans.pages import current_page, page_kind_flags
from docketry.queries import render
from docketry.queries.common import (
    customer,
    dealt,
    key,
    pages_from,
    priority,
    sql_block_text,
    sql_entities,
    sql_inner_text,
    sql_spaces,
    status,
    table,
    text_of,
)



def orders_table(spark, sf):
    return dealt(table(spark, sf, "orders"))


def prepared_pages(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", "url", markup.prepare(F.col("html")).alias("html"))


def page_profile(spark, sf):
    """Flagship: title, language, links and first paragraph of the first page of each host."""
    pages = table(spark, sf, "pages")
    first = pages.groupBy(host(F.col("url")).alias("host")).agg(F.min("page_id").alias("page_id")).select("page_id")
    chosen = pages.join(first, "page_id", "left_semi").select("page_id", "url", markup.prepare(F.col("html")).alias("html"))
    html = F.col("html")
    paragraph = F.regexp_extract(html, r"(?s)<article>.*?<p>(.*?)</p>", 1)
    return chosen.select(
        F.col("page_id").alias("seq"),
        host(F.col("url")).alias("host"),
        markup.inner_text(F.regexp_extract(html, "(?s)<h1[^>]*>(.*?)</h1>", 1)).alias("title"),
        markup.attr_value(F.regexp_extract(html, "<html[^>]*>", 0), "lang").alias("lang"),
        F.regexp_count(html, F.lit("<a href=")).cast("bigint").alias("links"),
        normalise_space(markup.inner_text(paragraph)).alias("paragraph"),
    )


def inner_text(spark, sf):
    return prepared_pages(spark, sf).select("page_id", markup.inner_text(F.col("html")).alias("text"))


def block_text(spark, sf):
    return prepared_pages(spark, sf).select("page_id", markup.block_text(F.col("html")).alias("text"))


def attr_value(spark, sf):
    tag = F.regexp_extract("html", "<html[^>]*>", 0)
    return table(spark, sf, "pages").select("page_id", markup.attr_value(tag, "lang").alias("lang"))


def tags_joined(spark, sf):
    return prepared_pages(spark, sf).select(
        "page_id", markup.tags_joined(F.col("html"), "ad").alias("ads"), markup.element_texts(F.col("html"), "li").alias("items")
    )


def last_block_text(spark, sf):
    return prepared_pages(spark, sf).select("page_id", markup.last_block_text(F.col("html"), "article", "p").alias("text"))


def anchor_text(spark, sf):
    body = text_of(
        "<html><div id='other'>x</div>",
        render.span_anchor(at.FIRST_CASE_SPAN_ANCHORS["classe"], priority()),
        render.own_anchor(at.FIRST_CASE_OWN_ANCHORS["juiz"], text_of("Juiz ", customer())),
    )
    orders = orders_table(spark, sf).select("o_orderkey", body.alias("body"))
    return orders.select(
        "o_orderkey",
        markup.anchor_text(F.col("body"), at.FIRST_CASE_SPAN_ANCHORS["classe"]).alias("classe"),
        markup.anchor_text(F.col("body"), at.FIRST_CASE_OWN_ANCHORS["juiz"]).alias("juiz"),
        markup.anchor_text(F.col("body"), at.FIRST_CASE_OWN_ANCHORS["vara"]).alias("vara"),
    )


def label_detail(spark, sf):
    block = text_of(
        "<table>", render.labelled_row("Classe/Assunto:", priority()), render.labelled_row("Foro:", text_of("Foro ", customer())), "</table>"
    )
    orders = orders_table(spark, sf).select("o_orderkey", markup.labelled_cells(block).alias("cells"))
    return orders.select(
        "o_orderkey",
        *[
            markup.label_detail(F.col("cells"), label).alias(name)
            for name, label in [("assunto", "Assunto:"), ("foro", "Foro:"), ("vara", "Vara:")]
        ],
    )


def labelled_block(spark, sf):
    container, link = at.RELATED_CONTAINER, r"<a\b[^>]*+>"
    main = text_of('<div><a href="/a?x=', key(), '&amp;y=1">', priority(), "</a></div>")
    body = text_of(
        render.labelled_container("col-md", at.MAIN_CASE_LABEL, "<div><a href='/no'>no</a></div>"),
        render.labelled_container(container, "Outro", "<div><a href='/no'>no</a></div>"),
        F.when(status() != "P", render.labelled_container(container, at.MAIN_CASE_LABEL, main)).otherwise(F.lit("")),
        render.labelled_container(container, at.ATTACHED_CASE_LABEL, "<div></div>"),
        '<span class="unj-label">z</span><a href="/z">z</a>',
    )
    orders = orders_table(spark, sf).select("o_orderkey", body.alias("body"))
    orders = orders.select(
        "o_orderkey",
        markup.labelled_block(F.col("body"), container, at.LABEL_CLASS, at.MAIN_CASE_LABEL).alias("main"),
        markup.labelled_block(F.col("body"), container, at.LABEL_CLASS, at.ATTACHED_CASE_LABEL).alias("attached"),
    )
    return orders.select(
        "o_orderkey",
        markup.value_text(F.col("main"), link).alias("principal"),
        markup.attr_value(F.col("main"), "href").alias("href"),
        markup.value_text(F.col("attached"), link).alias("apensado"),
    )


def link_text_by_title(spark, sf):
    block = render.decision_block(text_of("<b>", key(), "</b>-", status()), [("Classe:", priority())], "x")
    return orders_table(spark, sf).select(
        "o_orderkey", markup.link_text_by_title(block, at.FULL_TEXT_TITLE).alias("numero"),
        markup.link_text_by_title(block, "Outro").alias("outro"),
    )


def nth_cell(spark, sf):
    row = text_of("<tr><td>\n", key(), "</td><td> ", status(), "<b>x</b></td><td class='c'>", priority(), "\n</td></tr>")
    cells = markup.cells_of(row)
    return orders_table(spark, sf).select(
        "o_orderkey", *[markup.nth_cell(cells, n).alias(f"cell_{n}") for n in (1, 2, 3, 4)]
    )


def table_after_label(spark, sf):
    body = text_of("<p>", render.first_instance_tables(priority(), customer()), "<table><tr><td>late</td></tr></table>")
    inside = markup.table_after_label(body, at.FIRST_INSTANCE_LABEL)
    return orders_table(spark, sf).select(
        "o_orderkey", markup.inner_text(inside, "|").alias("text"), markup.table_after_label(body, "Outro").alias("other")
    )


def script_param(spark, sf):
    parameters = text_of("doc=", F.col("doc_id"), "&lang=", F.col("lang"), "&src=", F.col("source"))
    body = F.when(F.col("lang") == "de", F.lit("<html><script>var x = 1;</script></html>")).otherwise(render.viewer_page(parameters))
    return table(spark, sf, "documents").select("doc_id", markup.script_param(body, at.VIEWER_PARAM).alias("parameters"))


def fallback_text(spark, sf):
    linked = F.when(status() == "P", F.lit(" ")).otherwise(status())
    cell = text_of("\n", priority(), "<a>", linked, "</a>")
    link = F.trim(F.regexp_extract(cell, "<a>([^<]*)", 1))
    own = F.regexp_extract(cell, r"^\s*([^<]*)", 1)
    return orders_table(spark, sf).select("o_orderkey", markup.fallback_text(link, own).alias("title"))


def result_blocks(spark, sf):
    body = render.result_page(render.first_decision_blocks(), anchored=True)
    captures = pages_from(table(spark, sf, "orders"), at.FIRST_SEARCH, body, "o_orderkey")
    # Every nested table has a place, the small one inside a decision too.
    found = blocks.result_blocks(captures.select("seq", "body"), at.RESULTS_ID).filter(
        blocks.is_decision(F.col("block"), at.FULL_TEXT_TITLE)
    )
    return found.select("seq", markup.link_text_by_title(F.col("block"), at.FULL_TEXT_TITLE).alias("numero_processo"))


def movements_explode(spark, sf):
    rows = render.movement_table(
        "<tr><th>Data</th></tr>",
        render.movement_row(F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus"), linked=True),
        F.replace(render.movement_row(F.col("l_suppkey"), F.col("l_partkey"), "&eacute; " , linked=False), F.lit("</tr>"), F.lit("")),
    )
    captures = pages_from(table(spark, sf, "lineitem"), at.FIRST_CASE, rows, "l_orderkey", F.col("l_orderkey"))
    found = blocks.movements(captures, F.try_element_at("meta", F.lit("numero_processo")), at.MOVEMENTS)
    return found.select("numero_processo", "data", "titulo", "descricao")


def _party_pages(spark, sf):
    cells = text_of(
        "<table><tr>",
        render.party_cell(F.col("c_name"), [F.col("c_mktsegment"), text_of("Dra. ", F.col("c_nationkey"))]),
        "</tr><tr>",
        F.when(F.col("c_mktsegment") != "BUILDING", render.party_cell(text_of("R&eacute;u ", F.col("c_custkey")), [])).otherwise(F.lit("")),
        "</tr></table>",
    )
    return dealt(table(spark, sf, "customer")).select("c_custkey", blocks.parties(markup.prepare(cells), at.PARTY_CLASS).alias("parties"))


def parties_split(spark, sf):
    rows = _party_pages(spark, sf).select("c_custkey", F.posexplode("parties").alias("place", "party"))
    return rows.select(
        "c_custkey", F.col("place").cast("bigint").alias("place"),
        F.array_join("party.nomes_parte", "|").alias("nomes"), F.array_join("party.advogados_parte", "|").alias("advogados"),
    )


def parties_wide(spark, sf):
    party = F.col("parties")
    return _party_pages(spark, sf).select(
        "c_custkey",
        *[
            blocks.party_at(party, place, field).alias(f"{name}_{place + 1}")
            for place in (0, 1)
            for name, field in [("nomes", "nomes_parte"), ("advogados", "advogados_parte")]
        ],
    )


def doc_links(spark, sf):
    body = text_of(
        '<input type="hidden" name="cdProcesso" value="', customer(), '">',
        render.document_link(text_of("0", key()), status(), priority(), text_of("desc ", customer())),
        render.document_link(text_of("1", key()), "2&ordf;", "Outro", ""),
    )
    captures = pages_from(table(spark, sf, "orders"), at.SECOND_CASE, body, "o_orderkey", key())
    found = blocks.document_links(captures, F.try_element_at("meta", F.lit("numero_processo")), at.DOCUMENT_LINKS)
    return found.drop("seq", "link_no")


def page_kind(spark, sf):
    listed = F.when(status() == "P", render.case_list(key())).otherwise(F.lit('<p class="modal__lista-processos__vazia">'))
    body = text_of(listed, render.pager(at.FIRST_SEARCH, key(), priority() == "1-URGENT"))
    flags = page_kind_flags(F.col("body"))
    orders = orders_table(spark, sf).select("o_orderkey", body.alias("body"))
    return orders.select("o_orderkey", *[flag.cast("bigint").alias(name) for name, flag in flags.items()])


def crawl_progress(spark, sf):
    first = text_of(render.pager(at.FIRST_SEARCH, key(), priority() == "1-URGENT"), "x")
    second = text_of(render.pager(at.SECOND_SEARCH, customer(), F.lit(False)), "x")
    body = F.when(status() == "P", F.lit("no pager")).when(status() == "O", second).otherwise(first)
    kind = F.when(status() == "O", at.SECOND_SEARCH).otherwise(at.FIRST_SEARCH)
    captures = pages_from(table(spark, sf, "orders"), kind, body, "o_orderkey")
    page_no = current_page(F.col("body"), F.col("request_kind")).cast("bigint")
    progress = search_progress(captures, page_no, page_kind_flags()["has_next"])
    return progress.withColumn("has_next", F.col("has_next").cast("bigint"))


SQL_LINKS = "(length(html) - length(replace(html, '<a href=', ''))) // 8"

QUERIES = {
    "page_profile": (
        page_profile,
        f"""WITH p AS (SELECT *, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages),
            f AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS rn FROM p)
            SELECT page_id AS seq, host, {sql_inner_text("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS title,
            regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang, CAST({SQL_LINKS} AS BIGINT) AS links,
            {sql_spaces(sql_inner_text("regexp_extract(html, '(?s)<article>.*?<p>(.*?)</p>', 1)"))} AS paragraph
            FROM f WHERE rn = 1""",
    ),
    "inner_text": (inner_text, f"SELECT page_id, {sql_inner_text('html')} AS text FROM pages"),
    "block_text": (block_text, f"SELECT page_id, {sql_block_text('html')} AS text FROM pages"),
    "attr_value": (attr_value, """SELECT page_id, regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang FROM pages"""),
    "tags_joined": (
        tags_joined,
        f"""SELECT page_id,
            {sql_entities("trim(array_to_string(regexp_extract_all(html, 'class=.ad.[^>]*>([^<]*)', 1), '|'))")} AS ads,
            array_to_string(list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1),
            lambda x: {sql_inner_text('x')}), '|') AS items FROM pages""",
    ),
    "last_block_text": (
        last_block_text,
        f"""SELECT page_id, CASE WHEN contains(rest, '<p') THEN
            {sql_spaces(sql_inner_text("regexp_extract(string_split(rest, '<p')[-1], '(?s)^[^>]*>(.*?)(?:</p>|$)', 1)"))}
            ELSE '' END AS text FROM (SELECT page_id, string_split(html, '<article')[-1] AS rest FROM pages)""",
    ),
    "anchor_text": (
        anchor_text,
        "SELECT o_orderkey, o_orderpriority AS classe, 'Juiz ' || o_custkey AS juiz, '' AS vara FROM orders",
    ),
    "label_detail": (
        label_detail,
        "SELECT o_orderkey, o_orderpriority AS assunto, 'Foro ' || o_custkey AS foro, '' AS vara FROM orders",
    ),
    "labelled_block": (
        labelled_block,
        """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS principal,
           CASE WHEN o_orderstatus <> 'P' THEN '/a?x=' || o_orderkey || '&y=1' ELSE '' END AS href, '' AS apensado FROM orders""",
    ),
    "link_text_by_title": (
        link_text_by_title,
        "SELECT o_orderkey, o_orderkey || '-' || o_orderstatus AS numero, '' AS outro FROM orders",
    ),
    "nth_cell": (
        nth_cell,
        """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS cell_1, o_orderstatus AS cell_2, o_orderpriority AS cell_3,
           '' AS cell_4 FROM orders""",
    ),
    "table_after_label": (
        table_after_label,
        "SELECT o_orderkey, 'h|' || o_orderpriority || '|' || o_custkey AS text, '' AS other FROM orders",
    ),
    "script_param": (
        script_param,
        """SELECT doc_id, CASE WHEN lang <> 'de' THEN 'doc=' || doc_id || '&lang=' || lang || '&src=' || source END
           AS parameters FROM documents""",
    ),
    "fallback_text": (
        fallback_text,
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_orderstatus END AS title FROM orders",
    ),
    "result_blocks": (
        result_blocks,
        """SELECT o_orderkey * 268435456 AS seq, CAST(o_orderkey AS VARCHAR) AS numero_processo FROM orders
           UNION ALL SELECT o_orderkey * 268435456 + 2, o_orderkey || '-R' FROM orders""",
    ),
    "movements_explode": (
        movements_explode,
        """SELECT CAST(l_orderkey AS VARCHAR) AS numero_processo, '' AS data, '' AS titulo, '' AS descricao FROM lineitem
           UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag, l_linestatus FROM lineitem
           UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_partkey AS VARCHAR), 'é' FROM lineitem""",
    ),
    "parties_split": (
        parties_split,
        """SELECT c_custkey, CAST(0 AS BIGINT) AS place, c_name AS nomes, c_mktsegment || '|Dra. ' || c_nationkey AS advogados
           FROM customer UNION ALL SELECT c_custkey, 1, 'Réu ' || c_custkey, '' FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    ),
    "parties_wide": (
        parties_wide,
        """SELECT c_custkey, c_name AS nomes_1, c_mktsegment || '|Dra. ' || c_nationkey AS advogados_1,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Réu ' || c_custkey ELSE '' END AS nomes_2, '' AS advogados_2 FROM customer""",
    ),
    "doc_links": (
        doc_links,
        """SELECT CAST(o_orderkey AS VARCHAR) AS numero_processo, '0' || o_orderkey AS documento, o_orderpriority AS titulo,
           'desc ' || o_custkey AS descricao, o_orderstatus AS origem, CAST(o_custkey AS VARCHAR) AS processo FROM orders
           UNION ALL SELECT CAST(o_orderkey AS VARCHAR), '1' || o_orderkey, 'Outro', '', '2ª', CAST(o_custkey AS VARCHAR) FROM orders""",
    ),
    "page_kind_flags": (
        page_kind,
        """SELECT o_orderkey, CAST(o_orderstatus = 'P' AS BIGINT) AS has_case_list,
           CAST(o_orderpriority = '1-URGENT' AS BIGINT) AS has_next FROM orders""",
    ),
    "crawl_progress": (
        crawl_progress,
        """SELECT CASE WHEN o_orderstatus = 'O' THEN 'second_search' ELSE 'first_search' END AS request_kind,
           max(CASE o_orderstatus WHEN 'O' THEN o_custkey WHEN 'F' THEN o_orderkey END) AS last_page, count(*) AS pages,
           CAST(bool_or(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS BIGINT) AS has_next FROM orders GROUP BY 1""",
    ),
}

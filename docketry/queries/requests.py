"""Next-request tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.plans import layouts as at
from docketry.plans import records, requests
from docketry.queries import render
from docketry.queries.common import BASE, customer, key, pages_from, priority, status, table, text_of
from docketry.queries.records import first_case_captures
from docketry.queries.tables import CASES_SQL, case_table

UNTIL = "09/02/2024"


def sql_fill(template: str, **values: str) -> str:
    """The SQL text expression for a template filled with expressions."""
    text = f"'{BASE}{template}'"
    for name, value in values.items():
        text = text.replace("{" + name + "}", f"' || {value} || '")
    return text


def search_requests(spark, sf):
    searches = table(spark, sf, "part").select(F.col("p_partkey").alias("seq"), text_of('"', F.col("p_name"), '" OU "1/2"').alias("search"))
    both = requests.union_requests(
        requests.first_search_requests(searches, BASE, UNTIL), requests.second_search_requests(searches, BASE)
    )
    return both.select("seq", "kind", "url", "request_id")


def next_page(spark, sf):
    first = text_of("<p>", render.pager(at.FIRST_SEARCH, key(), priority() != "5-LOW"))
    second = text_of("<p>", render.pager(at.SECOND_SEARCH, customer(), priority() != "5-LOW"))
    unnumbered = text_of("<p>", render.pager(at.FIRST_SEARCH, "", F.lit(True)))
    body = F.when(status() == "F", first).when(status() == "O", second).otherwise(unnumbered)
    kind = F.when(status() == "O", at.SECOND_SEARCH).otherwise(at.FIRST_SEARCH)
    captures = pages_from(table(spark, sf, "orders"), kind, body, "o_orderkey")
    return requests.next_page_requests(captures, BASE, BASE).select("seq", "kind", "url")


def case_requests(spark, sf):
    work = case_table(spark, sf)
    both = requests.union_requests(
        requests.case_requests(work, BASE, at.FIRST_CASE), requests.case_requests(work, BASE, at.SECOND_CASE)
    )
    return both.select("seq", "kind", "url", F.try_element_at("meta", F.lit("numero_processo")).alias("numero_processo"))


def batch_requests(spark, sf):
    return requests.batch_requests(case_table(spark, sf), BASE).select("seq", "kind", "url")


def follow_ups(spark, sf):
    rows = requests.follow_ups(first_case_captures(spark, sf), at.FIRST_CASE, BASE)
    return rows.select("seq", "url", F.try_element_at("meta", F.lit("numero_processo")).alias("numero_processo"))


def doc_requests(spark, sf):
    page = text_of(
        '<input name="cdProcesso" value="', customer(), '">',
        F.when(status() == "P", F.lit("<p>none</p>")).otherwise(render.document_link(key(), status(), priority(), "d")),
        render.document_link(text_of("0", key()), "R", " ", "e"),
    )
    captures = pages_from(table(spark, sf, "orders"), at.SECOND_CASE, page, "o_orderkey", key())
    rows = requests.doc_requests(records.document_links(captures), BASE)
    names = ["numero_processo", "documento", "titulo", "descricao"]
    return rows.select("url", *[F.try_element_at("meta", F.lit(n)).alias(n) for n in names])


def viewer_requests(spark, sf):
    address = F.when(status() != "P", text_of("https://viewer.example.org/open?doc=", key())).otherwise(F.lit(" \n"))
    captures = pages_from(table(spark, sf, "orders"), at.DOC_ACCESS, address, "o_orderkey", key())
    good, bad = requests.viewer_requests(captures)
    shown = good.select("seq", "kind", "url", F.try_element_at("meta", F.lit("numero_processo")).alias("numero_processo"))
    return shown.unionByName(bad.select("seq", F.col("reason").alias("kind")), allowMissingColumns=True)


def pdf_requests(spark, sf):
    page = F.when(status() == "P", F.lit("<script>{}</script>")).otherwise(render.viewer_page(text_of("id=", key(), "&k=", customer())))
    captures = pages_from(table(spark, sf, "orders"), at.DOC_VIEWER, page, "o_orderkey", key())
    good, bad = requests.pdf_requests(captures, BASE)
    return good.select("seq", "url").unionByName(bad.select("seq", F.col("reason").alias("url")))


def _search_sql(name: str, template: str) -> str:
    phrase = "'%22' || replace(p_name, ' ', '%20') || '%22%20OU%20%221/2%22'"
    url = sql_fill(template, search=phrase, until="'09%2F02%2F2024'")
    return f"SELECT p_partkey AS seq, '{name}' AS kind, {url} AS url FROM part"


QUERIES = {
    "search_requests": (
        search_requests,
        f"""SELECT seq, kind, url, sha256(kind || ' ' || url) AS request_id FROM (
            {_search_sql(at.FIRST_SEARCH, at.FIRST_SEARCH_QUERY)} UNION ALL {_search_sql(at.SECOND_SEARCH, at.SECOND_SEARCH_QUERY)})""",
    ),
    "next_page": (
        next_page,
        f"""SELECT o_orderkey AS seq, CASE o_orderstatus WHEN 'O' THEN 'second_search' ELSE 'first_search' END AS kind,
            CASE o_orderstatus WHEN 'O' THEN {sql_fill(at.SECOND_NEXT_PAGE, page="CAST(o_custkey + 1 AS VARCHAR)")}
            ELSE {sql_fill(at.FIRST_NEXT_PAGE, page="CAST(o_orderkey + 1 AS VARCHAR)")} END AS url FROM orders
            WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    ),
    "case_requests": (
        case_requests,
        f"""WITH {CASES_SQL} SELECT seq, k.kind, {sql_fill(at.LISTED_CASE_QUERY, case="numero_processo")} AS url, numero_processo
            FROM cases, (VALUES ('first_case'), ('second_case')) k(kind) WHERE numero_processo IS NOT NULL""",
    ),
    "batch_requests": (
        batch_requests,
        f"""WITH {CASES_SQL} SELECT min(seq) AS seq, 'first_case' AS kind,
            {sql_fill(at.ONE_CASE_QUERY, case="numero_processo")} AS url FROM cases
            WHERE numero_processo IS NOT NULL GROUP BY numero_processo""",
    ),
    "follow_ups": (
        follow_ups,
        f"""SELECT o_orderkey AS seq, {sql_fill(at.SHOW_CASE_QUERY, code="o_orderkey")} AS url,
            CAST(o_orderkey AS VARCHAR) AS numero_processo FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "doc_requests": (
        doc_requests,
        f"""SELECT {sql_fill(at.DOC_ACCESS_QUERY, document="o_orderkey", origin="o_orderstatus", process="o_custkey")} AS url,
            CAST(o_orderkey AS VARCHAR) AS numero_processo, CAST(o_orderkey AS VARCHAR) AS documento, o_orderpriority AS titulo,
            'd' AS descricao FROM orders WHERE o_orderstatus <> 'P'
            UNION ALL SELECT {sql_fill(at.DOC_ACCESS_QUERY, document="'0' || o_orderkey", origin="'R'", process="o_custkey")},
            CAST(o_orderkey AS VARCHAR), '0' || o_orderkey, '', 'e' FROM orders""",
    ),
    "viewer_requests": (
        viewer_requests,
        """SELECT o_orderkey AS seq, 'doc_viewer' AS kind, 'https://viewer.example.org/open?doc=' || o_orderkey AS url,
           CAST(o_orderkey AS VARCHAR) AS numero_processo FROM orders WHERE o_orderstatus <> 'P'
           UNION ALL SELECT o_orderkey, 'no viewer address', NULL, NULL FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "pdf_requests": (
        pdf_requests,
        f"""SELECT o_orderkey AS seq, CASE WHEN o_orderstatus = 'P' THEN 'no viewer parameter' ELSE
            {sql_fill(at.DOC_FILE_QUERY, parameters="'id=' || o_orderkey || '&k=' || o_custkey")} END AS url FROM orders""",
    ),
}

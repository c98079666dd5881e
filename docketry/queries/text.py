"""Text, map, link and predicate functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions import links, maps, predicates, text
from docketry.functions.links import SECOND_DEGREE_PARAMS
from docketry.functions.markup import attr_value
from docketry.operators.documents import document_id
from docketry.plans.pages import from_page
from docketry.queries.common import BASE, sql_spaces, sql_strip, table, text_of

ODD_SPACE = "\u2003\u00a0 \t"


def documents(spark, sf):
    return table(spark, sf, "documents")


def normalise_space(spark, sf):
    return documents(spark, sf).select("doc_id", text.normalise_space(F.col("text")).alias("text"))


def strip_unicode(spark, sf):
    padded = text_of(ODD_SPACE, F.col("text"), ODD_SPACE)
    return documents(spark, sf).select("doc_id", text.strip_space(padded).alias("text"))


def blank_default(spark, sf):
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    null_status = text.blank_to_null(status)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.or_blank(null_status).alias("or_blank"),
        F.coalesce(null_status, F.lit("(null)")).alias("or_null"),
        text.first_filled(status, F.col("o_orderpriority")).alias("filled"),
    )


def delete_chars(spark, sf):
    return documents(spark, sf).select("doc_id", text.delete_chars(F.col("text")).alias("text"))


def strip_label(spark, sf):
    label = (
        F.when(F.col("o_orderstatus") == "F", "Advogado: ").when(F.col("o_orderstatus") == "O", "Advogada:").otherwise("")
    )
    labelled = text_of(label, F.col("o_orderpriority"), ODD_SPACE)
    return table(spark, sf, "orders").select("o_orderkey", text.strip_lawyer_label(labelled).alias("lawyer"))


def drop_parens(spark, sf):
    made = text_of(F.col("o_orderpriority"), "  (", F.col("o_orderstatus"), ") ", F.col("o_custkey"), "(x)(y)")
    return table(spark, sf, "orders").select("o_orderkey", text.drop_parens(made).alias("text"))


def paren_parts(spark, sf):
    typed = text_of(F.col("o_custkey"), " (", F.col("o_orderpriority"), ") (", F.col("o_orderstatus"), ")")
    made = F.when(F.col("o_orderstatus") == "P", text_of(F.col("o_custkey"), " (open")).otherwise(typed)
    return table(spark, sf, "orders").select(
        "o_orderkey", text.before_paren(made).alias("number"), text.paren_text(made).alias("kind")
    )


def clean_document(spark, sf):
    return documents(spark, sf).select("doc_id", text.clean_document(F.col("text")).alias("text"))


def query_params(spark, sf):
    params = table(spark, sf, "pages").select("page_id", F.explode(maps.query_params(F.col("url"))).alias("name", "value"))
    return params.select("page_id", "name", "value")


def cookie_map(spark, sf):
    def header(name, *value):
        return F.struct(F.lit(name).alias("name"), text_of(*value).alias("value"))

    headers = F.array(
        header("Set-Cookie", "session=", F.col("o_custkey"), "; Path=/; HttpOnly"),
        header("Content-Type", "kind=html"),
        header("set-cookie", "token=a=", F.col("o_orderpriority")),
        header("Set-Cookie", "session=", F.col("o_orderkey"), "; Path=/"),
    )
    found = table(spark, sf, "orders").select("o_orderkey", maps.cookies(headers).alias("jar"))
    return found.select("o_orderkey", F.explode("jar").alias("name", "value"))


def quote_text(spark, sf):
    return documents(spark, sf).select("doc_id", links.quote_text(F.col("text")).alias("quoted"))


def absolute_link(spark, sf):
    link = links.absolute_link(BASE, attr_value(F.col("html"), "href"))
    blank = links.absolute_link(BASE, F.lit(""))
    return table(spark, sf, "pages").select("page_id", link.alias("link"), F.coalesce(blank, F.lit("(null)")).alias("no_link"))


def _second_degree_href():
    values = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.lit("S")]
    pairs = [text_of(f"{n}=", v) for n, v in zip(SECOND_DEGREE_PARAMS, values)]
    short = F.concat_ws("&", *pairs[:3], F.lit("isProcessoOrigemCr="))
    return F.when(F.col("o_orderstatus") == "P", text_of("/open.do?", short)).otherwise(
        text_of("/open.do?x=1&", F.concat_ws("&", *pairs[::-1]))
    )


def rebuild_link(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", links.rebuild_link(BASE, _second_degree_href()).alias("link"))


def required_params(spark, sf):
    complete = links.required_params(maps.query_params(_second_degree_href()), SECOND_DEGREE_PARAMS)
    return table(spark, sf, "orders").filter(complete).select("o_orderkey", "o_custkey")


def host_filter(spark, sf):
    pages = table(spark, sf, "pages").filter(links.host_allowed(F.col("url"), ["example.com"]))
    return pages.select("page_id", links.host(F.col("url")).alias("host"))


def url_suffix(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        links.has_suffix(F.col("url"), ".html").cast("bigint").alias("is_html"),
        links.has_suffix(F.col("url")).cast("bigint").alias("is_pdf"),
    )


SEARCH = '"prueba" OU "était" OU "que é"'


def any_phrase(spark, sf):
    return documents(spark, sf).filter(predicates.any_phrase(F.col("text"), predicates.phrases_of(SEARCH))).select("doc_id", "lang")


def date_upper_bound(spark, sf):
    shown = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "sem data").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("shown"),
    )
    return shown.filter(predicates.until_date(F.col("shown"), "1998-02-09"))


def from_page_query(spark, sf):
    turns = table(spark, sf, "conversations")
    return from_page(turns, 3, F.col("turn")).select("conv_id", "turn", "role")


def case_lookup(spark, sf):
    orders = table(spark, sf, "orders").filter(F.col("o_custkey") == 77)
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus")


def doc_complete(spark, sf):
    complete = predicates.document_complete(
        F.col("o_custkey"), F.col("o_orderstatus"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), 77, "F"
    )
    flagged = table(spark, sf, "orders").select(complete.cast("bigint").alias("complete"))
    return flagged.groupBy("complete").agg(F.count("*").alias("n"))


def document_id_query(spark, sf):
    return documents(spark, sf).select("doc_id", document_id(F.col("text").cast("binary")).alias("pdf_name"))


def class_subject(spark, sf):
    combined = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        text_of(F.col("o_orderstatus"), " / ", F.col("o_orderpriority"), "/ ", F.col("o_custkey"), " ")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.first_slash_part(combined, F.lit(" alone ")).alias("classe"),
        text.later_slash_parts(combined).alias("assunto"),
    )


def sql_clean(x: str) -> str:
    return sql_spaces(f"translate({sql_spaces(x)}, ';,''\"' || chr(13), '')")


QUERIES = {
    "normalise_space": (normalise_space, f"SELECT doc_id, {sql_spaces('text')} AS text FROM documents"),
    "strip_unicode": (strip_unicode, f"SELECT doc_id, {sql_strip('text')} AS text FROM documents"),
    "blank_default": (
        blank_default,
        """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS or_blank,
                  CASE WHEN o_orderstatus = 'P' THEN '(null)' ELSE o_orderstatus END AS or_null,
                  CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_orderstatus END AS filled FROM orders""",
    ),
    "delete_chars": (
        delete_chars,
        "SELECT doc_id, replace(replace(replace(text, chr(10), ''), chr(9), ''), chr(160), '') AS text FROM documents",
    ),
    "strip_label": (strip_label, "SELECT o_orderkey, o_orderpriority AS lawyer FROM orders"),
    "drop_parens": (drop_parens, "SELECT o_orderkey, o_orderpriority || CAST(o_custkey AS VARCHAR) AS text FROM orders"),
    "paren_parts": (
        paren_parts,
        """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderstatus = 'P' THEN ' (open' ELSE '' END AS number,
                  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS kind FROM orders""",
    ),
    "clean_document": (clean_document, f"SELECT doc_id, {sql_clean('text')} AS text FROM documents"),
    "query_params": (
        query_params,
        """SELECT page_id, split_part(part, '=', 1) AS name, split_part(part, '=', 2) AS value
           FROM (SELECT page_id, unnest(string_split(split_part(url, '?', 2), '&')) AS part FROM pages)
           WHERE contains(part, '=')""",
    ),
    "cookie_map": (
        cookie_map,
        """SELECT o_orderkey, 'session' AS name, CAST(o_orderkey AS VARCHAR) AS value FROM orders
           UNION ALL SELECT o_orderkey, 'token', 'a=' || o_orderpriority FROM orders""",
    ),
    "quote_text": (quote_text, "SELECT doc_id, replace(url_encode(text), '%2F', '/') AS quoted FROM documents"),
    "absolute_link": (
        absolute_link,
        f"""SELECT page_id, '{BASE}' || nullif(regexp_extract(html, 'href="([^"]*)"', 1), '') AS link,
                   '(null)' AS no_link FROM pages""",
    ),
    "rebuild_link": (
        rebuild_link,
        f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE
                   '{BASE}/abrirConsultaProcessoSG.do?nuProcesso=' || o_orderkey || '&cdProcessoSg=' || o_custkey ||
                   '&cdForoSg=' || o_orderstatus || '&isProcessoOrigemCr=S' END AS link FROM orders""",
    ),
    "required_params": (required_params, "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'"),
    "host_filter": (
        host_filter,
        r"""SELECT page_id, host FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages)
            WHERE host = 'example.com' OR ends_with(host, '.example.com')""",
    ),
    "url_suffix": (
        url_suffix,
        """SELECT page_id, CAST(ends_with(url, '.html') AS BIGINT) AS is_html,
                  CAST(ends_with(url, '.pdf') AS BIGINT) AS is_pdf FROM pages""",
    ),
    "any_phrase": (
        any_phrase,
        """SELECT doc_id, lang FROM documents WHERE contains(strip_accents(lower(text)), 'prueba')
           OR contains(strip_accents(lower(text)), 'etait') OR contains(strip_accents(lower(text)), 'que e')""",
    ),
    "date_upper_bound": (
        date_upper_bound,
        """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS shown FROM orders
           WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) <= DATE '1998-02-09'""",
    ),
    "from_page": (from_page_query, "SELECT conv_id, turn, role FROM conversations WHERE turn >= 3"),
    "case_lookup": (case_lookup, "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey = 77"),
    "doc_complete": (
        doc_complete,
        """SELECT CAST(o_custkey = 77 AND o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' AS BIGINT) AS complete,
                  count(*) AS n FROM orders GROUP BY 1""",
    ),
    "document_id": (document_id_query, "SELECT doc_id, sha256(text) AS pdf_name FROM documents"),
    "class_subject": (
        class_subject,
        """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'alone' ELSE o_orderstatus END AS classe,
                  CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
                       ELSE o_orderpriority || '| ' || CAST(o_custkey AS VARCHAR) END AS assunto FROM orders""",
    ),
}

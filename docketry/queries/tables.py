"""Sources, sinks, write modes, joins, aggregates and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions.predicates import date_of
from docketry.operators import aggregates, joins, writes
from docketry.operators.documents import case_documents, decode_pages, utf8_pages
from docketry.queries.common import day, sql_inner_text, table, text_of
from docketry.queries.text import sql_clean
from docketry.functions.markup import inner_text
from docketry.session import work_dir
from docketry.sources.captures import as_captures, decode_body
from docketry.sources.files import store_files
from docketry.sources.tables import read_csv, read_table, string_schema, work_list, write_csv



def case_table(spark, sf, *extra):
    """Orders as cases: several rows per customer, one priority without a key."""
    key = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey").cast("string"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"),
        key.alias("numero_processo"),
        F.col("o_orderstatus").alias("situacao"),
        F.col("o_orderpriority").alias("classe"),
        *extra,
    )


CASES_SQL = """cases AS (SELECT o_orderkey AS seq,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS VARCHAR) END AS numero_processo,
    o_orderstatus AS situacao, o_orderpriority AS classe, strftime(o_orderdate, '%d/%m/%Y') AS dia FROM orders)"""


def captures_scan(spark, sf):
    pages = table(spark, sf, "pages")
    captures = as_captures(pages, kind="first_case", body=F.col("html"), seq=F.col("page_id"), url=F.col("url"))
    return captures.select("capture_id", "request_kind", "url", "body", "seq")


def csv_lines(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment")
    path = work_dir(spark, "csv-lines")
    write_csv(rows, path)
    return read_csv(spark, path, rows.columns)


def decode_latin1(spark, sf):
    # Bytes 0x80 and 0x93 to 0x97, a euro sign and curly quotes to long dash, before each URL.
    return table(spark, sf, "pages").select(
        "page_id",
        decode_body(F.concat(F.unhex(F.lit("809394959697")), F.encode("url", "ISO-8859-1"))).alias("url"),
        decode_body(F.encode("html", "UTF-8"), "UTF-8").alias("html"),
    )


def csv_roundtrip(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source")
    path = work_dir(spark, "csv")
    write_csv(rows, path)
    back = read_csv(spark, path, rows.columns, line_breaks=True)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source")


def worklist(spark, sf):
    return work_list(case_table(spark, sf).filter(aggregates.filled_key(["numero_processo"])))


def empty_target(spark, sf):
    new = case_table(spark, sf)
    missing = read_table(spark, work_dir(spark, "missing"), string_schema(["numero_processo", "situacao", "classe"]))
    return writes.insert_if_absent(missing, new)


def _stored_and_new(spark, sf, *extra):
    cases = case_table(spark, sf, *extra)
    return cases.filter(F.col("situacao") == "F"), cases.filter(F.col("situacao") != "F")


def append_union(spark, sf):
    stored, new = _stored_and_new(spark, sf, day("o_orderdate").alias("dia"))
    return writes.append(stored.drop("dia"), new.drop("classe"))


def insert_if_absent(spark, sf):
    stored, new = _stored_and_new(spark, sf)
    return writes.insert_if_absent(stored, new)


def upsert_latest(spark, sf):
    stored, new = _stored_and_new(spark, sf)
    blanked = new.withColumn("classe", F.when(F.col("situacao") != "P", F.col("classe")))
    return writes.upsert(stored, blanked)


def upsert_widen(spark, sf):
    stored, new = _stored_and_new(spark, sf, day("o_orderdate").alias("dia"))
    return writes.upsert(stored.drop("dia"), new.drop("classe"))


def _documents(spark, sf):
    """Line items as documents of a case; the position follows from columns that tell rows of one key apart."""
    place = (F.col("l_partkey") * 100000 + F.col("l_suppkey")) * 100000 + F.datediff("l_shipdate", F.lit("1970-01-01"))
    return table(spark, sf, "lineitem").select(
        place.alias("seq"),
        F.col("l_orderkey").cast("string").alias("numero_processo"),
        F.col("l_linenumber").cast("string").alias("documento"),
        F.col("l_returnflag").alias("titulo"),
        F.col("l_linestatus").alias("descricao"),
    )


DOCUMENTS_SQL = """docs AS (SELECT (l_partkey * 100000 + l_suppkey) * 100000 +
    date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS seq, CAST(l_orderkey AS VARCHAR) AS numero_processo,
    CAST(l_linenumber AS VARCHAR) AS documento, l_returnflag AS titulo, l_linestatus AS descricao FROM lineitem)"""


def upsert_composite(spark, sf):
    documents = _documents(spark, sf)
    stored, new = documents.filter(F.col("titulo") == "N"), documents.filter(F.col("titulo") != "N")
    return writes.upsert(stored, new, writes.DOCUMENT_KEY)


def stored_files(spark, sf):
    """Texts as files, those in English first and then all of them."""
    files = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("url"), F.encode("text", "UTF-8").alias("content"), "lang"
    )
    path = work_dir(spark, "files")
    store_files(files.filter("lang = 'en'").drop("lang"), path)
    store_files(files.drop("lang"), path)
    return spark.read.parquet(path).select("pdf_name", "url", F.octet_length("content").cast("bigint").alias("n_bytes"))


def pending_cases(spark, sf):
    stored = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    keys = stored.select(F.col("c_custkey").cast("string").alias("numero_processo"))
    return joins.pending(work_list(case_table(spark, sf)), keys, ["numero_processo"])


def known_cases(spark, sf):
    stored = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    keys = stored.select(F.col("c_custkey").cast("string").alias("numero_processo"))
    return joins.known(work_list(case_table(spark, sf)), keys, ["numero_processo"])


def pending_documents(spark, sf):
    documents = _documents(spark, sf)
    stored = documents.filter(F.col("titulo") == "R")
    return joins.pending(documents, stored, writes.DOCUMENT_KEY).select("seq", *writes.DOCUMENT_KEY)


def resume_after(spark, sf):
    work = work_list(case_table(spark, sf))
    stored = case_table(spark, sf).filter((F.col("situacao") == "F") & F.col("numero_processo").isNotNull())
    return joins.resume_after(work, stored)


def request_context(spark, sf):
    captures = table(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("request_id"))
    requests = table(spark, sf, "customer").select(F.col("c_custkey").alias("request_id"), "c_name", "c_mktsegment")
    return joins.with_context(captures, requests)


def distinct_keys(spark, sf):
    return aggregates.distinct_keys(case_table(spark, sf).filter(F.col("numero_processo").isNotNull()))


def last_key(spark, sf):
    return aggregates.last_key(case_table(spark, sf).filter(F.col("numero_processo").isNotNull()))


def any_match(spark, sf):
    cases = case_table(spark, sf)
    some = aggregates.any_match(cases, (F.col("numero_processo") == "77") & (F.col("situacao") == "F"))
    none = aggregates.any_match(cases, F.col("situacao") == "X")
    both = some.select(F.lit("some").alias("test"), "found").union(none.select(F.lit("none"), "found"))
    return both.select("test", F.col("found").cast("bigint").alias("found"))


def document_text(spark, sf):
    pages = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("page_no"), "text")
    return aggregates.document_text(pages, ["conv_id"])


def document_text_hot(spark, sf):
    """A third of all pages belongs to one document."""
    document = F.when(F.col("conv_id") % 3 == 0, F.lit(0)).otherwise(F.col("conv_id"))
    pages = table(spark, sf, "conversations").select(document.alias("document"), (F.col("conv_id") * 1000 + F.col("turn")).alias("page_no"), "text")
    return aggregates.document_text(pages, ["document"])


def case_documents_query(spark, sf):
    pages = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), F.col("turn").alias("page_no"), "text")
    links = table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"),
        F.sha2(F.col("text").cast("binary"), 256).alias("pdf_name"),
        text_of("case-", F.col("doc_id")).alias("numero_processo"),
        F.col("doc_id").cast("string").alias("documento"),
        F.col("lang").alias("titulo"),
        F.col("source").alias("descricao"),
        F.col("n_chars").cast("string").alias("processo"),
    )
    return case_documents(pages, links)


def decode_hook(spark, sf):
    files = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("text").cast("binary").alias("content"))
    return decode_pages(files, utf8_pages).filter("reason IS NULL").drop("reason")


def first_capture(spark, sf):
    cases = case_table(spark, sf).filter(F.col("numero_processo").isNotNull())
    return aggregates.first_per_key(cases, ["numero_processo"])


def latest_capture(spark, sf):
    cases = case_table(spark, sf).filter(F.col("numero_processo").isNotNull())
    return aggregates.last_per_key(cases, ["numero_processo"])


def ordered_results(spark, sf):
    shown = case_table(spark, sf, day("o_orderdate").alias("dia"))
    return shown.orderBy(date_of(F.col("dia")).desc(), "seq")


def first_match(spark, sf):
    links = F.regexp_extract_all("html", F.lit(r"(?s)<a\b[^>]*>(.*?)</a>"), F.lit(1))
    return table(spark, sf, "pages").select("page_id", inner_text(F.get(links, F.lit(0))).alias("first_link"))


UPSERT_SQL = """WITH {source}, target AS (SELECT * FROM {name} WHERE {stored}),
    new AS (SELECT * FROM {name} WHERE NOT ({stored})),
    latest AS (SELECT * FROM (SELECT *, min(seq) OVER (PARTITION BY {keys}) AS first_seq,
        row_number() OVER (PARTITION BY {keys} ORDER BY seq DESC) AS rn FROM new WHERE {filled}) WHERE rn = 1)
    SELECT t.seq, {tkeys}, {updated} FROM target t LEFT JOIN latest l ON {on}
    UNION ALL SELECT l.first_seq, {lkeys}, {added} FROM latest l WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {on})
    UNION ALL SELECT l.seq, {lkeys}, {added} FROM new l WHERE NOT ({filled})"""

CASE_UPSERT = dict(
    source=CASES_SQL, name="cases", stored="situacao = 'F'", keys="numero_processo", tkeys="t.numero_processo",
    lkeys="l.numero_processo", filled="numero_processo IS NOT NULL", on="t.numero_processo = l.numero_processo",
)


def _found(name, x, y):
    return f"CASE WHEN l.seq IS NOT NULL THEN {x} ELSE {y} END AS {name}"


QUERIES = {
    "captures_scan": (
        captures_scan,
        "SELECT page_id AS capture_id, 'first_case' AS request_kind, url, html AS body, page_id AS seq FROM pages",
    ),
    "decode_latin1": (decode_latin1, "SELECT page_id, '€“”•–—' || url AS url, html FROM pages"),
    "csv_lines": (csv_lines, "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer"),
    "csv_roundtrip": (csv_roundtrip, "SELECT doc_id, text, lang, source FROM documents"),
    "worklist": (worklist, f"WITH {CASES_SQL} SELECT seq, numero_processo FROM cases WHERE numero_processo IS NOT NULL"),
    "empty_target": (
        empty_target,
        f"""WITH {CASES_SQL} SELECT seq, numero_processo, situacao, classe FROM (SELECT *, row_number() OVER
            (PARTITION BY numero_processo ORDER BY seq) AS rn FROM cases) WHERE rn = 1 OR numero_processo IS NULL""",
    ),
    "append_union": (
        append_union,
        f"""WITH {CASES_SQL} SELECT seq, numero_processo, situacao, classe, CAST(NULL AS VARCHAR) AS dia FROM cases
            WHERE situacao = 'F' UNION ALL
            SELECT seq, numero_processo, situacao, NULL, dia FROM cases WHERE situacao <> 'F'""",
    ),
    "stored_files": (
        stored_files,
        """SELECT sha256(text) AS pdf_name, coalesce(min(CAST(doc_id AS VARCHAR)) FILTER (WHERE lang = 'en'),
           min(CAST(doc_id AS VARCHAR))) AS url, max(CAST(octet_length(encode(text)) AS BIGINT)) AS n_bytes
           FROM documents WHERE text IS NOT NULL GROUP BY 1""",
    ),
    "insert_if_absent": (
        insert_if_absent,
        f"""WITH {CASES_SQL}, target AS (SELECT * FROM cases WHERE situacao = 'F'),
            new AS (SELECT *, row_number() OVER (PARTITION BY numero_processo ORDER BY seq) AS rn FROM cases
                    WHERE situacao <> 'F')
            SELECT seq, numero_processo, situacao, classe FROM target UNION ALL
            SELECT seq, numero_processo, situacao, classe FROM new n WHERE numero_processo IS NULL OR
            (rn = 1 AND NOT EXISTS (SELECT 1 FROM target t WHERE t.numero_processo = n.numero_processo))""",
    ),
    "upsert_latest": (
        upsert_latest,
        UPSERT_SQL.format(
            **CASE_UPSERT,
            updated=_found("situacao", "l.situacao", "t.situacao")
            + ", "
            + _found("classe", "CASE WHEN l.situacao <> 'P' THEN l.classe END", "t.classe"),
            added="l.situacao, CASE WHEN l.situacao <> 'P' THEN l.classe END",
        ),
    ),
    "upsert_widen": (
        upsert_widen,
        UPSERT_SQL.format(
            **CASE_UPSERT,
            updated=_found("situacao", "l.situacao", "t.situacao") + ", t.classe, " + _found("dia", "l.dia", "NULL"),
            added="l.situacao, NULL, l.dia",
        ),
    ),
    "upsert_composite": (
        upsert_composite,
        UPSERT_SQL.format(
            source=DOCUMENTS_SQL, name="docs", stored="titulo = 'N'", keys="numero_processo, documento",
            tkeys="t.numero_processo, t.documento", lkeys="l.numero_processo, l.documento", filled="TRUE",
            on="t.numero_processo = l.numero_processo AND t.documento = l.documento",
            updated=_found("titulo", "l.titulo", "t.titulo") + ", " + _found("descricao", "l.descricao", "t.descricao"),
            added="l.titulo, l.descricao",
        ),
    ),
    "pending_cases": (
        pending_cases,
        f"""WITH {CASES_SQL} SELECT seq, numero_processo FROM cases c WHERE NOT EXISTS (SELECT 1 FROM customer
            WHERE c_mktsegment = 'BUILDING' AND CAST(c_custkey AS VARCHAR) = c.numero_processo)""",
    ),
    "known_cases": (
        known_cases,
        f"""WITH {CASES_SQL} SELECT seq, numero_processo FROM cases c WHERE EXISTS (SELECT 1 FROM customer
            WHERE c_mktsegment = 'BUILDING' AND CAST(c_custkey AS VARCHAR) = c.numero_processo)""",
    ),
    "pending_documents": (
        pending_documents,
        f"""WITH {DOCUMENTS_SQL} SELECT seq, numero_processo, documento FROM docs d WHERE NOT EXISTS (SELECT 1 FROM docs s
            WHERE s.titulo = 'R' AND s.numero_processo = d.numero_processo AND s.documento = d.documento)""",
    ),
    "resume_after": (
        resume_after,
        f"""WITH {CASES_SQL} SELECT seq, numero_processo FROM cases WHERE seq > coalesce((SELECT min(seq) FROM cases
            WHERE numero_processo = (SELECT arg_max(numero_processo, seq) FROM cases
            WHERE situacao = 'F' AND numero_processo IS NOT NULL)), -1)""",
    ),
    "request_context": (
        request_context,
        """SELECT o_orderkey AS seq, o_custkey AS request_id, c_name, c_mktsegment FROM orders
           JOIN customer ON o_custkey = c_custkey""",
    ),
    "distinct_keys": (
        distinct_keys,
        f"WITH {CASES_SQL} SELECT min(seq) AS seq, numero_processo FROM cases WHERE numero_processo IS NOT NULL GROUP BY 2",
    ),
    "last_key": (
        last_key,
        f"WITH {CASES_SQL} SELECT arg_max(numero_processo, seq) AS numero_processo FROM cases WHERE numero_processo IS NOT NULL",
    ),
    "any_match": (
        any_match,
        f"""WITH {CASES_SQL} SELECT 'some' AS test, CAST(bool_or(numero_processo = '77' AND situacao = 'F') AS BIGINT) AS found
            FROM cases UNION ALL SELECT 'none', CAST(bool_or(situacao = 'X') AS BIGINT) FROM cases""",
    ),
    "document_text": (
        document_text,
        "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    ),
    "document_text_hot": (
        document_text_hot,
        """SELECT CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id END AS document,
                  string_agg(text, '' ORDER BY conv_id * 1000 + turn, text) AS text
           FROM conversations GROUP BY 1""",
    ),
    "case_documents": (
        case_documents_query,
        f"""SELECT doc_id AS seq, sha256(d.text) AS pdf_name, 'case-' || doc_id AS numero_processo,
                   CAST(doc_id AS VARCHAR) AS documento, lang AS titulo, source AS descricao,
                   CAST(n_chars AS VARCHAR) AS processo, nullif({sql_clean("pages.text")}, '') AS conteudo
            FROM documents d LEFT JOIN (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text
                FROM conversations GROUP BY conv_id) pages ON doc_id = conv_id""",
    ),
    "decode_hook": (decode_hook, "SELECT doc_id AS seq, CAST(1 AS BIGINT) AS page_no, text FROM documents"),
    "first_capture": (
        first_capture,
        f"""WITH {CASES_SQL} SELECT min(seq) AS seq, numero_processo, arg_min(situacao, seq) AS situacao,
            arg_min(classe, seq) AS classe FROM cases WHERE numero_processo IS NOT NULL GROUP BY 2""",
    ),
    "latest_capture": (
        latest_capture,
        f"""WITH {CASES_SQL} SELECT max(seq) AS seq, numero_processo, arg_max(situacao, seq) AS situacao,
            arg_max(classe, seq) AS classe FROM cases WHERE numero_processo IS NOT NULL GROUP BY 2""",
    ),
    "ordered_results": (
        ordered_results,
        f"""WITH {CASES_SQL} SELECT c.seq, numero_processo, situacao, classe, dia FROM cases c
            JOIN orders o ON o_orderkey = seq ORDER BY CAST(o_orderdate AS DATE) DESC, seq""",
    ),
    "first_match": (
        first_match,
        f"""SELECT page_id, {sql_inner_text("regexp_extract(html, '(?s)<a[^>]*>(.*?)</a>', 1)")} AS first_link FROM pages""",
    ),
}

"""Table updates: captures and the stored table in, the next version of the table out.

A version is a list of folders (``sources.tables``), so an update writes its new rows alone. Of a
table with upserts the first folder is the base and the others are changes, which readers apply;
``compact`` makes one base of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docketry.operators import joins, writes
from docketry.operators.documents import case_documents, decode_pages, document_id
from docketry.plans import layouts as at
from docketry.plans import records, requests
from docketry.sources.tables import publish, read_folders, stage, string_schema, table_folders, work_list, write_folder

Mode = Callable[[DataFrame, DataFrame], DataFrame]
#: A file is asked for by a viewer page, and that by the answer to an access check.
DOCUMENT_HOPS = 3
DOCUMENT_CONTEXT = ["numero_processo", "documento", "titulo", "descricao", "processo"]


@dataclass(frozen=True)
class RecordTable:
    """A published table: its columns, how captures become rows, and how rows enter it."""

    columns: list[str]
    extract: Callable[[DataFrame, str], DataFrame] | None
    mode: Mode
    keys: tuple[str, ...] = tuple(writes.CASE_KEY)


TABLES = {
    "first_degree_decisions": RecordTable(
        at.FIRST_DECISION_COLUMNS, lambda captures, _: records.first_degree_decisions(captures), writes.append
    ),
    "second_degree_decisions": RecordTable(
        at.SECOND_DECISION_COLUMNS, lambda captures, _: records.second_degree_decisions(captures), writes.insert_if_absent
    ),
    "first_degree_cases": RecordTable(at.FIRST_CASE_COLUMNS, records.first_degree_cases, writes.append),
    "case_movements": RecordTable(
        at.MOVEMENT_COLUMNS, lambda captures, _: records.case_movements(captures), writes.append
    ),
    "second_degree_cases": RecordTable(
        at.SECOND_CASE_COLUMNS, lambda captures, _: records.second_degree_cases(captures), writes.upsert
    ),
    "first_instance_links": RecordTable(
        at.FIRST_INSTANCE_COLUMNS, lambda captures, _: records.first_instance_links(captures), writes.upsert
    ),
    "case_documents": RecordTable(at.DOCUMENT_COLUMNS, None, writes.upsert, tuple(writes.DOCUMENT_KEY)),
}


def schema_of(name: str) -> T.StructType:
    return string_schema(TABLES[name].columns)


def stored(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The stored table, empty when nothing is stored yet."""
    table, folders = TABLES[name], table_folders(spark, path)
    if table.mode is not writes.upsert:
        return read_folders(spark, folders, schema_of(name)).drop("batch_id")
    base = read_folders(spark, {p: f for p, f in folders.items() if p == 0}, schema_of(name)).drop("batch_id")
    changes = {p: f for p, f in folders.items() if p > 0}
    if not changes:
        return base
    return writes.upsert(base, read_folders(spark, changes, schema_of(name)), [*table.keys], ("batch_id", "seq"))


def update(captures: DataFrame, name: str, stored_path: str, next_path: str, base_url: str = "") -> DataFrame:
    """Write the table's next version and give it back. The stored version is left alone."""
    extract = TABLES[name].extract
    if extract is None:
        raise ValueError(f"{name} has no extraction from captures: use document_records and update_documents")
    return _add(extract(captures, base_url), name, stored_path, next_path)


def document_records(
    files: DataFrame, requests_made: DataFrame, read_pages: Callable[[bytes], list[str | None]]
) -> tuple[DataFrame, DataFrame]:
    """Document records from captured files, and ``seq, reason`` of the files that have no text to read.

    ``files(seq, request_id, content)`` and ``requests_made(request_id, parent_id, meta)`` are the tables of
    ``sources.captures``. Case, document, title and description come from the request that asked for access
    to the document: the file's own request, the one for its viewer or the one before. Every file has its record: one without
    bytes has no name, one that the decoder fails on no text, one of an unknown request no key.
    The bytes are read by two narrow passes, one for names and one for pages, and never moved.
    """
    pages = stage(decode_pages(files.filter("content IS NOT NULL"), read_pages))
    context = joins.context_over(files.select("seq", "request_id"), requests_made, DOCUMENT_HOPS)
    asked = [F.try_element_at("meta", F.lit(c)).alias(c) for c in DOCUMENT_CONTEXT]
    names = files.select("seq", document_id(F.col("content")).alias("pdf_name"))
    links = stage(names.join(context, "seq").select("seq", "pdf_name", *asked, F.col("meta").isNull().alias("_unknown")))
    reasons = [
        pages.filter("reason IS NOT NULL").select("seq", "reason"),
        links.filter("pdf_name IS NULL").select("seq", F.lit("no bytes").alias("reason")),
        links.filter("_unknown").select("seq", F.lit("no request").alias("reason")),
    ]
    records_of = case_documents(pages.filter("reason IS NULL"), links.drop("_unknown"))
    return records_of, reasons[0].unionByName(reasons[1]).unionByName(reasons[2])


def update_documents(documents: DataFrame, stored_path: str, next_path: str) -> DataFrame:
    """The same for document records, which are kept apart by case and document."""
    return _add(documents, "case_documents", stored_path, next_path)


def _add(new: DataFrame, name: str, stored_path: str, next_path: str) -> DataFrame:
    spark, table = new.sparkSession, TABLES[name]
    folders = table_folders(spark, stored_path)
    if table.mode is writes.insert_if_absent:
        known = read_folders(spark, folders, schema_of(name))
        new = writes.fresh_rows(known, stage(new), [*table.keys])
    place = max(folders, default=0) + 1
    publish(spark, folders | write_folder(new.select("seq", *table.columns), place, next_path), next_path)
    return stored(spark, name, next_path)


def compact(spark: SparkSession, name: str, stored_path: str, next_path: str) -> DataFrame:
    """The same table as one folder: for tables whose changes have come to cost more to apply than to write.

    The folders of earlier versions are left alone, for those who still read them.
    """
    publish(spark, write_folder(stored(spark, name, stored_path), 0, next_path), next_path)
    return stored(spark, name, next_path)


def next_case_requests(decisions: DataFrame, cases: DataFrame, base_url: str) -> DataFrame:
    """First-degree lookups still to make: after the last stored case, without those stored."""
    left = joins.resume_after(work_list(decisions), cases)
    return requests.case_requests(joins.pending(left, cases, writes.CASE_KEY), base_url, at.FIRST_CASE)


def next_document_requests(links: DataFrame, documents: DataFrame, base_url: str) -> DataFrame:
    """Access checks of the documents that are not stored yet."""
    filled = documents.filter("conteudo IS NOT NULL")
    return requests.doc_requests(joins.pending(stage(links), filled, writes.DOCUMENT_KEY), base_url)

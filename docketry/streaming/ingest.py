"""Incremental runs: each picks up the captures that arrived since the last one.

``foreachBatch`` may run a batch again, so every batch owns one folder named by its id
and replaces it. Keys live in the table, not in stream state: they never expire.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docketry.operators.writes import CASE_KEY, fresh_rows, upsert
from docketry.sources.captures import CAPTURE_SCHEMA
from docketry.sources.tables import publish, read_folders, read_table, stage, table_folders, write_folder


def new_captures(spark: SparkSession, path: str, schema: T.StructType = CAPTURE_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what is there and stop; the checkpoint remembers where."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_folder(table: str, batch_id: int) -> str:
    return f"{table}/batch_id={batch_id}"


def stored_batches(
    spark: SparkSession, table: str, schema: T.StructType, before: int | None = None, after: int | None = None
) -> DataFrame:
    """Rows of the batch folders, or of those before one batch and after another, with ``batch_id``."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = read_table(spark, table, full)
    rows = rows if after is None else rows.filter(F.col("batch_id") > after)
    return rows if before is None else rows.filter(F.col("batch_id") < before)


def append_batch(extract: Callable[[DataFrame], DataFrame], table: str) -> Callable[[DataFrame, int], None]:
    """Append: each batch's records go to its folder."""

    def write(captures: DataFrame, batch_id: int) -> None:
        extract(captures).write.mode("overwrite").parquet(batch_folder(table, batch_id))

    return write


def insert_batch(
    extract: Callable[[DataFrame], DataFrame], table: str, schema: T.StructType, keys: list[str] = CASE_KEY
) -> Callable[[DataFrame, int], None]:
    """Insert-if-absent: a batch stores only rows whose key no earlier batch has.

    Only the key columns of earlier batches are read; nothing stored is rewritten.
    """

    def write(captures: DataFrame, batch_id: int) -> None:
        stored = stored_batches(captures.sparkSession, table, schema, before=batch_id)
        fresh_rows(stored, stage(extract(captures)), keys).write.mode("overwrite").parquet(batch_folder(table, batch_id))

    return write


def upserted_view(base: DataFrame, changes: DataFrame, keys: list[str] = CASE_KEY) -> DataFrame:
    """The table as of now: the base with all stored batches of changes applied in order."""
    return upsert(base, changes, keys, order=("batch_id", "seq"))


def current(spark: SparkSession, base: str, changes: str, schema: T.StructType, keys: list[str] = CASE_KEY) -> DataFrame:
    """The table as of now: a compacted base, or none yet, and the changes of the batches after it."""
    rows, applied = _base(spark, base, schema)
    return upserted_view(rows, stored_batches(spark, changes, schema, after=applied), keys)


def _base(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, int | None]:
    """The base's rows and the last batch applied in it; none in a plain or missing table."""
    folders = table_folders(spark, path)
    plain = not folders or path in folders.values()
    return read_folders(spark, folders, schema).drop("batch_id"), None if plain else max(folders)


def compact(
    spark: SparkSession, base: str, changes: str, next_base: str, schema: T.StructType, keys: list[str] = CASE_KEY
) -> None:
    """Write the current table as the next base, with the last batch in it, so that no change is applied twice.

    Run it between two runs of the stream: a batch that is being written is not whole. The changes
    stay; those up to the base's batch are not read again and may be removed.
    """
    rows, applied = _base(spark, base, schema)
    last = stored_batches(spark, changes, schema, after=applied).agg(F.max("batch_id")).first()[0]
    if last is None:
        last = -1 if applied is None else applied
    new = stored_batches(spark, changes, schema, before=last + 1, after=applied)
    publish(spark, write_folder(upserted_view(rows, new, keys), last, next_base), next_base)

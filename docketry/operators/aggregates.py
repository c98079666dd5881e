"""Keyed aggregates. Each reduces on the map side, so a hot key sends one row per task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

PAGE_RUN = 64


def filled_key(keys: list[str]) -> Column:
    """True when no part of the key is null or blank."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() & (F.col(k) != "") for k in keys])


def first_per_key(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The earliest row of each key. ``order`` must be unique within a key."""
    return _one_per_key(df, keys, F.min_by, order)


def last_per_key(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The latest row of each key. ``order`` must be unique within a key."""
    return _one_per_key(df, keys, F.max_by, order)


def _one_per_key(df: DataFrame, keys: list[str], pick, order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def distinct_keys(df: DataFrame, key: str = "numero_processo") -> DataFrame:
    """Distinct keys with the position where each is first seen."""
    return df.groupBy(key).agg(F.min("seq").alias("seq")).select("seq", key)


def last_key(df: DataFrame, key: str = "numero_processo") -> DataFrame:
    """One row: the key stored last."""
    return df.agg(F.max_by(key, "seq").alias(key))


def any_match(df: DataFrame, test: Column, name: str = "found") -> DataFrame:
    """One row: does any row satisfy the test? False for an empty table."""
    return df.agg(F.coalesce(F.bool_or(test), F.lit(False)).alias(name))


def document_text(pages: DataFrame, document: list[str]) -> DataFrame:
    """Page texts joined in page order, one row per document.

    First the pages of each run of ``PAGE_RUN`` page numbers are joined, then the runs: the
    pages of one long document are gathered by many tasks. A text beyond what one cell can
    hold (2 GB) stops the job.
    """
    filled = pages.select(
        *document, "page_no", F.floor(F.col("page_no") / PAGE_RUN).alias("_run"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    in_run = F.expr("listagg(text, '') within group (order by page_no, text)")
    runs = filled.groupBy(*document, "_run").agg(in_run.alias("text"))
    joined = F.expr("listagg(text, '') within group (order by _run)")
    return runs.groupBy(*document).agg(joined.alias("text"))


def search_progress(captures: DataFrame, page_no: Column, has_next: Column) -> DataFrame:
    """Last page, pages seen and whether a next page was offered, per kind of search."""
    return captures.groupBy("request_kind").agg(
        F.max(page_no).alias("last_page"),
        F.count("*").alias("pages"),
        F.bool_or(has_next).alias("has_next"),
    )

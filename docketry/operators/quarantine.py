"""Bad rows set aside instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def split_bad(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with a null reason, and the others with the reason as a column."""
    marked = df.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())

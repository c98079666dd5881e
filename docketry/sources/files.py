"""Document bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docketry.sources.tables import read_table


def read_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of a folder as ``url, content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("url"), "content")


def new_files(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Files whose bytes are not stored yet, each content once, under the lowest url that has it.

    ``files`` has one row per url. A first pass hashes the bytes where they are read, and only names and
    urls are shuffled; a second pass joins the bytes to the chosen urls. Where the chosen urls are too many for
    Spark to broadcast, that join shuffles the bytes of all files once. Files without bytes are left out.
    """
    names = files.filter("content IS NOT NULL").select("url", F.sha2(F.col("content"), 256).alias("pdf_name"))
    first = names.groupBy("pdf_name").agg(F.min("url").alias("url"))
    fresh = first.join(stored.select("pdf_name").distinct(), "pdf_name", "left_anti")
    return files.join(fresh, "url").select(*files.columns, "pdf_name")


def store_files(files: DataFrame, path: str) -> None:
    """Bytes under a name derived from them; what is stored already, or comes twice, is stored once."""
    schema = T.StructType([*files.schema.fields, T.StructField("pdf_name", T.StringType())])
    stored = read_table(files.sparkSession, path, schema)
    new_files(files, stored).write.mode("append").parquet(path)

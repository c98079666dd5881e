"""Record tables: Parquet at rest, CSV for import and export.

A table that is kept over many updates is a list of folders, itself a small Parquet table of
``place, folder`` in one file. An update writes its own rows to a folder of its own and then the
list of the next version: no stored row is read or written again, and since the list is one file,
readers see a whole version or none. Rows carry ``batch_id``, the place of their folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docketry.session import work_dir


CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def string_schema(columns: list[str], with_seq: bool = True) -> T.StructType:
    fields = [T.StructField("seq", T.LongType())] if with_seq else []
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str], with_seq: bool = False, line_breaks: bool = False) -> DataFrame:
    """A CSV table with a header, every column a string: nothing is inferred.

    Large files are split. A table with quoted line breaks needs ``line_breaks=True``, and
    then one task per file.
    """
    reader = spark.read.schema(string_schema(columns, with_seq)).options(**CSV_OPTIONS)
    return reader.option("multiLine", line_breaks).csv(path)


def import_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file without positions, with ``seq`` from the place of each row in it.

    The file may have quoted line breaks, so one task reads it from top to bottom and stages it
    as one Parquet file; the reader then gives each row its place in that file.
    """
    rows = read_csv(spark, path, columns, line_breaks=True).coalesce(1)
    staged = stage(rows)
    return staged.select(*columns, F.col("_metadata.row_index").alias("seq"))


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8, header, every value quoted, quotes doubled."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("quoteAll", True).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, source_format: str = "parquet") -> DataFrame:
    """A stored table; a path that does not exist yet is an empty table."""
    try:
        return spark.read.schema(schema).format(source_format).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Write a table as a new folder (never over the one it is read from) and read it back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FOLDERS = "place long, folder string"


def table_folders(spark: SparkSession, path: str) -> dict[int, str]:
    """The folders of a version by place; a plain Parquet table is its own first folder, a missing one has none.

    One short row per update since the last compaction reaches the driver.
    """
    try:
        found = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    if found.columns != ["place", "folder"]:
        return {0: path}
    return {r["place"]: r["folder"] for r in found.orderBy("place").collect()}


def read_folders(spark: SparkSession, folders: dict[int, str], schema: T.StructType) -> DataFrame:
    """The rows of some folders with ``batch_id``, which is null in a plain table."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(*folders.values()) if folders else spark.createDataFrame([], full)


def write_folder(df: DataFrame, place: int, path: str) -> dict[int, str]:
    """Rows in a new folder beside ``path``; a run that is broken off leaves a folder that no list names."""
    folder = f"{path}.rows-{uuid.uuid4().hex}"
    df.withColumn("batch_id", F.lit(place).cast("long")).write.mode("errorifexists").parquet(folder)
    return {place: folder}


def publish(spark: SparkSession, folders: dict[int, str], path: str) -> None:
    """The list of a version's folders, in one file and never over another list."""
    spark.createDataFrame([*folders.items()], FOLDERS).coalesce(1).write.mode("errorifexists").parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Rows written once to the shared work folder and read back.

    Table maintenance reads its new rows more than once. Staged rows are not worked out
    again from the pages, and a lost executor costs one read instead of the whole chain.
    """
    return write_version(df, work_dir(df.sparkSession, "staged"))


def work_list(table: DataFrame, key: str = "numero_processo") -> DataFrame:
    """The key column of a table as a list of work, with its order."""
    return table.select("seq", key)

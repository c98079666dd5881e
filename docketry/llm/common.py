"""Shared pieces: reading, staging, batches of bounded size and ordered shards."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docketry.session import work_dir

BATCH_ROWS = 256
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python workers get at most BATCH_ROWS whole texts at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: its lineage ends there."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables staged in the shared folder, and removed as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[DataFrame, str] = {}

    def keep(self, df: DataFrame, purpose: str) -> DataFrame:
        path = work_dir(self.spark, purpose)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[table] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(table))
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def map_rows(df: DataFrame, columns_of: Callable[[dict], dict], schema: str) -> DataFrame:
    """One Arrow batch at a time through ``columns_of``, from lists by column name to lists by column name."""
    small_batches(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(columns_of(batch.to_pydict()), schema=arrow)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def append_column(df: DataFrame, name: str, kind: str, values: Callable[..., list], columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """``df`` with a column made from whole ``columns`` of a batch; all other columns pass through as they are.

    ``name`` must be free in ``df``; see ``free_name``.
    """
    small_batches(df.sparkSession)
    places = [df.columns.index(c) for c in columns]
    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"`{name}` {kind}").fields])
    arrow_type = to_arrow_schema(StructType.fromDDL(f"x {kind}")).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array(values(*[batch.column(i).to_pylist() for i in places]), arrow_type)
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shard_bounds(df: DataFrame, key: str, shards: int) -> list[float]:
    """Inner bounds of about equal shards by ``key``: fewer than ``shards`` numbers, from one quantile sketch."""
    if shards < 2:
        return []
    steps = [i / shards for i in range(1, shards)]
    found = df.agg(F.percentile_approx(F.col(key).cast("double"), steps, max(10_000, 20 * shards))).first()[0]
    return sorted(set(found or []))


def with_shard(df: DataFrame, key: str, bounds: list[float], name: str) -> DataFrame:
    """The number of the shard each row falls into; shards are in key order, null keys in the first."""
    if not bounds:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *bounds, float("inf")]
    as_double = df.withColumn("_key", F.coalesce(F.col(key).cast("double"), F.lit(float(NO_ID))))
    cut = Bucketizer(splits=splits, inputCol="_key", outputCol=name).transform(as_double)
    return cut.withColumn(name, F.col(name).cast("int")).drop("_key")


def filled(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))

"""Joins and aggregates when one key holds a third of all rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from docketry.operators import joins, skew, writes


@pytest.fixture(scope="module")
def tables(spark):
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    big = spark.range(n).select(F.col("id").alias("seq"), key.alias("numero_processo"), F.lit("old").alias("a"))
    new = spark.createDataFrame([(n + 1, "hot", "A"), (n + 2, "k1", "B"), (n + 3, "new", "C")], "seq long, numero_processo string, a string")
    return big, new


@pytest.fixture(autouse=True)
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_keys_are_found(spark, tables):
    big, _ = tables
    hashes = spark.range(1).select(skew.hot_key_hashes(big, ["numero_processo"]).alias("h")).collect()[0]["h"]
    assert hashes == [spark.range(1).select(F.xxhash64(F.lit("hot"))).collect()[0][0]]


def test_no_task_holds_the_hot_key_alone(spark, tables):
    big, new = tables
    joined = skew.keyed_join(big, new.select("numero_processo", F.lit(1).alias("hit")), ["numero_processo"], "left", ["seq"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 2 * 30_000 / 8
    assert joined.count() == 30_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, tables, how):
    big, new = tables
    right = new.select("numero_processo") if how.startswith("left_") else new.select("numero_processo", F.col("a").alias("hit"))
    got = skew.keyed_join(big, right, ["numero_processo"], how, ["seq"])
    plain = big.join(right, ["numero_processo"], how)
    assert got.columns == plain.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))


def test_upsert_reaches_every_row_of_the_hot_key(tables):
    big, new = tables
    counts = {r["a"]: r["count"] for r in writes.upsert(big, new).groupBy("a").count().collect()}
    assert counts == {"A": 10_000, "B": 1, "C": 1, "old": 19_999}


def test_blank_keys_may_be_a_third_too(spark):
    key = F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id").cast("string")))
    work = spark.range(9000).select(F.col("id").alias("seq"), key.alias("numero_processo"))
    stored = spark.createDataFrame([("k1",)], "numero_processo string")
    assert joins.pending(work, stored, ["numero_processo"]).count() == 8999
    assert writes.insert_if_absent(work.limit(0), work).count() == 9000

"""Interleaved shards: their law, their mixture and their SQL."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docketry.llm import queries, shards
from tools.check import connect, rows_of

SCHEMA = "doc_id long, text string, source string, extra string"


def rows(n=3000):
    rng = random.Random(4)
    out = [(i, f"text {i % 700} é", "hot" if i % 3 == 0 else f"s{rng.randrange(12)}", "x") for i in range(n)]
    out += [(n + i, "one of a kind", f"single {i}", "x") for i in range(200)]
    return out + [(None, None, None, None), (None, "", None, "y"), (7, "same", "s1", "a"), (7, "same", "s1", "b")] + [(8, "again", "s2", "x")] * 50


def test_law_mixture_and_digests(spark):
    given = rows()
    df = spark.createDataFrame(given, SCHEMA).selectExpr("*", "doc_id AS bucket", "text AS stratum", "extra AS rank")
    got = shards.dealt(df.repartition(5)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), s) for i, t, s, _ in given)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.source) for r in got) == want
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    mixture = Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        mixture[r.source, r.shard] += 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    for source, n in Counter(s for _, _, s, _ in given).items():
        counts = [mixture[source, j] for j in range(16)]
        assert max(abs(c - n / 16) for c in counts) <= 3
    halves = Counter((r.source, r.slot < sizes[r.shard] // 2) for r in got)
    assert abs(halves["hot", True] - halves["hot", False]) < 40  # the mixture holds within a shard, too


def test_places_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(rows(500), SCHEMA)

    def places():
        return Counter((r.doc_id, r.text_crc32, r.source, r.shard, r.slot) for r in shards.dealt(df).collect())

    first = places()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert places() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("n", [0, 1, 5, 16, 17])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(i, "t", "s", "x") for i in range(n)], SCHEMA)
    got = shards.dealt(df).collect()
    assert len(got) == n and max(Counter(r.shard for r in got).values(), default=0) <= -(-n // 16)


def test_equal_rows_beyond_one_run(spark, monkeypatch):
    monkeypatch.setattr(shards, "RUN", 7)
    df = spark.range(100).select(F.lit(1).cast("long").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    got = shards.dealt(df).collect()
    assert len({(r.shard, r.slot) for r in got}) == 100


def test_written_shards(spark, tmp_path):
    given = rows(400)
    df = spark.createDataFrame(given, SCHEMA)
    shards.write(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.source, r.extra) for r in back.collect()) == Counter(given)
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_no_python_in_the_plan(spark, small):
    plan = shards.dealt(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_equals_sql(spark, small):
    cursor = connect(small).execute(shards.ORACLE)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    df = queries.op13_shards(spark, small)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want

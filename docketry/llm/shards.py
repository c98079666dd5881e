"""Shards that all hold the mixture: proportional stratified interleaving, with DataFrame operations alone.

The rows of each stratum (a source) are shuffled by a seeded hash and ranked. The row of rank
``r`` among the ``n`` of its stratum has the fractional rank ``(r + phase) / n``, with a phase
in [0, 1) from the stratum's own hash, so that many small strata do not meet at one place.
Sorted by fractional rank, any stretch of rows holds each stratum in proportion, to within a
row or so; the sorted rows are cut into shards whose counts differ by one at most.

Neither rank needs a stratum, or all rows, in one task. A hash is cut into equal intervals:
counts per interval give where each begins, and ranks are counted within an interval. Fractional
ranks are spread evenly by their making, and cut in the same way. The tables of counts hold
one row per interval, ``INTERVALS`` times the shuffle partitions. What moves is a few numbers per row; texts do not.

A null text has no bytes; a null stratum is a stratum of its own. Rows alike in id, text and
stratum are one row with a count until their ranks are known, and get a place each. A row
without id is placed like any other. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketry.llm.common import free_name, shuffle_partitions, staged

SHARDS = 16
SEED = "mixture"
INTERVALS = 4
HASH_BITS = 60
#: Places of equal rows are made in runs of this many, so that no cell holds more.
RUN = 1_000_000


def _hash_bits(text: Column) -> Column:
    """60 bits of the MD5 of a text, as a number."""
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _keys(stratum: str) -> list[Column]:
    return [
        F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("stratum"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    ]


def _interval_bits(df: DataFrame) -> int:
    return (INTERVALS * shuffle_partitions(df.sparkSession) - 1).bit_length()


def ranked(docs: DataFrame, stratum: str = "source", seed: str = SEED) -> DataFrame:
    """``stratum, doc_id, size, text_crc32, copies, rank, n, fraction`` of every row, staged."""
    alike = docs.select(*_keys(stratum)).groupBy("stratum", "doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size", "text_crc32")
    shuffled = alike.withColumn("place", _hash_bits(name))
    shuffled = staged(shuffled.withColumn("bucket", F.shiftright("place", HASH_BITS - _interval_bits(docs))), "strata")
    counts = shuffled.groupBy("stratum", "bucket").agg(F.sum("copies").alias("rows"))
    own = Window.partitionBy("stratum")
    up_to = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "stratum",
        "bucket",
        F.coalesce(F.sum("rows").over(up_to), F.lit(0)).alias("before"),
        F.sum("rows").over(own).alias("n"),
    )
    in_order = Window.partitionBy("stratum", "bucket").orderBy("place", "doc_id", "size", "text_crc32")
    within = F.sum("copies").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    rows = shuffled.join(starts, ["stratum", "bucket"]).withColumn("first", F.col("before") + within)
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN)))
    places = rows.select("*", runs.alias("run"))
    low = F.col("run") * RUN
    places = places.select("*", F.explode(F.sequence(low, F.least(low + RUN, F.col("copies")) - 1)).alias("nth"))
    phase = _hash_bits(F.concat(F.lit(f"{seed}/"), F.col("stratum"))) / F.lit(float(2**HASH_BITS))
    found = places.withColumn("rank", F.col("first") + F.col("nth")).withColumn("fraction", (F.col("rank") + phase) / F.col("n"))
    return staged(found.select("stratum", "doc_id", "size", "text_crc32", "nth", "rank", "n", "fraction"), "fractions")


def dealt(docs: DataFrame, shards: int = SHARDS, stratum: str = "source", seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, source.

    The law is ``rows``: counts of shards differ by one at most. ``slot`` counts from 0 in each shard.
    """
    return _placed(docs, shards, stratum, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.when(F.col("stratum") != "", F.expr("substring(stratum, 2)")).alias("source"),
    )


def _placed(docs: DataFrame, shards: int, stratum: str, seed: str) -> DataFrame:
    rows = ranked(docs, stratum, seed)
    cuts = 2 ** _interval_bits(docs)
    cut = F.least(F.floor(F.col("fraction") * cuts), F.lit(cuts - 1)).alias("cut")
    rows = rows.select("*", cut)
    counts = rows.groupBy("cut").agg(F.count("*").alias("rows"))
    up_to = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select("cut", F.coalesce(F.sum("rows").over(up_to), F.lit(0)).alias("before"), F.sum("rows").over(everything).alias("total"))
    in_order = Window.partitionBy("cut").orderBy("fraction", "stratum", "rank")
    position = F.col("before") + F.row_number().over(in_order) - 1
    placed = rows.join(starts, "cut").withColumn("position", position)
    placed = placed.withColumn("shard", F.expr(f"position * {shards} div total").cast("int"))
    return placed.withColumn("slot", F.expr(f"position - (shard * total + {shards - 1}) div {shards}"))


def write(docs: DataFrame, folder: str, shards: int = SHARDS, stratum: str = "source", seed: str = SEED) -> None:
    """``docs``, with all columns, as Parquet folders ``shard=0``, ... in slot order.

    Texts move twice: to their place's row, and to their shard. Rows alike in id, text and
    stratum may swap places; only those are numbered.
    """
    names = ["stratum", "doc_id", "size", "text_crc32"]
    key, nth, shard, slot = (free_name(docs, x) for x in ("key", "nth", "shard", "slot"))
    place = _placed(docs, shards, stratum, seed)
    wanted = place.select(_key(names).alias(key), F.col("nth").alias(nth), F.col("shard").alias(shard), F.col("slot").alias(slot))
    keyed = docs.withColumn(key, F.struct(*_keys(stratum))).withColumn(key, _key([f"{key}.{x}" for x in names]))
    numbered = keyed.withColumn(nth, (F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0))) - 1).cast("long"))
    joined = numbered.join(wanted, [key, nth]).drop(key, nth)
    runs = max(shards, shuffle_partitions(docs.sparkSession))
    ordered = joined.repartitionByRange(runs, shard, slot).sortWithinPartitions(shard, slot)
    ordered.write.partitionBy(shard).parquet(folder)


def _key(names: list[str]) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in names))


_HASH = "CAST('0x' || substring(md5({}), 1, 15) AS BIGINT)"

#: The CRC is worked out byte by byte, from a table made by its rule.
ORACLE = f"""
WITH bytes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
crcs AS (
  SELECT doc_id, source, CAST(COALESCE(strlen(text), 0) + 1 AS BIGINT) AS size,
    CAST(CASE WHEN COALESCE(text, '') = '' THEN 0 ELSE xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda p: CAST('0x' || p AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) END AS BIGINT) AS text_crc32
  FROM documents, bytes),
hashed AS (
  SELECT *, COALESCE('=' || source, '') AS stratum,
    {_HASH.format(f"'{SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), '-') || ':' || size || ':' || text_crc32")} AS place
  FROM crcs),
ranked AS (
  SELECT *, {_HASH.format(f"'{SEED}/' || stratum")} / {float(2**HASH_BITS)!r} AS phase,
    row_number() OVER (PARTITION BY stratum ORDER BY place, doc_id, size, text_crc32) - 1 AS r,
    count(*) OVER (PARTITION BY stratum) AS n
  FROM hashed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + phase) / n, stratum, r) - 1 AS position, count(*) OVER () AS total
  FROM ranked),
cut AS (SELECT *, position * {SHARDS} // total AS s FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(s AS INTEGER) AS shard,
  CAST(position - (s * total + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, source
FROM cut
"""

"""Joins that stay balanced when one key holds a large share of the rows.

The frequent keys of the big side are found with one sketch pass over its key
columns (``approx_top_k``: partial on every task, no shuffle, bounded size). A key is hot
if it has more rows than a partition's fair share, so the bound follows from the number of rows
and of shuffle partitions. Rows of a hot key are spread over as many salts as it has fair
shares, times ``SPREAD``, and the matching rows of the other side are repeated once per salt: at most
``SPREAD + 1`` copies per partition, all keys together. All other rows join on the key alone. The sketch only decides
*where* rows meet, never whether: results do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SALT = "_salt"
SPREAD = 4
#: Sketch entries per hot key that there can be, and the least and most entries that the sketch takes.
SPARE, LEAST_TRACKED, MOST_TRACKED = 16, 16_384, 1_000_000


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: list[str], name: Column | None = None) -> DataFrame:
    """One row: the hot keys of ``df``, fewer than there are partitions, with their number of salts.

    They are known by their hash, or by ``name``: every name that is given out is that of a row of ``df``.
    """
    parts = partitions_of(df)
    tracked = min(MOST_TRACKED, max(LEAST_TRACKED, SPARE * parts))
    tally = df.select((F.xxhash64(*keys) if name is None else name).alias("h")).agg(
        F.expr(f"approx_top_k(h, {min(parts, tracked // 2)}, {tracked})").alias("top"), F.count("*").alias("n")
    )
    salts = f"cast(ceil(t.count * {SPREAD * parts}D / n) AS int)"
    hot = F.expr(f"transform(filter(top, t -> t.count * {parts}D > n and t.count > 1), t -> struct(t.item AS h, {salts} AS salts))")
    return tally.select(F.map_from_entries(hot).alias("hot"))


def hot_key_hashes(df: DataFrame, keys: list[str]) -> Column:
    """Hashes of the hot keys, as a scalar subquery."""
    return hot_keys(df, keys).select(F.map_keys("hot").alias("hot")).scalar()


def keyed_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, spread_by: list[str], hot: dict[int, int] | None = None
) -> DataFrame:
    """Join the big ``left`` to ``right`` on equal keys: inner, left, left_semi or left_anti.

    ``spread_by`` names left columns that differ within a key (a position, an id).
    For inner and left joins ``right`` should hold one row per key. ``left`` is read twice,
    its key columns alone the first time: hand over a stored or staged table. ``hot`` gives the
    salts of its hot keys, by hash, where they are known already; then ``left`` is read once.
    """
    if hot == {}:
        return left.join(right, keys, how)
    known = hot_keys(left, keys).scalar() if hot is None else F.expr(f"map({', '.join(f'{h}L, {n}' for h, n in hot.items())})")
    salts = F.coalesce(F.try_element_at(known, F.xxhash64(*keys)), F.lit(1))
    salted_left = left.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), salts).cast("int"))
    salted_right = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted_left.join(salted_right, [*keys, SALT], how).drop(SALT)

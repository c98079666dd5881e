"""Table maintenance as DataFrame algebra: append, insert-if-absent, upsert.

Rows carry ``seq``, their position. Null and blank keys equal nothing: their rows are
always appended and take no part in grouping or joining, however many there are.
New rows are read more than once: hand over a stored or staged table, not a chain of
page extraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docketry.operators.aggregates import filled_key, first_per_key
from docketry.operators.skew import SALT, hot_keys

CASE_KEY = ["numero_processo"]
DOCUMENT_KEY = ["numero_processo", "documento"]


def append(target: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables' rows, duplicates kept, columns matched by name."""
    return target.unionByName(new, allowMissingColumns=True)


def fresh_rows(target: DataFrame, new: DataFrame, keys: list[str] = CASE_KEY) -> DataFrame:
    """Rows insert-if-absent would add: the first of each unknown key, and all blank ones."""
    usable = filled_key(keys)
    first = first_per_key(new.filter(usable), keys)
    stored = target.filter(usable).select(*keys).distinct()
    return first.join(stored, keys, "left_anti").select(*new.columns).unionByName(new.filter(~usable))


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str] = CASE_KEY) -> DataFrame:
    """Existing rows untouched; of several new rows with a key the first is added."""
    return append(target, fresh_rows(target, new, keys))


def upsert(
    target: DataFrame, new: DataFrame, keys: list[str] = CASE_KEY, order: tuple[str, ...] = ("seq",)
) -> DataFrame:
    """Every target row with a key takes all columns of its latest new row.

    A blank overwrites, columns the new rows lack stay as they are, and columns only
    they have widen the table. Unknown keys are added once, at their first position.
    ``order`` names the columns of ``new`` that say which row is later. The target is moved once, and its
    key columns are read once more, for the hot ones.
    """
    usable = filled_key(keys)
    values = [c for c in new.columns if c not in (*keys, *order, "seq")]
    latest = _latest_at_first_place(new.filter(usable), keys, values, F.struct(*order) if len(order) > 1 else F.col(order[0]))

    # One join: target rows meet the new row of their key, or one of its copies if many rows hold the key. Only keys
    # of the target have copies, so those that meet no row there are dropped; a new row without copies is added.
    name = F.to_json(F.struct(*keys))
    salts = F.coalesce(F.try_element_at(hot_keys(target, keys, name).scalar(), name), F.lit(1))
    held = target.withColumn(SALT, F.pmod(F.xxhash64("seq"), salts).cast("int")).withColumn("_held", F.lit(True))
    fresh = latest.select(*keys, F.struct("seq", *values).alias("_new"), salts.alias("_copies"))
    fresh = fresh.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    joined = held.join(fresh, [*keys, SALT], "full").filter(F.col("_held") | (F.col("_copies") == 1))
    columns = [*target.columns, *[c for c in values if c not in target.columns]]
    place = F.when(F.col("_held"), F.col("seq")).otherwise(F.col("_new.seq")).alias("seq")
    merged = joined.select(
        *[place if c == "seq" else _overwritten(c, c in target.columns) if c in values else F.col(c) for c in columns]
    )
    return append(merged, new.filter(~usable).select(*[c for c in new.columns if c in (*keys, *values, "seq")]))


def _overwritten(name: str, had: bool) -> Column:
    old = F.col(name) if had else F.lit(None)
    return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(old).alias(name)


def _latest_at_first_place(new: DataFrame, keys: list[str], values: list[str], place: Column) -> DataFrame:
    """The latest row of each key, standing where the key first appeared."""
    picked = new.groupBy(*keys).agg(
        F.min_by("seq", place).alias("seq"), F.max_by(F.struct(*values), place).alias("_row")
    )
    return picked.select("seq", *keys, *[F.col(f"_row.{c}").alias(c) for c in values])

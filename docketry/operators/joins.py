"""Membership, resume and context joins. Null and blank keys match nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docketry.operators.aggregates import filled_key
from docketry.operators.skew import keyed_join
from docketry.sources.tables import stage


def pending(work: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Work items whose key is not stored yet."""
    return keyed_join(work, _stored_keys(stored, keys), keys, "left_anti", ["seq"])


def known(work: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Work items whose key is stored."""
    return keyed_join(work, _stored_keys(stored, keys), keys, "left_semi", ["seq"])


def _stored_keys(stored: DataFrame, keys: list[str]) -> DataFrame:
    return stored.filter(filled_key(keys)).select(*keys).distinct()


def resume_after(work: DataFrame, stored: DataFrame, key: str = "numero_processo") -> DataFrame:
    """Work items after the first place of the key stored last; all of them if it is unknown."""
    last = stored.agg(F.max_by(key, "seq").alias("last")).scalar()
    place = work.filter(F.col(key) == last).agg(F.min("seq").alias("place")).scalar()
    return work.filter(F.col("seq") > F.coalesce(place, F.lit(-1)))


def with_context(captures: DataFrame, requests: DataFrame, key: str = "request_id") -> DataFrame:
    """Captures with the context of the request that led to them.

    Page bodies would travel through the join: take the fields out first.
    """
    return keyed_join(captures, requests, [key], "inner", ["seq"])


def context_over(captures: DataFrame, requests: DataFrame, hops: int) -> DataFrame:
    """``captures(seq, request_id)`` as ``seq, meta``: the context of the request, or of the nearest one before it.

    ``requests(request_id, parent_id, meta)`` has one row per id. A request without context passes the
    question on to its parent, over ``hops`` requests in all. Each hop joins narrow rows, written in
    between, since a join reads its left side twice. Every capture keeps its row; where no request of
    the chain has a context, or none is known, ``meta`` is null.
    """
    answers = requests.select("request_id", "parent_id", F.col("meta").alias("_meta"))
    asked = stage(captures.select("seq", "request_id", F.lit(None).cast("map<string,string>").alias("meta")))
    for hop in range(hops):
        found = keyed_join(asked, answers, ["request_id"], "left", ["seq"])
        meta = F.coalesce("meta", F.when(F.size("_meta") > 0, F.col("_meta")))
        asked = found.select("seq", F.when(meta.isNull(), F.col("parent_id")).alias("request_id"), meta.alias("meta"))
        asked = stage(asked) if hop < hops - 1 else asked
    return asked.drop("request_id")

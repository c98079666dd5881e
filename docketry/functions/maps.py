"""Query strings and cookie headers as maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docketry.functions.text import bound


def last_wins_map(pairs: Column) -> Column:
    """Map from an array of ``key=value`` texts; of repeated keys the last one counts.

    Texts without ``=`` are dropped; a value keeps any further ``=``. Repeats are
    removed here, so the result does not hang on the session's map settings.
    """
    usable = F.filter(pairs, lambda p: F.contains(p, F.lit("=")))
    entries = F.transform(
        usable,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"),
            F.substr(p, F.length(F.substring_index(p, "=", 1)) + 2).alias("value"),
        ),
    )
    return F.map_from_entries(bound(entries, _last_of_each_key))


def _last_of_each_key(entries: Column) -> Column:
    """The last entry of each key: sorted by key and place, it stands before another key; then back in order."""
    placed = F.transform(entries, lambda e, n: F.struct(e["key"].alias("key"), n.alias("place"), e["value"].alias("value")))

    def last_ones(in_order: Column) -> Column:
        def is_last(entry: Column, n: Column) -> Column:
            after = F.get(in_order, n + 1)
            return after.isNull() | (after["key"] != entry["key"])

        found = F.transform(F.filter(in_order, is_last), lambda e: F.struct(e["place"].alias("place"), e["key"].alias("key"), e["value"].alias("value")))
        return F.transform(F.array_sort(found), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))

    return bound(F.array_sort(placed), last_ones)


def query_params(url: Column) -> Column:
    """Parameters between the first and second question mark of a link."""
    query = F.coalesce(F.get(F.split(url, r"\?"), F.lit(1)), F.lit(""))
    return last_wins_map(F.split(query, "&"))


def cookies(headers: Column) -> Column:
    """``Set-Cookie`` headers to a map, each value up to its first semicolon after the name."""
    mine = F.filter(headers, lambda h: F.lower(h["name"]) == "set-cookie")
    return last_wins_map(F.transform(mine, lambda h: F.regexp_extract(h["value"], "^[^=]*=[^;]*", 0)))

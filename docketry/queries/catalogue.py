"""All checked queries by name."""

from __future__ import annotations

from docketry.queries import pages, records, requests, streams, tables, text
from docketry.queries.common import Query

FAMILIES = [pages, text, tables, records, requests, streams]
ENTRIES = {name: entry for family in FAMILIES for name, entry in family.QUERIES.items()}


def queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql is not None}

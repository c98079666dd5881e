"""Shared pieces of the query catalogue."""

from __future__ import annotations

import re
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketry.sources.captures import as_captures

Query = Callable[[SparkSession, str], DataFrame]

# The white space class and hidden blocks, in the form the SQL engine takes.
SQL_SPACE = r"[\s\v\p{Z}\x{85}\x{1c}-\x{1f}]"
SQL_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
BASE = "https://portal.example.org/app"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """A table's rows over the shuffle partitions, before a query writes a page from each of them.

    For narrow rows only: the given files have one row group, and so one task, each.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def text_of(*parts: Column | str) -> Column:
    """Literals and columns joined to one text."""
    spelling = _spelling.get() or str
    return F.concat(*[F.lit(spelling(p)) if isinstance(p, str) else p.cast("string") for p in parts])


def key() -> Column:
    return F.col("o_orderkey")


def customer() -> Column:
    return F.col("o_custkey")


def status() -> Column:
    return F.col("o_orderstatus")


def priority() -> Column:
    return F.col("o_orderpriority")


def day(column: str) -> Column:
    return F.date_format(column, "dd/MM/yyyy")


def case_meta(key: Column) -> Column:
    return F.create_map(F.lit("numero_processo"), key.cast("string"))


def pages_from(df: DataFrame, kind: Column | str, body: Column, seq: str, key: Column | None = None) -> DataFrame:
    """Captures written from a table's rows.

    The generator keeps a job's filters on the page from being moved below ``dealt``, where each would
    write every page once more in the few tasks that scan the table.
    """
    pages = dealt(df).select("*", F.explode(F.array(body)).alias("_page"))
    return as_captures(pages, kind=kind, body=F.col("_page"), seq=F.col(seq), meta=None if key is None else case_meta(key))


def spelt(page: Callable[[], Column], key: Column, values: list[Column]) -> Column:
    """The same page in one of four spellings, by the row's key. ``values`` are the texts that ``page`` puts in.

    The literals of a page, which hold whole tags, are spelt while the query is built; a page with markup in
    its values is spelt as a whole.
    """

    def written(spelling: Callable[[str], str]) -> Column:
        token = _spelling.set(spelling)
        try:
            return page()
        finally:
            _spelling.reset(token)

    def choice(*spellings: Column) -> Column:
        place = F.pmod(key, F.lit(4))
        return F.when(place == 1, spellings[1]).when(place == 2, spellings[2]).when(place == 3, spellings[3]).otherwise(spellings[0])

    plain = text_of(*values)
    has_markup = F.contains(plain, F.lit("<")) | F.contains(plain, F.lit('"'))
    whole = choice(*[_spelt_by(F.regexp_replace, page(), rules) for rules in SPELLINGS])
    literals = choice(*[written(lambda text, rules=rules: _spelt_by(_replaced, text, rules)) for rules in SPELLINGS])
    return F.when(~has_markup, literals).otherwise(whole)


SPELLINGS = [
    [],
    [(f"(</?){name}\\b", f"$1{name.upper()}") for name in ("table", "tr", "td", "div", "span")]
    + [(' (id|class|title)="', ' DATA-X="1" $1 = "')],
    [('\\sid="', ' data-id="tdResultados" id="')],
    [("=\"([^\"'<>]*)\"", "='$1'")],
]
_spelling: ContextVar[Callable[[str], str] | None] = ContextVar("spelling", default=None)


def _spelt_by(replace: Callable, text, rules: list[tuple[str, str]]):
    for pattern, replacement in rules:
        text = replace(text, pattern, replacement)
    return text


def _replaced(text: str, pattern: str, replacement: str) -> str:
    return re.sub(pattern, replacement.replace("$1", r"\g<1>"), text, flags=re.ASCII)


def sql_spaces(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SQL_SPACE}+', ' ', 'g'))"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_entities(x: str) -> str:
    for name, char in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("middot", "·"), ("copy", "©"), ("amp", "&")]:
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def sql_shown(x: str) -> str:
    return f"replace(regexp_replace({x}, '{SQL_HIDDEN}', '<>', 'g'), '&nbsp;', chr(160))"


def sql_inner_text(x: str) -> str:
    flat = f"regexp_replace({sql_shown(x)}, '{SQL_SPACE}*<[^>]*>{SQL_SPACE}*', '', 'g')"
    return sql_entities(sql_strip(flat))


def sql_block_text(x: str) -> str:
    return sql_strip(sql_entities(f"regexp_replace({sql_shown(x)}, '<[^>]*>', '', 'g')"))

"""Row predicates as boolean columns."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, functions as F

from docketry.functions.text import bound

# How the search text marks phrases and joins them, and its date format.
PHRASE_PATTERN = '"([^"]+)"'
SEARCH_OPERATORS = ("OU", "E")
DATE_FORMAT = "dd/MM/yyyy"


# Letters that are a base letter with marks, and the base letter, in every script; then the
# combining marks themselves, which have no counterpart and are dropped.
_DECOMPOSED = {c: unicodedata.normalize("NFD", c) for c in map(chr, range(0xC0, 0x30000)) if unicodedata.decomposition(c)}
MARKED = [c for c, d in _DECOMPOSED.items() if d[0] != c and len(d) > 1 and all(map(unicodedata.combining, d[1:]))]
UNMARKED = [_DECOMPOSED[c][0] for c in MARKED]
MARKS = [c for c in map(chr, range(0x300, 0x20000)) if unicodedata.combining(c)]


def phrases_of(search: str) -> list[str]:
    """The quoted phrases and the words between them, or the whole text when none is quoted."""
    if not re.search(PHRASE_PATTERN, search):
        return [search]
    parts = re.findall(rf"{PHRASE_PATTERN}|(\S+)", search)
    return [quoted or word for quoted, word in parts if quoted or word.upper() not in SEARCH_OPERATORS]


def folded(x: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(x), "".join([*MARKED, *MARKS]), "".join(UNMARKED))


def any_phrase(x: Column, phrases: list[str]) -> Column:
    """True when the text has one of the phrases, whatever the case or accents."""

    def has_one(text: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(text, folded(F.lit(p))) for p in phrases])

    return bound(folded(x), has_one)


def date_of(x: Column) -> Column:
    return F.try_to_date(x, DATE_FORMAT)


def until_date(x: Column, last_day: str) -> Column:
    """True for day/month/year texts up to and including ``last_day`` (ISO)."""
    return date_of(x) <= F.lit(last_day).cast("date")


def document_complete(case: Column, document: Column, content: Column, case_key: str, document_key: str) -> Column:
    """True for the stored row of one document of one case whose text is filled."""
    return (
        (case == case_key)
        & (document == document_key)
        & (F.coalesce(content, F.lit("")) != "")
    )

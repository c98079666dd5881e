"""Unicode-aware text cleaning. Every function maps a string column to a column."""

from __future__ import annotations

from html.entities import codepoint2name

from pyspark.sql import Column, functions as F

# The characters that count as white space (Java's \s and trim cover fewer).
# Single characters first: the matcher keeps those below 256 in one table.
SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\p{Z}]"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# A run of white space taken from its start, so that a long run is not tried from each of its places.
SPACE_RUN = rf"{SPACE}(?<!{SPACE}{SPACE}){SPACE}*+"

# Characters and prefixes the record contract removes.
PARTY_NOISE = "\n\t\u00a0"
DOCUMENT_NOISE = ";,'\"\r"
LAWYER_LABEL = "^Advogad[oa]:"

# All named entities of the standard table, and the one that only XML has.
ENTITY_NAMES = {name: chr(code) for code, name in codepoint2name.items()} | {"apos": "'"}
# HTML readers take the codes 128 to 159, and "latin1" bytes of that value, as windows-1252.
CONTROLS = "".join(chr(c) for c in range(128, 160) if bytes([c]).decode("cp1252", "ignore"))
WINDOWS = bytes(map(ord, CONTROLS)).decode("cp1252")


def strip_space(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def windows_text(x: Column) -> Column:
    """Control characters 128 to 159 as the windows-1252 characters of that code."""
    return F.translate(x, CONTROLS, WINDOWS)


def normalise_space(x: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(x, rf"{SPACE}++", " "))


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def or_blank(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def first_filled(first: Column, second: Column) -> Column:
    """The first text, or the second when the first is blank or null."""
    return F.coalesce(blank_to_null(first), second)


def delete_chars(x: Column, chars: str = PARTY_NOISE) -> Column:
    return F.translate(x, chars, "")


def strip_lawyer_label(x: Column) -> Column:
    return strip_space(F.regexp_replace(x, LAWYER_LABEL, ""))


def drop_parens(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?:{SPACE_RUN})?\([^\n]*?\){SPACE}*+", "")


def paren_text(x: Column) -> Column:
    """Text of the first parenthesis, blank when there is none."""
    return F.regexp_extract(x, r"\(([^\n]*?)\)", 1)


def before_paren(x: Column) -> Column:
    """Text before the first parenthesis, or all of it when none is closed."""
    has_parens = F.regexp_like(x, F.lit(r"\([^\n]*?\)"))
    return strip_space(F.when(has_parens, F.substring_index(x, "(", 1)).otherwise(x))


def first_slash_part(combined: Column, alone: Column) -> Column:
    """Class: what stands before the first slash of a combined value, else ``alone``."""
    parts = F.split(combined, "/")
    return F.when(F.size(parts) > 1, strip_space(F.get(parts, F.lit(0)))).otherwise(strip_space(alone))


def later_slash_parts(combined: Column) -> Column:
    """Subject: everything after the first slash joined by pipes, else the only part."""
    parts = F.split(combined, "/")
    later = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), "|")
    return F.when(F.size(parts) > 1, strip_space(later)).otherwise(F.get(parts, F.lit(0)))


def clean_document(x: Column) -> Column:
    return normalise_space(F.translate(normalise_space(x), DOCUMENT_NOISE, ""))


def page_number(x: Column) -> Column:
    return strip_space(x).try_cast("int")


def next_page_number(x: Column) -> Column:
    return page_number(x) + 1


def bound(x: Column, use) -> Column:
    """``use(x)`` with x worked out once, however often ``use`` names it.

    For arrays and maps made by higher-order functions, which Spark would otherwise
    build again at each place that names them. The value is the start of a fold over nothing:
    an element of a transformed array would have its type derived anew, from all of ``use``, in each row.
    """
    return F.aggregate(F.array(), x, lambda value, _: value, use)


def decode_entities(x: Column) -> Column:
    """Named and numeric character references to characters, in one pass over the text."""

    def decoded(text: Column) -> Column:
        pieces = F.call_function("transform", F.split(text, "&"), F.expr(DECODE_PIECE))
        return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)

    return bound(x, decoded)


def _sql_text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


ENTITY_MAP = f"str_to_map({_sql_text(';'.join(f'{name} {char}' for name, char in ENTITY_NAMES.items()))}, ';', ' ')"
# The number of #233 or #xE9, and its character when there is one.
CODE = """coalesce(try_cast(regexp_extract(piece, '^#([0-9]{1,7});', 1) AS BIGINT),
    try_cast(conv(nullif(regexp_extract(piece, '^#[xX]([0-9a-fA-F]{1,6});', 1), ''), 16, 10) AS BIGINT))"""
NUMBERED = f"""CASE WHEN {CODE} BETWEEN 1 AND 55295 OR {CODE} BETWEEN 57344 AND 1114111
    THEN translate(decode(unhex(lpad(hex({CODE}), 8, '0')), 'UTF-32'), {_sql_text(CONTROLS)}, {_sql_text(WINDOWS)}) END"""
# One piece of a text cut at ampersands; the piece at place 0 stands before the first of them.
DECODE_PIECE = f"""(piece, place) -> CASE WHEN place = 0 THEN piece ELSE coalesce(
    concat(
        CASE WHEN NOT contains(piece, ';') THEN NULL WHEN startswith(piece, '#') THEN {NUMBERED}
             ELSE try_element_at({ENTITY_MAP}, substring_index(piece, ';', 1)) END,
        substr(piece, length(substring_index(piece, ';', 1)) + 2)),
    concat('&', piece)) END"""

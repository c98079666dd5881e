"""Field extraction from page markup, as column expressions.

All functions but ``prepare`` and ``script_param`` take prepared markup: call
``prepare`` once per page, then read as many fields as needed. Patterns start with a
literal where they can, so that the JVM's matcher skips ahead, and use possessive
quantifiers, so that no page makes them backtrack.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from docketry.functions.structure import closed_rows, inside, last_block, plain_tags
from docketry.functions.text import SPACE, SPACE_RUN, bound, decode_entities, first_filled, strip_space

# Stand-in for comments, scripts and styles: an empty tag, so that text on both sides stays apart.
GAP = "<>"
# Cell boundary inside a flattened block. No page text holds this control character.
CELL_END = "\u0001"

SCRIPT = r"[sS][cC][rR][iI][pP][tT]"
STYLE = r"[sS][tT][yY][lL][eE]"
HIDDEN = rf"(?s)<(?:!--.*?-->|{SCRIPT}\b[^>]*>.*?</{SCRIPT}\s*>|{STYLE}\b[^>]*>.*?</{STYLE}\s*>)"
TAG_WITH_SPACE = rf"(?:{SPACE_RUN})?<[^>]*>{SPACE}*+"
# References to the no-break space, which counts as white space at the ends of a text node.
HARD_SPACE = "&(?:nbsp|#160|#[xX][aA]0);"
# Up to the first filled text: white space, empty spans, one opening span.
# Up to there also whole elements of other kinds, whose text is not the anchor's own.
OTHER = r"<(?!span\b|/)[a-z0-9]++[^>]*+>(?:[^<]*+</(?!span|div|td)[a-z0-9]++>)?+"
TO_FIRST_TEXT = rf"(?:{SPACE}++|<>|<span[^>]*+>{SPACE}*+</span>|{OTHER})*+(?:<span[^>]*+>)?+{SPACE}*+"


def class_pattern(*names: str) -> str:
    """Attribute pattern for elements carrying all the class names."""
    wanted = "".join(rf'(?=(?:[^"]*\s)?{re.escape(n)}[\s"])' for n in names)
    return rf'class="(?<=\sclass="){wanted}[^"]*"'


def prepare(html: Column) -> Column:
    """A page without comments, scripts and styles, its tags in one spelling."""
    return bound(F.regexp_replace(html, HIDDEN, GAP), plain_tags)


def inner_text(markup: Column, delimiter: str = "") -> Column:
    """Each text node below an element, stripped, joined by the delimiter."""
    spaced = F.regexp_replace(markup, HARD_SPACE, "\u00a0")
    if delimiter == "":
        return bound(strip_space(F.regexp_replace(spaced, TAG_WITH_SPACE, "")), decode_entities)
    nodes = F.filter(F.split(spaced, "<[^>]*>"), lambda n: n != "")
    return bound(F.array_join(F.transform(nodes, strip_space), delimiter), decode_entities)


def block_text(markup: Column) -> Column:
    """Whole text of a block, stripped at its two ends only."""
    return strip_space(bound(F.regexp_replace(markup, "<[^>]*>", ""), decode_entities))


def anchor_text(body: Column, element_id: str) -> Column:
    """First filled text of the element with an id, or of the span that opens it."""
    found = F.regexp_extract(body, rf'\sid="{re.escape(element_id)}"[^>]*+>{TO_FIRST_TEXT}([^<]*+)', 1)
    return strip_space(decode_entities(found))


def anchored_heads(body: Column, element_ids: list[str]) -> Column:
    """The opening tag and first text of several anchors, cut out in one pass over the page."""
    ids = "|".join(re.escape(i) for i in element_ids)
    return F.regexp_extract_all(body, F.lit(rf'\sid="(?:{ids})"[^>]*+>{TO_FIRST_TEXT}[^<]*+'), F.lit(0))


def head_ids(heads: Column) -> Column:
    return F.transform(heads, lambda h: F.substring_index(F.substring_index(h, '"', 2), '"', -1))


def head_texts(heads: Column) -> Column:
    texts = F.transform(heads, lambda h: F.substring_index(h, ">", -1))
    return F.transform(texts, lambda t: strip_space(decode_entities(t)))


def head_text(ids: Column, texts: Column, element_id: str) -> Column:
    """Text of the first head with an id: what ``anchor_text`` finds in the whole page."""
    place = F.array_position(ids, element_id).cast("int") - 1
    return F.coalesce(F.get(texts, place), F.lit(""))


def labelled_cells(block: Column) -> Column:
    """A block's text with cell boundaries kept, ready for ``label_detail``."""
    spaced = F.regexp_replace(block, HARD_SPACE, "\u00a0")
    shown = F.regexp_replace(spaced, r"</?[tT][rRdDhH]\b[^>]*>", CELL_END)
    return bound(F.regexp_replace(shown, TAG_WITH_SPACE, ""), decode_entities)


def label_detail(cells: Column, label: str) -> Column:
    """Text after a label up to the end of its cell, white space normalised; blank if absent."""
    found = F.regexp_extract(cells, rf"{re.escape(label)}([^{CELL_END}]*+)", 1)
    return F.trim(F.regexp_replace(found, rf"{SPACE}++", " "))


def attr_value(tag: Column, name: str) -> Column:
    """Value of an attribute in the first tag that has it; blank if absent."""
    found = F.regexp_extract(tag, rf"""(?i)<[^<>]*?\s{re.escape(name)}\s*=\s*(["'])((?:(?!\1)[^>])*+)\1""", 2)
    return decode_entities(found)


def tag_with(body: Column, tag: str, attribute: str) -> Column:
    """First opening ``tag`` that carries the attribute text (a pattern)."""
    return F.regexp_extract(body, rf"<{tag}\b[^<>]*?\s{attribute}[^<>]*+>", 0)


def labelled_block(body: Column, container: str, label_class: str, label: str) -> Column:
    """Markup from a label to the next label or the container's end, in the first container that has it; blank if none has."""
    opening = re.escape(container)
    marker = rf"{re.escape(label_class)}[^>]*>[^<]*{re.escape(label)}"
    pattern = rf"(?s){opening}[^>]*+>((?:(?!{opening}).)*?{marker}.*)"

    def region(rest: Column) -> Column:
        return F.regexp_extract(inside(rest, "div"), rf"(?s){marker}(.*?)(?:{re.escape(label_class)}|\z)", 1)

    # Most pages lack most labels, and the plain search is far cheaper than the pattern.
    return F.when(F.contains(body, F.lit(label)), bound(F.regexp_extract(body, pattern, 1), region)).otherwise(F.lit(""))


def value_text(region: Column, opening: str) -> Column:
    """Raw first text after an opening tag pattern inside a labelled block."""
    return decode_entities(F.regexp_extract(region, rf"(?s){opening}([^<]*+)", 1))


def tags_joined(body: Column, tag_class: str, separator: str = "|") -> Column:
    """First texts of all elements of a class, joined, stripped at the two ends."""
    void = r"<(?:br|wbr|img|hr)\b[^>]*+>"
    child = r"<([a-z0-9]++)\b[^>]*+>[^<]*+</\2>"
    found = F.regexp_extract_all(body, F.lit(rf"{class_pattern(tag_class)}[^>]*+>([^<]*+(?:(?:{void}|{child})[^<]*+)*+)"), F.lit(1))
    # An element's own text nodes: what its child elements hold is not among them.
    nodes = F.transform(found, lambda t: F.filter(F.split(t, rf"{void}|<([a-z0-9]++)\b[^>]*+>[^<]*+</\1>"), lambda n: n != ""))
    return strip_space(decode_entities(F.array_join(F.flatten(nodes), separator)))


def element_texts(body: Column, tag: str, separator: str = "|") -> Column:
    """Inner markup-free texts of all elements of one tag name, joined."""
    found = F.regexp_extract_all(body, F.lit(rf"(?s)<{tag}\b[^>]*+>(.*?)</{tag}>"), F.lit(1))
    spaced = F.transform(found, lambda t: F.regexp_replace(t, HARD_SPACE, "\u00a0"))
    texts = F.transform(spaced, lambda t: strip_space(F.regexp_replace(t, TAG_WITH_SPACE, "")))
    return F.array_join(F.transform(texts, decode_entities), separator)


def link_text_by_title(block: Column, title: str) -> Column:
    """Inner text of the first link with a given title."""
    pattern = rf'(?s)<a\b[^>]*?\stitle="{re.escape(title)}"[^>]*+>(.*?)</a>'
    return inner_text(F.regexp_extract(block, pattern, 1))


def last_block_text(block: Column, row_tag: str, block_tag: str) -> Column:
    """Normalised text of the last outermost ``block_tag`` in the last ``row_tag``."""
    last = F.substring_index(block, f"<{row_tag}", -1)
    # What the end of a table follows is a row of a table inside the block's own last row.
    row = F.when(F.contains(last, F.lit("</table")), last_block(closed_rows(block), row_tag)).otherwise(last)
    return bound(row, lambda own: _last_text(own, block_tag))


def _last_text(row: Column, block_tag: str) -> Column:
    if block_tag == "div":
        found = last_block(row, block_tag)
    else:  # elements that end where the next one starts
        found = F.regexp_extract(F.substring_index(row, f"<{block_tag}", -1), rf"(?s)^[^>]*+>(.*?)(?:</{block_tag}>|\z)", 1)
    content = F.when(F.contains(row, F.lit(f"<{block_tag}")), found).otherwise(F.lit(""))
    return F.trim(F.regexp_replace(inner_text(content), rf"{SPACE}++", " "))


def own_text(markup: Column) -> Column:
    """Text before the first tag, stripped."""
    return strip_space(decode_entities(F.substring_index(markup, "<", 1)))


def first_text(markup: Column, opening: str) -> Column:
    """Text right after the first opening tag that fits a pattern, stripped; blank if none does."""
    return strip_space(decode_entities(F.regexp_extract(markup, rf"{opening}([^<]*+)", 1)))


def cells_of(row: Column) -> Column:
    """Markup of each table cell of a row, in order."""
    return F.regexp_extract_all(row, F.lit(r"(?s)<td\b[^>]*+>(.*?)(?=</td>|<td\b|</tr>|\z)"), F.lit(1))


def nth_cell(cells: Column, n: int) -> Column:
    """Own first text of the n-th cell, stripped; blank when there is no such cell."""
    return F.coalesce(own_text(F.get(cells, F.lit(n - 1))), F.lit(""))


def table_after_label(body: Column, label: str) -> Column:
    """Markup of the table that directly follows the table holding a label."""
    between = r"(?:[^<]++|<(?!table\b|/(?:div|td|tr|form|body)\b))*+"
    pattern = rf"(?s){re.escape(label)}.*?</table>{between}<table\b[^>]*+>(.*?)</table>"
    return F.regexp_extract(body, pattern, 1)


def first_row_with_cell(table: Column) -> Column:
    return F.regexp_extract(table, r"(?s)<td\b.*?(?:</tr>|\z)", 0)


def script_param(body: Column, name: str) -> Column:
    """Quoted value of a name inside a script; null when the page has none."""
    return F.get(F.regexp_extract_all(body, F.lit(rf'"{re.escape(name)}":"([^"]*+)"'), F.lit(1)), F.lit(0))


def fallback_text(first: Column, second: Column) -> Column:
    return first_filled(first, second)


def has_class(body: Column, name: str) -> Column:
    # The plain search is far cheaper than the pattern, and most pages fail it.
    return F.contains(body, F.lit(name)) & F.regexp_like(body, F.lit(class_pattern(name)))


def has_text(body: Column, marker: str) -> Column:
    return F.contains(body, F.lit(marker))

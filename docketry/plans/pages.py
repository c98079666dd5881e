"""What kind of page a capture is, and where it stands in a search."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from docketry.functions.markup import attr_value, has_class, has_text
from docketry.functions.text import page_number
from docketry.plans import layouts as at


def of_kind(captures: DataFrame, kind: str) -> DataFrame:
    return captures.filter(F.col("request_kind") == kind)


def meta(name: str) -> Column:
    return F.try_element_at(F.col("meta"), F.lit(name))


def case_key() -> Column:
    return meta("numero_processo")


def page_kind_flags(body: Column | None = None) -> dict[str, Column]:
    page = F.col("body") if body is None else body
    return {
        "has_case_list": has_class(page, at.CASE_LIST_CLASS),
        "has_next": has_text(page, at.NEXT_PAGE_MARKER),
    }


def listed_case_code(body: Column) -> Column:
    """Code of the first case in a page's list of cases; blank if it shows none."""
    listed = F.regexp_extract(body, rf"(?s){at.CASE_LIST_HEADER}.*", 0)
    tag = F.regexp_extract(listed, rf'<input\b[^>]*\sid="{at.CASE_LIST_INPUT}"[^>]*+>', 0)
    return attr_value(tag, "value")


def current_page(body: Column, kind: Column) -> Column:
    """Page number shown in the pager; null when the marker is missing or not a number."""
    pager = F.regexp_extract(body, rf"(?s){at.PAGER_CLASS}.*", 0)
    bold = F.regexp_extract(pager, rf"{re.escape(at.CURRENT_PAGE_STYLE)}[^>]*+>([^<]*+)", 1)
    marked = F.regexp_extract(pager, rf'class="[^"]*{at.CURRENT_PAGE_CLASS}[^>]*+>([^<]*+)', 1)
    return page_number(F.when(kind == at.FIRST_SEARCH, bold).otherwise(marked))


def from_page(captures: DataFrame, first_page: int, page_no: Column) -> DataFrame:
    return captures.filter(page_no >= first_page)

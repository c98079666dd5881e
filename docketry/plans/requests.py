"""Next-request tables: what to capture next, derived from what is captured. Fetches nothing.

A request row is ``request_id, kind, url, meta, seq``; its id follows from kind and url.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from docketry.functions.links import quote_text
from docketry.functions.markup import script_param
from docketry.functions.text import strip_space
from docketry.operators.aggregates import distinct_keys
from docketry.operators.quarantine import split_bad
from docketry.plans import layouts as at
from docketry.plans.pages import case_key, current_page, listed_case_code, of_kind, page_kind_flags


def fill(base_url: str, template: str, **values: Column) -> Column:
    """A template's text and columns joined; null when one of the columns is null."""
    parts, rest = [], base_url + template
    for name, value in values.items():
        before, rest = rest.split("{" + name + "}", 1)
        parts += [F.lit(before), value]
    return F.concat(*parts, F.lit(rest))


def request_rows(df: DataFrame, kind: Column | str, url: Column, **meta: Column) -> DataFrame:
    kind_col = F.lit(kind) if isinstance(kind, str) else kind
    pairs = [p for name, value in meta.items() for p in (F.lit(name), value)]
    context = F.create_map(*pairs) if pairs else F.lit(None)
    rows = df.select(kind_col.alias("kind"), url.alias("url"), context.cast("map<string,string>").alias("meta"), "seq")
    return rows.select(F.sha2(F.concat_ws(" ", "kind", "url"), 256).alias("request_id"), "*")


def first_search_requests(searches: DataFrame, base_url: str, until: str) -> DataFrame:
    """From ``searches(seq, search)``; ``until`` is the last date, day/month/year."""
    url = fill(base_url, at.FIRST_SEARCH_QUERY, search=quote_text(F.col("search")), until=F.url_encode(F.lit(until)))
    return request_rows(searches, at.FIRST_SEARCH, url)


def second_search_requests(searches: DataFrame, base_url: str) -> DataFrame:
    url = fill(base_url, at.SECOND_SEARCH_QUERY, search=quote_text(F.col("search")))
    return request_rows(searches, at.SECOND_SEARCH, url)


def next_page_requests(captures: DataFrame, first_base: str, second_base: str) -> DataFrame:
    """One request per result page that offers a next page and shows its own number."""
    searches = captures.filter(F.col("request_kind").isin(at.FIRST_SEARCH, at.SECOND_SEARCH))
    offered = searches.filter(page_kind_flags()["has_next"])
    pages = offered.select(
        "seq", "request_kind", (current_page(F.col("body"), F.col("request_kind")) + 1).cast("string").alias("page")
    ).filter(F.col("page").isNotNull())
    url = F.when(
        F.col("request_kind") == at.FIRST_SEARCH, fill(first_base, at.FIRST_NEXT_PAGE, page=F.col("page"))
    ).otherwise(fill(second_base, at.SECOND_NEXT_PAGE, page=F.col("page")))
    return request_rows(pages, F.col("request_kind"), url)


def case_requests(work: DataFrame, base_url: str, kind: str, single: bool = False) -> DataFrame:
    """Lookup of each case of a work list. A single first-degree lookup has its own form.

    Rows without a case key give no request; ``split_cases`` sets them aside.
    """
    work, _ = split_cases(work)
    template = at.ONE_CASE_QUERY if single and kind == at.FIRST_CASE else at.LISTED_CASE_QUERY
    case = F.col("numero_processo")
    return request_rows(work, kind, fill(base_url, template, case=case), numero_processo=case)


def split_cases(work: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Work that can be asked for, and the rows without a case key, with the reason."""
    return split_bad(work, F.when(F.coalesce(F.col("numero_processo"), F.lit("")) == "", "no case key"))


def batch_requests(decisions: DataFrame, base_url: str) -> DataFrame:
    """One single first-degree lookup per distinct case, at the place it is first seen."""
    filled = distinct_keys(decisions.filter(F.col("numero_processo").isNotNull()))
    return case_requests(filled, base_url, at.FIRST_CASE, single=True)


def follow_ups(captures: DataFrame, kind: str, base_url: str) -> DataFrame:
    """Requests for the first case listed on pages that show a list instead of a case."""
    listed = of_kind(captures, kind).filter(page_kind_flags()["has_case_list"])
    rows = listed.select("seq", case_key().alias("numero_processo"), listed_case_code(F.col("body")).alias("code"))
    url = fill(base_url, at.SHOW_CASE_QUERY, code=F.col("code"))
    return request_rows(rows, kind, url, numero_processo=F.col("numero_processo"))


def doc_requests(links: DataFrame, base_url: str) -> DataFrame:
    """Access check of each document link."""
    blank = F.lit("")
    url = fill(
        base_url,
        at.DOC_ACCESS_QUERY,
        document=F.coalesce(F.col("documento"), blank),
        origin=F.coalesce(F.col("origem"), blank),
        process=F.coalesce(F.col("processo"), blank),
    )
    context = {c: F.col(c) for c in ("numero_processo", "documento", "titulo", "descricao", "processo")}
    return request_rows(links, at.DOC_ACCESS, url, **context)


def viewer_requests(captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The body of an access answer is the address of the viewer; answers without one are set aside."""
    answers = of_kind(captures, at.DOC_ACCESS)
    rows = answers.select("seq", strip_space(F.col("body")).alias("next_url"), F.col("meta").alias("context"))
    good, bad = split_bad(rows, F.when(F.coalesce(F.col("next_url"), F.lit("")) == "", "no viewer address"))
    return _with_context(good, at.DOC_VIEWER, F.col("next_url")), bad


def pdf_requests(captures: DataFrame, base_url: str) -> tuple[DataFrame, DataFrame]:
    """File requests from viewer pages, and the pages that have no parameter."""
    pages = of_kind(captures, at.DOC_VIEWER).select(
        "seq", script_param(F.col("body"), at.VIEWER_PARAM).alias("parameters"), F.col("meta").alias("context")
    )
    good, bad = split_bad(pages, F.when(F.col("parameters").isNull(), "no viewer parameter"))
    return _with_context(good, at.DOC_FILE, fill(base_url, at.DOC_FILE_QUERY, parameters=F.col("parameters"))), bad


def _with_context(df: DataFrame, kind: str, url: Column) -> DataFrame:
    rows = df.select(F.lit(kind).alias("kind"), url.alias("url"), F.col("context").alias("meta"), "seq")
    return rows.select(F.sha2(F.concat_ws(" ", "kind", "url"), 256).alias("request_id"), "*")


def union_requests(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)

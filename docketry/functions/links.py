"""Links: encoding, joining, rebuilding and host tests."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# The parameters a second-degree link must carry, in its order.
SECOND_DEGREE_PARAMS = ["nuProcesso", "cdProcessoSg", "cdForoSg", "isProcessoOrigemCr"]
SECOND_DEGREE_PATH = "/abrirConsultaProcessoSG.do?"


def quote_text(x: Column) -> Column:
    """Percent-encode as UTF-8, a space as ``%20``, the slash and tilde left alone."""
    quoted = F.url_encode(x)
    for found, wanted in [("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")]:
        quoted = F.replace(quoted, F.lit(found), F.lit(wanted))
    return quoted


def absolute_link(base_url: str, href: Column) -> Column:
    """The base put before a link; null when the link is blank or null."""
    return F.concat(F.lit(base_url), F.nullif(href, F.lit("")))


def required_params(params: Column, names: list[str]) -> Column:
    """True when every named parameter is present and filled."""
    return reduce(
        lambda a, b: a & b,
        [F.coalesce(F.try_element_at(params, F.lit(n)), F.lit("")) != "" for n in names],
    )


def rebuild_link(base_url: str, href: Column) -> Column:
    """Second-degree link from its four parameters, blank when one is missing; of repeated ones the last counts."""
    query = F.coalesce(F.get(F.split(href, r"\?"), F.lit(1)), F.lit(""))
    values = [F.regexp_extract(query, rf"(?s)^(?:.*&)?{re.escape(n)}=([^&]*+)", 1) for n in SECOND_DEGREE_PARAMS]
    pairs = [F.concat(F.lit(f"{n}="), v) for n, v in zip(SECOND_DEGREE_PARAMS, values)]
    rebuilt = F.concat(F.lit(base_url + SECOND_DEGREE_PATH), F.concat_ws("&", *pairs))
    filled = reduce(lambda a, b: a & b, [v != "" for v in values])
    return F.when(F.contains(href, F.lit("?")) & filled, rebuilt).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def host_allowed(url: Column, domains: list[str]) -> Column:
    """True when the host is one of the domains or below one of them."""
    name = host(url)
    return reduce(
        lambda a, b: a | b,
        [(name == d) | F.endswith(name, F.lit("." + d)) for d in domains],
    )


def has_suffix(url: Column, suffix: str = ".pdf") -> Column:
    return F.endswith(url, F.lit(suffix))

"""Pages gone through tag by tag in Python: same results as the column functions, whatever the markup."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from docketry.functions import markup, scan, structure, text
from docketry.functions.text import bound
from docketry.operators import blocks
from docketry.operators.scans import scanned

PIECES = [
    "<table>", '<table class="r">', "</table>", "<TABLE>", "</TABLE >", "<tr>", "<tr class='f'>", "</tr>", "<TR\n>", "<td>", "</td>", "<td-x>",
    '<td id="a">', "<TD ID = a>", "<TD CLASS='k' title=\"it's\">", "<div>", "</div>", "<div id='a' style='x>y'>", '<span id="a">', "</span>", "<br/>",
    '<input id="a"/>', '<a title="T" href="#">', "<a title='T'>", "</a>", "<A HREF=x/y?a=b NOWRAP>", "<!-- c -->", "<script>x<td></script>", "<p.q>",
    "<", ">", "< b", '"', "'", "=", "x", "é y", " \n ", "  ", "&amp;", "&nbsp;", "&#233;", "&#x93;", "&nope;", "&", "Label: v ", "</", "<>",
    '<td class="a k b">', "<td title='\"'>", '<b c="<td>">', "</table", "<tr/>", " id=\"a\"",
    "<br>", "<br />", "Advogado: z", '<i class="k">', "<span>", "<i>", "</i>", '<b id="b">',
]
CASES = {
    "prepare": (scan.prepare, markup.prepare),
    "element": (lambda x: scan.element(x, "a"), lambda x: structure.element(x, "a")),
    "inside": (lambda x: scan.inside(x, "td"), lambda x: structure.inside(x, "td")),
    "tables": (lambda x: scan.deep_elements(x, "table", 2), lambda x: structure.deep_elements(x, "table", 2)),
    "rows": (lambda x: scan.deep_elements(x, "tr", 1), lambda x: structure.deep_elements(x, "tr", 1)),
    "closed_rows": (scan.closed_rows, structure.closed_rows),
    "last_block": (lambda x: scan.last_block(x, "div"), lambda x: structure.last_block(x, "div")),
    "last_block_text": (lambda x: scan.last_block_text(x, "tr", "div"), lambda x: markup.last_block_text(x, "tr", "div")),
    "inner_text": (scan.inner_text, markup.inner_text),
    "labelled_cells": (scan.labelled_cells, markup.labelled_cells),
    "label_detail": (lambda x: scan.label_detail(x, "Label:"), lambda x: markup.label_detail(x, "Label:")),
    "link_text": (lambda x: scan.link_text_by_title(x, "T"), lambda x: markup.link_text_by_title(x, "T")),
    "first_text": (lambda x: scan.first_text(x, r"<a\b[^>]*+>"), lambda x: markup.first_text(x, r"<a\b[^>]*+>")),
    "own_text": (scan.own_text, markup.own_text),
    "tags_joined": (lambda x: scan.tags_joined(x, "k"), lambda x: markup.tags_joined(x, "k")),
    "roles": (
        lambda x: scan.texts_of_class(x, ("k", "b")),
        lambda x: F.regexp_extract_all(x, F.lit(rf"{markup.class_pattern('k', 'b')}[^>]*+>([^<]*+)"), F.lit(1)),
    ),
    "tag_with": (lambda x: scan.tag_with_class(x, "td", "k"), lambda x: markup.tag_with(x, "td", markup.class_pattern("k"))),
    "labelled_block": (lambda x: scan.labelled_block(x, "k b", "x", "y"), lambda x: markup.labelled_block(x, "k b", "x", "y")),
    "anchors": (
        lambda x: [scan.anchored_texts(x, ("a", "b")).get(i, "") for i in ("a", "b")],
        lambda x: bound(
            markup.anchored_heads(x, ["a", "b"]),
            lambda h: F.array(*[markup.head_text(markup.head_ids(h), markup.head_texts(h), i) for i in ("a", "b")]),
        ),
    ),
    "parties": (
        lambda x: [(p["nomes_parte"], p["advogados_parte"]) for p in scan.parties(x, "k")],
        lambda x: blocks.parties(x, "k"),
    ),
    "decode_entities": (scan.decode_entities, text.decode_entities),
}


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(11)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 24))) for _ in range(1500)]
    return [*made, *map(scan.prepare, made)]


def test_equals_the_column_functions(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "n int, x string").repartition(8)
    found = df.select("n", *[columns(F.col("x")).alias(name) for name, (_, columns) in CASES.items()]).collect()
    pairs = [(name, pages[r.n], plain(pages[r.n]), r[name]) for r in found for name, (plain, _) in CASES.items()]
    wrong = {name: (page, own, column) for name, page, own, column in pairs if own != column}
    assert not wrong


def test_rows_of_a_page_keep_its_other_columns(spark):
    rows = [(1, "ab", ["p"]), (2, None, ["q"]), (3, "", None), (4, "c" * 100, [])]
    df = spark.createDataFrame(rows, "k long, page string, own array<string>").coalesce(1)
    found = scanned(df, "page", lambda x: enumerate(x), "place int, sign string").collect()
    assert [tuple(r) for r in found] == [(1, ["p"], 0, "a"), (1, ["p"], 1, "b"), *[(4, [], n, "c") for n in range(100)]]


@pytest.mark.parametrize("cut", [scan.prepare, lambda x: scan.deep_elements(x, "table", 2), lambda x: scan.last_block_text(x, "tr", "div")])
def test_time_grows_with_the_page(cut):
    def seconds(n):
        page = "<table>" * 50 + "".join(f"<TR CLASS='c{k}'><td><table><div>x</div></table>" for k in range(n)) + "</table>" * 50
        best = []
        for _ in range(3):
            start = time.perf_counter()
            cut(page)
            best.append(time.perf_counter() - start)
        return min(best)

    assert seconds(32_000) < 10 * seconds(8000)

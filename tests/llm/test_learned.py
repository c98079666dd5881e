"""The classifier and the extraction of pages: corner cases, and accuracy on held-out rows."""

from __future__ import annotations

import html
import itertools
import random
import re

import numpy as np
import pytest

from docketry.llm import extract, quality, queries
from docketry.llm.blocks import blocks_of

CORNER = [None, "", "   ", "word", "x" * 20_000, "\n\n", "same text.", "same text."]


@pytest.fixture(scope="module")
def scores(spark, small):
    return queries.op3_quality(spark, "/root/testdata/sf0.01").toPandas()


def test_every_document_is_scored(spark, scores):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert len(scores) == docs and scores.score.between(0, 1).all()


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    learn, test = labels.filter("doc_id % 4 != 0"), labels.filter("doc_id % 4 = 0")
    found = quality.document_scores(docs, learn).join(test, "doc_id").toPandas()
    good = (found.quality == 1) & (found.toxic == 0)
    assert (found.keep == good).mean() > 0.9 and found.keep[good].mean() > 0.95


@pytest.mark.parametrize("fold", [1, 2])
def test_held_out_recall_of_bad_and_toxic(spark, fold):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    learn, test = labels.filter(f"doc_id % 4 <> {fold}"), labels.filter(f"doc_id % 4 = {fold}")
    found = quality.document_scores(docs, learn).join(test, "doc_id").toPandas()
    good = (found.quality == 1) & (found.toxic == 0)
    assert (~found.keep[~good]).mean() > 0.96 and (~found.keep[found.toxic == 1]).mean() > 0.91
    assert found.keep[good].mean() > 0.99


def test_corner_rows_are_scored(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)] + [(1, 0, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    df = docs(CORNER).selectExpr("*", "doc_id AS quality")
    out = quality.scored(df, labels).collect()
    assert len(out) == 8 and out[0].asDict().keys() >= {"quality", "_quality"}
    assert quality.document_scores(docs([]), labels).count() == 0
    kept = quality.kept(docs(CORNER), labels.limit(0))
    assert kept.count() == 8 and kept.columns == docs(CORNER).columns


def test_each_view_teaches_the_other():
    rng = np.random.default_rng(1)
    good = np.where(np.arange(400) < 300, rng.integers(0, 2, 400), -1)
    truth = np.where(good < 0, rng.integers(0, 2, 400), good)
    x = {"text": truth[:, None] + rng.normal(0, 0.1, (400, 1)), "meta": truth[:, None] + rng.normal(0, 0.6, (400, 1))}
    own = quality.co_train(quality.Classifier({}, {}, {}), x, good)
    assert ((own.text.probability(x["text"]) > 0.5) == truth).mean() > 0.98


def brute_labels(rows, model):
    weights, steps, first = model
    emits = [sum(weights.get(f, 0.0) for f in row) for row in rows]

    def value(labels):
        total = first * labels[0] + sum(e for e, y in zip(emits, labels) if y)
        return total + sum(steps[a][b] for a, b in zip(labels, labels[1:]))

    return list(max(itertools.product((0, 1), repeat=len(rows)), key=value))


def test_viterbi_finds_the_best_labels():
    rng = random.Random(3)
    for _ in range(60):
        blocks = blocks_of(extract.labelled_page(rng))[:9]
        rows = extract.features(blocks)
        assert extract.decode(rows, extract.field()) == brute_labels(rows, extract.field())


def test_phrases_late_in_a_long_block_are_seen():
    blocks = blocks_of("<p>" + "river stone winter " * 40 + "All rights reserved.</p>")
    assert "says=all rights reserved" in extract.features(blocks)[0]


def test_held_out_pages():
    rng, right, total = random.Random(123), 0, 0
    for _ in range(300):
        blocks, labels = extract.labelled(extract.labelled_page(rng))
        right += sum(a == b for a, b in zip(extract.decode(extract.features(blocks), extract.field()), labels))
        total += len(labels)
    assert right / total > 0.98


def test_reading_of_markup():
    page = (
        "<head><title>no</title></head><p>A&amp;B &eacute;<b>c</b>\n d<br>e<p>next<script>var t='</p>';</script> end"
        "<!-- <p>hidden</p> --><ul><li>one<li>two</ul><style>p{}</style><td>x<p title='>'>y</P>tail"
    )
    assert [b.text for b in blocks_of(page)] == ["A&B éc d e", "next end", "one", "two", "x", "y", "tail"]
    assert blocks_of("<script>never closed <p>x") == [] and blocks_of("a < b")[0].text == "a < b"


@pytest.mark.parametrize(
    "page",
    [
        "<html><body><svg-icon></svg-icon>{}",
        "<body><title-bar></title-bar>{}<template-x></template-x><select-menu></select-menu></body>",
        "<body><svg width='1'/>{}</body>",
        "<body><svg title='>'><text>no</text></svg >{}",
        "<!DOCTYPE html><html><head><meta charset=utf-8><title>no</title><link rel=a>{}",
        "<html><head>\n<script>var no;</script>\n<noscript><p>no</p></noscript>{}",
        "<title>no</title>{}",
    ],
)
def test_no_article_is_lost_with_its_head_or_custom_tags(page):
    article = "<article><h1>River stone</h1><p>Garden window meadow copper lantern.</p>Market winter, letter.</article>"
    assert [b.text for b in blocks_of(page.format(article))] == ["River stone", "Garden window meadow copper lantern.", "Market winter, letter."]
    assert extract.main_text(page.format(article)).startswith("River stone\nGarden window")
    assert [b.text for b in blocks_of(page.format("own text<p>more"))] == ["own text", "more"]


@pytest.mark.parametrize("many", ["<p>" * 50_000, "<div class='a' " * 20_000, "<" * 100_000, "a" * 500_000, "<li>x" * 20_000])
def test_odd_pages_end_soon(many):
    extract.main_text(many)


def article_of(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    parts = re.split(r"</?(?:p|h1)>", inside)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in p else "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_given_pages(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in queries.op4_main_text(spark, small).collect():
        assert r.text == article_of(pages[r.page_id]) and r.n_chars == len(r.text)


def test_corner_pages(spark):
    rows = [(1, None, None), (None, "u", ""), (3, "u", "<nav><a>menu</a></nav>"), (3, "u", "<nav><a>menu</a></nav>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "html AS text")
    assert [(r.text, r.n_chars) for r in extract.extract(df).collect()] == [("", 0)] * 4
    assert extract.extract(df.limit(0)).count() == 0

"""Lexical search against scores worked out one by one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from docketry.llm import lexical, queries
from tools.check import connect, rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            if c:
                m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
                score = 0
                for t in set(terms(text)):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                scores.append((-score, doc_id is None, doc_id or 0))
        best = sorted(s for s in scores if s[0] < 0)[:10]
        out += [(item_id, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(best, 1)]
    return sorted(out, key=str)


def prose(rng, n):
    return " ".join(f"w{min(int(rng.expovariate(0.05)), 300)}" for _ in range(n))


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.mark.parametrize("points, leaf", [(4096, 32), (50, 4)])
def test_equals_all_scores(docs, items, monkeypatch, points, leaf):
    monkeypatch.setattr(lexical, "TREE_POINTS", points)
    monkeypatch.setattr(lexical, "LEAF_POINTS", leaf)
    rng = random.Random(2)
    rows = [prose(rng, rng.randrange(1, 120)) for _ in range(500)]
    rows += [rows[3]] * 40 + [None, "", "...", "Öl ÖL öl ÄÖ", "w1-w2_w3 W1.W2", prose(rng, 20_000), "東京 w1\x00w2"]
    pairs = [*enumerate(rows), (3, rows[3]), (None, rows[7]), (None, rows[8])]
    rng.shuffle(pairs)
    asked = [(i, prose(rng, 25)) for i in range(30)] + [(31, rows[3]), (32, None), (33, ""), (34, "unknown"), (35, "ÖL öl 東京"), (5, prose(rng, 9)), (None, rows[7])]
    asked.append(asked[0])
    df = docs(pairs).selectExpr("*", "doc_id AS n", "text AS terms", "lang AS item_id")
    assert found(lexical.search(df, items(asked))) == brute(pairs, asked)
    assert found(lexical.search(df, items(asked), block_chars=400)) == brute(pairs, asked)


def test_empty_tables(docs, items):
    assert found(lexical.search(docs([]), items([(1, "a")]))) == []
    assert found(lexical.search(docs(["a b"]), items([]))) == []
    assert found(lexical.search(docs([None, ""]), items([(1, "a")]))) == []


def test_balls_hold_their_points_and_prune():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 900, 12)
    rows = [np.unique(np.concatenate([c + rng.integers(0, 12, 8), rng.integers(0, 1000, 2)])) for c in np.repeat(centres, 100)]
    sizes = np.array([len(r) for r in rows])
    columns, values = np.concatenate(rows), rng.integers(1, 10**6, int(sizes.sum()))
    tree = lexical.Tree(sizes, columns, values)
    dense = np.zeros((len(rows), 1000), np.int64)
    dense[np.repeat(np.arange(len(rows)), sizes), columns] = values
    for (low, high, *_), centroid, radius, rises in zip(tree.nodes, tree.centroids, tree.radii, tree.rises):
        own = dense[np.ix_(tree.order[low:high], tree.terms)]
        assert (own - centroid <= rises * (1 + 1e-12)).all()
        assert np.sqrt(((own - centroid) ** 2).sum(1)).max() <= radius
    opened = 0
    for c in centres:
        wanted = np.arange(c, c + 10)
        weights = rng.integers(1, 5000, 10)
        kept = lexical.Results()
        for points, scores in tree.search(wanted, weights, kept.least):
            opened += 1
            kept.add(scores, [[(False, int(p))] for p in points])
        scores = dense[:, wanted] @ weights
        best = sorted((-int(s), False, i) for i, s in enumerate(scores) if s > 0)[:10]
        assert [x for x in kept.kept if x[0] < 0] == best
    leaves = sum(n[2] < 0 for n in tree.nodes)
    assert opened < 0.9 * leaves * len(centres)


def test_equals_sql(spark, small):
    con = connect(small)
    cursor = con.execute(lexical.ORACLE)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    df = queries.op12_lexical_search(spark, small)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want and want.total() > 50

"""Near-duplicate classes, URL lists and the pipeline against brute force."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest

import corpus_pipeline
from docketry.llm import decontaminate, dedup, queries, secrets, urls
from tools.check import connect, rows_of


def shingles(text):
    words = (text or "").lower().split()
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def brute_classes(rows):
    """Least id of each component of the links, by comparing all pairs of different texts."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            union = (x | y).total()
            if (not union and not x and not y) or (union and (x & y).total() / union >= 0.8):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}


def prose(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()) + str(rng.randrange(40)) for _ in range(n)]


def test_classes_equal_all_pairs(docs):
    rng, rows = random.Random(5), []
    for size in (8, 60, 60, 300):
        base = prose(rng, size)
        for copy in range(12):
            words = list(base)
            for _ in range(copy % 4):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(9)}"
            rows.append(" ".join(words) if copy % 5 else "  ".join(words).upper())
    chain = prose(rng, 200)
    for step in range(10):  # neighbours are alike, the ends are not
        chain = list(chain)
        chain[step * 12 : step * 12 + 3] = ["x", "y", f"z{step}"]
        rows.append(" ".join(chain))
    rows += [None, "", "  ", "one", "one", "two words", "a a a a a a a a", "a a a a a a a a a", "w " * 4000]
    pairs = list(enumerate(rows)) + [(5, rows[5]), (None, rows[0])]
    random.Random(1).shuffle(pairs)
    got = dedup.classes(docs(pairs).selectExpr("*", "doc_id AS node", "text AS bands")).collect()
    want = brute_classes(pairs)
    assert len(got) == len(pairs) and all(r.class_id == want.get(r.doc_id) for r in got)
    kept = dedup.one_per_class(docs(pairs))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [*((False, i) for i in sorted(set(want.values()))), (True, 0)]
    assert dedup.classes(docs([])).count() == 0


def test_one_of_each_class_where_ids_name_several_texts(docs):
    a, b = " ".join(prose(random.Random(1), 50)), " ".join(prose(random.Random(2), 50))
    rows = [(1, a), (1, b), (1, a.upper()), (2, a), (3, b + " end"), (None, a), (4, "c"), (5, "d"), (5, a), (0, "d")]
    df = docs(rows).selectExpr("*", "doc_id AS node")
    kept = dedup.one_per_class(df)
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text.lower()) for r in kept.collect()), key=str)
    assert found == sorted([(1, a), (1, b), (4, "c"), (0, "d"), (None, a)], key=str)


def test_large_group_of_near_copies(docs):
    rng = random.Random(8)
    base = prose(rng, 120)
    rows = [" ".join([*base[:60], f"id{n}", *base[60:]]) for n in range(400)] + [" ".join(base)] * 200
    assert {r.class_id for r in dedup.classes(docs(rows)).collect()} == {0}


@pytest.mark.parametrize("weights", [(1, 1), (3, 1)])
def test_agreement_of_signatures_is_the_weighted_similarity(weights):
    a = [w for i in range(300) for w in [f"s{i}"] * (weights[i % 2])]
    b = [w for i in range(100, 400) for w in [f"s{i}"] * (weights[i % 2])]
    with np.errstate(over="ignore"):
        x, y = (dedup.elements(t) for t in (a, b))
        runs = []
        for salt in range(20):
            seed = np.uint64(salt * 7919 + 1)
            runs.append((dedup.signature(dedup.mixed(x + seed)) == dedup.signature(dedup.mixed(y + seed))).mean())
    assert abs(np.mean(runs) - dedup.similarity(x, y)) < 0.03


def test_each_size_of_text_fills_its_signature():
    with np.errstate(over="ignore"):
        for n in (1, 2, 20, 500, 40_000):
            assert len(set(dedup.signature(dedup.elements([f"w{i}" for i in range(n + 4)])).tolist())) == dedup.COORDINATES


def test_given_documents_classes(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = brute_classes(rows)
    assert {r.doc_id: r.class_id for r in queries.op1_near_dedup(spark, small).collect()} == want


START = datetime(2024, 1, 1)


def brute_verdict(url, at, entries):
    host = url.split("://")[1].split("/")[0].lower() if url and "://" in url else ""
    parts = [p for p in url.split("://")[1].split("?")[0].split("/")[1:] if p] if host else []
    if not host or at is None:
        return ("none", None, 0)
    strength = {"block": 2, "allow": 1, "remove": 0}
    best = None
    for pattern in {p for _, p, _, _ in entries}:
        clean = pattern.rstrip("/")
        head, *tail = clean.split("/")
        if not (parts[: len(tail)] == tail and (host == head if tail else host == head or host.endswith("." + head))):
            continue
        modes = []
        for name in {n for n, _, _, _ in entries}:
            past = [(t, strength[a]) for n, p, a, t in entries if (n, p.rstrip("/")) == (name, clean) and t <= at]
            if past:
                modes.append(max(past)[1])
        active = [m for m in modes if m]
        if active:
            kind = "allow" if 1 in active else "block"
            found = (bool(tail), len(clean), clean, kind, active.count(1 if kind == "allow" else 2))
            best = max(best, found) if best else found
    return ("none", None, 0) if best is None else (best[3], best[2], best[4])


def test_lists_as_of_fetch_time(spark):
    rng = random.Random(4)
    patterns = ["bad.example.com", "example.com", "sub.bad.example.com", "bad.example.com/en/", "bad.example.com/en/x", "other.org"]
    entries = [(rng.choice("ab"), rng.choice(patterns), rng.choice(["block", "allow", "remove"]), START + timedelta(days=rng.randrange(20))) for _ in range(40)]
    odd = [("a", None, "block", START), ("a", "x.com", "block", None), ("a", "x.com", "what", START), ("a", "", "block", START)]
    hosts = ["bad.example.com", "sub.bad.example.com", "a.sub.bad.example.com", "EXAMPLE.com", "notexample.com", "other.org", "x.com"]
    captures = [(n, f"http://{rng.choice(hosts)}/{rng.choice(['', 'en', 'en/x/y?q', 'fr'])}", START + timedelta(hours=rng.randrange(600))) for n in range(300)]
    captures += [(n, "https://bad.example.com/en/", START + timedelta(hours=n)) for n in range(300, 700)]
    captures += [(900, None, START), (901, "", START), (902, "no url", START), (903, "http://other.org/", None), (None, "http://other.org/", START)]
    captures += captures[:3]
    left = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").selectExpr("*", "url AS pattern", "1 AS at")
    right = spark.createDataFrame(entries + odd, "list_name string, pattern string, action string, listed_at timestamp")
    got = Counter((r.page_id, r.url, r.verdict, r.pattern, r.n_lists) for r in urls.judged(left, right).collect())
    assert got == Counter((i, u, *brute_verdict(u, t, entries)) for i, u, t in captures)
    assert {r.verdict for r in urls.judged(left, right.limit(0)).collect()} == {"none"}
    assert urls.judged(left.limit(0), right).count() == 0


def test_list_join_equals_sql_and_runs_no_python(spark, small):
    df = queries.op7_url_filter(spark, small)
    cursor = connect(small).execute(queries.ORACLE_SQL["op7_url_filter"])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))


def test_pipeline_against_its_parts(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    kept = {r.doc_id for r in queries.op3_quality(spark, small).collect() if r.keep}
    alone = {i for i, c in brute_classes([(i, docs[i]) for i in kept]).items() if i == c}
    items = [decontaminate.normalised(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    dirty = {r.doc_id for r in queries.op5_decontamination(spark, small).collect()}
    assert all(any(x in decontaminate.normalised(docs[i]) for x in items) for i in dirty)
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    assert set(out) == alone - dirty and all(r.round_trip for r in out.values())
    from docketry.llm import pieces

    own = pieces._encoder(queries.public_tokenizer("piece_bpe_32k.model"), pieces.model(queries.public_tokenizer("piece_bpe_32k.model")))
    for i, r in out.items():
        assert r.n_tokens == len(own.encode([secrets.redact(docs[i], secrets.find(docs[i]))])[0])


def test_stages_keep_columns_and_survive_empty_input(spark, small, docs):
    frame = docs([None, "", "token=abcdefghij1 text"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (frame, frame.limit(0)):
            assert stage(spark, df, small).columns == frame.columns, name


def edited(rng, words, edits):
    out = list(words)
    for place in rng.sample(range(len(out)), edits):
        out[place] = f"edit{rng.randrange(10**9)}"
    return " ".join(out)


def test_groups_of_copies_make_no_pairs_of_all_with_all(docs, monkeypatch):
    """Copies below 0.8 of each other, copies of one original, and copies that are alike without one."""
    rng = random.Random(6)
    texts = []
    for edits, original in ((3, False), (2, True), (1, False)):
        base = prose(rng, 120)
        texts += [edited(rng, base, edits) for _ in range(200)] + [" ".join(base)] * original
    made = []
    monkeypatch.setattr(dedup, "verified", lambda pairs, sets, real=dedup.verified: made.append(pairs.count()) or real(pairs, sets))
    got = dedup.classes(docs(texts)).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(list(enumerate(texts)))
    assert sum(made) <= 0.06 * 3 * 200 * 199 / 2


def test_groups_that_pivots_of_buckets_leave_apart_make_few_pairs(docs, monkeypatch):
    """Each text of a group is alike to all others; the buckets' pivots are taken to find none of it."""
    rng = random.Random(12)
    texts = []
    for words in (120, 150):
        base = prose(rng, words)
        texts += [edited(rng, base, 1) for _ in range(100)]
    made = []
    monkeypatch.setattr(dedup, "candidates", lambda *args, real=dedup.candidates: real(*args).limit(0))
    monkeypatch.setattr(dedup, "verified", lambda pairs, sets, real=dedup.verified: made.append(pairs.count()) or real(pairs, sets))
    got = dedup.classes(docs(texts)).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(list(enumerate(texts)))
    assert sum(made) <= 5 * len(texts)

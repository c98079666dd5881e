"""Benchmark matching and pieces against plain Python and the library."""

from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from docketry.llm import decontaminate, pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def plain_distance(item, text):
    """Least edit distance of the item to any substring, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@given(st.text("ab c", min_size=1, max_size=12), st.text("ab c", max_size=40))
@settings(max_examples=300, deadline=None)
def test_bit_parallel_distance(item, text):
    masks = {c: sum(1 << i for i, x in enumerate(item) if x == c) for c in set(item)}
    assert decontaminate.best_distance(masks, len(item), text) == plain_distance(item, text)


@given(st.lists(st.text("abc ", min_size=1, max_size=24), max_size=4), st.text("abc ", max_size=80), st.sampled_from([0, 0.1, 0.2, 0.4]))
@settings(max_examples=300, deadline=None)
def test_no_passage_within_the_budget_is_missed(items, text, rate):
    plain = decontaminate.normalised(text)
    want = []
    for n, item in enumerate(map(decontaminate.normalised, items)):
        if item and plain_distance(item, plain) <= int(len(item) * rate):
            want.append((n, plain_distance(item, plain)))
    assert decontaminate.Matcher(list(enumerate(items)), rate).find(text) == want


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        chars[at : at + 1] = rng.choice(["", "x", chars[at] + "y"])
    return "".join(chars)


@pytest.mark.parametrize("block_chars", [50, 10**6])
def test_matches_and_filter(spark, docs, block_chars):
    rng = random.Random(1)
    item = "the quick brown fox jumps over the lazy dog and then it sleeps for a while"
    far = edited(rng, item, 30)
    texts = [None, "", item.upper(), "start " + edited(rng, item, 4) + " end", far, "clean text here", "w " * 5000 + item, item[:40]]
    bench = spark.createDataFrame([(1, item), (2, None), (3, "  "), (1, item), (4, "not there at all")], "item_id long, text string")
    got = decontaminate.matches(docs(texts), bench, 0.08, block_chars).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted([(2, 1), (3, 1), (6, 1)] * 2)
    clean = decontaminate.without_matches(docs(texts).selectExpr("*", "doc_id AS hit"), bench, 0.08, block_chars)
    assert sorted(r.hit for r in clean.collect()) == [0, 1, 4, 5, 7] and "n_chars" in clean.columns
    assert decontaminate.matches(docs([]), bench).count() == 0
    assert decontaminate.without_matches(docs(texts), bench.limit(0)).count() == len(texts)


def test_given_benchmark(spark, small):
    texts = [(r.doc_id, decontaminate.normalised(r.text)) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, decontaminate.normalised(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    exact = {(d, i) for d, t in texts for i, x in items if x in t}
    got = queries.op5_decontamination(spark, small).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.distance == 0} == exact and exact


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CORNER = ["", " ", "   ", "a", "Hello  wörld\nfoo\tbar 日本 ", "  a", "a\nb c", "\n\n x\n", "a▁b  ▁c", "  \n  \n", "x" * 3000, "é" * 70, "🎉🎉 ok", "don't stop!!! $$$ *** &&&"]
WORDS = st.lists(st.sampled_from(["the", "tion", "ing", " ", "  ", "\n", "é", "ß", "日", "🎉", "▁", "Q", "!!", "0", "\t", "ein", "x"]), max_size=25)


@given(WORDS.map("".join) | st.text(max_size=30).filter(lambda t: "\x00" not in t))
@settings(max_examples=400, deadline=None)
def test_ids_equal_the_library(text):
    own = pieces._encoder(MODEL, pieces.model(MODEL))
    ids = own.encode([text])[0]
    assert ids.tolist() == LIBRARY.encode(text)
    assert pieces.decode(ids, own.m.texts) == text.replace("▁", " ")


@pytest.mark.parametrize("matrix_chars", [3, 64])
def test_batches_long_words_and_corner_texts(monkeypatch, matrix_chars):
    monkeypatch.setattr(pieces, "MATRIX_CHARS", matrix_chars)
    own = pieces.Encoder(pieces.model(MODEL))
    assert [x.tolist() for x in own.encode(CORNER)] == [LIBRARY.encode(t) for t in CORNER]


def test_documents_round_trip(spark, small, docs):
    table = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    encoded = {r.doc_id: list(r.ids) for r in pieces.encode_documents(table, MODEL).collect()}
    assert encoded == {d: LIBRARY.encode(t) for d, t in texts.items()}
    decoded = pieces.decode_documents(pieces.encode_documents(table, MODEL), MODEL).collect()
    assert {r.doc_id: r.text for r in decoded} == texts
    for r in queries.op9_sentencepiece(spark, small).collect():
        assert r.round_trip and r.n_tokens == len(encoded[r.doc_id])
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()
    rows = pieces.round_trip(docs([None, "", (None, "a b")]), MODEL).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 2] and all(r.round_trip for r in rows)
    assert pieces.round_trip(docs([]), MODEL).count() == 0

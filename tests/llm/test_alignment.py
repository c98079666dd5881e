"""Alignment of two tokenizers against the libraries run on whole texts."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from docketry.llm import align, queries

A_PATH, B_PATH = "byte_bpe_50k.json", "piece_bpe_32k.model"


def token_bytes():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.public_tokenizer(A_PATH))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=queries.public_tokenizer(B_PATH))
    decode = {chr(x): x for x in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    spare = (x for x in range(256) if x not in decode.values())
    decode |= {chr(256 + n): x for n, x in enumerate(list(spare))}

    def of_a(text):
        return [(i, bytes(decode[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def of_b(text):
        out = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            byte = len(piece) == 6 and piece.startswith("<0x")
            out.append((i, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
        return out

    return of_a, of_b


def brute(texts):
    of_a, of_b = token_bytes()
    found, counts = [], Counter()
    for text in texts:
        a, b = (of_a(text), of_b(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            found.append(None)
            continue
        ends_a = dict(zip(np.cumsum([len(x) for _, x in a]).tolist(), range(len(a))))
        ends_b = dict(zip(np.cumsum([len(x) for _, x in b]).tolist(), range(len(b))))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            x, y = ends_a[end], ends_b[end]
            groups.append(",".join(str(t) for t, _ in a[i : x + 1]) + "|" + ",".join(str(t) for t, _ in b[j : y + 1]))
            links.append((a[x][0], b[y][0]))
            i, j = x + 1, y + 1
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    rows = []
    for x in found:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_best = sum(counts[p] == best[p[1]] for p in x[3])
            digest = sha256(";".join(x[2]).encode()).hexdigest()
            rows.append((x[0], x[1], len(x[2]), len(x[3]), n_best, sum(counts[p] for p in x[3]), digest))
    return rows


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a\n  b", "a \n b", "\n", " \n ", "tab\t x", "héllo 你好 😀 ok", "࿀ ࿀࿀x",
    "x▁y", "▁", "<|endoftext|> <s> <0x41> </s>", "it's we'll don't", " nbsp   x", "　 wide 　", "é combine",
    "\x00 nul\x00", "a" * 300, "9" * 50 + " 1,000.00", "the the the the", " line  sep \u0085 nel", "😀😀 😀", "x\x1c y", "﻿bom",
]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    signs = ["a", "b", "The", " ", "  ", "\n", "\t", "é", "你", "😀", "࿀", "▁", "'s", ".", "1", " ", "　", "\x00", "word", "ing", " x"]
    return [*ODD, *("".join(rng.choices(signs, k=rng.randrange(1, 30))) for _ in range(n))]


def rows_of(df):
    return sorted(((r.doc_id, *list(r)[1:]) for r in df.collect()), key=str)


@pytest.mark.parametrize("frequent", [align.FREQUENT, 40])
def test_equals_whole_library_runs(docs, frequent):
    texts = odd_texts(400)
    texts += [texts[14]] * 30  # copies whose rare pairs are looked up once
    paths = queries.public_tokenizer(A_PATH), queries.public_tokenizer(B_PATH)
    df = docs(texts).selectExpr("*", "doc_id AS links", "text AS pair", "lang AS rest")
    got = rows_of(align.alignment(df, *paths, frequent=frequent))
    want = sorted(((i, *row) for i, row in enumerate(brute(texts))), key=str)
    assert got == want


def test_repeated_rows_missing_ids_empty_tables_and_long_texts(docs):
    paths = queries.public_tokenizer(A_PATH), queries.public_tokenizer(B_PATH)
    long = " ".join(f"word{i % 977} 你" for i in range(60_000)) + "x" * 20_000
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (None, None), (2, long)]
    got = rows_of(align.alignment(docs(rows), *paths))
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows]))), key=str)
    assert got == want
    assert align.alignment(docs([]), *paths).count() == 0


def test_whole_table(spark, small):
    got = rows_of(queries.op11_alignment(spark, small))
    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(((r.doc_id, *x) for r, x in zip(table, brute([r.text for r in table]))), key=str)


def test_tally_gives_out_what_it_cannot_hold(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(align, "HELD", 5)
    batches = [pa.RecordBatch.from_arrays([pa.array([np.arange(k, k + 4).tobytes()], pa.binary())], names=["links"]) for k in range(9)]
    total = Counter()
    for out in align._tally(iter(batches)):
        for row in out.to_pylist():
            total[row["pair"]] += row["n"]
    assert total == Counter(x for k in range(9) for x in range(k, k + 4))


def test_parts_are_forgotten_by_generations(monkeypatch):
    monkeypatch.setattr(align, "KEPT_PARTS", 5)
    texts = odd_texts(60, seed=8)
    paths = queries.public_tokenizer(A_PATH), queries.public_tokenizer(B_PATH)
    few, fresh = align.Aligner(*paths), align.Aligner(*paths)
    for i in range(0, len(texts), 4):
        some = [t for t in texts[i : i + 4] if t]
        fresh.parts.clear()
        fresh.unsound.clear()
        assert few.align(some) == fresh.align(some)
        assert few.unsound <= {*few.parts, *few.elder}

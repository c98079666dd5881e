"""Personal data, secrets, fingerprints and token files against plain Python."""

from __future__ import annotations

import base64
import gzip
import random
import re
import time
import zlib
from hashlib import sha256
from urllib.parse import quote

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from docketry.llm import merkle, pii, queries, secrets, tokenfile

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CORNER = [None, "", "   ", "plain words only", "plain words only", "x" * 5_000, "é" * 50 + "\n\n# head\nlast."]


def digest(parts):
    return sha256(",".join(f"{k}:{s}:{e}" for k, s, e in parts).encode()).hexdigest()


def naive_pii(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        double = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def naive_secrets(text):
    pattern = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", *m.span()) for m in re.finditer(pattern, text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


PII_TEXTS = st.text(st.sampled_from("a1.@+-25 0()%é9"), max_size=60) | st.lists(
    st.sampled_from(["4111 1111 1111 1111", "a.b@c.de", "@", "1.2.3.4", "+1 (555) 123-4567", ".", " ", "300.1.1.1", "x"])
).map("".join)


@given(PII_TEXTS)
@settings(max_examples=400, deadline=None)
def test_base_personal_data_equals_the_plain_patterns(text):
    assert [x[:3] for x in pii.find(text) if x[0] in pii.BASE_KINDS] == naive_pii(text)


SECRET_TEXTS = st.lists(
    st.sampled_from(["token", "PassWord", "api_key", "secret", "=", ": ", '"', " ", "abcdefgh", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "ſ", "é"])
).map("".join)


@given(SECRET_TEXTS)
@settings(max_examples=400, deadline=None)
def test_base_secrets_equal_the_plain_patterns(text):
    assert [x for x in secrets.find(text) if x[0] in secrets.BASE_KINDS] == naive_secrets(text)


def test_validators_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    spans = pii.find("account GB82 WEST 1234 5698 7654 32 or call 555 123 4567, code 555 123 4567" + "." * 60)
    assert [(k, s) for k, s, _, _ in spans] == [("iban", 8), ("phone_local", 44), ("phone_local", 63)]
    assert not pii.find("x" * 60 + " 555 123 4567 " + "x" * 60)
    assert not [x for x in pii.find("GB82 WEST 1234 5698 7654 33") if x[0] == "iban"]
    assert pii.find("server 10.0.0.1")[0][3] > pii.find("v 10.0.0.1")[0][3]


@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"])
@pytest.mark.parametrize("after", [" BIC COBADEFFXXX", " 2024-05-17", " 20240517", " 17.05.2024", " EUR 100", " OK", "", ", then", " Bank", " X1 DE89 3704 0044 0532 0130 00"])
def test_iban_with_words_after_it(iban, after):
    found = [x[1:3] for x in pii.find(f"IBAN {iban}{after}") if x[0] == "iban"]
    assert found[0] == (5, 5 + len(iban)) and len(found) == 1 + after.startswith(" X1")


@pytest.mark.parametrize("many", ["1" * 300_000, "a" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" * 100_000])
def test_long_runs_are_scanned_in_linear_time(many):
    pii.find(many)
    secrets.find(many)


def layers(secret):
    raw = f'token = "{secret}"'.encode()
    yield "base64", base64.b64encode(raw).decode()
    yield "base64", base64.b64encode(gzip.compress(raw)).decode()
    yield "base64", base64.b64encode(zlib.compress(raw)).decode()
    yield "url", quote(raw.decode(), safe="").replace("token", "%74oken")
    yield "url>base64", quote(base64.b64encode(raw).decode(), safe="").replace("d", "%64")
    yield "base64>base64", base64.b64encode(base64.b64encode(raw)).decode()
    yield "unicode", "".join(f"\\u{c:04x}" for c in raw)


@pytest.mark.parametrize("path, coded", list(layers("hunter2hunter2")))
def test_decoded_layers_are_scanned_and_mapped_back(path, coded):
    text = f"before {coded} after"
    found = [x for x in secrets.find(text) if x[0] == f"{path}>assign"]
    assert found and 7 <= found[0][1] < found[0][2] <= 7 + len(coded)
    masked = secrets.redact(text, found)
    assert masked.startswith("before ") and masked.endswith(" after") and secrets.MASK in masked


RAW = b'first line\ntoken = "hunter2hunter2"\nlast line of it\n'
LONG = "".join(f"line {i} of {sha256(b'%d' % i).hexdigest()[:9]} text\n" for i in range(9)) + RAW.decode()


def wrapped(raw, columns, end="\n"):
    coded = base64.b64encode(raw).decode()
    return end.join(coded[i : i + columns] for i in range(0, len(coded), columns))


@pytest.mark.parametrize("before", ["https://host.example/cb/", "cfg_", "cfg-", "a/b_c-", "x/yy/zzz/"])
@pytest.mark.parametrize("raw", [RAW, gzip.compress(RAW), b"\xff\xfe" + RAW.decode().encode("utf-16-le")])
@pytest.mark.parametrize("encode", [base64.b64encode, base64.urlsafe_b64encode])
@pytest.mark.parametrize("after", ["", "/x.txt"])
def test_payload_behind_a_prefix(before, raw, encode, after):
    text = f"see {before}{encode(raw).decode()}{after} end"
    found = [x for x in secrets.find(text) if x[0] == "base64>assign"]
    assert found and all(4 + len(before) <= s < e <= len(text) - 4 for _, s, e in found)


@pytest.mark.parametrize("columns", [64, 76, 41])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    ", "\\n"])
@pytest.mark.parametrize("raw", [LONG.encode(), gzip.compress(LONG.encode()), ("é" + LONG).encode("latin-1")])
def test_wrapped_base64(columns, end, raw):
    for around in ("data:\n{}\nhello there", "data {}", "some_long_identifier_here\n{}\n"):
        found = [x for x in secrets.find(around.format(wrapped(raw, columns, end))) if x[0] == "base64>assign"]
        assert len(found) == 1


def test_all_tokens_of_a_list_are_read():
    tokens = [base64.b64encode(b'token = "hunter2hunter%d"' % i).decode().rstrip("=") for i in range(12)]
    text = "\n".join(tokens)
    found = [(s, e) for k, s, e in secrets.find(text) if k == "base64>assign"]
    assert all(any(s <= text.index(t) + 9 < e for s, e in found) for t in tokens)


def test_value_encoded_behind_a_plain_key_word():
    text = "password = %68unter2hunter2 rest"
    assert ("url>assign", 0, 27) in secrets.find(text)


SECRET = b'token = "hunter2hunter2"\n'
PARTS = {
    "gzip members": gzip.compress(b"first\n") + gzip.compress(SECRET),
    "zstd frames": zstandard.compress(b"first\n") + zstandard.compress(SECRET),
    "padding between": gzip.compress(b"first\n") + bytes(20) + gzip.compress(SECRET),
    "rest after": gzip.compress(b"first\n") + SECRET,
    "damaged end": gzip.compress(SECRET)[:-8] + bytes(8),
    "twice": gzip.compress(zlib.compress(SECRET)),
    "mark": b"\xef\xbb\xbf" + SECRET,
    "no-break space": "a\u00a0b ".encode() + SECRET,
    "form feed": b"a\x0c" + SECRET,
    "nul": b"a\0" + SECRET,
    "utf-16": SECRET.decode().encode("utf-16"),
    "utf-16 big": SECRET.decode().encode("utf-16-be"),
    "latin-1": "naïve ".encode("latin-1") + SECRET,
    "archive": gzip.compress(b"name.env" + bytes(100) + SECRET + bytes(300)),
    "nested": b"\xff\0" + base64.b64encode(SECRET),
}


@pytest.mark.parametrize("raw", PARTS.values(), ids=PARTS.keys())
def test_whole_content_of_layers_is_read(raw):
    found = secrets.find(f"before {base64.b64encode(raw).decode()} after")
    assert [k.split(">")[-1] for k, _, _ in found] == ["assign"]


def test_unpack_reads_to_the_end():
    assert secrets.unpack(gzip.compress(b"a") + gzip.compress(b"b")) == b"ab" == secrets.unpack(zstandard.compress(b"a") + zstandard.compress(b"b"))
    assert secrets.unpack(b"xylophone") is None


def test_distinct_secrets_of_one_run_stay_distinct():
    lines = [f"password{i}: x\npassword={i}hunter2hunter\nclean {i}\n" for i in range(5)]
    raw = "".join(lines)
    for coded in (base64.b64encode(raw.encode()).decode(), "".join(f"%{c:02x}" for c in raw.encode()), "".join(f"\\x{c:02x}" for c in raw.encode())):
        text = f"before {coded} after"
        found = secrets.find(text)
        assert len({x[1:] for x in found}) == 5 and {x[0].split(">")[-1] for x in found} == {"assign"}
        masked = secrets.redact(text, found)
        assert masked.count(secrets.MASK) == 5 and len(masked) > len(text) / 3
    packed = base64.b64encode(gzip.compress(raw.encode())).decode()
    found = secrets.find(f"before {packed} %41 after")
    assert len(set(found)) == 5 and {x[1:] for x in found} == {(7, 7 + len(packed))}
    assert secrets.redact(f"before {packed} after", found) == "before [REDACTED] after"
    url = "é=%C3%A9 x=%ff" + "%70assword=hunter2hunter2"
    assert secrets.find(url) == [("url>assign", 14, len(url))]


def test_cycles_end_and_bombs_are_reported(monkeypatch):
    assert secrets.find("%2525252525252525") == []
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1000)
    bomb = base64.b64encode(zlib.compress(b"a" * 5000)).decode()
    assert secrets.find("x " + bomb) == [("unread", 2, 2 + len(bomb))]


@pytest.mark.parametrize("kb", [1, 10, 100, 1000])
@pytest.mark.parametrize("start, again, end", [("%", "25", "41"), ("\\", "u005c", "u0041"), ("\\", "x5c", "x41"), ("&", "#38;", "#65;")])
def test_nested_escapes_take_one_step_and_few_spans(kb, start, again, end):
    nested = start + again * (kb * 1000 // len(again)) + end
    text = f"token=hunter2hunter{nested}. " + nested
    began = time.perf_counter()
    found = secrets.find(text)
    assert time.perf_counter() - began < 2 + kb / 100
    span = next(x for x in found if x[0].endswith(">assign"))
    assert span[1] == 0 and span[2] >= len("token=hunter2hunter" + nested) and len(found) < 8


def test_escaped_escape_signs_end_in_the_same_text():
    """Against unwrapping one level at a time with plain replacements."""
    signs = random.Random(3)
    for _ in range(3000):
        text = "".join(signs.choices(["%", "25", "41", "3D", "z", "%25", "%C3%A9", "\\u005c", "u0041", "&#38;", "#65;"], k=12))
        layer, seen = secrets.Layer(text), set()
        while layer is not None and layer.text not in seen:
            seen.add(layer.text)
            last, layer = layer, next((x for c in secrets.CODECS[:2] if (x := layer.decoded(*c, {"next": 1})[0])), None)
        assert last.text == plainly(text) and (last.places is None or (last.places[0] < last.places[1]).all())


def plainly(text):
    def unwrapped(s):
        url = re.sub("(?:%[0-9A-Fa-f]{2})+", lambda m: bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace"), s)
        if url != s:
            return url
        return re.sub(r"\\u([0-9A-Fa-f]{4})|&#([0-9]+);", lambda m: chr(int(m[1], 16) if m[1] else int(m[2])), s)

    while (after := unwrapped(text)) != text:
        text = after
    return text


def test_paths_of_repeated_codecs():
    path = ""
    for name, want in [("url", "url>"), ("base64", "url>base64>"), ("base64", "url>base64>base64>"), ("base64", "url>base64*3>"), ("base64", "url>base64*4>"), ("url", "url>base64*4>url>")]:
        assert (path := secrets.longer_path(path, name)) == want


def test_scans_of_whole_tables(spark, docs):
    texts = CORNER + ["mail me: a@b.cd", "token=abcdefghi1"]
    got = {r.doc_id: r for r in pii.scan(docs(texts).selectExpr("*", "text AS spans", "1 AS scores")).collect()}
    for i, text in enumerate(texts):
        assert got[i].base_sha256 == digest(naive_pii(text or "")) and got[i].n_email == (i == 7)
    got = {r.doc_id: r for r in secrets.scan(docs(texts)).collect()}
    for i, text in enumerate(texts):
        assert got[i].base_sha256 == digest(naive_secrets(text or "")) and got[i].n_assign == (i == 8)
    assert pii.scan(docs([])).count() == secrets.scan(docs([])).count() == 0


def test_redaction_keeps_rows_and_columns(docs):
    df = docs(["token=abcdefghi1 x", None, ""]).selectExpr("*", "doc_id AS rest")
    rows = secrets.redacted(df).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["[REDACTED] x", None, ""] and [r.n_chars for r in rows] == [12, None, 0]
    assert [r.rest for r in rows] == [0, 1, 2] and rows[0].asDict().keys() == set(df.columns)


def test_given_documents_against_plain_patterns(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op6_pii(spark, small).collect():
        assert r.base_sha256 == digest(naive_pii(texts[r.doc_id]))
    for r in queries.op8_secrets(spark, small).collect():
        assert r.base_sha256 == digest(naive_secrets(texts[r.doc_id]))


def naive_edits(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        trees = [merkle.fingerprint(x) for x in (text, edited, after)]
        near = [merkle.likeness(trees[0], t) for t in trees[1:]]
        out.append((doc_id, len(text), sha256(edited.encode()).hexdigest(), *trees[:2], *near))
    return out


@pytest.mark.parametrize("rows", [CORNER, ["only one."], [(5, "a"), (5, "a"), (None, "b"), (7, None)], []])
def test_edited_fingerprints(docs, rows):
    df = docs(rows)
    pairs = [(r.doc_id, r.text) for r in df.collect()]
    got = [tuple(r) for r in merkle.edited_fingerprints(df).collect()]
    assert sorted(got, key=str) == sorted(naive_edits(pairs), key=str)


def test_edited_fingerprints_of_given_documents(spark, small):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op2_merkle_fingerprint(spark, small).collect()]
    assert sorted(got) == sorted(naive_edits(pairs))


def test_trees_locate_edits():
    lines = [f"Line number {i} has some words. And a second part." for i in range(60)]
    a, b = "\n".join(lines), "\n".join([*lines[:30], "changed", *lines[31:]])
    assert merkle.fingerprint(a)[:32] != merkle.fingerprint(b)[:32]
    assert merkle.edited_paragraphs(merkle.fingerprint(a), merkle.fingerprint(b)) == ([30], [30])
    assert merkle.edited_paragraphs(merkle.fingerprint(a), merkle.fingerprint(a)) == ([], [])
    assert 0.95 < merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) < 1
    assert merkle.likeness(merkle.fingerprint("one thing."), merkle.fingerprint("other stuff.")) == 0


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=50), st.integers(0, 50), st.integers(0, 50))
@settings(max_examples=200, deadline=None)
def test_packing_round_trip_and_random_access(width, ids, a, b):
    ids = np.array(ids, np.uint32) & np.uint32(2**width - 1)
    packed = tokenfile.pack(ids, width)
    a, b = sorted((min(a, len(ids)), min(b, len(ids))))
    assert len(packed) == -(-len(ids) * width // 8)
    assert tokenfile.unpack(packed, width, a, b).tolist() == ids[a:b].tolist()


def naive_tokens(rows):
    own, start, out = Tokenizer.from_file(TOKENIZER), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = "Ünï code A\x1cB ΣΑΣ ὈΔΟΣ é it's <|endoftext|> 日本語\t\ttab\r\nend İstanbul 12345 !!!"


@pytest.mark.parametrize("block_ids", [4, 65_536])
def test_token_files_round_trip(spark, docs, monkeypatch, block_ids):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", block_ids)
    df = docs([*CORNER[:5], ODD, "w" * 5000, (None, "no id")])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, tokenfile.round_trip(df, TOKENIZER).collect()), key=str) == sorted(naive_tokens(rows), key=str)
    assert tokenfile.round_trip(docs([]), TOKENIZER).count() == 0


def test_token_files_of_given_documents(spark, small, tmp_path):
    df = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = naive_tokens(rows)
    assert sorted(map(tuple, queries.op10_token_files(spark, small).collect())) == want
    tokenfile.write(df.filter("doc_id < 20"), TOKENIZER, str(tmp_path / "f"))
    own = Tokenizer.from_file(TOKENIZER)
    first = [*own.encode(rows[0][1], add_special_tokens=False).ids, 1]
    assert tokenfile.read_ids(spark, str(tmp_path / "f"), 0, 2, 9) == first[2:9]

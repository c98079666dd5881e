"""SentencePiece encoding and decoding: a batched Viterbi over equal-length words.

Words of one length form a matrix and advance together, one end position at a time. For
each piece length the hashes of all substrings ending there come from prefix hashes by one
numpy expression and are looked up in the sorted hashes of the pieces. A candidate piece
extends the best path of the position where it starts; each position keeps its winner and
a backpointer, and the paths are read off backwards.

The model is a byte-pair one. There a path is as good as its worst adjacent pair: a pair
counts 0 if merging by rank would leave it as it is, and minus infinity if it would not.
The best path is then the one the library gives, and no other path is above minus infinity.

White space: a space (or U+2581) becomes U+2581, and one goes in front of the text; runs of
it are encoded on their own. A character that no piece has becomes its UTF-8 bytes' pieces.
Words beyond ``MATRIX_CHARS`` take the same steps one by one. Null and empty texts have no
ids. Decoding gives the text back, U+2581 as a space.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docketry.llm.common import filled, small_batches
from docketry.llm.words import WordMemory, packed

SPACE = "▁"
MATRIX_CHARS = 64
BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 21
PAIR_BITS = 20


def merge(word: str, score: dict[str, float]) -> tuple[list[str], dict[str, tuple[str, str]]]:
    """Pieces of a word by merging the best adjacent pair, leftmost first; and the merges made."""
    parts: list[str | None] = list(word)
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    queue: list[tuple[float, int, int, str]] = []
    made: dict[str, tuple[str, str]] = {}

    def offer(left: int, right: int) -> None:
        if left >= 0 and right < len(word):
            both = parts[left] + parts[right]
            if both in score:
                heapq.heappush(queue, (-score[both], left, right, both))

    for i in range(len(word) - 1):
        offer(i, i + 1)
    while queue:
        _, left, right, both = heapq.heappop(queue)
        if parts[left] is None or parts[right] is None or parts[left] + parts[right] != both or after[left] != right:
            continue
        made[both] = (parts[left], parts[right])
        parts[left], parts[right] = both, None
        after[left] = after[right]
        if after[left] < len(word):
            before[after[left]] = left
        offer(before[left], left)
        offer(left, after[left])
    return [p for p in parts if p is not None], made


class Model:
    """Tables of a piece model, built once on the driver and sent with the tasks (about 4 MB)."""

    def __init__(self, path: str):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [own.id_to_piece(i) for i in range(own.get_piece_size())]
        plain = [i for i in range(len(names)) if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i))]
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(len(names)) if own.is_byte(i)}
        self.unknown_id = own.unk_id()
        self.score = {names[i]: own.get_score(i) for i in plain}
        self.texts = [self._bytes(own, i, names[i]) for i in range(len(names))]
        self._number({names[i]: i for i in plain})

    @staticmethod
    def _bytes(own, i: int, name: str) -> bytes:
        if own.is_byte(i):
            return bytes([int(name[3:5], 16)])
        return b"" if own.is_control(i) else b" \xe2\x81\x87 " if own.is_unknown(i) else name.replace(SPACE, " ").encode()

    def _number(self, ids: dict[str, int]) -> None:
        """Own numbers: single characters first, then pieces in merge order."""
        halves = {}
        for name in ids:
            parts, made = merge(name, self.score)
            if parts == [name]:  # else merging never gives this piece
                halves[name] = made.get(name, (name, name))
        order = sorted(halves, key=lambda p: (len(p) > 1, -self.score[p], p))
        self.numbers = number = {name: n for n, name in enumerate(order)}
        self.ids = np.array([ids[name] for name in order], np.int64)
        self.left = np.array([number[halves[name][0]] for name in order], np.int64)
        self.right = np.array([number[halves[name][1]] for name in order], np.int64)
        pairs = {}
        for name in order:
            for cut in range(1, len(name)):
                a, b = number.get(name[:cut]), number.get(name[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = number[name]
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_values = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.chars = {c for name in order for c in name}
        self.longest = max(map(len, order))
        keys = np.array([hash_of(name) for name in order], np.uint64)
        by_key = np.argsort(keys)
        self.keys, self.key_numbers = keys[by_key], by_key
        self.sizes = np.array([len(name) for name in order], np.int64)
        self.names = order


def hash_of(text: str) -> np.uint64:
    with np.errstate(over="ignore"):
        h = np.uint64(0)
        for c in text:
            h = h * BASE + np.uint64(ord(c) + 1)
        return h


@cache
def model(path: str) -> Model:
    return Model(path)


class Encoder:
    """Ids of words by the batched search; remembers words and judged pairs."""

    def __init__(self, tables: Model):
        self.m = tables
        self.memory = WordMemory(self._encode_new)
        self.pair_slots = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_stays = np.zeros(1 << PAIR_BITS, bool)
        self.possible = np.zeros(1 << FILTER_BITS, bool)
        self.possible[tables.keys >> np.uint64(64 - FILTER_BITS)] = True
        self.lone_space = int(tables.ids[tables.numbers[SPACE]])
        self.runs: dict[int, list[int]] = {}
        self.cut_lines = "\n" not in tables.chars
        self.id_list = tables.ids.tolist()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.memory.encode([self._words(t) for t in texts])

    def _words(self, text: str) -> list[str]:
        """Words, each with one space before it in mind; further spaces stand in front of it.

        A line break that no piece has begins a word of its own, one without that space.
        """
        if not text:
            return []
        if self.cut_lines:
            text = text.replace("\n", " \n")
        words = text.replace(SPACE, " ").split(" ")
        if "" not in words:
            return words
        out, extra = [], 0
        for place, word in enumerate(words):
            if extra and self.cut_lines and word.startswith("\n"):
                out.append(SPACE * (extra - 1))
                extra = 0
            if word or place == len(words) - 1:
                out.append(SPACE * extra + word)
                extra = 0
            else:
                extra += 1
        return out

    def _encode_new(self, words: list[str]) -> list[bytes]:
        """One list of ids per word; all known parts are searched together."""
        plain = [SPACE + w for w in words if self._plain(w)]
        odd = {w: self._known_parts(w) for w in words if not self._plain(w)}
        known = [p for parts in odd.values() for p in parts if p[0] in self.m.chars]
        found = iter(self._search(plain + known))
        ids = dict(zip(plain, found))
        odd_ids = {w: [next(found) if p[0] in self.m.chars else self._as_bytes(p) for p in parts] for w, parts in odd.items()}
        return [packed(ids[SPACE + w] if w not in odd else self._joined(w, odd_ids[w])) for w in words]

    def _plain(self, word: str) -> bool:
        first = word[:1]
        return first != SPACE and first != "\n" and (word.isascii() and word.isalpha() or self.m.chars.issuperset(word))

    def _joined(self, word: str, parts: list[list[int]]) -> list[int]:
        """The ids of an odd word; spaces in front of it form a run, with its own space if that stays alone."""
        ids = [i for part in parts for i in part]
        extra = len(word) - len(word.lstrip(SPACE))
        alone = ids[0] == self.lone_space
        return self._run(extra + alone) + ids[alone:] if extra else ids

    def _known_parts(self, word: str) -> list[str]:
        if not (self.cut_lines and word.startswith("\n")):
            word = SPACE + word.lstrip(SPACE)
        parts, start = [], 0
        for i, c in enumerate(word):
            if c not in self.m.chars:
                parts += [word[start:i]] * (i > start) + [c]
                start = i + 1
        return parts + [word[start:]] * (len(word) > start)

    def _as_bytes(self, char: str) -> list[int]:
        ids = self.m.byte_ids
        return [ids[b] for b in char.encode("utf-8", "surrogatepass")] if ids else [self.m.unknown_id]

    def _run(self, n: int) -> list[int]:
        if n not in self.runs:
            parts, _ = merge(SPACE * n, self.m.score)
            self.runs[n] = [int(self.m.ids[self.m.numbers[p]]) for p in parts]
        return self.runs[n]

    def _search(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        names, ids = self.m.names, self.id_list
        by_length: dict[int, list[int]] = {}
        for n, word in enumerate(words):
            by_length.setdefault(len(word), []).append(n)
        for length, places in by_length.items():
            if length <= MATRIX_CHARS:
                paths = self._matrix([words[n] for n in places], length)
            else:
                paths = [self._single(words[n]) for n in places]
            for n, path in zip(places, paths):
                if "".join([names[p] for p in path]) != words[n]:  # two texts with one hash
                    path = self._single(words[n])
                out[n] = [ids[p] for p in path]
        return out

    def _matrix(self, words: list[str], length: int) -> list[list[int]]:
        m = self.m
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).T
        prefix = np.zeros((length + 1, len(words)), np.uint64)
        power = np.ones(length + 1, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(length):
                prefix[j + 1] = prefix[j] * BASE + letters[j].astype(np.uint64) + np.uint64(1)
                power[j + 1] = power[j] * BASE
            last = np.full((length + 1, len(words)), -1, np.int64)
            back = np.zeros((length + 1, len(words)), np.int32)
            reached = np.zeros((length + 1, len(words)), bool)
            reached[0] = True
            for j in range(1, length + 1):
                low = max(0, j - m.longest)
                keys = prefix[j] - prefix[low:j] * power[j - low : 0 : -1, None]
                maybe = self.possible[keys >> np.uint64(64 - FILTER_BITS)] & reached[low:j]
                sizes, rows = np.nonzero(maybe)
                key, i = keys[sizes, rows], sizes + low
                at = np.minimum(np.searchsorted(m.keys, key), len(m.keys) - 1)
                piece = m.key_numbers[at]
                hit = (m.keys[at] == key) & (m.sizes[piece] == j - i)
                rows, i, piece = rows[hit], i[hit], piece[hit]
                later = np.flatnonzero(i)
                stays = np.ones(len(rows), bool)
                stays[later] = self._stays(last[i[later], rows[later]], piece[later])
                rows = rows[stays]
                last[j, rows], back[j, rows], reached[j, rows] = piece[stays], i[stays], True
        return self._paths(last, back, length)

    def _paths(self, last: np.ndarray, back: np.ndarray, length: int) -> list[list[int]]:
        """Ids along the backpointers, all words at once, from the end."""
        n = last.shape[1]
        at, columns, steps = np.full(n, length), np.arange(n), []
        while (at > 0).any():
            steps.append(np.where(at > 0, last[at, columns], -1))
            at = np.where(at > 0, back[at, columns], 0)
        return [[i for i in row if i >= 0] for row in np.array(steps[::-1]).T.tolist()]

    def _stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the pair as it is; judged pairs are looked up."""
        key = a << 32 | b
        slot = (a * 0x9E3779B1 + b * 0x85EBCA77) & ((1 << PAIR_BITS) - 1)
        known = self.pair_slots[slot] == key
        if not known.all():
            new = np.unique(key[~known])
            fresh = self._judge(new >> 32, new & 0xFFFFFFFF)
            out = self.pair_stays[slot]
            out[~known] = fresh[np.searchsorted(new, key[~known])]
            self.pair_slots[slot[~known]], self.pair_stays[slot[~known]] = key[~known], out[~known]
            # of two pairs for one slot the last one stays, with its own verdict
            return out
        return self.pair_stays[slot]

    def _judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges of both pieces in reverse order; an earlier merge across the border breaks the pair."""
        m, n = self.m, len(a)
        a, b, stays = a.copy(), b.copy(), np.ones(n, bool)
        limit, open_ = np.full(n, np.iinfo(np.int64).max), np.arange(n)
        while len(open_):
            x, y = a[open_], b[open_]
            key = x << 32 | y
            at = np.minimum(np.searchsorted(m.pair_keys, key), len(m.pair_keys) - 1)
            broken = (m.pair_keys[at] == key) & (m.pair_values[at] < limit[open_])
            stays[open_[broken]] = False
            x_whole, y_whole = m.right[x] == x, m.left[y] == y
            first = np.where(x_whole, False, np.where(y_whole, True, x > y))  # the later merge is undone first
            done = broken | (x_whole & y_whole)
            limit[open_] = np.where(first, x, y + 1)
            a[open_], b[open_] = np.where(first, m.right[x], x), np.where(first, y, m.left[y])
            open_ = open_[~done]
        return stays

    def _single(self, word: str) -> list[int]:
        """The same search for one long word."""
        m, n = self.m, len(word)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        judged: dict[tuple[int, int], bool] = {}
        for j in range(1, n + 1):
            for i in range(max(0, j - m.longest), j):
                piece = m.numbers.get(word[i:j])
                if piece is None or (i and last[i] < 0):
                    continue
                if i:
                    pair = (last[i], piece)
                    if pair not in judged:
                        judged[pair] = bool(self._judge(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if not judged[pair]:
                        continue
                last[j], back[j] = piece, i
                break
        path, at = [], n
        while at:
            path.append(last[at])
            at = back[at]
        return path[::-1]


def decode(ids: np.ndarray, texts: list[bytes]) -> str:
    """Pieces joined; the space put in front goes."""
    joined = b"".join(map(texts.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return joined[1:] if joined.startswith(" ") else joined


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str, tables: Model) -> Encoder:
    """One per worker process, with what it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(tables)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ``ids array<int>`` of every whole text; a narrow pass."""
    small_batches(docs.sparkSession)
    tables = model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(model_path, tables)
        for batch in batches:
            ids = own.encode(batch.column(1).to_pylist())
            column = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["doc_id", "ids"])

    return docs.select("doc_id", filled().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of ``encoded(doc_id, ids)``."""
    small_batches(encoded.sparkSession)
    texts = model(model_path).texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            found = [decode(np.asarray(column[i].values, np.int64), texts) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


SUMMARY = "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Every text encoded and decoded again: counts and digests, and whether it came back."""
    small_batches(docs.sparkSession)
    tables = model(model_path)
    names = [x.split()[0] for x in SUMMARY.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(model_path, tables)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = []
            for doc_id, text, ids in zip(batch.column(0).to_pylist(), texts, own.encode(texts)):
                back = decode(ids, tables.texts)
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                sha = sha256(back.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((doc_id, len(ids), crc, sha, back == text.replace(SPACE, " ")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select("doc_id", filled().alias("text")).mapInArrow(run, SUMMARY)

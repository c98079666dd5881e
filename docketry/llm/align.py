"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A (tokenizers library, byte-level) reads a space and the text, B (sentencepiece) the
text, before which it puts the space itself. A's character offsets and B's spans give coarse
ends; tokens that share a character, and B's byte pieces, end where their decoded bytes end.
Places where tokens of both end cut them into groups and link those two tokens.

Texts are cut before spaces, where both tokenizers always cut: A's pattern starts a piece there,
and no piece of B goes on over a space (tried when the model is read; else a text is one
part). Each distinct part is aligned once and kept while a worker goes on meeting it; new parts are read
together, as one text, where they may follow each other.

An id pair's count is the number of its links in the whole table. The most frequent pairs,
``FREQUENT`` at most, go to every task with their counts. Links of other pairs are joined with
theirs; such a pair holds less than one in ``FREQUENT`` of all links, so none is a hot key,
and texts with equal groups are looked up once.

Null and empty texts, and those whose token bytes are not the space and the text, have no
tokens: zeros and an empty digest column. Repeated rows count, and have a row, each; a row without
doc_id is like any other. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docketry.llm.common import filled, small_batches, staged
from docketry.operators.skew import keyed_join

#: Parts that a worker keeps in each of two generations: when the younger is full it becomes the elder,
#: and parts of the elder that are met again move to the younger, so that frequent words stay.
KEPT_PARTS = 200_000
KEPT_CHARS = 100
#: Characters of new parts that are read at once.
TOGETHER = 20_000
FREQUENT = 131_072
#: Links that a counting task holds before it sums them, and pairs before it gives them out.
HELD = 4_000_000

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
LOOKED_UP = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
    "rest array<struct<pair: long, n: long>>"
)
COUNTS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

#: How byte-level models show a byte: itself if it is a visible Latin-1 sign, else the next free sign from 256 on.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_OF = {chr(b): b for b in VISIBLE} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*VISIBLE}))}
AFTER_WORD = re.compile(r"(?<=\S)(?=\x20\s*+\S)")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def _a_bytes(entry: str) -> bytes:
    if all(c in BYTE_OF for c in entry):
        return bytes(BYTE_OF[c] for c in entry)
    return entry.encode()


def _b_bytes(piece: str) -> bytes:
    byte = BYTE_PIECE.fullmatch(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def refined(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from coarse byte spans; tokens that share a character are parted by their decoded sizes.

    Tokens belong together while a later one starts before the highest end so far, or is empty. The
    last of them ends where the span does; the others end by their sizes, counted from the first one's start.
    """
    if not len(ends):
        return ends
    high = np.maximum.accumulate(ends)
    fresh = np.concatenate([[True], (starts[1:] >= high[:-1]) & (high[1:] > high[:-1])])
    fresh[1:] &= ends[:-1] > starts[:-1]  # an empty span is a byte of the character that follows
    if fresh.all():
        return ends
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(ends)), 0))
    total = np.cumsum(sizes)
    counted = starts[first] + total - (total - sizes)[first]
    last = np.append(fresh[1:], True)
    return np.where(last, high, counted)


class Part(NamedTuple):
    """The tokens of one part of a text: their numbers, groups as text, and linked pairs."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes
    sound: bool


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        vocabulary = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [_a_bytes(vocabulary.get(i, "")) for i in range(max(vocabulary) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [_b_bytes(p) for p in pieces]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.parts: dict[str, Part] = {}
        self.elder: dict[str, Part] = {}
        self.unsound: set[str] = set()

    def _parts(self, text: str) -> list[str]:
        """A space and the text, cut before spaces, each part without the space that it starts with."""
        if not self.cuts:
            return [text]
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [p[1:] for p in AFTER_WORD.split(" " + text)]

    def _spans(self, text: str, content: bytes) -> tuple[np.ndarray, ...]:
        """Ids and byte ends of both tokenizers' tokens."""
        found = self.a.encode(text, add_special_tokens=False)
        a = np.array(found.ids, np.int64)
        flat = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(a))
        if len(content) > len(text):
            # A character starts at every byte that is not a continuation byte.
            starts = np.flatnonzero((np.frombuffer(content, np.uint8) & 0xC0) != 0x80)
            flat = np.append(starts, len(content))[flat]
        a_ends = refined(flat[::2], flat[1::2], self.a_sizes[a])
        pieces = self.b.encode(text[1:], return_type="offset_mapping", return_bytes=True, num_threads=1)
        b = np.array(pieces["ids"], np.int64)
        flat = np.fromiter(chain.from_iterable(pieces["offsets"]), np.int64, 2 * len(b)) + 1
        flat[:1] = 0  # the first piece starts with the space that the model puts first
        return a, a_ends, b, refined(flat[::2], flat[1::2], self.b_sizes[b])

    def _aligned(self, parts: list[str]) -> list[Part]:
        """Parts that may stand one after the other, read as one text; their ends are ends of tokens."""
        text = " " + " ".join(parts)
        content = text.encode("utf-8")
        a, a_ends, b, b_ends = self._spans(text, content)
        sound = b"".join([self.a_bytes[i] for i in a.tolist()]) == content == b"".join([self.b_bytes[i] for i in b.tolist()])
        common, at_a, at_b = np.intersect1d(a_ends, b_ends, return_indices=True)
        links = (a[at_a] << 32 | b[at_b]).tobytes()
        groups, low_a, low_b, left, right = [], 0, 0, [*map(str, a.tolist())], [*map(str, b.tolist())]
        for high_a, high_b in zip((at_a + 1).tolist(), (at_b + 1).tolist()):
            ours = left[low_a] if high_a == low_a + 1 else ",".join(left[low_a:high_a])
            theirs = right[low_b] if high_b == low_b + 1 else ",".join(right[low_b:high_b])
            groups.append(f"{ours}|{theirs}")
            low_a, low_b = high_a, high_b
        if len(parts) == 1:
            return [Part(len(a), len(b), len(groups), ";".join(groups), links, sound)]
        part_ends = np.cumsum([1 + (len(p) if p.isascii() else len(p.encode("utf-8"))) for p in parts])
        if not (sound and np.isin(part_ends, common).all()):
            return [self._aligned([p])[0] for p in parts]
        cuts = [np.diff(np.searchsorted(ends, part_ends, "right"), prepend=0).tolist() for ends in (a_ends, b_ends)]
        last = np.searchsorted(common, part_ends, "right").tolist()
        return [
            Part(n_a, n_b, high - low, ";".join(groups[low:high]), links[8 * low : 8 * high], True)
            for n_a, n_b, low, high in zip(*cuts, [0, *last], last)
        ]

    def _learn(self, new: Iterable[str]) -> None:
        """Align new parts; those that start with one space and end with none are read together."""
        together: list[str] = []
        size = 0
        for part in new:
            if part and not part[0].isspace() and not part[-1].isspace() and "▁" not in part:
                together.append(part)
                size += len(part)
                if size > TOGETHER:
                    self.parts.update(zip(together, self._aligned(together)))
                    together, size = [], 0
            else:
                self.parts[part] = own = self._aligned([part])[0]
                if not own.sound:
                    self.unsound.add(part)
        if together:
            self.parts.update(zip(together, self._aligned(together)))

    def align(self, texts: list[str]) -> list[list[Part]]:
        """The parts of each text, or none if it has no tokens by contract."""
        cut = [self._parts(t) if t else [] for t in texts]
        wanted = set().union(*cut)
        if len(self.parts) > KEPT_PARTS:
            self.elder, self.parts = self.parts, {}
            self.unsound &= self.elder.keys()
        new = wanted.difference(self.parts)
        again = [p for p in new if p in self.elder]
        self.parts.update((p, self.elder[p]) for p in again)
        new.difference_update(again)
        self._learn(new)
        out = []
        for text, names in zip(texts, cut):
            if self.unsound and not self.unsound.isdisjoint(names):
                parts = self._aligned([text])
                out.append(parts if parts[0].sound else [])
            else:
                out.append([*map(self.parts.__getitem__, names)])
        for part in new:
            if len(part) > KEPT_CHARS:
                del self.parts[part]
                self.unsound.discard(part)
        return out


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row its numbers of tokens, groups and links, the digest of its groups, and its links as packed pairs."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        gc.disable()  # many small objects, none of them in a cycle
        try:
            for batch in batches:
                yield aligned_batch(own, batch)
        finally:
            gc.enable()

    def aligned_batch(own: Aligner, batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, parts in zip(batch.column(0).to_pylist(), own.align(batch.column(1).to_pylist())):
            if not parts:
                rows.append((doc_id, 0, 0, 0, 0, "", b""))
                continue
            n_a, n_b, n_groups, groups, links, _ = zip(*parts)
            packed = b"".join(links)
            digest = sha256(";".join(groups).encode()).hexdigest()
            rows.append((doc_id, sum(n_a), sum(n_b), sum(n_groups), len(packed) // 8, digest, packed))
        types = [*[pa.int64()] * 5, pa.string(), pa.binary()]
        columns = zip(*rows) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = [x.split()[0] for x in ALIGNED.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), filled().alias("text")).mapInArrow(run, ALIGNED)


def _summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(pairs, return_inverse=True)
    return found, np.bincount(place, times, len(found)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and how often they are linked, summed within a task as far as ``HELD`` allows."""
    pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, n = [], 0
    for batch in batches:
        waiting.append(b"".join(batch.column(0).to_pylist()))
        n += len(waiting[-1]) // 8
        if n >= HELD:
            pairs, times = _merged(pairs, times, waiting)
            waiting, n = [], 0
            if len(pairs) >= HELD:
                yield _pair_rows(pairs, times)
                pairs, times = pairs[:0], times[:0]
    pairs, times = _merged(pairs, times, waiting)
    yield _pair_rows(pairs, times)


def _merged(pairs: np.ndarray, times: np.ndarray, waiting: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    new, found = np.unique(np.frombuffer(b"".join(waiting), np.int64), return_counts=True)
    return _summed(np.concatenate([pairs, new]), np.concatenate([times, found]))


def _pair_rows(pairs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(times, pa.int64())], names=["pair", "n"])


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count, best`` of every linked id pair; ``pair`` is A's id times 2**32 plus B's."""
    counts = rows.select("links").mapInArrow(_tally, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(2**32 - 1))  # at most the vocabulary of A
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def alignment(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = staged(aligned(docs, a_path, b_path), "aligned")
    counts = staged(pair_counts(rows), "pair-counts")
    top = sorted(tuple(r) for r in counts.orderBy(F.desc("count"), "pair").limit(frequent).collect())
    known = np.array([r[0] for r in top] or [-1], np.int64)
    worth = np.array([r[1] for r in top] or [0], np.int64)
    good = np.array([r[2] for r in top] or [False], np.bool_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_best, sums, rests = [], [], []
            for links in batch.column(6).to_pylist():
                pairs = np.frombuffer(links, np.int64)
                at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                hit = known[at] == pairs
                n_best.append(int(good[at[hit]].sum()))
                sums.append(int(worth[at[hit]].sum()))
                rest = np.unique(pairs[~hit], return_counts=True) if not hit.all() else ()
                rests.append([{"pair": p, "n": n} for p, n in zip(*(x.tolist() for x in rest))])
            new = [pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())]
            rest = pa.array(rests, pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())])))
            columns = [*batch.columns[:5], *new, batch.column(5), rest]
            yield pa.RecordBatch.from_arrays(columns, names=[*COUNTS, "rest"])

    found = rows.mapInArrow(run, LOOKED_UP)
    if counts.count() <= frequent:
        return found.select(*COUNTS)
    found = staged(found, "looked-up")
    whole = found.filter(F.size("rest") == 0).select(*COUNTS)
    open_rows = found.filter(F.size("rest") > 0)
    asked = open_rows.groupBy("groups_sha256").agg(F.first("rest").alias("rest")).select("groups_sha256", F.inline("rest"))
    joined = asked.join(counts, "pair")
    more = joined.groupBy("groups_sha256").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("count")).alias("more_sum")
    )
    filled_in = keyed_join(open_rows, staged(more, "rare-pairs"), ["groups_sha256"], "inner", ["doc_id"])
    sums = {"n_best": F.col("n_best") + F.col("more_best"), "count_sum": F.col("count_sum") + F.col("more_sum")}
    return whole.union(filled_in.withColumns(sums).select(*COUNTS))

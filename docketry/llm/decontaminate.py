"""Benchmark decontamination by pigeonhole edit matching.

Test items and texts are compared in lower case with white space as single spaces. An item
of ``n`` characters may differ in ``k = floor(n * error_rate)`` edits; cut into ``k + 1``
pieces, at least one piece stands unchanged in every such passage. One automaton finds all
pieces of all items in one pass over a text; around each hit the whole item is verified
with Myers' bit-parallel edit distance. Hits that lie close together are verified once.

Items are the query set. They are taken in blocks of about ``BLOCK_CHARS`` characters, so
that an automaton fits a worker whatever the size of the benchmark; every text meets every
block. Documents never move.

A null or blank item matches nothing; a null or empty text contains no item. Repeated rows
on either side give a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import append_column, filled, free_name, small_batches

ERROR_RATE = 0.08
BLOCK_CHARS = 2_000_000

MATCHES = "doc_id long, item_id long, distance int"


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of about equal length, with their places."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_distance(masks: dict[str, int], length: int, text: str) -> int:
    """Least edit distance between the pattern and any substring of ``text``, column by column."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score, best = full, 0, length, length
    for char in text:
        equal = masks.get(char, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            best = min(best, score)
        up, down = up << 1, down << 1
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical & full
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = [(i, normalised(t)) for i, t in items]
        self.budgets = [int(len(t) * error_rate) for _, t in self.items]
        self.masks: dict[int, dict[str, int]] = {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(self.items):
            for place, piece in pieces(text, self.budgets[n]) if text else ():
                owners.setdefault(piece, []).append((n, place))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        if owners:
            self.automaton.make_automaton()

    def _masks(self, n: int) -> dict[str, int]:
        if n not in self.masks:
            masks: dict[str, int] = {}
            for place, char in enumerate(self.items[n][1]):
                masks[char] = masks.get(char, 0) | 1 << place
            self.masks[n] = masks
        return self.masks[n]

    def find(self, text: str | None) -> list[tuple[int | None, int]]:
        """(item_id, distance) of every item within its budget."""
        if not len(self.automaton):
            return []
        text = normalised(text)
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for n, place in where:
                starts.setdefault(n, set()).add(end + 1 - size - place)
        found = []
        for n in sorted(starts):
            distance = self._verify(n, text, sorted(starts[n]))
            if distance <= self.budgets[n]:
                found.append((self.items[n][0], distance))
        return found

    def _verify(self, n: int, text: str, starts: list[int]) -> int:
        item, budget = self.items[n][1], self.budgets[n]
        if any(text.startswith(item, s) for s in starts if s >= 0):
            return 0
        best, low, high = budget + 1, None, None
        for start in [*starts, None]:
            if start is not None and high is not None and start - budget <= high:
                high = start + len(item) + budget
                continue
            if high is not None:
                best = min(best, best_distance(self._masks(n), len(item), text[max(0, low) : max(0, high)]))
            if start is not None:
                low, high = start - budget, start + len(item) + budget
        return best


_MATCHERS: dict[tuple, Matcher] = {}


def _matcher(items: list[tuple[int, str]], error_rate: float) -> Matcher:
    """The block's matcher, kept by the worker process until it needs another one."""
    key = (hash(tuple(items)), len(items), error_rate)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, error_rate)
    return _MATCHERS[key]


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of bounded size; only one block at a time is on the driver."""
    items = benchmark.select("item_id", filled().alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for n in range(blocks):
        yield sorted((tuple(r) for r in items.filter(block == n).collect()), key=str)


def matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every document and item that match, with the edit distance of the best passage."""
    small_batches(docs.sparkSession)
    plain = docs.select("doc_id", filled().alias("text"))

    def of_block(items: list[tuple[int, str]]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _matcher(items, error_rate)
            for batch in batches:
                rows = [(d, *x) for d, t in zip(*(c.to_pylist() for c in batch.columns)) for x in own.find(t)]
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "distance"])

        return plain.mapInArrow(run, MATCHES)

    return reduce(DataFrame.union, [of_block(items) for items in item_blocks(benchmark, block_chars)])


def without_matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without those that contain an item; a narrow pass."""
    for items in item_blocks(benchmark, block_chars):
        hit = free_name(docs, "hit")

        def found(texts: list[str | None], items=items) -> list[bool]:
            own = _matcher(items, error_rate)
            return [bool(own.find(t)) for t in texts]

        docs = append_column(docs, hit, "boolean", found).filter(~F.col(hit)).drop(hit)
    return docs

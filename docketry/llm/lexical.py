"""Ranked lexical search: exact inner products by best-first search in sparse ball trees.

A document is a sparse vector over terms, a component growing with how often the term occurs
and falling with the document's length; an item is the vector of its terms' weights. All
numbers are integers, so scores are exact.

Texts are read once: each task keeps, per document, its number of terms and the counts of
the items' terms. Statistics of the whole table follow from that table, and so do the vectors.
Each task then puts its documents into ball trees of bounded size. A ball has a centroid ``c`` and
a radius ``R``; no document in it scores above ``q.c + |q| R``, rounded up by more than floating
point can lose. Weights are not negative, and only the item's terms count: where it is less, ``R``
is the length of the greatest rises above the centroid in those terms. A search opens balls by falling bound and ends when the bound is below the
worst of the results kept, which pass from one tree of a task to its next. At the leaves
documents are scored in integers. Documents with equal vectors are one point: of such, the ten
least ids can be among the results and no others. The results of all tasks are ranked together.

Items are the query set: taken in blocks of about ``BLOCK_CHARS`` characters, each against all documents.

Null and empty texts have no terms and are in no result; a null or empty item has none.
Equal scores go by doc_id, null ids last. Repeated documents are documents of their own,
and repeated items have their results each. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docketry.llm.common import filled, small_batches, staged

TOP = 10
BLOCK_CHARS = 250_000
TREE_POINTS = 4096
TREE_VALUES = 4_000_000
LEAF_POINTS = 64
#: Bounds are raised by this share and by one; sums of doubles here lose less than a hundredth of it.
SAFETY = 1e-9
SALTS = 64

# A term's bytes are 0-9, a-z and all beyond ASCII; A-Z are lower-cased; the rest parts terms.
PARTS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

COUNTED = "doc_id long, n long, terms binary, times binary"
FOUND = "item_id long, item int, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(PARTS).split()


def damping(n: int, documents: int, all_terms: int) -> int:
    return 100 - 90 + 90 * n * documents // all_terms


def component(times, damp):
    return 1_000_000_000 * times // (1000 * times + 8 * damp)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document its number of terms, and the counts of those in ``vocabulary`` by ascending number."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = vocabulary.get
        for batch in batches:
            sizes, numbers, times = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                counts = Counter(map(number_of, words))
                counts.pop(None, None)
                own = np.fromiter(counts.keys(), np.uint32, len(counts))
                order = np.argsort(own)
                sizes.append(len(words))
                numbers.append(own[order].tobytes())
                times.append(np.fromiter(counts.values(), np.uint32, len(counts))[order].tobytes())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(numbers, pa.binary()), pa.array(times, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return docs.select(F.col("doc_id").cast("long"), filled().alias("text")).mapInArrow(run, COUNTED)


def holding(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs; one sum per task moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["term", "held"])

    out = np.zeros(size, np.int64)
    sums = rows.select("terms").mapInArrow(run, "term long, held long").groupBy("term").agg(F.sum("held").alias("held"))
    for row in sums.collect():  # at most the terms of one block of items
        out[row.term] = row.held
    return out


class Tree:
    """A ball tree over sparse points: rows ``ends[i-1]:ends[i]`` of ``columns`` and ``values``."""

    def __init__(self, sizes: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.terms, self.columns = np.unique(columns, return_inverse=True)
        self.sizes, self.values = sizes, values
        self.starts = np.cumsum(sizes) - sizes
        self.order = np.arange(len(sizes))
        floats = values.astype(np.float64)
        self.squares = np.bincount(np.repeat(self.order, sizes), floats * floats, len(sizes))
        self.nodes: list[tuple[int, int, int, int]] = []  # low, high, left and right child; -1 at a leaf
        self.centroids, self.radii, self.rises = [], [], []
        self.leaves: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._split()
        self.centroids, self.radii, self.rises = map(np.array, (self.centroids, self.radii, self.rises))

    def _entries(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and value of all entries of some points; rows as places in ``points``."""
        sizes = self.sizes[points]
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[points] - (np.cumsum(sizes) - sizes), sizes)
        return np.repeat(np.arange(len(points)), sizes), self.columns[at], self.values[at]

    def _split(self) -> None:
        todo = [(0, len(self.order), -1, 0)]
        while todo:
            low, high, parent, side = todo.pop()
            points = self.order[low:high]
            rows, columns, values = self._entries(points)
            centroid = np.bincount(columns, values, len(self.terms)) / len(points)
            square = self.squares[points]
            away = square - 2 * np.bincount(rows, values * centroid[columns], len(points)) + centroid @ centroid
            # The squares cancel: what that may have lost is added before the root.
            lost = SAFETY * (float(square.max()) + float(centroid @ centroid))
            node = len(self.nodes)
            self.nodes.append((low, high, -1, -1))
            highest = np.zeros(len(self.terms))
            np.maximum.at(highest, columns, values)
            self.centroids.append(centroid)
            self.rises.append(np.maximum(0.0, highest - centroid))
            self.radii.append(math.sqrt(max(0.0, float(away.max())) + lost))
            if parent >= 0:
                at = list(self.nodes[parent])
                at[2 + side] = node
                self.nodes[parent] = tuple(at)
            if len(points) > LEAF_POINTS:
                far = self._dense(points[np.argmax(away)])
                other = np.argmax(square - 2 * np.bincount(rows, values * far[columns], len(points)))
                direction = self._dense(points[other]) - far
                along = np.bincount(rows, values * direction[columns], len(points))
                half = len(points) // 2
                self.order[low:high] = points[np.argpartition(along, half)]
                todo += [(low + half, high, node, 1), (low, low + half, node, 0)]

    def _dense(self, point: int) -> np.ndarray:
        out = np.zeros(len(self.terms))
        own = slice(self.starts[point], self.starts[point] + self.sizes[point])
        out[self.columns[own]] = self.values[own]
        return out

    def _leaf(self, node: int) -> tuple[np.ndarray, np.ndarray]:
        if node not in self.leaves:
            low, high, *_ = self.nodes[node]
            rows, columns, values = self._entries(self.order[low:high])
            own, inverse = np.unique(columns, return_inverse=True)
            matrix = np.zeros((high - low, len(own)), np.int64)
            matrix[rows, inverse] = values
            self.leaves[node] = own, matrix
        return self.leaves[node]

    def search(self, wanted: np.ndarray, weights: np.ndarray, least) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Points and scores of leaves, by falling bound, while a bound is not below ``least()``."""
        at = np.searchsorted(self.terms, wanted)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == wanted[here]
        columns, weights = at[here], weights[here]
        if not len(columns):
            return
        floats = weights.astype(np.float64)
        radii = np.minimum(self.radii, np.sqrt(np.square(self.rises[:, columns]).sum(1)))
        bounds = (self.centroids[:, columns] @ floats + math.sqrt(float(floats @ floats)) * radii) * (1 + SAFETY) + 1
        open_balls = [(-bounds[0], 0)]
        while open_balls:
            bound, node = heapq.heappop(open_balls)
            if -bound < least():
                return
            low, high, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(open_balls, (max(bound, -bounds[child]), child))
                continue
            own, matrix = self._leaf(node)
            place = np.searchsorted(own, columns)
            place[place == len(own)] = 0
            known = own[place] == columns
            yield self.order[low:high], matrix[:, place[known]] @ weights[known]


class Results:
    """The best documents of one item so far."""

    def __init__(self):
        self.kept: list[tuple[int, bool, int]] = []

    def least(self) -> int:
        """No lower score can enter."""
        return -self.kept[-1][0] if len(self.kept) == TOP else 1

    def add(self, scores: np.ndarray, ids: list[list[tuple[bool, int]]]) -> None:
        new = [(-int(s), *x) for s, own in zip(scores, ids) for x in own]
        self.kept = sorted(self.kept + new)[:TOP]


def _trees(batches: Iterator[pa.RecordBatch], documents: int, all_terms: int) -> Iterator[tuple[Tree, list]]:
    """Trees of bounded size over the documents with any term, and the least ids of each of their points."""
    points: dict[tuple, list[tuple[bool, int]]] = {}
    size = 0

    def tree() -> tuple[Tree, list]:
        columns = np.frombuffer(b"".join(k[1] for k in points), np.uint32)
        times = np.frombuffer(b"".join(k[2] for k in points), np.uint32).astype(np.int64)
        sizes = np.array([len(k[1]) // 4 for k in points])
        damp = np.array([damping(k[0], documents, all_terms) for k in points], np.int64)
        return Tree(sizes, columns, component(times, np.repeat(damp, sizes))), [sorted(x)[:TOP] for x in points.values()]

    for batch in batches:
        for doc_id, n, numbers, times in zip(*(c.to_pylist() for c in batch.columns)):
            if not numbers:
                continue
            ids = points.setdefault((n, numbers, times), [])
            size += len(numbers) // 4 if not ids else 0
            ids.append((doc_id is None, doc_id or 0))
            if len(ids) > 100:
                ids[:] = sorted(ids)[:TOP]
            if len(points) >= TREE_POINTS or size >= TREE_VALUES:
                yield tree()
                points, size = {}, 0
    if points:
        yield tree()


def _search_block(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    wanted = []
    for item_id, text in items:
        own = {vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)}
        wanted.append((item_id, np.array(sorted(own), np.int64)))
    rows = staged(counted(docs, vocabulary), "term-counts")
    documents, all_terms = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.array([weight(documents, int(h)) for h in holding(rows, len(vocabulary))], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = [Results() for _ in wanted]
        for tree, ids in _trees(batches, documents, all_terms):
            for (_, own), kept in zip(wanted, results):
                for points, scores in tree.search(own, weights[own], kept.least):
                    good = np.flatnonzero(scores >= kept.least())
                    kept.add(scores[good], [ids[p] for p in points[good]])
        found = [(i, n, None if none else x, -s) for n, ((i, _), r) in enumerate(zip(wanted, results)) for s, none, x in r.kept]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "item", "doc_id", "score"])

    found = rows.mapInArrow(run, FOUND)
    best_first = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*best_first)
    few = found.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= TOP)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best_first)))
    return ranked.filter(F.col("rank") <= TOP).select("item_id", "rank", "doc_id", "score")


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of bounded size; one block at a time is on the driver."""
    plain = items.select(F.col("item_id").cast("long"), filled().alias("text"))
    total = plain.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for n in range(blocks):
        yield sorted((tuple(r) for r in plain.filter(block == n).collect()), key=str)


def search(docs: DataFrame, items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``TOP`` best documents with a score above 0."""
    return reduce(DataFrame.union, [_search_block(docs, block) for block in item_blocks(items, block_chars)])


_TERMS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS.format("text")} AS t FROM documents),
sums AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS.format("text")}) AS t FROM benchmark),
asked AS (SELECT item, item_id, unnest(t) AS term FROM q),
held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, sums GROUP BY term),
damped AS (SELECT row, doc_id, 100 - 90 + (90 * len(t) * n_docs) // n_terms AS m FROM d, sums WHERE len(t) > 0),
scores AS (
  SELECT item, item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN damped USING (row)
  GROUP BY item, item_id, row, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""

"""Near-duplicate classes by DartMinHash.

A text is the weighted set of its five-word shingles, a shingle's weight being how often it
occurs. Each unit of weight of each shingle owns a region of the plane (weight, rank) into
which darts fall at unit density; place and coordinate of every dart follow from hashes, so
equal regions have equal darts in all texts. A signature keeps, for each of its coordinates,
the dart of least rank. Two texts agree in a coordinate with the chance of their weighted
Jaccard similarity. Only darts up to a rank of about ``ln(coordinates)`` per coordinate are
thrown, whatever the length of the text; if a coordinate gets none, the bound is doubled.

Signatures are cut into bands; texts that share a band are candidates. Candidates are not
paired with each other. First the elements of all texts that share any band are counted: an
element that only one text has is in no overlap, so a text's other elements bound its
similarity to any text of a given size, and a text that can't reach ``SIMILARITY`` with the
smallest of its bucket leaves the bucket. Then each bucket's texts are compared with one pivot,
the text with the greatest share of elements that others have too: in a group of edited copies
that is the original, or the copy nearest to it. Links to pivots make classes. Texts of buckets
that still hold more than one class are compared by their rarest elements: two texts that are
similar enough share one among the first few of each, by rising frequency. There too the texts of
an element first meet two pivots, the least edited text of its largest class and the least edited
other one, for a few turns with classes made anew; then all pairs of different classes that are left
are made. Pairs beyond the bound are left out throughout. Similarity is computed exactly, and links of
``SIMILARITY`` or more make classes (connected components, by alternating large-star and small-star steps).

Words are the lower-cased text cut at white space. Texts with equal words are one node from
the start, named by a 64-bit hash of the words. A class is named by its least doc_id.

Null text counts as empty; all texts without words are one class. A text of fewer than five
words has one shingle, of all its words. Rows that share a doc_id and text share a class.
A row without doc_id gets class null and is compared with nothing.

Hot keys: copies of a text send one signature per task; buckets and classes that hold
many rows are salted (``operators.skew.keyed_join``), and groups are reduced before they move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from docketry.llm.common import Scratch, append_column, filled, free_name, small_batches, staged
from docketry.operators.skew import hot_keys, keyed_join

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 6
COORDINATES = BANDS * ROWS
DARTS = COORDINATES * (np.log(COORDINATES) + 4)
KEPT_WORDS = 500_000
ELEMENT_ROWS = 65_536
TURNS = 4

U = np.uint64
GOLD, MIX_A, MIX_B, STEP = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0xD6E8FEB86659FD93)
BAND_FACTORS = (np.arange(1, COORDINATES + 1, dtype=np.uint64) * GOLD | U(1)).reshape(BANDS, ROWS)

_WORDS: dict[str, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


def word_hashes(words: list[str]) -> np.ndarray:
    known = _WORDS
    if len(known) > KEPT_WORDS:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh3_64_intdigest(word)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def elements(words: list[str]) -> np.ndarray:
    """One hash per unit of weight: a shingle's n-th occurrence is an element of its own; sorted."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    size = min(SHINGLE, len(words))
    shingles = np.full(len(words) - size + 1, size, np.uint64)
    for place in range(size):
        shingles = shingles * GOLD + hashes[place : place + len(shingles)]
    shingles = np.sort(mixed(shingles))
    starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    nth = np.arange(len(shingles)) - np.repeat(starts, np.diff(np.append(starts, len(shingles))))
    return np.sort(mixed(shingles + nth.astype(np.uint64) * STEP))


def darts(owners: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ranks of all darts up to ``bound`` in the regions of ``owners``.

    Along a region's rank the darts are a Poisson process: gaps are exponential, drawn from hashes.
    """
    ids, ranks = [], []
    first, base = 1, np.zeros(len(owners))
    while len(owners):
        many = int(bound + 4 * np.sqrt(bound) + 4) if bound >= 2 else 1
        turns = np.arange(first, first + many, dtype=np.uint64)
        own = mixed(owners[:, None] + turns * GOLD)
        gaps = -np.log(((own >> U(11)).astype(np.float64) + 1) * 2.0**-53)
        rank = base[:, None] + (np.cumsum(gaps, 1) if many > 1 else gaps)
        inside = rank <= bound
        ids.append(own[inside])
        ranks.append(rank[inside])
        on = inside[:, -1]
        owners, base, first = owners[on], rank[on, -1], first + many
    return np.concatenate(ids), np.concatenate(ranks)


def signature(own: np.ndarray) -> np.ndarray:
    """The dart of least rank in each coordinate."""
    bound = DARTS / len(own)
    while True:
        ids, ranks = darts(own, bound)
        place = (mixed(ids ^ STEP) % U(COORDINATES)).astype(np.int64)
        order = np.argsort(-ranks, kind="stable")
        out, hit = np.zeros(COORDINATES, np.uint64), np.zeros(COORDINATES, bool)
        out[place[order]], hit[place] = ids[order], True  # of several, the last one written has the least rank
        if hit.all():
            return out
        bound *= 2


def bands_of(own: np.ndarray) -> np.ndarray:
    """One bucket number per band."""
    mine = mixed(signature(own)).reshape(BANDS, ROWS) * BAND_FACTORS
    return mixed(mine.sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * STEP).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays of distinct elements."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def _node(words: list[str]) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))).view(np.int64))


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, node, size, bands`` of every document with an id; of copies in one task the first alone has bands."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        with np.errstate(over="ignore"):
            for batch in batches:
                nodes, sizes, bands = [], [], []
                for text in batch.column(1).to_pylist():
                    words = text.lower().split()
                    nodes.append(node := _node(words))
                    fresh = words and node not in seen
                    seen.add(node)
                    own = elements(words) if fresh else np.zeros(0, np.uint64)
                    sizes.append(len(own))
                    bands.append(bands_of(own) if fresh else np.zeros(0, np.int64))
                arrays = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "node", "size", "bands"])

    named = docs.filter("doc_id IS NOT NULL").select("doc_id", filled().alias("text"))
    return named.mapInArrow(run, "doc_id long, node long, size long, bands array<long>")


def weighted_sets(docs: DataFrame) -> DataFrame:
    """``node, own``: each text's elements, packed."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                words = [t.lower().split() for t in batch.column(0).to_pylist()]
                own = pa.array([elements(w).tobytes() for w in words], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(map(_node, words), pa.int64()), own], names=["node", "own"])

    return docs.select(filled().alias("text")).mapInArrow(run, "node long, own binary")


def _close_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            near.append(similarity(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= SIMILARITY)
        yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per element; elements and node of one text at a time."""
    for batch in batches:
        for node, own in zip(*(c.to_pylist() for c in batch.columns)):
            found = np.frombuffer(own, np.int64)
            for start in range(0, len(found), ELEMENT_ROWS):
                part = found[start : start + ELEMENT_ROWS]
                columns = [pa.array(part, pa.int64()), pa.array(np.full(len(part), node), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["element", "node"])


def sets_of(nodes: DataFrame, docs: DataFrame, first_ids: DataFrame) -> DataFrame:
    """The weighted sets of some nodes; only their texts move."""
    wanted = first_ids.join(nodes.select("node").distinct(), "node", "left_semi").select("doc_id").distinct()
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    return weighted_sets(texts).groupBy("node").agg(F.first("own").alias("own"))


def lone_elements(sets: DataFrame) -> DataFrame:
    """``node, lone``: how many elements of a text no other text has; texts without any are left out."""
    rows = sets.select("node", "own").mapInArrow(_elements, "element long, node long")
    alone = rows.groupBy("element").agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1")
    return alone.groupBy("node").agg(F.count("*").alias("lone"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(pivot, node)`` that are similar enough; one set moves per pair.

    A pivot may have many pairs: they are salted. A node has at most one pivot per bucket and slot.
    """
    of_pivot = sets.select(F.col("node").alias("pivot"), F.col("own").alias("pivot_own"))
    both = keyed_join(pairs, of_pivot, ["pivot"], "inner", ["node"]).join(sets, "node").select("pivot", "node", "pivot_own", "own")
    return both.mapInArrow(_close_pairs, "pivot long, node long")


def _reaches(shared: str, size: str, other_size: str) -> str:
    """SQL: an overlap of at most ``shared`` can make two texts of these sizes similar enough."""
    return f"{shared} * {1 + SIMILARITY}D >= {SIMILARITY}D * ({size} + {other_size}) - 1e-6"


def open_rows(rows: DataFrame, hot: dict[int, int]) -> DataFrame:
    """``rows(bucket, node, size, shared, class)`` of a staged table that may still find a link in their bucket."""
    ends = rows.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.min("size").alias("least"))
    kept = keyed_join(rows, ends.filter("low < high").select("bucket", "least"), ["bucket"], "inner", ["node"], hot)
    return kept.filter(_reaches("shared", "size", "least")).select("bucket", "node", "size", "shared", "class")


def candidates(rows: DataFrame, pivots: DataFrame, hot: dict[int, int]) -> DataFrame:
    """``pivot, node`` of each text and pivot of a bucket that may be similar and are not of one class; each pair once."""
    of_bucket = pivots.select("bucket", *(F.col(f"top.{x}").alias(f"p_{x}") for x in ("node", "size", "shared", "class")))
    met = keyed_join(rows, of_bucket, ["bucket"], "inner", ["node"], hot)
    may = met.filter(F.expr("p_class <> class AND " + _reaches("least(p_shared, shared)", "p_size", "size")))
    low, high = F.least("p_node", "node"), F.greatest("p_node", "node")
    once = may.groupBy(low.alias("low"), high.alias("high")).agg(F.min("p_node").alias("pivot"))
    return once.select("pivot", F.when(F.col("pivot") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("node"))


def early_elements(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``element, node, size, class, place``: the elements by which texts of ``rows(node, size, class)`` may find one of another class.

    Elements of one class alone stand first, they are counted only; the others by rising frequency among
    these texts. Texts of sizes ``m`` and ``n`` that overlap in ``k`` elements share one among the first
    ``m - k + 1`` and ``n - k + 1`` of them. An element's rows, a few numbers per text, meet once.
    """
    elements = sets.join(rows, "node", "left_semi").select("node", "own").mapInArrow(_elements, "element long, node long")
    of_element = Window.partitionBy("element")
    ends = {"n": F.count("*").over(of_element), "low": F.min("class").over(of_element), "high": F.max("class").over(of_element)}
    common = elements.join(rows, "node").withColumns(ends).filter("low < high")
    of_node = Window.partitionBy("node")
    alone = F.col("size") - F.count("*").over(of_node)
    placed = common.withColumn("place", alone + F.row_number().over(of_node.orderBy("n", "element")))
    most = F.col("size") - F.ceil(SIMILARITY * F.col("size") - 1e-6) + 1  # with the smallest possible partner
    return placed.filter(F.col("place") <= most).select("element", "node", "size", "class", "place")


def minor_rows(early: DataFrame, turn: int = 0) -> DataFrame:
    """The rows of ``early`` but those of the largest class of their element, with that class as ``major`` and its ``top`` row.

    The top row is that of the text with the fewest rarer elements for its size, the least edited one; in later turns any.
    """
    order = F.struct(F.xxhash64("node", "element", F.lit(turn)) if turn else F.col("place") / F.col("size"), "node")
    of_class = early.groupBy("element", "class").agg(F.count("*").alias("n"), F.min_by(F.struct("node", "size", "class", "place"), order).alias("top"))
    largest = F.max_by("top", F.struct("n", "class")).alias("top")
    ends = of_class.groupBy("element").agg(F.count("*").alias("classes"), largest).filter("classes > 1")
    return early.join(ends.select("element", "top", F.col("top.class").alias("major")), "element").filter("class <> major")


def _other(row: str) -> list[Column]:
    """The columns of a row of ``early`` as those of the other text of a pair."""
    return [F.col(f"{row}{x}").alias(f"o_{x}") for x in ("node", "size", "class", "place")]


def _soon_pairs(met: DataFrame) -> DataFrame:
    """``pivot, node`` of the rows of two texts (the other's columns begin with o_) whose classes differ and that share their element early enough."""
    overlap = f"({SIMILARITY / (1 + SIMILARITY)!r}D * (size + o_size) - 1e-6)"
    soon = met.filter(f"class <> o_class AND place <= size - {overlap} + 1 AND o_place <= o_size - {overlap} + 1")
    return soon.select(F.least("node", "o_node").alias("pivot"), F.greatest("node", "o_node").alias("node")).distinct()


def pivot_pairs(early: DataFrame, turn: int) -> DataFrame:
    """``pivot, node``: at most two pairs for each row of ``early``.

    An element's texts meet one that is not of its largest class, and those that are not of that class one that is.
    """
    minor = minor_rows(early, turn)
    order = F.struct(F.xxhash64("node", F.lit(turn)) if turn else F.col("place") / F.col("size"), "node")
    pivots = minor.groupBy("element").agg(F.min_by(F.struct("node", "size", "class", "place"), order).alias("top"))
    to_minor = _soon_pairs(keyed_join(early, pivots.select("element", *_other("top.")), ["element"], "inner", ["node"]))
    return _soon_pairs(minor.select("*", *_other("top."))).union(to_minor).distinct()


def rare_pairs(early: DataFrame) -> DataFrame:
    """``pivot, node``: all pairs of texts of different classes that share an element early enough.

    Of an element's texts, those of its largest class meet the others alone, not each other.
    """
    other = early.select("element", *_other(""))
    return _soon_pairs(minor_rows(early).join(other, "element").filter("o_class = major OR node < o_node"))


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows(node, class, ..)`` with the classes that ``roots(node, root)`` gives; others are their own class."""
    return rows.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node")).select(*rows.columns)


def linked_classes(sigs: DataFrame, docs: DataFrame, first_ids: DataFrame) -> DataFrame:
    """``(node, root)`` of every text linked to another one, roots included; ``sigs`` as staged by ``classes``."""
    scratch = Scratch(sigs.sparkSession)
    rows = sigs.select(F.explode("bands").alias("bucket"), "node", "size")
    ends = rows.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    met = scratch.keep(keyed_join(rows, ends.select("bucket"), ["bucket"], "left_semi", ["node"]).select("bucket", "node", "size"), "met")
    hot = hot_keys(met, ["bucket"]).first().hot  # fewer than there are partitions
    sets = scratch.keep(sets_of(met, docs, first_ids), "weighted-sets")
    with_lone = met.join(lone_elements(sets), "node", "left")
    shared = (F.col("size") - F.coalesce("lone", F.lit(0))).alias("shared")
    bounded = scratch.keep(with_lone.select("bucket", "node", "size", shared, F.col("node").alias("class")), "bounded")
    members = scratch.keep(open_rows(bounded, hot), "members")
    scratch.drop(met, bounded)
    central = F.struct(F.col("shared") / F.col("size"), "size", "node")
    pivots = members.groupBy("bucket").agg(F.max_by(F.struct("node", "size", "shared", "class"), central).alias("top"))
    tested = scratch.keep(candidates(members, pivots, hot), "tested")
    links = scratch.keep(verified(tested, sets), "links")
    roots = components(links)
    parted = scratch.keep(with_roots(members, roots), "parted")
    still_open = scratch.keep(open_rows(parted, hot).select("node", "size", "class").distinct(), "open")
    scratch.drop(members, parted)
    early = scratch.keep(early_elements(still_open, sets), "early")
    known = tested.select(F.least("pivot", "node").alias("pivot"), F.greatest("pivot", "node").alias("node"))
    for turn in range(TURNS):  # what these leave is compared in full
        pairs = scratch.keep(pivot_pairs(early, turn).join(known, ["pivot", "node"], "left_anti"), "pairs")
        more = scratch.keep(verified(pairs, sets), "more-links")
        known = known.union(pairs)
        if more.isEmpty():
            break
        links = links.union(more)
        roots = components(links)
        last, early = early, scratch.keep(with_roots(early, roots), "early")
        scratch.drop(last)
    pairs = scratch.keep(rare_pairs(early).join(known, ["pivot", "node"], "left_anti"), "pairs")
    more = scratch.keep(verified(pairs, sets), "more-links")
    if not more.isEmpty():
        roots = components(links.union(more))
    scratch.drop(tested, still_open, early, pairs, sets)
    return roots.union(roots.select(F.col("root").alias("node"), "root")).distinct()


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """The least of each node and its neighbours, beside each of its edges."""
    least = edges.groupBy(node).agg(F.least(F.first(node), F.min(other)).alias("least"))
    return keyed_join(edges, least, [node], "inner", [other])


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of a link but the roots; the root is the least node of its component."""
    scratch = Scratch(pairs.sparkSession)
    edges = scratch.keep(pairs.select(F.col("pivot").alias("u"), F.col("node").alias("v")), "edges")
    last = None
    while True:
        both = scratch.keep(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "both-ways")
        large = _least(both, "u", "v").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        down = scratch.keep(large.filter("u <> v").distinct(), "large-star")  # u > v
        scratch.drop(edges, both)
        small = _least(down, "u", "v")
        kept = small.select(F.col("v").alias("u"), F.col("least").alias("v")).union(small.select("u", F.col("least").alias("v")))
        edges = scratch.keep(kept.filter("u <> v").distinct(), "small-star")
        scratch.drop(down)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = state


def _texts(sigs: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text_id, root, class_id`` of each different text; the last two are null where no link ends."""
    first_ids = sigs.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    linked = staged(linked_classes(sigs, docs, first_ids).join(first_ids, "node"), "linked")
    names = linked.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = keyed_join(linked, names, ["root"], "inner", ["node"]).select("node", "root", "class_id")
    return first_ids.withColumnRenamed("doc_id", "text_id").join(named, "node", "left")


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_id (least id of equal texts), class_id."""
    sigs = staged(signed(docs), "signatures")
    texts = _texts(sigs, docs).drop("root")
    placed = keyed_join(sigs.select("doc_id", "node"), texts, ["node"], "inner", ["doc_id"])
    out = placed.select("doc_id", "text_id", F.coalesce("class_id", "text_id").alias("class_id"))
    nameless = docs.filter("doc_id IS NULL").select("doc_id", F.col("doc_id").alias("text_id"), F.col("doc_id").alias("class_id"))
    return out.union(nameless)


def one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, the one with the least id; rows without an id stay.

    An id may name several texts: the row kept is the one with the class's text, of several
    such texts under the least id the one with the least node.
    """
    sigs = staged(signed(docs), "signatures")
    least = _texts(sigs, docs).groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(F.struct("text_id", "node")).alias("first"))
    kept = staged(least.select(F.col("first.text_id").alias("doc_id"), "first.node"), "kept")
    ids = kept.select("doc_id").distinct()
    first = docs.join(ids, "doc_id", "left_semi").select(*docs.columns)
    if not sigs.groupBy("doc_id").count().filter("count > 1").join(ids, "doc_id", "left_semi").isEmpty():
        node = free_name(docs, "node")
        named = append_column(first, node, "long", lambda texts: [_node((t or "").lower().split()) for t in texts])
        named = named.join(kept.select("doc_id", F.col("node").alias(node)), ["doc_id", node], "left_semi")
        first = named.dropDuplicates(["doc_id", node]).drop(node)
    return first.select(*docs.columns).union(docs.filter("doc_id IS NULL"))

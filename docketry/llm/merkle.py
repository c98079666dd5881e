"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut into paragraphs (its lines) and these into leaves (sentences, in runs of
at most ``LEAF_BYTES`` bytes). A paragraph's digest is over its bytes. A section is a run of
paragraphs; it ends before a blank line or a heading, and after a paragraph whose own
digest says so (one in ``SECTION_PARAGRAPHS``), so that an edit moves no later border. A
section's digest is over its paragraphs' digests, the root over the sections'. Equal
texts have equal roots; for different texts, a walk from the root goes into differing
branches alone and so finds the edited paragraphs.

The fingerprint is the tree as one string:
``root~section:paragraph,leaf leaf ...;paragraph,...|section:...``, digests in hex,
a leaf with its length in front (two hex digits).

Null text counts as empty; the empty text has a tree without leaves. Repeated rows
give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import NO_ID, filled, map_rows, shard_bounds, shuffle_partitions, small_batches, with_shard

LEAF_BYTES = 64
SECTION_PARAGRAPHS = 8
LEAF = re.compile(rb"[^.!?]{1,%d}[.!?]*|[.!?]{1,%d}" % (LEAF_BYTES, LEAF_BYTES))
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _digest(content: bytes, size: int) -> str:
    return blake2b(content, digest_size=size).hexdigest()


def _leaves(paragraph: bytes) -> list[str]:
    return ["%02x%08x" % (min(len(x), 255), xxhash.xxh32_intdigest(x)) for x in LEAF.findall(paragraph)]


def fingerprint(text: str | None) -> str:
    sections: list[list[tuple[str, str]]] = [[]]
    closed = False
    for paragraph in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        if sections[-1] and (closed or not paragraph.strip() or paragraph.startswith(b"#")):
            sections.append([])
        own = _digest(paragraph, 8)
        closed = int(own[:8], 16) % SECTION_PARAGRAPHS == 0
        sections[-1].append((own, " ".join(_leaves(paragraph))))
    branches = [(_digest("".join(p for p, _ in s).encode(), 8), s) for s in sections]
    root = _digest("".join(d for d, _ in branches).encode(), 16)
    return root + "~" + "|".join(d + ":" + ";".join(f"{p},{leaves}" for p, leaves in s) for d, s in branches)


def _branches(tree: str) -> list[tuple[str, list[str]]]:
    """Sections as (digest, paragraphs)."""
    return [(s[:16], s[17:].split(";")) for s in tree.partition("~")[2].split("|")]


def _weight(leaves: Counter) -> int:
    return sum(int(leaf[:2], 16) * n for leaf, n in leaves.items())


def _all_leaves(paragraphs) -> Counter:
    return Counter(" ".join(p[17:] for p in paragraphs).split())


def likeness(a: str, b: str) -> float:
    """Share of both trees' leaves, by length, that they have in common; 1 for equal roots."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = _all_leaves(p for _, s in _branches(a) for p in s), _all_leaves(p for _, s in _branches(b) for p in s)
    total = _weight(left) + _weight(right)
    return 2.0 * _weight(left & right) / total if total else 0.0


def edited_paragraphs(a: str, b: str) -> tuple[list[int], list[int]]:
    """Places of the paragraphs of ``a`` and of ``b`` that the other lacks; equal sections are not entered."""
    if a[:32] == b[:32]:
        return [], []
    ours, theirs = _branches(a), _branches(b)
    same = Counter(d for d, _ in ours) & Counter(d for d, _ in theirs)

    def open_paragraphs(sections):
        left, place, found = Counter(same), 0, []
        for digest, paragraphs in sections:
            if left[digest]:
                left[digest] -= 1
            else:
                found += [(p[:16], place + i) for i, p in enumerate(paragraphs)]
            place += len(paragraphs)
        return found

    x, y = open_paragraphs(ours), open_paragraphs(theirs)
    common = Counter(d for d, _ in x) & Counter(d for d, _ in y)

    def lacking(rows):
        left, places = Counter(common), []
        for digest, place in rows:
            if left[digest]:
                left[digest] -= 1
            else:
                places.append(place)
        return places

    return lacking(x), lacking(y)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``fingerprint``; a narrow pass over doc_id and text."""
    plain = docs.select("doc_id", filled(text).alias("text"))

    def run(rows: dict) -> dict:
        return {"doc_id": rows["doc_id"], "fingerprint": [fingerprint(t) for t in rows["text"]]}

    return map_rows(plain, run, "doc_id long, fingerprint string")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict | None]]:
    """Each row with the one after it, in one shard; the guest row at the end only follows."""
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            if last is not None and not last["guest"] and last["shard"] == row["shard"]:
                yield last, row
            if last is None or last["shard"] != row["shard"] or not last["guest"]:
                last = row


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, tree_of_next = [], None
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for row, after in _neighbours(batches):
        text, n = row["text"], len(row["text"])
        own = tree_of_next[1] if tree_of_next and tree_of_next[0] is row else fingerprint(text)
        tree_of_next = (after, fingerprint(after["text"]))
        edited = text[: n - n // 2] + after["text"][: n // 2]
        edited_tree = fingerprint(edited)
        sha = sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        rows.append((row["doc_id"], n, sha, own, edited_tree, likeness(own, edited_tree), likeness(own, tree_of_next[1])))
        if len(rows) == 64:
            yield out()
            rows.clear()
    if rows:
        yield out()


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The next document has the next lower doc_id (ties: by text; null ids come last; after
    the last comes the first). The edited text has its last half replaced by as many code
    points from the start of the next document.

    One shuffle of the texts: documents go to shards in id order, and each shard gets, as a
    guest, the document its last one needs. Shard bounds and guests are as many numbers as
    there are shards; no text goes through the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shards = shuffle_partitions(spark)
    keyed = docs.select("doc_id", filled().alias("text"), F.coalesce("doc_id", F.lit(NO_ID)).alias("place"))
    bounds = shard_bounds(keyed, "place", shards)
    cut = with_shard(keyed, "place", bounds, "shard")
    firsts = cut.groupBy("shard").agg(F.max("place").alias("place")).orderBy("shard").collect()
    hosts = [(firsts[i].place, firsts[(i + 1) % len(firsts)].shard) for i in range(len(firsts))]
    guests = spark.createDataFrame(hosts, "place long, host int")
    found = cut.join(F.broadcast(guests), "place", "left")
    own = F.struct(F.col("shard"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("host").alias("shard"), F.lit(True).alias("guest"))
    seats = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, guest))
    dealt = found.select("doc_id", "text", "place", F.explode(seats).alias("seat")).select("doc_id", "text", "place", "seat.*")
    ordered = dealt.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(
        "shard", "guest", F.desc("place"), "text"
    )
    return ordered.select("doc_id", "text", "shard", "guest").mapInArrow(_compare, SCHEMA)

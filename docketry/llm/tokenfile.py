"""Token ids in files of fixed-width bit-packed blocks.

Texts are encoded where they are read. The packed ids, a fraction of the text, go to shards
in doc_id order; each shard is written as a run of blocks. A block is one row of the file:

    shard, block      its place; rows are in this order
    first             number of ids of the shard before the block
    width, n_ids      bits per id, ids in the block
    doc_ids, ends     its documents and, for each, the number of ids up to its end
    packed            the ids, ``width`` bits each, little endian, no gaps

Id ``i`` of a block lies at bit ``i * width``, so one id or a range is read without the rest,
and a whole block is unpacked with a few numpy calls. A block ends with the document that
brings it to ``BLOCK_IDS``. The files are Parquet, written by Spark: a lost executor's
files are written again, and a range of ids is found by ``shard`` and ``first`` alone.

Null and empty texts have one id, the end id. Order: doc_id, then the ids; null doc_ids first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docketry.llm.common import filled, shard_bounds, shuffle_partitions, small_batches, with_shard
from docketry.llm.words import KEPT_WORDS, WordMemory, packed
from docketry.session import work_dir

BLOCK_IDS = 65_536
END_ID = 1
SIMPLE_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?$%&*#|]{0,8})")
#: How byte-level models show a byte: itself if it is a visible Latin-1 sign, else the next free sign from 256 on.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in VISIBLE)}

BLOCK_SCHEMA = (
    "shard int, block int, first long, width int, n_ids long, doc_ids array<long>, ends array<long>, packed binary"
)
RESULT_SCHEMA = "doc_id long, shard int, first long, n_tokens long, ids_crc32 long"


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a block; only their bytes are touched."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(packed, f"<u{size}", end - start, start * size).astype(np.uint32)
    low = start * width
    part = np.frombuffer(packed, np.uint8)[low // 8 : -(-end * width // 8)]
    bits = np.unpackbits(part, bitorder="little")[low % 8 :][: (end - start) * width]
    return (bits.reshape(-1, width).astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(1, dtype=np.uint32)


class Encoder:
    """Encodes whole texts with the tokenizers library, each distinct word once.

    A word of Latin letters, with or without punctuation at its end, is two pieces of the
    tokenizer's own split. Its letters go to the tokenizer's model directly, in lower case;
    every other word goes through the whole tokenizer. Whether the model takes words in this
    form is tried on a few words first.
    """

    TRIAL = ("the", "Wörter", "Été,", "of.", "x!!!", "ñandú", "Straße", "supercalifragilistic")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.memory = WordMemory(self._encode_new)
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.simple = True
        self.simple = self._encode_new(list(self.TRIAL)) == self._whole(list(self.TRIAL))

    def _whole(self, words: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _of_letters(self, letters: str) -> bytes:
        ids = self.letters.get(letters)
        if ids is None:
            if len(self.letters) > KEPT_WORDS:
                self.letters.clear()
            shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(BYTE_SIGNS)
            ids = self.letters[letters] = packed([t.id for t in self.tokenizer.model.tokenize(shown)])
        return ids

    def _of_marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            self.marks[marks] = self._whole([marks])[0]
        return self.marks[marks]

    def _encode_new(self, words: list[str]) -> list[bytes]:
        found = [SIMPLE_WORD.fullmatch(w) if self.simple else None for w in words]
        others = iter(self._whole([w for w, m in zip(words, found) if m is None]))
        return [self._of_letters(m[1].lower()) + self._of_marks(m[2]) if m else next(others) for m in found]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.memory.encode([self._words(t) for t in texts])

    @staticmethod
    def _words(text: str) -> list[str]:
        """Cut at spaces and line breaks: the tokenizer drops all white space and no piece of it reaches across."""
        words = text.replace("\n", " ").split(" ")
        return [w for w in words if w] if "" in words else words


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def id_width(tokenizer_path: str, end_id: int) -> int:
    return width_of(max(encoder(tokenizer_path).vocabulary, end_id + 1))


def id_type(tokenizer_path: str, end_id: int) -> str:
    return "<u2" if id_width(tokenizer_path, end_id) <= 16 else "<u4"


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and its ids as packed little-endian integers of 16 or 32 bits, the end id last."""
    small_batches(docs.sparkSession)
    kind = id_type(tokenizer_path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path)
        for batch in batches:
            encoded = own.encode(batch.column(1).to_pylist())
            ids = [np.append(x, np.uint32(end_id)).astype(kind).tobytes() for x in encoded]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", filled().alias("text")).mapInArrow(run, "doc_id long, ids binary")


def _blocks(width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first, docs, ends, parts, n = None, 0, 0, [], [], [], 0

        def row() -> pa.RecordBatch:
            packed = pack(np.concatenate(parts), width)
            values = [shard, block, first, width, n, docs, ends, packed]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            for doc_id, ids, own in zip(*(c.to_pylist() for c in batch.columns)):
                if own != shard:
                    if docs:
                        yield row()
                    shard, block, first, docs, ends, parts, n = own, 0, 0, [], [], [], 0
                part = np.frombuffer(ids, kind)
                n += len(part)
                docs.append(doc_id)
                ends.append(n)
                parts.append(part)
                if n >= BLOCK_IDS:
                    yield row()
                    block, first, docs, ends, parts, n = block + 1, first + n, [], [], [], 0
        if docs:
            yield row()

    names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
    longs = pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), longs, longs, pa.binary()]
    return run


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> None:
    """Token files of ``docs`` in ascending doc_id order, in ``folder``."""
    spark = docs.sparkSession
    bounds = shard_bounds(docs, "doc_id", shuffle_partitions(spark))
    packer = _blocks(id_width(tokenizer_path, end_id), id_type(tokenizer_path, end_id))
    cut = with_shard(token_ids(docs, tokenizer_path, end_id), "doc_id", bounds, "shard")
    ordered = cut.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids")
    ordered.select("doc_id", "ids", "shard").mapInArrow(packer, BLOCK_SCHEMA).write.parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RESULT_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        for block in batch.to_pylist():
            ids = unpack(block["packed"], block["width"], 0, block["n_ids"]).astype("<u4")
            rows, start = [], 0
            for doc_id, end in zip(block["doc_ids"], block["ends"]):
                crc = zlib.crc32(ids[start:end].tobytes())
                rows.append((doc_id, block["shard"], block["first"] + start, end - start, crc))
                start = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all shards before each one: one row per shard, as many as the writer had partitions."""
    totals = spark.read.parquet(folder).groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    starts, total = [], 0
    for row in totals:
        starts.append((row.shard, total))
        total += row.n
    return spark.createDataFrame(starts, "shard int, before long")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    small_batches(spark)
    blocks = spark.read.parquet(folder)
    docs = blocks.mapInArrow(_documents, RESULT_SCHEMA)
    placed = docs.join(F.broadcast(shard_starts(spark, folder)), "shard")
    return placed.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, folder: str, shard: int, start: int, end: int) -> list[int]:
    """Ids ``start`` to ``end`` of one shard, by random access; the caller bounds the range."""
    last = F.col("first") + F.col("n_ids")
    hit = spark.read.parquet(folder).filter((F.col("shard") == shard) & (F.col("first") < end) & (last > start))
    out: list[int] = []
    for b in hit.orderBy("first").collect():
        out += unpack(b.packed, b.width, max(0, start - b.first), min(b.n_ids, end - b.first)).tolist()
    return out


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write token files to the shared folder, then read every document back."""
    folder = work_dir(docs.sparkSession, "tokens")
    write(docs, tokenizer_path, folder)
    return read(docs.sparkSession, folder)

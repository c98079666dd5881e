"""Training-corpus pipeline over ``documents``: five stages, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on every row its predecessor kept. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import decontaminate, dedup, pieces, quality, secrets
from docketry.llm.common import staged, table
from docketry.llm.queries import public_tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return dedup.one_per_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    return secrets.redacted(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text: counts, digests, and whether decoding gives the text back."""
    return pieces.round_trip(docs, public_tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("SentencePiece encoding and decoding", token_stage),
]

# Learned scores, similarity classes, edit distances and decoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, f"stage-{number}")
    return docs

"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import align, decontaminate, dedup, extract, lexical, merkle, pieces, pii, quality, secrets, shards, tokenfile, urls
from docketry.llm.common import table


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.classes(table(spark, sf_dir, "documents"))


def op2_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.page_verdicts(table(spark, sf_dir, "pages"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizer("piece_bpe_32k.model"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("piece_bpe_32k.model")
    return align.alignment(table(spark, sf_dir, "documents"), *paths)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.dealt(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_merkle_fingerprint,
        op3_quality,
        op4_main_text,
        op5_decontamination,
        op6_pii,
        op7_url_filter,
        op8_secrets,
        op9_sentencepiece,
        op10_token_files,
        op11_alignment,
        op12_lexical_search,
        op13_shards,
    )
}
ORACLE_SQL = {"op7_url_filter": urls.ORACLE, "op12_lexical_search": lexical.ORACLE, "op13_shards": shards.ORACLE}

"""The queries of the llm operators, and their DuckDB counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, divergence, embedding_dedup, exact_dedup, fill_in_middle, language_id, language_model, mixing, pii, quality, simhash, token_files, warc
from tidemark.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with all evidence, and documents with the text alone."""
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def flip_a_byte(page_id: int | None, raw: bytes) -> bytes:
    """The drill's faulty replica: in every record whose page id leaves 5 modulo 97, the byte in the middle is inverted."""
    if page_id is None or page_id % 97 != 5:
        return raw
    at = len(raw) // 2
    return raw[:at] + bytes([raw[at] ^ 0xFF]) + raw[at + 1 :]


def op7_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two replicas of all pages, the second with known faults, audited."""
    (good, bad), _ = warc.write_replicas(table(spark, sf_dir, "pages"), [None, flip_a_byte])
    return warc.audit(spark, good, bad)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


NAMED = (
    op1_language_id, op2_token_files, op3_quality, op4_mixing, op5_simhash, op6_decontaminate, op7_warc_audit, op8_language_model, op9_pii, op10_exact_dedup,
    op11_divergence, op12_embedding_dedup, op13_fill_in_middle,
)
QUERIES = {f.__name__: f for f in NAMED}
ORACLE_SQL = {
    "op4_mixing": mixing.ORACLE, "op10_exact_dedup": exact_dedup.ORACLE, "op11_divergence": divergence.ORACLE, "op12_embedding_dedup": embedding_dedup.ORACLE,
    "op13_fill_in_middle": fill_in_middle.ORACLE,
}

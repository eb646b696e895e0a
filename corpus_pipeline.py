"""From raw documents to token shards in five stages.

Every stage takes all that its predecessor kept; all but the last return the columns of documents. Between stages the
documents are written as Parquet below the folder named by ``spark.checkpoint.dir`` and read again, so a lost executor
never costs more than the stage that is running.

Cases, for every stage: a null text counts as empty; null and repeated ids and repeated rows are rows like others (of a
group of near copies one row stays, ties go to the smallest id, null last); documents without words leave with the
mixing; an empty table gives an empty one, and without labels, benchmark items or sources nothing is rejected for
them; columns of documents pass through whatever their names, the last stage returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, near_copies, quality, token_files
from tidemark.llm.common import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (importance resampling): rejected documents go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-dedup by SimHash blocks and minima of five-word shingles, settled at a similarity of 0.8: one document of each group stays."""
    return near_copies.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark passage go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents come as often as the mix takes them."""
    return mixing.mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary shards, and what reading them back gives."""
    return token_files.token_files(docs)


STAGES = [
    ("quality", good_documents),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("tokens", token_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per document and copy that was written (doc_id, start, n_tokens, ids_crc32)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: SQL can't express the fingerprints, the alignment or the subwords; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None

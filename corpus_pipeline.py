"""From raw documents to training shards: each stage takes whole documents and decides about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerloom.llm.common import documents, stored
from layerloom.llm.curriculum import mixed
from layerloom.llm.divergence import keep_good
from layerloom.llm.latent import without_leaks
from layerloom.llm.near_texts import keep_one_near
from layerloom.llm.ring import shard_in_order


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the quality rules; null and empty texts fail them, equal rows fare alike, an empty table stays empty."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity of 0.8 or more.

    The smallest doc_id stays, null ids come last, repeated rows are one, texts without a word are one group.
    """
    return keep_one_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null and empty texts hold none, an empty benchmark drops nothing."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and orders the documents by the curriculum; a null source is a source, a text without words is never taken."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard and the slot of every training row; within a shard the rows stay in the curriculum's order."""
    return shard_in_order(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Fingerprints and latent vectors have no SQL form. tests/llm compares the first two stages with their operators only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each kept in the shared folder for the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus from raw documents to shards, one operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plateflow.llm import decontamination, quality_rules, sharding, simhash_dedup, source_mixing
from plateflow.llm.common import materialise, scan


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, at most three differing bits."""
    return simhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, scan(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once at least, those of small sources up to twice, one row per pass."""
    return source_mixing.mix(docs).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix with their shard and their slot in it."""
    return sharding.assign_shards(docs, "doc_id")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
    ("shards", shards),
]

# Fingerprint groups are components of a graph, and shards need a 64-bit hash of Spark's.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

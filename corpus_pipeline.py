"""Corpus preparation: quality rules, near-dedup, decontamination, mixing and sharding of documents.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from crossmart.llm import contamination, mixing, quality, sharding, simhash
from crossmart.llm.common import table
from crossmart.session import work_dir

SHARDS = 8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules."""
    return quality.judged(docs).where("kept").select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.deduplicated(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says, in a global random order."""
    return mixing.mixed(docs).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it, which scatters the mixture's copies."""
    return sharding.with_slots(sharding.with_shards(docs, "doc_id", [1.0] * SHARDS), "doc_id", scattered=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: XXH64 fingerprints cannot be written in DuckDB; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{work_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

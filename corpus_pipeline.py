"""From raw documents to shards: toxic texts, near copies and leaks out, sources mixed, rows placed.

Every stage is one operator of ``sentloom.llm`` on all documents the one before kept; its
result is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentloom.llm import decontamination, mixing, sharding, simhash, toxicity
from sentloom.llm.common import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; learnt from the labels of these documents."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: four-word shingles, up to four bits."""
    return simhash.drop_near_copies(docs, shingle=4, distance=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source as often as its weight asks for, a row for each use."""
    return mixing.mix_sources(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their place in it."""
    return sharding.shard_documents(docs, shards=24)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

# Fingerprints and fitted scores have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of ``documents`` under ``sf_dir``."""
    docs, scratch, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs

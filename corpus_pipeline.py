"""The corpus pipeline: from raw documents to shards of a training mix.

Each stage takes (spark, docs, folder) and returns a DataFrame; its result is written and read again as the
documents of the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakewarden.llm import decontamination, mixing, quality_model, sharding, simhash
from lakewarden.llm.common import read, table_of


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_model.keep_good(docs, read(spark, folder, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near copies stays: fingerprints of three-word shingles, linked within three bits."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, read(spark, folder, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents are dropped or repeated so that each source has its target share of the words."""
    return mixing.take(docs)


def shard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every row gets its shard and slot."""
    return sharding.with_shards(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("source mix", mix),
    ("k-d tree shards", shard),
]

# The stages use a trained model, hashes and random walks, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = table_of(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)

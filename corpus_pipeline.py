"""From raw documents to sharded training data: five operators in a row, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableworks.llm import decontaminate, minhash, mixing, quality, sharding
from tableworks.llm.queries import session
from tableworks.llm.scratch import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to resemble those labelled good; the others go."""
    return quality.good_documents(docs, session(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 0.8 or more of its five-word shingles in common."""
    session(spark)
    return minhash.without_near_duplicates(docs, shingle=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, session(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source weights take it."""
    session(spark)
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    session(spark)
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source mix", mix_to_weights),
    ("sharding", assign_shards),
]

# The classifier and the MinHash families have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again by the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    scratch.close(docs)
    return docs

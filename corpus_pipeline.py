"""Corpus pipeline: quality filter, near-duplicate removal, benchmark
decontamination, curriculum mix, sharding.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all its
predecessor kept; its result is written as Parquet and read again as
the next stage's ``docs``.  All stages but the last return the columns of
``documents``.  SQL cannot express the classifier, so there is no ORACLE_SQL;
the tests hold the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidyleads.llm import op01_quality, op03_mixing, op08_decontaminate, op09_sharding, op10_near_dedup
from tidyleads.llm.common import settled as materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good with a probability of one half at least."""
    return op01_quality.good_documents(docs, op01_quality.graded(table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return op10_near_dedup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op08_decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum mix: documents in order of training position, repeated as the targets ask."""
    return op03_mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place and slot of each document in 16 shards."""
    return op09_sharding.shard_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Registered queries of the operators: thin wrappers that apply each
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op01_quality, op02_perspectives, op03_mixing, op04_toxicity, op05_voronoi_knn, op06_suffix_tree, op07_suffix_dedup, op08_decontaminate, op09_sharding, op10_near_dedup, op11_merkle as merkle, op12_resampling as resampling, op13_secrets as secrets, oracles
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ordinal_quality(spark, sf_dir):
    return op01_quality.grade_documents(table(spark, sf_dir, "documents"), op01_quality.graded(table(spark, sf_dir, "labels")))


def op2_perspectives(spark, sf_dir):
    return op02_perspectives.perspectives(table(spark, sf_dir, "conversations"))


def op3_mixing(spark, sf_dir):
    return op03_mixing.mix_documents(table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    return op04_toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_voronoi_knn(spark, sf_dir):
    return op05_voronoi_knn.top_k(table(spark, sf_dir, "embeddings"))


def op6_suffix_tree(spark, sf_dir):
    return op06_suffix_tree.score_documents(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark, sf_dir):
    return op07_suffix_dedup.dedup_strings(table(spark, sf_dir, "documents")).drop("kept")


def op8_pigeonhole(spark, sf_dir):
    return op08_decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_hash_tree(spark, sf_dir):
    return op09_sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_bottom_k(spark, sf_dir):
    found = op10_near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


def op11_merkle(spark, sf_dir):
    found = merkle.verified_manifest(table(spark, sf_dir, "documents"), merkle.tampered_text())
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_resampling(spark, sf_dir):
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_secrets(spark, sf_dir):
    return secrets.report(secrets.secrets(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_ordinal_quality, op2_perspectives, op3_mixing, op4_toxicity, op5_voronoi_knn, op6_suffix_tree, op7_suffix_dedup, op8_pigeonhole, op9_hash_tree, op10_bottom_k, op11_merkle, op12_resampling, op13_secrets)}
ORACLE: dict[str, str] = {"op2_perspectives": oracles.OP2, "op3_mixing": oracles.OP3, "op5_voronoi_knn": oracles.OP5, "op11_merkle": oracles.OP11, "op12_resampling": oracles.OP12}

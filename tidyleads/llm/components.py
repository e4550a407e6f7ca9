"""Connected components by alternating large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled as materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the neighbours of every node at the smallest of them and the node.
    Only the minimum of a node's neighbours is gathered, never the neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    near = both.join(least, "u")
    if large:
        near = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # edges point down: u > v
        near = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return near.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (u, v); the root is the least node
    that it reaches.  Stops when a round changes no edge."""
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        mark = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
        edges = materialize(_star(_star(edges, True), False))
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

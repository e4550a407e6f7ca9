"""Sharding by a hierarchical weighted hash tree [native].

Shards are leaves of a tree region / rack / shard.  A row descends the tree; on
each level every child draws ``-ln(u) / weight`` with u hashed from (doc_id,
child), and the smallest draw wins (a child wins with probability weight /
sum of weights).  A draw depends on the child alone, so when a weight changes
only rows that the changed subtree wins or loses move.  `default_tree` adds
shards beyond its base as regions of their own, so one more shard takes rows
only into itself.

Null and repeated doc_ids hash like any value (null as the text 'null'), null
text has size 1 and the crc of no bytes, an empty table gives an empty result;
extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Tree = dict[str, dict[str, dict[int, float]]]


def default_tree(shards: int, base: int = 16, racks: int = 2, per_rack: int = 4) -> Tree:
    """Equal shards: full regions of racks up to ``base`` shards, then one
    region for each further shard."""
    tree: Tree = {}
    for s in range(shards):
        if s < base:
            region, rack = divmod(s // per_rack, racks)
            tree.setdefault(f"g{region}", {}).setdefault(f"g{region}/k{rack}", {})[s] = 1.0
        else:
            tree[f"g+{s}"] = {f"g+{s}/k0": {s: 1.0}}
    return tree


def _children(nodes: list[tuple[str, float]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("node"), F.lit(float(w)).alias("weight")) for n, w in nodes if w > 0])


def _draw(key: Column, children: Column) -> Column:
    def score(c):
        u = F.conv(F.substring(F.md5(F.concat_ws("|", key, c["node"]).cast("binary")), 1, 13), 16, 10).cast("double")
        return -F.ln((u + 0.5) / F.lit(float(1 << 52))) / c["weight"]
    return F.array_min(F.transform(children, lambda c: F.struct(score(c).alias("s"), c["node"].alias("node"))))["node"]


def place(df: DataFrame, key: Column, tree: Tree, prefix: str = "") -> DataFrame:
    """Add ``{prefix}region``, ``{prefix}rack`` and ``{prefix}shard``."""
    weight = {r: sum(sum(k.values()) for k in racks.values()) for r, racks in tree.items()}
    by_region = F.create_map(*[x for r, racks in tree.items() if weight[r] > 0
                               for x in (F.lit(r), _children([(k, sum(s.values())) for k, s in racks.items()]))])
    by_rack = F.create_map(*[x for racks in tree.values() for k, s in racks.items() if sum(s.values()) > 0
                             for x in (F.lit(k), _children([(f"{k}/{n}", w) for n, w in s.items()]))])
    df = df.withColumn(f"{prefix}region", _draw(key, _children(list(weight.items()))))
    df = df.withColumn(f"{prefix}rack", _draw(key, F.element_at(by_region, F.col(f"{prefix}region"))))
    leaf = _draw(key, F.element_at(by_rack, F.col(f"{prefix}rack")))
    return df.withColumn(f"{prefix}shard", F.element_at(F.split(leaf, "/"), -1).cast("int"))


def with_slots(df: DataFrame, group: str, bucket: str, order: list[str]) -> DataFrame:
    """Gapless ``slot`` from 0 inside each group, ordered by (bucket, *order): bucket
    counts give the offsets, rows are numbered only inside their bucket."""
    counts = df.groupBy(group, bucket).count()
    before = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(group, bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(W.partitionBy(group, bucket).orderBy(*order)) - 1
    return (df.join(offsets, [group, bucket]).withColumn("slot", (F.col("offset") + rank).cast("long"))
            .drop("offset"))


def shard_documents(docs: DataFrame, shards: int = 16, tree: Tree | None = None, grown: Tree | None = None) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes + 1), text_crc32, law
    ('key'), region, rack, shard, slot, grown_shard (under ``grown``; by default
    one more shard)."""
    tree, grown = tree or default_tree(shards), grown or default_tree(shards + 1)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    df = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                     F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    df = place(place(df, key, tree), key, grown, "grown_")
    spread = F.md5(F.concat_ws("|", key, F.col("text_crc32"), F.col("size")).cast("binary"))
    df = df.withColumn("spread", spread).withColumn("slot_bucket", F.substring("spread", 1, 3))
    df = with_slots(df, "shard", "slot_bucket", ["spread", "doc_id", "text_crc32", "size"])
    return df.select("doc_id", "size", "text_crc32", "law", "region", "rack", "shard", "slot", "grown_shard")

"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf: the SHA-256 of its encoded fields.  Leaves of one source, by ascending
doc_id, are the first level of a tree of runs of ``ARITY`` consecutive nodes; a run's node is
the hash of its digests.  A node of level l sits on the row of its first leaf (``pos`` a
multiple of ARITY ** l), so its siblings are at fixed offsets of ARITY ** l rows: lag and lead
columns of those offsets, masked by the node's slot in its run and by the run's length, hold
them, and rows of slot 0 hash the parent.  Subroots of all sources make a tree in the same way.

Windows are over blocks of ARITY ** LEVELS rows of a source, never over a source: a tier of
LEVELS levels ends with one node per block, and these are the rows of the next tier.  Paths
come back by joining a tier's rows to the next tier's by block.  Positions come from
`range_index` (sampled ranges), so a hot source or doc_id spans many tasks.  To the driver go
two numbers: the leaves of the largest source and the number of sources.

Nulls are hashed as ``-`` (a null is unlike an empty text); null sources are one source, the
first; rows of null doc_id come first.  Rows of equal doc_id are ordered by leaf digest, and
rows that are equal throughout take any order, which changes no result as a whole.  An empty
table gives no rows.  Columns besides those hashed are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.identity import range_index
from .common import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels of a tier: windows hold ARITY ** LEVELS rows.
LEVELS = 6


def encoded_row(columns: dict[str, Column]) -> Column:
    """The bytes that a leaf hashes: each value as its byte count, ':' and text, '-' if null."""
    parts = [F.col(c) if x is None else x for c, x in columns.items()]
    parts = [p.cast("string") for p in parts]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])


def digest(*parts) -> Column:
    """Lowercase hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered_text() -> Column:
    """The text of a row that was tampered with: rows of even crc32(doc_id) lose their line breaks."""
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def leaves(docs: DataFrame, suspect: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, and ``suspect_leaf`` with the text replaced by ``suspect``."""
    plain = {c: None for c in FIELDS}
    leaf = digest(encoded_row(plain))
    changed = leaf
    if suspect is not None:
        changed = F.when(suspect.eqNullSafe(F.col("text")), F.lit(None)).otherwise(digest(encoded_row(plain | {"text": suspect})))
    out = docs.select(*FIELDS).select(F.col("doc_id"), F.col("source"), leaf.alias("leaf"), changed.alias("suspect_leaf"))
    return out.withColumn("suspect_leaf", F.coalesce("suspect_leaf", "leaf"))


def _rank(n: int, level: int) -> int:
    """Nodes of a level above n leaves."""
    for _ in range(level):
        n = -(-n // ARITY)
    return n


def _climb(nodes: DataFrame) -> DataFrame:
    """One tier over (tree, pos, n, digest; n nodes in the tree): the rows with ``path``, an
    array of (left, right) sibling digests per level, null above the tree's root, and
    ``top``, on each block's first row the digest of the block's node."""
    block = F.floor(F.col("pos") / F.lit(ARITY ** LEVELS))
    rows = nodes.withColumns({"_block": block, "_d0": F.col("digest")})
    w = Window.partitionBy("tree", "_block").orderBy("pos")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    for l in range(LEVELS):
        step = ARITY ** l
        count = F.ceil(F.col("n") / F.lit(step))
        at = F.floor(F.col("pos") / F.lit(step))
        slot = at % ARITY
        length = F.least(F.lit(ARITY), count - (at - slot))
        here = (F.col("pos") % step == 0) & (count > 1)
        d = F.col(f"_d{l}")
        none = F.lit("")
        left = [F.when(slot >= k, F.lag(d, k * step).over(w)).otherwise(none) for k in range(ARITY - 1, 0, -1)]
        right = [F.when(slot + k < length, F.lead(d, k * step).over(w)).otherwise(none) for k in range(1, ARITY)]
        rows = rows.withColumn(f"_s{l}", F.when(here, F.struct(F.concat(*left).alias("left"), F.concat(*right).alias("right"))))
        s = F.col(f"_s{l}")
        parent = F.when(count == 1, d).when(here & (slot == 0), digest(d, s["right"]))
        rows = rows.withColumn(f"_d{l + 1}", parent)
    # a node's siblings, on the row of its first leaf, hold for all rows up to the next such row
    known = {f"_s{l}": F.when(F.ceil(F.col("n") / F.lit(ARITY ** l)) > 1, F.last(f"_s{l}", ignorenulls=True).over(so_far)) for l in range(LEVELS)}
    rows = rows.withColumns(known)
    return rows.select(*nodes.columns, "_block", F.array(*[f"_s{l}" for l in range(LEVELS)]).alias("path"),
                       F.col(f"_d{LEVELS}").alias("top"))


def _tree(nodes: DataFrame, most: int) -> DataFrame:
    """(tree, pos, n, digest, ...) with the path of every row up to its tree's root, and ``root``."""
    tiers, size = 1, most
    while size > ARITY ** LEVELS:
        size, tiers = _rank(size, LEVELS), tiers + 1
    levels, above = [nodes], nodes
    for _ in range(tiers - 1):
        # count == 1 keeps its digest on all rows of pos 0 only: the first row of a block carries its node
        found = _climb(above.select("tree", "pos", "n", "digest")).where(F.col("pos") % ARITY ** LEVELS == 0)
        up = reduce(lambda c, _: F.ceil(c / F.lit(ARITY)), range(LEVELS), F.col("n"))
        above = materialize(found.select("tree", F.col("_block").alias("pos"), up.alias("n"), F.col("top").alias("digest")))
        levels.append(above)
    known = None
    for rows in reversed(levels):
        found = _climb(rows)
        if known is None:
            root = found.where(F.col("pos") == 0).select(F.col("tree").alias("_tree"), F.col("top").alias("root"))
            known = found.join(root, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree", "_block", "top")
        else:
            above = known.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("path").alias("_above"), "root")
            known = (found.join(above, (F.col("tree") == F.col("_tree")) & (F.col("_block") == F.col("_pos")))
                     .withColumn("path", F.concat("path", "_above")).drop("_tree", "_pos", "_above", "_block", "top"))
    return known.withColumn("path", F.filter("path", lambda s: s.isNotNull()))


def manifest(docs: DataFrame, suspect: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, leaf, suspect_leaf, subroot, root and ``path``, its
    proof: an array of (left, right) sibling digests, concatenated, from the leaf up."""
    placed = materialize(range_index(materialize(leaves(docs, suspect)), ["doc_id", "leaf", "suspect_leaf"], ["source"], name="at"))
    sources = placed.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    sources = materialize(range_index(sources, [F.col("source").asc_nulls_first()], name="tree"))
    most, many = sources.agg(F.max("n"), F.count(F.lit(1))).first()
    if not many:
        most = 1
    p, s = placed.alias("p"), sources.alias("s")
    nodes = p.join(s, F.col("p.source").eqNullSafe(F.col("s.source"))).select(
        "s.tree", (F.col("p.at") - 1).alias("pos"), "s.n", F.col("p.leaf").alias("digest"), "p.doc_id", "p.source", "p.suspect_leaf")
    below = _tree(nodes, most).withColumnRenamed("root", "subroot")
    subroots = below.where(F.col("pos") == 0).select(F.lit(0).alias("tree"), (F.col("tree") - 1).alias("pos"),
                                                     F.lit(many).cast("long").alias("n"), F.col("subroot").alias("digest"))
    over = _tree(materialize(subroots), many).select(F.col("pos").alias("_at"), F.col("path").alias("_over"), "root")
    # one row per source: a broadcast if small, else joined by source
    out = below.join(over, F.col("tree") - 1 == F.col("_at"))
    return out.select("doc_id", "source", F.col("digest").alias("leaf"), "suspect_leaf", "subroot", "root",
                      F.concat("path", "_over").alias("path"))


def proof_digest(path) -> Column:
    """SHA-256 of a proof's siblings, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf, path) -> Column:
    """The root that a leaf and the siblings of its proof lead to."""
    return F.aggregate(path, leaf, lambda d, s: digest(s["left"], d, s["right"]))


def verified_manifest(docs: DataFrame, suspect: Column | None = None) -> DataFrame:
    """The manifest with ``proof_sha256``, ``folded_root`` (from the suspect leaf and the
    original proof) and ``verified`` (it is the root)."""
    out = manifest(docs, suspect).withColumns({"proof_sha256": proof_digest("path"), "folded_root": fold(F.col("suspect_leaf"), F.col("path"))})
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

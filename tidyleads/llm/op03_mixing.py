"""Mixing sources to target weights: time-varying curriculum [native].

Every source has a weight and a schedule, a piecewise linear curve over training
time 0..1 that integrates to 1.  The target of a source is its share of
the mix (by weight; what exceeds ``max_repeat`` times the source's words is
shared anew by weight until no target does).  Its documents, in hashed order,
are laid end to end, epoch after epoch, up to the target; a document's position
is the time at which the source's cumulative demand reaches the middle of its
words: the inverse of the integrated schedule.  The mix is sorted by position in ranges.

Null text has no words (taken 0, no position); a null source is a source of its
own, last in order; repeated rows are mixed as rows of their own; an empty table gives an
empty mix; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import word_count

#: Schedule shapes, given to the sources in turn: early, steady, late.
SHAPES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))


def segments(shape) -> list[tuple[float, float, float, float, float]]:
    """(t0, length, weight at t0, slope, share before t0), the integral scaled to 1."""
    area = sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(shape, shape[1:]))
    out, done = [], 0.0
    for (t0, a), (t1, b) in zip(shape, shape[1:]):
        if t1 > t0 and a + b > 0:
            out.append((float(t0), float(t1 - t0), a / area, (b - a) / (t1 - t0) / area, done))
            done += (t1 - t0) * (a + b) / 2 / area
    return out


def _cycle(values: list, rank: Column) -> Column:
    return F.element_at(F.array(*values), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=(3, 1, 2), shapes=SHAPES, share=1.5, max_repeat=2.0) -> DataFrame:
    """One row per source: src, source_size, weight, target, segs.  ``sizes`` has
    (src, size).  The level that the uncapped sources get per weight is found
    over the sources sorted by cap / weight: exactly what resharing arrives at."""
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("src").asc_nulls_last()))
    segs = [F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("t0", "len", "w", "m", "y0"), s)]) for s in segments(x)])
            for x in shapes]
    per = per.withColumn("rank", rank).select(
        "src", "source_size", _cycle([F.lit(float(w)) for w in weights], F.col("rank")).alias("weight"),
        _cycle(segs, F.col("rank")).alias("segs"))
    per = per.withColumn("cap", max_repeat * F.col("source_size"))
    up_to = W.orderBy(F.col("cap") / F.col("weight"), F.col("src").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ((share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up_to), F.lit(0.0))))
    # the first source, by cap / weight, that its level does not fill to the cap sets the level of all
    per = per.withColumn("level", level)
    open_ = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct((F.col("cap") / F.col("weight")).alias("ratio"), (-F.col("level")).alias("level"))))
    per = per.withColumn("level", -open_.over(every)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return per.select("src", "source_size", "weight", target.alias("target"), "segs")


def position(share_done: Column, segs: Column) -> Column:
    """Time at which the schedule's integral reaches ``share_done``."""
    def solve(s):
        left = share_done - s["y0"]
        root = s["w"] + F.sqrt(F.greatest(s["w"] * s["w"] + 2 * s["m"] * left, F.lit(0.0)))
        return s["t0"] + F.when(root > 0, F.least(2 * left / root, s["len"])).otherwise(0.0)
    inside = F.filter(segs, lambda s: s["y0"] <= share_done)
    return F.try_element_at(F.transform(inside, solve), F.lit(-1))


def lay_out(docs: DataFrame, weights=(3, 1, 2), shapes=SHAPES, share=1.5, max_repeat=2.0, keep: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, src, source_size, target, segs, before
    (words of the source that come first in an epoch), carried ``keep``."""
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    df = docs.select("doc_id", F.col("source").alias("src"), word_count("text").alias("size"), hashed.alias("spread"),
                     *([keep.alias("kept")] if keep is not None else []))
    tie = ["spread", "doc_id", "size"] + ([F.md5(F.to_json("kept"))] if keep is not None else [])
    # one key without nulls for windows and joins: the rows are dealt out once
    key = ["name", "unnamed", "bucket"]
    df = df.withColumns({"name": F.coalesce("src", F.lit("")), "unnamed": F.col("src").isNull(), "bucket": F.substring("spread", 1, 3)})
    per = source_targets(df.select("src", "size"), weights, shapes, share, max_repeat)
    # cumulative words in two tiers: per bucket of the hash, then inside the bucket
    sums = df.groupBy(*key).agg(F.sum("size").alias("words"))
    ahead = W.partitionBy("name", "unnamed").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*key, F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    per = per.withColumns({"name": F.coalesce("src", F.lit("")), "unnamed": F.col("src").isNull()}).drop("src")
    tiers = sums.join(per, ["name", "unnamed"])
    inside = W.partitionBy(*key).orderBy(*tie).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    df = df.join(tiers, key)
    return df.withColumn("before", F.col("offset") + F.col("inside")).drop(*key, "offset", "inside", "spread")


def epochs(df: DataFrame, max_repeat: float) -> DataFrame:
    """Add ``copies``: for each epoch that takes words of the document, struct(position, words)."""
    limit = F.floor("target")

    def one(e):
        start = F.col("before") + e * F.col("source_size")
        words = F.greatest(F.least(limit - start, F.col("size")), F.lit(0))
        return F.struct(position(F.try_divide(start + words / 2, F.col("target")), F.col("segs")).alias("position"),
                        words.cast("long").alias("words"))
    runs = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(int(max_repeat) - (int(max_repeat) == max_repeat)).cast("long")), one)
    return df.withColumn("copies", F.filter(runs, lambda c: c["words"] > 0))


def mix_documents(docs: DataFrame, weights=(3, 1, 2), shapes=SHAPES, share=1.5, max_repeat=2.0) -> DataFrame:
    """One row per document, range-sorted by its first position: doc_id, size, source,
    source_size, target, taken (words over all epochs), position, copies."""
    df = epochs(lay_out(docs, weights, shapes, share, max_repeat), max_repeat)
    df = df.select("doc_id", "size", F.col("src").alias("source"), "source_size", "target",
                   F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"),
                   F.round(F.get("copies", F.lit(0))["position"], 9).alias("position"))
    return df.repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def mixed_rows(docs: DataFrame, weights=(3, 1, 2), shapes=SHAPES, share=1.5, max_repeat=2.0) -> DataFrame:
    """The mix itself: each document's row, with its own columns only, once for
    each epoch that takes it (a document cut by the target comes whole), sorted by position in ranges."""
    df = epochs(lay_out(docs, weights, shapes, share, max_repeat, F.struct("*")), max_repeat)
    df = df.select("kept", F.explode("copies.position").alias("position"))
    return df.repartitionByRange("position").sortWithinPartitions("position").select("kept.*")

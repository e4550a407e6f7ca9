"""Importance resampling of documents towards a target distribution.

Words come from an untrained pre-tokeniser (a Regex Split of the `tokenizers` package) over the
ASCII-lowered text, with their offsets.  Windows over 1..max_n consecutive offset pairs are the
features: a window's words, joined by one space.  A feature's bucket is the CRC-32 of its bytes,
modulo ``buckets``.  Histograms of the documents and of the target texts give each bucket a gain,
the log ratio of its smoothed shares; a document's weight is the sum of its features' gains, and
a Gumbel draw, hashed from the document's id, turns weights into a sample without replacement.

The texts are pre-tokenised once: each document's buckets are written as packed integers (16 or
32 bits a feature), from which the histogram is counted per task and, once the gains are known,
the weights are summed.  The gains (one number a bucket) are all that is sent to tasks.  Ranks
come from `range_index`, over (score, doc_id) of the eligible documents only.

Null and empty texts have no feature and weight 0.  Null ids hash as 'null' and come last
among equal scores.  Repeated rows score alike and count each; among rows of equal score and id,
any take the lower ranks.  A document of very many words is one row of packed integers.  An
empty target gives gains from smoothing alone; an empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.identity import range_index
from .common import materialize, split

#: Words: runs of ASCII letters, digits and characters beyond ASCII, in lowered text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
#: Distinct features whose bucket a task remembers before it starts anew.
REMEMBERED = 1 << 18


def splitter(pattern: str = WORD):
    """Pre-tokeniser that keeps the pattern's matches, with their offsets in the text."""
    from tokenizers import Regex, pre_tokenizers
    return pre_tokenizers.Split(Regex(pattern), "removed", invert=True)


class _Buckets(dict):
    """Feature -> bucket, filled when asked."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        b = self[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.buckets
        return b


def windows(words: list[tuple[str, tuple[int, int]]], text: str, n: int):
    """Features of n consecutive words: from the first one's start to the last one's end, with
    one space for whatever lies between the words."""
    if n == 1:
        return [w for w, _ in words]
    return [" ".join(text[a:b] for _, (a, b) in words[i:i + n]) for i in range(len(words) - n + 1)]


def _packed(buckets: int, max_n: int):
    dtype = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        words_of, known = splitter().pre_tokenize_str, _Buckets(buckets)
        bucket = known.__getitem__
        for pdf in batches:
            n_words, n_features, packed = [], [], []
            for t in pdf["text"]:
                t = t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass") if isinstance(t, str) else ""
                words = words_of(t) if t else []
                found = [b for n in range(1, max_n + 1) for b in map(bucket, windows(words, t, n))]
                n_words.append(len(words))
                n_features.append(len(found))
                packed.append(np.sort(np.array(found, dtype=dtype)).tobytes())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": n_words, "n_features": n_features, "packed": packed})
    return run, dtype


def featurize(texts: DataFrame, buckets: int = BUCKETS, max_n: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and the sorted buckets of all features, packed."""
    run, _ = _packed(buckets, max_n)
    return texts.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        run, "doc_id long, n_words long, n_features long, packed binary")


def histogram(features: DataFrame, buckets: int = BUCKETS, max_n: int = 1) -> DataFrame:
    """bucket, count: one partial histogram per task, then one sum."""
    _, dtype = _packed(buckets, max_n)

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for pdf in split(batches, 500):
            total += np.bincount(np.frombuffer(b"".join(pdf["packed"]), dtype=dtype), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "count": total[at]})
    return (features.select("packed").mapInPandas(run, "bucket long, count long")
            .groupBy("bucket").agg(F.sum("count").alias("count")))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: floor(1000 * ln) of the target's smoothed share over the source's."""
    spark = source.sparkSession
    s = spark.range(buckets).join(source.select(F.col("bucket").alias("id"), F.col("count").alias("s")), "id", "left")
    both = s.join(target.select(F.col("bucket").alias("id"), F.col("count").alias("t")), "id", "left").na.fill(0, ["s", "t"])
    totals = both.agg(F.struct(F.sum("s").alias("s"), F.sum("t").alias("t")).alias("x")).scalar()
    up = (F.col("t") + 1) * (totals["s"] + buckets)
    down = (F.col("s") + 1) * (totals["t"] + buckets)
    return both.select(F.col("id").alias("bucket"), F.floor(1000 * F.ln(up.cast("double") / down.cast("double"))).alias("gain"))


def weigh(features: DataFrame, gain: np.ndarray, buckets: int = BUCKETS, max_n: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight (the sum of the features' gains)."""
    _, dtype = _packed(buckets, max_n)
    sent = features.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        of = sent.value
        for pdf in batches:
            weight = [int(of[np.frombuffer(p, dtype=dtype)].sum()) for p in pdf["packed"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": pdf["n_words"], "n_features": pdf["n_features"], "weight": weight})
    return features.mapInPandas(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) of a uniform u hashed from seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
             buckets: int = BUCKETS, max_n: int = 1, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank: of the documents
    with at least ``least_words`` words, ``percent`` in a hundred are drawn, by score."""
    kept = materialize(featurize(docs, buckets, max_n))
    text = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    rows = gains(histogram(kept, buckets, max_n), histogram(featurize(text, buckets, max_n), buckets, max_n), buckets).collect()  # one row a bucket
    gain = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        gain[r["bucket"]] = r["gain"]
    scored = materialize(weigh(kept, gain, buckets, max_n).withColumn("score", F.col("weight") + gumbel("doc_id", seed)))
    able = F.col("n_words") >= least_words
    ranked = range_index(scored.where(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features"], name="rank")
    n = scored.agg(F.floor(F.count_if(able) * percent / 100).alias("n")).scalar()
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))

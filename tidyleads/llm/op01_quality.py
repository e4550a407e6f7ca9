"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A rating has grades 0 .. G - 1.  One vector of weights over hashed text features is
shared by all grades, and G - 1 ordered thresholds cut its scale:
P(grade >= j) = sigmoid(weights . features - threshold_j).  The expected grade is the
sum of these tails; selection uses the tail of a chosen grade.

Features are distinct words, and word patterns (letters, digits and other bytes by kind,
runs shortened) with how much of the text they make up, and how often the text repeats itself;
all hashed into `DIM` weights.  The model is fitted on at most `SAMPLE` rated
texts (of least hashed doc_id and text); every document is scored in full.

Null or empty text has no feature but the bias; documents without a rating, or with a null
one, are not learned from; a doc_id rated twice counts twice, rows that repeat its text count
once, and each other text under that doc_id counts, within the bound; without any rating all
documents get tails of 1 and stay; empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import encoded

DIM, SAMPLE, L2, ROUNDS = 1 << 16, 6000, 2e-4, 250
_KIND = bytes(0x61 if 0x61 <= b <= 0x7A else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else 0x7A if b >= 0x80 else b
              for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def _level(share: float) -> int:
    """Share in steps: 0 (none) to 8 (all)."""
    return int(np.ceil(share * 8 - 1e-9))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots (0 is the bias) and values of one text."""
    words = text.split()
    names: list[bytes] = []
    if words:
        counts, n = Counter(words), len(words)
        shapes = Counter(_RUN.sub(rb"\1", b" ".join(words).translate(_KIND)).split())
        names += [b"w" + w for w in counts]
        share: Counter = Counter()
        for s, c in shapes.items():
            share[s] += c
            share[b"end" + s[-1:]] += c
            share[b"all" + s[:1]] += c
        names += [b"s%d" % _level(c / n) + s for s, c in share.items()]
        twins = sum(a == b for a, b in zip(words, words[1:]))
        lines = text.split(b"\n")
        names += [b"r%d" % _level(1 - len(counts) / n), b"t%d" % _level(twins / n), b"m%d" % _level(max(counts.values()) / n),
                  b"l%d" % _level(1 - len(set(lines)) / len(lines)), b"n%d" % min(12, n.bit_length())]
        names += [b"T"] * (twins > 2)
    slots = np.unique(np.array([crc32(x) % (DIM - 1) + 1 for x in names], dtype=np.int64))
    # the words of a text share one unit of length, each pattern and statistic has its own
    strong = np.unique(np.array([crc32(x) % (DIM - 1) + 1 for x in names if x[:1] != b"w"], dtype=np.int64))
    values = np.where(np.isin(slots, strong), 0.3, 1 / np.sqrt(len(slots) + 1))
    return np.concatenate(([0], slots)), np.concatenate(([1.0], values))


def rated_sample(docs: DataFrame, ratings: DataFrame, bound: int) -> pd.DataFrame:
    """Features, grades and number of ratings of at most ``bound`` different rated texts, however many rows a rated doc_id has."""
    few = ratings.where("grade is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int"))
    few = few.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id", "grade").limit(bound).groupBy("doc_id", "grade").agg(F.count("*").alias("times"))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id").withColumn("digest", digest)
    chosen = rated.select("doc_id", "grade", "digest").distinct().orderBy(F.md5(F.concat_ws("|", "doc_id", "digest").cast("binary")), "doc_id", "grade").limit(bound)

    def run(batches):
        for pdf in batches:
            f = [features(t) for t in encoded(pdf["text"])]
            yield pd.DataFrame({**{c: pdf[c] for c in ("doc_id", "grade", "digest", "times")},
                                "slots": [x[0].astype(np.int32) for x in f], "values": [x[1].astype(np.float32) for x in f]})
    rows = rated.join(F.broadcast(chosen), ["doc_id", "grade", "digest"]).mapInPandas(
        run, "doc_id long, grade int, digest string, times long, slots array<int>, values array<float>")
    return rows.groupBy("doc_id", "grade", "digest", "times").agg(F.first("slots").alias("slots"), F.first("values").alias("values")).toPandas()


class Ordinal:
    """Weights and ordered thresholds (the first threshold, then gaps as exp)."""

    def __init__(self, grades: int):
        self.weights, self.cut = np.zeros(DIM), np.concatenate(([0.0], np.zeros(max(grades - 2, 0))))

    def thresholds(self) -> np.ndarray:
        return np.cumsum(np.concatenate((self.cut[:1], np.exp(self.cut[1:]))))

    def tails(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= 1 .. G - 1) of each score."""
        return 1 / (1 + np.exp(-np.clip(eta[:, None] - self.thresholds(), -50, 50)))

    def fit(self, sample: pd.DataFrame, rounds: int = ROUNDS, l2: float = L2) -> Ordinal:
        """Full-batch maximum likelihood (Adam).  ``sample``: doc_id, grade, slots, values; times (else 1 each), digest for the order."""
        sample = sample.sort_values([c for c in ("doc_id", "grade", "digest") if c in sample], kind="stable")
        doc = np.repeat(np.arange(len(sample)), [len(s) for s in sample["slots"]])
        slot, value = np.concatenate([np.asarray(s) for s in sample["slots"]]), np.concatenate([np.asarray(v) for v in sample["values"]])
        grade, times = sample["grade"].to_numpy(), sample["times"].to_numpy(np.float64) if "times" in sample else np.ones(len(sample))
        x = np.concatenate((self.weights, self.cut))
        m, v = np.zeros_like(x), np.zeros_like(x)
        for t in range(1, rounds + 1):
            self.weights, self.cut = x[:DIM], x[DIM:]
            tail = self.tails(np.bincount(doc, self.weights[slot] * value, minlength=len(sample)))
            edge = np.hstack((np.ones((len(sample), 1)), tail, np.zeros((len(sample), 1))))
            slope = edge * (1 - edge)
            rows = np.arange(len(sample))
            p = np.maximum(edge[rows, grade] - edge[rows, grade + 1], 1e-12)
            low, high = times * slope[rows, grade] / p, times * slope[rows, grade + 1] / p
            d_eta = -(low - high)
            d_cut = np.zeros(tail.shape[1] + 2)
            np.add.at(d_cut, grade, low)
            np.add.at(d_cut, grade + 1, -high)
            d_theta = d_cut[1:-1]
            later = np.cumsum(d_theta[::-1])[::-1]
            g = np.concatenate((np.bincount(slot, d_eta[doc] * value, minlength=DIM), later[:1], later[1:] * np.exp(self.cut[1:])))
            g = g / times.sum()
            g[1:DIM] += l2 * x[1:DIM]
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            x = x - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        self.weights, self.cut = x[:DIM], x[DIM:]
        return self


def fit(docs: DataFrame, ratings: DataFrame, grades: int, bound: int = SAMPLE) -> Ordinal | None:
    sample = rated_sample(docs, ratings, bound)
    return Ordinal(grades).fit(sample) if len(sample) else None


def _tails(spark, model: Ordinal | None, grades: int):
    sent = spark.sparkContext.broadcast(model)

    def run(texts: list[bytes]) -> np.ndarray:
        if sent.value is None:
            return np.ones((len(texts), grades - 1))
        w = sent.value.weights
        return sent.value.tails(np.array([w[s] @ v for s, v in map(features, texts)], dtype=float))
    return run


def grade_documents(docs: DataFrame, ratings: DataFrame, grades: int = 3, select: int = 1, at_least: float = 0.5, bound: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, expected_grade, tails (P(grade >= 1), ...), tail (of
    grade ``select``), kept (tail >= at_least).  ``ratings``: doc_id, grade."""
    tails = _tails(docs.sparkSession, fit(docs, ratings, grades, bound), grades)

    def run(batches):
        for pdf in batches:
            p = tails(encoded(pdf["text"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "expected_grade": p.sum(1), "tails": list(p),
                                "tail": p[:, select - 1], "kept": p[:, select - 1] >= at_least})
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        run, "doc_id long, expected_grade double, tails array<double>, tail double, kept boolean")


def good_documents(docs: DataFrame, ratings: DataFrame, rated: DataFrame | None = None, grades: int = 3, select: int = 1,
                   at_least: float = 0.5, bound: int = SAMPLE) -> DataFrame:
    """The documents, with their own columns, whose tail is high enough."""
    tails = _tails(docs.sparkSession, fit(docs if rated is None else rated, ratings, grades, bound), grades)

    @F.pandas_udf("double")
    def tail(text: pd.Series) -> pd.Series:
        return pd.Series(tails(encoded(text))[:, select - 1])
    return docs.where(tail(F.col("text")) >= at_least)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from the labels: 0 poor, 1 good but toxic, 2 good."""
    clean: Column = F.when(F.coalesce("toxic", F.lit(0)) == 0, 2).otherwise(1)
    return labels.select("doc_id", F.when(F.col("quality") == 1, clean).when(F.col("quality") == 0, 0).alias("grade"))

"""Benchmark decontamination by pigeonhole edit matching.

Text and items are normalised (lower case; runs of other characters than
letters and digits become one space).  An item of m characters may differ from
a passage by k = floor(m * budget) edits.  It is cut into k + 1 pieces: k edits
leave one of them intact, so every such passage holds an exact piece.  An
Aho-Corasick automaton finds the pieces; at each hit, Myers' bit-parallel
algorithm finds the least distance of the item to any passage around it.

The benchmark is read in blocks of bounded size, each searched in one scan of
the documents; nothing of the documents is shuffled.  Items under ``least``
characters match only a document that is equal to them as a whole; null and
empty items match nothing; null texts are empty; equal items, repeated rows and null ids each give their
own rows; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OTHER = re.compile(r"[\W_]+")
#: Characters of benchmark text that one scan searches for; bounds what is broadcast.
BLOCK_CHARS = 8_000_000


def normalise(text) -> str:
    return _OTHER.sub(" ", text.lower()).strip() if isinstance(text, str) else ""


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and the first
    end of such a part (Myers' bit vectors, of any length)."""
    m = len(pattern)
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        x = eq.get(c, 0)
        d0 = ((((x & pv) + pv) ^ pv) | x | mv) & full
        hp, hn = mv | ~(d0 | pv) & full, pv & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        pv, mv = hn | ~(d0 | hp) & full, hp & d0
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Items of one block, ready to search normalised texts."""

    def __init__(self, items: list[tuple[object, str]], budget: float, least: int):
        self.items, self.budget = items, [math.floor(len(t) * budget) for _, t in items]
        self.whole: dict[str, list[int]] = {}
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (_, t) in enumerate(items):
            if not t:
                continue
            if len(t) < least:
                self.whole.setdefault(t, []).append(i)
                continue
            n = self.budget[i] + 1
            cuts = [len(t) * p // n for p in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(t[a:b], []).append((i, a))
        self.find = ahocorasick.Automaton()
        for p, where in pieces.items():
            self.find.add_word(p, (len(p), where))
        self.some = bool(pieces)
        if self.some:
            self.find.make_automaton()

    def search(self, text: str) -> dict[int, tuple[int, int, int]]:
        """{item: (distance, start of the window, end)} of the nearest passage of each item."""
        found = {i: (0, 0, len(text)) for i in self.whole.get(text, ())}
        if not self.some:
            return found
        tried: dict[int, int] = {}
        for end, (length, where) in self.find.iter(text):
            for i, offset in where:
                item, k = self.items[i][1], self.budget[i]
                start = end + 1 - length - offset
                if found.get(i, (1,))[0] == 0 or -k <= start - tried.get(i, -1 << 60) <= 0:
                    continue  # an exact passage is known, or the last window held this alignment
                if text[max(start, 0):start + len(item)] == item:
                    found[i] = (0, start, start + len(item))
                    continue
                lo = max(0, start - k)
                distance, at = myers(item, text[lo:max(0, start) + len(item) + 2 * k])
                tried[i] = start
                if distance <= k and distance < found.get(i, (k + 1,))[0]:
                    found[i] = (distance, lo, lo + at)
        return found


def _blocks(benchmark: DataFrame, block_chars: int):
    """Lists of (item_id, normalised text), each of about ``block_chars`` characters."""
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_chars) or 1
    for b in range(n):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).select("item_id", "text").collect()
        yield [(r["item_id"], normalise(r["text"])) for r in rows]


def _matcher(spark, items, budget: float, least: int):
    sent = spark.sparkContext.broadcast(items)
    kept: list[Matcher] = []

    def get() -> Matcher:
        if not kept:
            kept.append(Matcher(sent.value, budget, least))
        return kept[0]
    return get


def leaks(docs: DataFrame, benchmark: DataFrame, budget: float = 0.05, least: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, distance, budget,
    start and end in the normalised text (of the window's start and the passage's end)."""
    spark, out = docs.sparkSession, None
    for items in _blocks(benchmark, block_chars):
        matcher = _matcher(spark, items, budget, least)

        def run(batches, matcher=matcher):
            m = matcher()
            for pdf in batches:
                rows = [(d, m.items[i][0], x, m.budget[i], a, b) for d, t in zip(pdf["doc_id"], pdf["text"])
                        for i, (x, a, b) in m.search(normalise(t)).items()]
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "budget", "start", "end"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})
        part = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
            run, "doc_id long, item_id long, distance long, budget long, start long, end long")
        out = part if out is None else out.union(part)
    return out


def _holds(matcher):
    @F.pandas_udf("boolean")
    def holds(text: pd.Series) -> pd.Series:
        m = matcher()
        return pd.Series([bool(m.search(normalise(t))) for t in text], dtype=bool)
    return holds


def decontaminated(docs: DataFrame, benchmark: DataFrame, budget: float = 0.05, least: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, with their own columns, that hold no item."""
    for items in _blocks(benchmark, block_chars):
        docs = docs.where(~_holds(_matcher(docs.sparkSession, items, budget, least))(F.col("text")))
    return docs

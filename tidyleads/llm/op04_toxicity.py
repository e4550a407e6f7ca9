"""Toxicity: Levenshtein automata intersected with a lexicon trie.

Lexicon.  From labelled documents outside the held-out fold (at most `SAMPLE`, those of least
hashed doc_id, equal texts once), words and word beginnings (stems) that occur
in toxic texts far more often than in others; of stems that begin one another the best is taken.

Matching.  The lexicon's trie is intersected with the Levenshtein automaton of distance 1
(0 for terms under `FUZZY_FROM` characters), and the product is determinised: one table that
reads a word character by character and knows the best term in reach.  All words
of a batch step through it together; each word of each text is read.

Scoring.  Each term counts by its learned share of toxic texts (exact and misspelled,
single and repeated apart), less inside quotation marks or after a reporting verb, more with other hits within
`WINDOW` words.  A text's score is 1 - the product of what its hits leave.

Null and empty texts score 0; labels that are null, or of unknown documents, teach nothing;
without toxic labels all scores are 0; repeated rows are scored alike; empty tables
give empty results; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_bucket

SAMPLE, SUPPORT, TERMS = 8_000, 0.02, 200
FUZZY_FROM, STEM, WINDOW = 5, (3, 4, 5, 6, 7), 5
#: A term must be found in so many times more toxic texts than others.
LIFT = 4
#: Part of a hit's weight that stays inside a quotation or after a reporting verb.
QUOTED = 0.4
_QUOTES = "\"“”„«»‹›"
_REPORTS = frozenset("said says wrote writes called calls quoted quotes reported shouted sagte schrieb nannte dit écrit dijo escribió".split())
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def bare(word: str) -> str:
    return _EDGE.sub("", word)


def _terms(words: list[str]) -> Counter:
    out = Counter(w + "$" for w in words)
    for n in STEM:
        out.update(w[:n] for w in words if len(w) > n)
    return out


def lexicon(train: DataFrame, support: float = SUPPORT, lift: float = LIFT, most: int = TERMS) -> list[str]:
    """Terms of the toxic texts: 'word$' for whole words, else stems; those whose single or whose
    repeated occurrence sets toxic texts apart.  ``train``: text, toxic."""
    total = dict(train.groupBy("toxic").count().collect())
    if not total.get(1):
        return []

    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), 300):
                seen: dict[str, list[int]] = {}
                for t, y in zip(pdf["text"][lo:lo + 300], pdf["toxic"][lo:lo + 300]):
                    for term, c in _terms([b for b in map(bare, t.lower().split()) if len(b) > 2]).items():
                        row = seen.setdefault(term, [0, 0, 0, 0])
                        row[y] += 1
                        row[2 + y] += c > 1
                yield pd.DataFrame([(t, *x) for t, x in seen.items()], columns=["term", "good", "bad", "good2", "bad2"])
    counts = train.mapInPandas(run, "term string, good long, bad long, good2 long, bad2 long").groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("good", "bad", "good2", "bad2")])
    gain = F.greatest(F.col("bad") - lift * F.col("good"), F.col("bad2") - lift * F.col("good2"))
    rows = counts.withColumn("gain", gain).where(F.col("gain") >= max(3.0, support * total[1]))
    out: list[str] = []
    for (t,) in rows.orderBy(F.desc("gain"), F.desc(F.length("term")), "term").select("term").limit(20 * most).collect():
        # a term that begins a taken one, or that a taken stem begins, adds nothing
        if len(out) < most and not any(o.startswith(t) or (t.startswith(o) and not o.endswith("$")) for o in out):
            out.append(t)
    return sorted(out)


class Automaton:
    """Determinised product of the lexicon trie and the distance-1 automaton."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        text = [t.rstrip("$") for t in terms]
        alphabet = sorted({c for t in text for c in t})
        self.code = {c: i + 1 for i, c in enumerate(alphabet)}  # 0: any other character
        width = len(alphabet) + 1
        fuzzy = [len(t) >= FUZZY_FROM for t in text]

        # an item: (term, characters matched, edits); a done stem: (term, -1, edits)
        def close(items):
            out, todo = set(items), list(items)
            while todo:
                t, i, e = todo.pop()
                if i >= 0 and i < len(text[t]) and e == 0 and fuzzy[t]:
                    nxt = (t, i + 1, 1)  # the word leaves out a character of the term
                    if nxt not in out:
                        out.add(nxt)
                        todo.append(nxt)
            for t, i, e in list(out):
                if i == len(text[t]) and not terms[t].endswith("$"):
                    out.add((t, -1, e))
            return frozenset(out)

        def step(items, c):
            out = set()
            for t, i, e in items:
                if i < 0:
                    out.add((t, -1, e))
                    continue
                if i < len(text[t]) and self.code[text[t][i]] == c:
                    out.add((t, i + 1, e))
                if e == 0 and fuzzy[t]:
                    out.add((t, i, 1))  # one more character in the word
                    if i < len(text[t]):
                        out.add((t, i + 1, 1))  # another character
            return close(out)
        start = close({(t, 0, 0) for t in range(len(terms))})
        dead = frozenset()
        number, todo, rows, best = {dead: 0}, [], {0: [0] * width}, {0: -1}
        if start != dead:
            number[start] = 1
            todo.append(start)
        while todo:
            s = todo.pop()
            rows[number[s]] = []
            ends = [(e, t) for t, i, e in s if i < 0 or (i == len(text[t]) and terms[t].endswith("$"))]
            best[number[s]] = (lambda x: x[1] * 2 + x[0])(min(ends)) if ends else -1
            for c in range(width):
                to = step(s, c)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                rows[number[s]].append(number[to])
        self.next = np.array([rows[i] for i in range(len(number))], dtype=np.int32)
        self.best = np.array([best[i] for i in range(len(number))], dtype=np.int32)

    def find(self, words: list[str]) -> np.ndarray:
        """For each word 2 * term + (1 if misspelled), or -1."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        table = np.zeros(max((ord(c) for c in self.code), default=0) + 2, dtype=np.int32)
        for c, i in self.code.items():
            table[ord(c)] = i
        x = table[np.minimum(points, len(table) - 1)]
        at = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(words) else sizes
        state, live = np.full(len(words), min(1, len(self.next) - 1), dtype=np.int32), np.arange(len(words) if self.terms else 0)
        for k in range(int(sizes.max()) if len(words) else 0):
            live = live[sizes[live] > k]
            if not len(live):
                break
            state[live] = self.next[state[live], x[at[live] + k]]
            live = live[state[live] > 0]
        return self.best[state]


def hits(text: str, found: np.ndarray, words: list[str]) -> list[tuple[int, int, bool]]:
    """(word number, 2 * term + misspelled, quoted) of one text's hits."""
    where = np.flatnonzero(found >= 0)
    if not len(where):
        return []
    marks = np.cumsum([sum(c in _QUOTES for c in w) for w in words]) if any(q in text for q in _QUOTES) else None
    out = []
    for i in where:
        before = words[max(0, i - 3):i]
        inside = marks is not None and ((marks[i - 1] if i else 0) % 2 == 1 or any(c in _QUOTES for c in words[i]))
        out.append((int(i), int(found[i]), bool(inside or any(bare(w) in _REPORTS for w in before))))
    return out


def text_score(found: list[tuple[int, int, bool]], weight: np.ndarray) -> float:
    """1 - product over the terms of 1 - weight, each by the strongest window around a hit.
    weight[0] is for a term's single hit in a text, weight[1] for repeated ones."""
    times, best, at = Counter(x[1] for x in found), {}, [x[0] for x in found]
    for n, (i, t, quoted) in enumerate(found):
        near = sum(0 < abs(j - i) <= WINDOW for j in at[max(0, n - WINDOW):n + WINDOW + 1])
        best[t] = max(best.get(t, 0.0), (QUOTED if quoted else 1.0) * (1 + 0.25 * near))
    left = 1.0
    for t, strength in best.items():
        left *= 1 - min(0.999, weight[min(times[t], 2) - 1, t] * strength)
    return 1 - left


def _read(texts, automaton: Automaton, size: int = 1 << 20):
    """Hits of each text; texts are read in groups of about ``size`` characters."""
    group, n = [], 0
    texts = [t.lower() if isinstance(t, str) else "" for t in texts]
    for i, t in enumerate(texts):
        group.append(t)
        n += len(t)
        if n >= size or i + 1 == len(texts):
            words = [t.split() for t in group]
            found = automaton.find([bare(w) if not w.isalpha() else w for ws in words for w in ws])
            cut = np.concatenate(([0], np.cumsum([len(w) for w in words])))
            for j, ws in enumerate(words):
                yield hits(group[j], found[cut[j]:cut[j + 1]], ws)
            group, n = [], 0


def learn(docs: DataFrame, labels: DataFrame, fold: int, folds: int, bound: int = SAMPLE) -> tuple[Automaton, np.ndarray]:
    """Automaton and the weight of each (term, misspelled)."""
    known = labels.where("toxic is not null and doc_id is not null").where(id_bucket("doc_id", folds) != fold)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).cast("int").alias("toxic"))
    known = known.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id", "toxic").limit(bound)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    train = text.join(F.broadcast(known), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic")).cache()
    automaton = Automaton(lexicon(train))

    def run(batches):
        for pdf in batches:
            seen = Counter()
            for y, h in zip(pdf["toxic"], _read(pdf["text"], automaton)):
                times = Counter(x[1] for x in h)
                exact = any(t % 2 == 0 for t in times)  # misspelled terms teach where nothing else explains the label
                seen.update((t, min(c, 2), y) for t, c in times.items() if t % 2 == 0 or not exact)
            yield pd.DataFrame([(*k, c) for k, c in seen.items()], columns=["t", "times", "y", "c"], dtype="int64")
    counts = train.mapInPandas(run, "t long, times long, y long, c long").groupBy("t", "times", "y").agg(F.sum("c").alias("c")).collect()
    train.unpersist()
    share = np.full((2, 2 * len(automaton.terms) + 2), np.nan)
    seen = np.zeros((2, *share.shape))
    for t, times, y, c in counts:
        seen[y, times - 1, t] = c
    n = seen.sum(0)
    share[n > 0] = np.maximum(seen[1][n > 0] - 0.5, 0) / n[n > 0]
    # what the sample doesn't show: repeats as single hits, single hits a little less than repeats,
    # misspellings half as much as their term
    share[1] = np.where(np.isnan(share[1]), share[0], share[1])
    share[0] = np.where(np.isnan(share[0]), 0.8 * share[1], share[0])
    share[:, 1::2] = np.where(np.isnan(share[:, 1::2]), 0.5 * share[:, 0::2], share[:, 1::2])
    return automaton, np.nan_to_num(share)


def score_documents(docs: DataFrame, labels: DataFrame, fold: int = 2, folds: int = 4, cut: float = 0.3, bound: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_hits, n_quoted, terms."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, fold, folds, bound))

    def run(batches):
        automaton, weight = sent.value
        for pdf in batches:
            found = list(_read(pdf["text"], automaton))
            score = [text_score(h, weight) for h in found]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"], "score": score,
                                "predicted": [int(s >= cut) for s in score], "n_hits": [len(h) for h in found],
                                "n_quoted": [sum(x[2] for x in h) for h in found],
                                "terms": [sorted({automaton.terms[x[1] // 2] for x in h}) for h in found]})
    return docs.select(F.col("doc_id").cast("long"), "text", (id_bucket("doc_id", folds) == fold).alias("held_out")).mapInPandas(
        run, "doc_id long, held_out boolean, score double, predicted int, n_hits int, n_quoted int, terms array<string>")

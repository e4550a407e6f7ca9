"""LM scoring by a probabilistic suffix tree.

The text is read as its words' bytes (A-Z lower-cased), one separator between
words and one end.  The 58 most frequent byte values are one symbol each, every other one a
pair of symbols, so all bytes are learned.  Contexts are the last 0 to `DEPTH` symbols.  A context
becomes a state of its own if it was seen `LEAST` times at least, whatever the corpus, and the
Kullback-Leibler divergence of its next symbols from those of its longest shorter state is at least
`MIN_KL`.  Distributions are smoothed by Witten-Bell towards that shorter
state.  A word's probability is the product over its bytes and what follows it, mixed with the base's
(`MIX` of it): the tree knows how words are built, the base which words there are.
The score is the sum of their log10.

Counting: map tasks combine the (DEPTH + 1)-grams of all training texts, Spark
sums them; each level's states and probabilities are Spark tables (`probabilities`) that grow with the
corpus.  Scoring: texts lie in blocks, and a block needs the probability of each of its distinct grams once.
Grams above `P_MIN` of all positions (at most 1 / P_MIN of them) are sent to the tasks; of all
others, each block's distinct ones are joined with the tables (`looked_up`).  The base score's word
counts likewise: words above `HEAVY` of all tokens (at most 1 / HEAVY of them) are sent to the tasks;
of all others, each block's distinct words are joined with the counts.  What a block asked for meets its
texts by one cogroup.

Null text is empty (one end token); a null doc_id hashes as 'null'; repeated
rows count as often as they occur; with no training rows all scores come from uniform
distributions; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import _SPACE, Counts, byte_chunks, encoded, id_bucket, settled as materialize, spans, split, word_hashes

DEPTH, P_MIN, MIN_KL, HEAVY, MIX = 5, 1e-6, 0.02, 1e-5, 0.4
BITS = 6
SIZE = 1 << BITS
END, SEP, OTHER = 0, 1, SIZE - 1
#: Bytes of text that a task counts at once.
CHUNK = 1 << 20
#: Bytes of a block's texts that a task scores at once: several arrays of eight bytes a symbol each.
SCORED = 1 << 18
#: Times that a state's context was seen at least.
LEAST = 2
#: Symbols of frequent bytes begin at 2; the last four begin the pairs of the other bytes.
PLAIN = SIZE - 6
#: Bytes of text in a block, and documents at most.
BLOCK, BLOCK_DOCS = 1 << 24, 30_000


def _symbols(texts: list[bytes], code: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, each behind ``depth`` ends and closed by one, and where each text's own begin (plus the total)."""
    buf, starts, ends, first = spans(texts)
    x = code[buf]
    own = ~_SPACE[buf]
    pair = own & (x >= SIZE)
    inner = np.delete(starts, first[:-1][first[:-1] < first[1:]]) if len(starts) else starts
    x[inner - 1], own[inner - 1] = SEP, True
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    sizes = np.diff(np.concatenate(([0], np.cumsum(own.astype(np.int64) + pair)))[at])
    begin = np.concatenate(([0], np.cumsum(sizes + depth + 1))) + depth
    out = np.full(begin[-1] - depth, END, dtype=np.uint8)
    out[np.arange(sizes.sum()) + np.repeat(begin[:-1] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)] = _single(x[own])
    return out, begin


def _single(x: np.ndarray) -> np.ndarray:
    """The pairs among coded bytes as two symbols."""
    if not len(x) or x.max() < SIZE:
        return x
    pair = x >= SIZE
    at = np.cumsum(1 + pair) - 1 - pair
    out = np.empty(len(x) + pair.sum(), dtype=np.uint8)
    out[at] = np.where(pair, x >> BITS, x)
    out[at[pair] + 1] = x[pair] & (SIZE - 1)
    return out


def byte_code(counts: np.ndarray) -> np.ndarray:
    """Symbols of the 256 byte values: one of the `PLAIN` most frequent each, two of all others."""
    order = np.argsort(-counts, kind="stable")
    code = np.empty(256, dtype=np.uint16)
    code[order[:PLAIN]] = np.arange(2, 2 + PLAIN)
    rest = np.arange(256 - PLAIN)
    code[order[PLAIN:]] = (2 + PLAIN + rest // PLAIN << BITS) | (2 + rest % PLAIN)
    return code


def _grams(x: np.ndarray, depth: int) -> np.ndarray:
    """Each symbol from the ``depth``-th on with those before it."""
    wide = x.astype(np.uint64)
    g = wide[:len(wide) - depth].copy()
    for i in range(1, depth + 1):
        g = (g << np.uint64(BITS)) | wide[i:len(wide) - depth + i]
    return g


def _predicted(n: int, begin: np.ndarray, depth: int) -> np.ndarray:
    mask = np.ones(n, dtype=bool)
    mask[(begin[:-1, None] - 1 - np.arange(depth)).ravel()] = False
    return mask


def word_table(train: DataFrame) -> DataFrame:
    """(kind, key, c): counts of words (kind 0, key: hash), bytes (1) and ends (2)."""
    def run(batches):
        words, bytes_, ends = Counts(), np.zeros(256, dtype=np.int64), 0

        def rows(kind, keys, counts):
            return pd.DataFrame({"kind": np.full(len(keys), kind, dtype=np.int32), "key": keys.view(np.int64), "c": counts})
        for pdf in split(batches):
            texts = encoded(pdf["text"])
            ends += len(texts)
            for a, b in byte_chunks(texts, CHUNK):
                buf, *_ = spans(texts[a:b])
                bytes_ += np.bincount(buf[~_SPACE[buf]], minlength=256)
                words.add(word_hashes(texts[a:b])[0])
                if (out := words.full()) is not None:
                    yield rows(0, *out)
        yield rows(0, *words.rest())
        yield rows(1, np.arange(256, dtype=np.uint64), bytes_)
        yield rows(2, np.zeros(1, dtype=np.uint64), np.array([ends], dtype=np.int64))
    return train.mapInPandas(run, "kind int, key long, c long").groupBy("kind", "key").agg(F.sum("c").alias("c")).where("c > 0")


def gram_table(train: DataFrame, code: np.ndarray, depth: int) -> DataFrame:
    """(g, c): counts of the (depth + 1)-grams that end in a predicted symbol."""
    def run(batches):
        grams = Counts()
        for pdf in split(batches):
            texts = encoded(pdf["text"])
            for a, b in byte_chunks(texts, CHUNK):
                x, begin = _symbols(texts[a:b], code, depth)
                grams.add(_grams(x, depth)[_predicted(len(x), begin, depth)[depth:]])
                if (out := grams.full()) is not None:
                    yield pd.DataFrame({"g": out[0].view(np.int64), "c": out[1]})
        out = grams.rest()
        yield pd.DataFrame({"g": out[0].view(np.int64), "c": out[1]})
    return train.mapInPandas(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def shorter(grams: DataFrame, depth: int) -> list[DataFrame]:
    """Counts (g, c) of the grams whose contexts have 0 .. depth symbols."""
    out = [grams]
    for d in range(depth, 0, -1):
        short = F.col("g").bitwiseAND(F.lit((1 << BITS * d) - 1))
        out.append(materialize(out[-1].groupBy(short.alias("g")).agg(F.sum("c").alias("c"))))
    return out[::-1]


def probabilities(levels: list[DataFrame], min_kl: float, least: int) -> list[DataFrame]:
    """(g, c, p, back) of each level: count and probability of every seen gram's last symbol after its context, and the
    share that the context's state, if it is one, leaves to the shorter one (else 1)."""
    counts = np.zeros(SIZE)
    for g, c in levels[0].collect():
        counts[g] = c
    root = (counts + 0.5) / (counts.sum() + 0.5 * SIZE)
    spark = levels[0].sparkSession
    out = [spark.createDataFrame([(i, int(counts[i]), float(p), 1.0) for i, p in enumerate(root)], "g long, c long, p double, back double")]
    own = W.partitionBy(F.shiftright("g", BITS))  # at most SIZE rows
    for d in range(1, len(levels)):
        up = out[-1].select(F.col("g").alias("s"), F.col("p").alias("up"))
        t = levels[d].join(up, F.col("g").bitwiseAND(F.lit((1 << BITS * d) - 1)) == F.col("s"))
        t = t.select("g", "c", "up", F.sum("c").over(own).alias("n"), F.count("*").over(own).alias("types"),
                     F.sum(F.col("c") * F.log(F.col("c") / F.col("up"))).over(own).alias("s"))
        keep = (F.col("n") >= least) & (F.col("s") / F.col("n") - F.log("n") >= min_kl)
        out.append(materialize(t.select("g", "c", F.when(keep, (F.col("c") + F.col("types") * F.col("up")) / (F.col("n") + F.col("types"))).otherwise(F.col("up")).alias("p"),
                                        F.when(keep, F.col("types") / (F.col("n") + F.col("types"))).otherwise(1.0).alias("back"))))
    return out


def looked_up(asked: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(block, g, p) of asked grams (block, g): those of the training texts by one join, others through the shorter states."""
    found = materialize(asked.join(tables[-1].select("g", "p"), "g", "left").select("block", "g", F.col("p").cast("float").alias("p")))
    new = materialize(found.where("p is null").select("g").distinct())
    root = [r.p for r in sorted(tables[0].collect(), key=lambda r: r.g)]
    p = new.select("g", F.element_at(F.array(*map(F.lit, root)), (F.col("g").bitwiseAND(F.lit(SIZE - 1)) + 1).cast("int")).alias("p"))
    for d, level in enumerate(tables[1:], 1):
        p = p.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << BITS * (d + 1)) - 1))).withColumn("ctx", F.shiftright("s", BITS))
        left = level.where("back < 1").select(F.shiftright("g", BITS).alias("ctx"), "back").distinct()
        p = p.join(level.select(F.col("g").alias("s"), F.col("p").alias("seen")), "s", "left").join(left, "ctx", "left")
        p = p.select("g", F.coalesce("seen", F.col("p") * F.coalesce("back", F.lit(1.0))).alias("p"))
    return found.where("p is not null").unionByName(found.where("p is null").drop("p").join(p.select("g", F.col("p").cast("float").alias("p")), "g"))


def blocked(docs: DataFrame) -> DataFrame:
    """Blocks of documents: block, ids (int64 array), nulls (a byte for each id), sizes, z."""
    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=3)

        def row(parts):
            ids, texts = ([x for p in parts for x in p[i]] for i in range(2))
            return pd.DataFrame({"ids": [np.array([0 if i is None else i for i in ids], np.int64).tobytes()],
                                 "nulls": [np.array([i is None for i in ids], np.uint8).tobytes()],
                                 "sizes": [np.array([len(t) for t in texts], np.int64).tobytes()], "z": [zip_.compress(b"".join(texts))]})
        parts, size, n = [], 0, 0
        for pdf in split(batches, 500):
            texts, ids = encoded(pdf["text"]), [None if i is None else int(i) for i in pdf["id"]]
            for a, b in byte_chunks(texts, CHUNK):
                parts.append((ids[a:b], texts[a:b]))
                size, n = size + sum(map(len, texts[a:b])), n + b - a
                if size >= BLOCK or n >= BLOCK_DOCS:
                    yield row(parts)
                    parts, size, n = [], 0, 0
        if parts:
            yield row(parts)
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(
        run, "ids binary, nulls binary, sizes binary, z binary")
    return materialize(rows.select(F.monotonically_increasing_id().alias("block"), "*"))


def _texts(row, limit: int):
    """(start, end, texts) of a block, about ``limit`` bytes of text at a time, one text at least."""
    sizes = np.frombuffer(row.sizes, dtype=np.int64)
    data = zstandard.ZstdDecompressor().decompress(row.z, max_output_size=int(sizes.sum()) + 1)
    at = np.concatenate(([0], np.cumsum(sizes)))
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(at, at[a] + limit, "right")) - 1)
        yield a, b, [data[x:y] for x, y in zip(at[a:b].tolist(), at[a + 1:b + 1].tolist())]
        a = b


def _values(keys: np.ndarray, values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values of x by sorted keys (0 where there is none)."""
    if not len(keys):
        return np.zeros(len(x))
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, values[at], 0.0)


class Known:
    """Values of sorted keys that every task has, and of the others that a block asked for."""

    def __init__(self, sent: tuple[np.ndarray, np.ndarray], keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.sent, self.own = sent, (keys[order], values[order])

    def _of(self, x: np.ndarray) -> np.ndarray:
        return _values(*self.sent, x) + _values(*self.own, x)  # no key is in both

    def of(self, x: np.ndarray) -> np.ndarray:
        """Each distinct key is looked up once.  Keys that leave room for their place are sorted as one number with it."""
        bits = len(x).bit_length()
        if not len(x) or x.min() < 0 or int(x.max()).bit_length() + bits > 63:
            own, at = np.unique(x, return_inverse=True)
            return self._of(own)[at]
        packed = np.sort((x << bits) | np.arange(len(x)))
        own, out = packed >> bits, np.empty(len(x))
        cut = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
        out[packed & ((1 << bits) - 1)] = np.repeat(self._of(own[cut[:-1]]), np.diff(cut))
        return out


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: `np.unique` hashes, which takes eight times as long on a million grams)."""
    x = np.sort(x)
    return x[np.concatenate((np.ones(min(len(x), 1), dtype=bool), x[1:] != x[:-1]))]


def _asked(parts, often: np.ndarray) -> np.ndarray:
    """Sorted distinct keys of all parts but those of ``often``; merged again and again, so that few repeats are held."""
    held, size, least = [], 0, 1 << 20
    for x in parts:
        held.append(_distinct(x))
        size += len(held[-1])
        if size > least:
            held = [_distinct(np.concatenate(held))]
            size = len(held[0])
            least = 2 * max(size, 1 << 19)
    k = _distinct(np.concatenate([np.empty(0, np.int64), *held]))
    return k if not len(often) else k[often[np.minimum(np.searchsorted(often, k), len(often) - 1)] != k]


def _sorted(rows: pd.DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.sort_values(key)
    return rows[key].to_numpy(np.int64), rows[value].to_numpy(np.float64)


def score_documents(docs: DataFrame, held: int = 2, folds: int = 7, depth: int = DEPTH, p_min: float = P_MIN,
                    min_kl: float = MIN_KL, heavy: float = HEAVY, share: float = MIX, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text", (id_bucket("doc_id", folds) == held).alias("held_out"))
    train = docs.where("not held_out").select("text")
    counted = materialize(word_table(train))
    words = counted.where("kind = 0").select(F.col("key").alias("k"), "c")
    ends = counted.where("kind = 2").agg(F.sum("c")).first()[0] or 0
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, v = n + ends, v + (ends > 0)
    norm = n + 1 * (v + 1)
    seen = counted.where("kind = 1").toPandas()
    seen = np.bincount(seen["key"].to_numpy(np.int64), seen["c"].to_numpy(np.float64), minlength=256)
    code = byte_code(seen)
    grams = materialize(gram_table(train, code, depth))
    total = grams.agg(F.sum("c")).first()[0] or 0
    tables = probabilities(shorter(grams, depth), min_kl, least)
    often_g = tables[-1].where(F.col("c") >= max(1.0, p_min * total)).select("g", F.log10("p").alias("lp")).toPandas()
    often_w = words.where(F.col("c") >= max(1.0, heavy * n)).toPandas()
    sent = spark.sparkContext.broadcast((code, _sorted(often_g, "g", "lp"), _sorted(often_w, "k", "c")))
    end_p = float((ends + 1) / norm)
    blocks = blocked(docs)

    def asking(key, often, distinct):
        """Rows (block, key) of what each block needs beyond the keys that all tasks have."""
        def run(batches):
            for r in (r for pdf in batches for r in pdf.itertuples()):
                k = _asked((distinct(texts).view(np.int64) for _, _, texts in _texts(r, SCORED)), often())
                yield pd.DataFrame({"block": np.full(len(k), r.block, dtype=np.int64), key: k})
        return packed.mapInPandas(run, f"block long, {key} long")

    def own_grams(texts):
        x, begin = _symbols(texts, sent.value[0], depth)
        return _grams(x, depth)[_predicted(len(x), begin, depth)[depth:]]

    packed = blocks.select("block", "sizes", "z")
    rare = looked_up(asking("g", lambda: sent.value[1][0], own_grams), tables)
    # words that the training texts lack stay away, as count 0
    seldom = words.where(F.col("c") < max(1.0, heavy * n))
    counts = asking("k", lambda: sent.value[2][0], lambda texts: word_hashes(texts)[0]).join(seldom, "k")
    # one shuffle of what was asked: a log10 probability (0 at most) is a gram's, a count (1 at least) a word's
    asked = rare.select("block", F.col("g").alias("k"), F.log10(F.col("p").cast("double")).alias("v")).unionByName(
        counts.select("block", "k", F.col("c").cast("double").alias("v")))

    def run(block, asked):
        code, often_g, often_w = sent.value
        k, v = asked["k"].to_numpy(np.int64), asked["v"].to_numpy(np.float64)
        gram_p, word_c = (Known(often, k[own], v[own]) for often, own in ((often_g, v <= 0), (often_w, v > 0)))
        out = []
        for r in block.itertuples():
            doc_ids = pd.arrays.IntegerArray(np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.nulls, dtype=bool))
            for a, b, texts in _texts(r, SCORED):
                x, begin = _symbols(texts, code, depth)
                own, lp = _predicted(len(x), begin, depth), np.zeros(len(x))
                lp[own] = gram_p.of(_grams(x, depth)[own[depth:]].view(np.int64))
                h, first = word_hashes(texts)
                c, size = word_c.of(h.view(np.int64)), np.diff(first)
                # the tree's probability of each word and what follows it; of an empty text, of its end
                total = np.concatenate(([0.0], np.cumsum(lp)))
                stops = np.flatnonzero((x == SEP) | ((x == END) & own)) + 1
                word = np.diff(np.concatenate(([0.0], total[stops])))
                full = np.repeat(size > 0, np.maximum(size, 1))
                tree_p, empty = 10 ** word[full], np.zeros(b - a)
                empty[size == 0] = np.log10(share * end_p + (1 - share) * 10 ** word[~full])
                doc, last = np.repeat(np.arange(b - a), size), np.ones(len(h))
                last[first[1:][size > 0] - 1] = end_p
                p = (c + 1) / norm
                score = empty + np.bincount(doc, np.log10(share * p * last + (1 - share) * tree_p), minlength=b - a)
                out.append(pd.DataFrame({"doc_id": doc_ids[a:b], "n_tokens": size + 1, "n_known": np.bincount(doc[c > 0], minlength=b - a),
                                         "base": np.bincount(doc, np.log10(p), minlength=b - a), "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"doc_id": [], "n_tokens": [], "n_known": [], "base": [], "score": []})

    out = blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(run, "doc_id long, n_tokens long, n_known long, base double, score double")
    end = float(np.log10(end_p))
    return out.select("doc_id", (id_bucket("doc_id", folds) == held).alias("held_out"), "n_tokens",
                      (F.col("n_known") + int(ends > 0)).cast("long").alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
                      (F.col("base") + end).alias("base_score"), "score")

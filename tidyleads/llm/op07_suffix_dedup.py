"""Repeated strings of ``length`` bytes across documents, found by hashed contexts around
a sampled cover.  The dealt method's suffix sorting and cover ranks are not built: a difference
cover would take several times the samples (see the README).

Removes every byte covered by a ``length``-byte string that also starts in a document of
a smaller doc_id.  Documents are packed into blocks of about 2 MB.

1. Cover sample.  Positions are sampled so that equal strings are sampled at equal
   places: of each string's grams, the one with the least hash.  (A periodic
   difference cover has this property too, but samples 6 of 31 positions, this one of
   the dealt length about 1 of 20; see the README for what that costs.)
2. Sampled grams are dealt out by hash; those that occur in one document only,
   or with other bytes on both sides, are out.  What is left are the samples worth comparing.
3. Buckets: samples with their neighbourhood are dealt out by a hash of the gram, and
   each bucket is grouped on its own.  Samples of one gram are told apart by 64-bit hashes, without order,
   of what lies before and after it, one per reach, so each string around a sample becomes
   one key; its least document keeps it, the others lose it.  The number of buckets
   follows the input, but all samples of one gram meet in one task: a very common gram is not split.
4. Each block drops its covered bytes.

A text equal to one of a smaller doc_id is covered whole (from ``length`` bytes on) and takes no
part in the comparison.  Null text has no bytes; a null doc_id comes after all others;
repeated rows of one doc_id are not smaller than each other and stay; empty
tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, _BASE_INV, _BYTE, _power, byte_chunks, encoded, materialize, mix

GRAM = 12
#: Documents in a block at most: a document's number in its block has 16 bits.
BLOCK_DOCS = 60_000
#: Blocks per bucket, which bounds a bucket to about a million samples.
BLOCKS_PER_BUCKET = 8
LAST = (1 << 63) - 1


def pack(docs: DataFrame) -> DataFrame:
    """Blocks: block, ids, sizes (int64 arrays), digests (16 bytes a document), z."""
    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=10)
        for pdf in batches:
            texts, ids = encoded(pdf["text"]), pdf["doc_id"].to_numpy()
            for a, e in byte_chunks(texts):
                for lo in range(a, e, BLOCK_DOCS):
                    part = texts[lo:min(e, lo + BLOCK_DOCS)]
                    yield pd.DataFrame({
                        "ids": [ids[lo:lo + len(part)].tobytes()], "sizes": [np.array([len(t) for t in part], dtype=np.int64).tobytes()],
                        "digests": [b"".join(hashlib.md5(t).digest() for t in part)], "z": [zip_.compress(b"".join(part))]})
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text").mapInPandas(run, "ids binary, sizes binary, digests binary, z binary")
    return rows.select(F.monotonically_increasing_id().alias("block"), "*")


def _unpack(row):
    sizes = np.frombuffer(row.sizes, dtype=np.int64)
    buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.z, max_output_size=int(sizes.sum()) + 1), dtype=np.uint8)
    return np.frombuffer(row.ids, dtype=np.int64), np.concatenate(([0], np.cumsum(sizes))), buf


def copies(blocks: DataFrame, length: int) -> DataFrame:
    """(block, copy): numbers of the documents whose whole text a smaller doc_id has."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                n = len(r.ids) // 8
                sizes = np.frombuffer(r.sizes, dtype=np.int64)
                out = pd.DataFrame({"block": r.block, "i": np.arange(n), "doc": np.frombuffer(r.ids, dtype=np.int64),
                                    "digest": [r.digests[16 * i:16 * i + 16] for i in range(n)]})
                yield out[sizes >= length]
    rows = blocks.select("block", "ids", "sizes", "digests").mapInPandas(run, "block long, i long, doc long, digest binary")
    least = rows.groupBy("digest").agg(F.min("doc").alias("least"), F.count("*").alias("m")).where("m > 1")
    return rows.join(least, "digest").where("doc > least").groupBy("block").agg(F.collect_list("i").alias("copy"))


def _slide(h: np.ndarray, w: int, f) -> np.ndarray:
    """f (minimum or maximum) over every w neighbours, by doubling."""
    s = 1
    while 2 * s <= w:
        h = f(h[:-s], h[s:])
        s *= 2
    return f(h[:s - w], h[w - s:]) if w > s else h


def _sums(buf: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * _power(_BASE, len(buf)), dtype=np.uint64)))


def _grams(sums: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each position."""
    return mix((sums[at + n] - sums[at]) * _power(_BASE_INV, len(sums))[at])


def samples(buf: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Sampled positions with their gram's hash, and the document each lies in."""
    none = np.empty(0, np.int64)
    if len(buf) < length:
        return none, none.astype(np.uint64), none
    sums = _sums(buf)
    h = _grams(sums, np.arange(len(buf) - gram + 1), gram) | np.uint64(1)
    w = length - gram + 1
    least = _slide(h, w, np.minimum)
    own = np.ones(len(least), dtype=bool)  # strings that don't cross into the next document
    for e in ends[1:-1]:
        own[max(0, e - length + 1):e] = False
    least = np.where(own, least, np.uint64(0))
    pad = np.zeros(w - 1, dtype=np.uint64)
    at = np.flatnonzero(_slide(np.concatenate((pad, least, pad)), w, np.maximum) == h)
    return at, h[at], np.searchsorted(ends, at, side="right") - 1


class _Out:
    """Buffer that a task deals out to buckets by hash, one row of packed columns for
    each bucket and flush."""

    def __init__(self, buckets: int, limit: int, alike: bool = False):
        self.buckets, self.limit, self.alike, self.parts, self.size = buckets, limit, alike, [], 0

    def add(self, h, *columns):
        self.parts.append((h, *columns))
        self.size += len(h)

    def flush(self):
        h, *cols = [np.concatenate(x) for x in zip(*self.parts)]
        bucket = (mix(h) % np.uint64(self.buckets)).astype(np.int64)
        # within a bucket by hash if like entries are to lie together: they pack better
        order = np.lexsort((h, bucket)) if self.alike else np.argsort(bucket, kind="stable")
        bucket, cols = bucket[order], [c[order] for c in cols]
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else [0]
        self.parts, self.size = [], 0
        zip_ = zstandard.ZstdCompressor(level=9).compress
        return pd.DataFrame([(bucket[a], *[zip_(c[a:b].tobytes()) for c in cols]) for a, b in zip(cut[:-1], cut[1:])],
                            columns=["bucket", *[f"c{i}" for i in range(len(cols))]])


def _joined(pdf, *kinds):
    unzip = zstandard.ZstdDecompressor().decompress
    return [np.concatenate([np.frombuffer(unzip(x), dtype=k) for x in pdf[f"c{i}"]]) for i, k in enumerate(kinds)]


def _by_block(gid: np.ndarray, *columns):
    """Rows (block, array...) of entries by the block in their document's number."""
    block = gid >> 16
    order = np.argsort(block, kind="stable")
    block = block[order]
    cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True]))) if len(block) else [0]
    return pd.DataFrame([(block[a], *[c[order][a:b].tobytes() for c in columns]) for a, b in zip(cut[:-1], cut[1:])],
                        columns=["block", *[f"c{i}" for i in range(len(columns))]])


def suspects(blocks: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """(block, c0): positions of the samples whose gram another document has too, with
    the same bytes on one side at least for half of what a string reaches past the gram."""
    side = (length - gram) // 2

    def deal(batches):
        out = _Out(buckets, 1 << 20)
        for pdf in batches:
            for r in pdf.itertuples():
                _, ends, buf = _unpack(r)
                at, h, doc = samples(buf, ends, length, gram)
                if not len(at):
                    continue
                sums = _sums(buf)
                left = _grams(sums, np.maximum(at - side, 0), side)
                right = _grams(sums, np.minimum(at + gram, len(buf) - side), side)
                out.add(h, h.view(np.uint8).reshape(-1, 8)[:, :5], left.astype(np.uint16), right.astype(np.uint16), (np.int64(r.block) << 16) + doc, at.astype(np.uint32))
                if out.size > out.limit:
                    yield out.flush()
        if out.parts:
            yield out.flush()

    def meet(pdf):
        h5, left, right, gid, at = _joined(pdf, np.uint8, np.uint16, np.uint16, np.int64, np.uint32)
        h = np.zeros((len(gid), 8), dtype=np.uint8)
        h[:, :5] = h5.reshape(-1, 5)  # ties of five bytes of a hash by chance only let a sample through
        h = h.view(np.uint64).ravel()
        hit = np.zeros(len(h), dtype=bool)
        for half in (left, right):
            order = np.lexsort((half, h))
            x, y, g = h[order], half[order], gid[order]
            cut = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))
            many = np.minimum.reduceat(g, cut) != np.maximum.reduceat(g, cut)
            hit[order] |= np.repeat(many, np.diff(np.concatenate((cut, [len(g)]))))
        return _by_block(gid[hit], at[hit])

    rows = blocks.select("block", "ids", "sizes", "z").mapInPandas(deal, "bucket long, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary")
    return rows.groupBy("bucket").applyInPandas(meet, "block long, c0 binary")


def _ranks(ctx: np.ndarray, reach: int) -> np.ndarray:
    """Hashes of the first 0 .. reach bytes of each row."""
    out = np.zeros((reach + 1, len(ctx)), dtype=np.uint64)
    for j in range(reach):
        out[j + 1] = (out[j] ^ (out[j] >> np.uint64(32))) * np.uint64(_BASE) + _BYTE[ctx[:, j]]
    return out


def shared_strings(blocks: DataFrame, near: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """(block, c0, c1): sample positions, and the set (a bit for each) of the strings around
    them, by how far before the sample they start, that a smaller doc_id has."""
    reach = length - gram

    def deal(batches):
        out = _Out(buckets, 1 << 18, alike=True)
        for pdf in batches:
            for r in pdf.itertuples():
                ids, ends, buf = _unpack(r)
                at = np.sort(np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in r.c0]).astype(np.int64))
                doc = np.searchsorted(ends, at, side="right") - 1
                if r.copy is not None and len(r.copy):
                    own = ~np.isin(doc, np.asarray(r.copy))
                    at, doc = at[own], doc[own]
                if not len(at):
                    continue
                before, after = np.minimum(at - ends[doc], reach), np.minimum(ends[doc + 1] - at - gram, reach)
                left = buf[np.maximum(at[:, None] - 1 - np.arange(reach), 0)]
                right = buf[np.minimum(at[:, None] + gram + np.arange(reach), len(buf) - 1)]
                h = _grams(_sums(buf), at, gram)
                out.add(h, h, ids[doc], (np.int64(r.block) << 16) + doc, at.astype(np.uint32), before.astype(np.uint8), after.astype(np.uint8), left, right)
                if out.size > out.limit:
                    yield out.flush()
        if out.parts:
            yield out.flush()

    def meet(pdf):
        h, doc, gid, at, before, after, left, right = _joined(pdf, np.uint64, np.int64, np.int64, np.uint32, np.uint8, np.uint8, np.uint8, np.uint8)
        order = np.argsort(h, kind="stable")
        left, right = left.reshape(-1, reach), right.reshape(-1, reach)
        found = np.zeros(len(h), dtype=np.uint64)
        # one run of the sorted bucket at a time, cut between grams
        sorted_h, lo = h[order], 0
        while lo < len(order):
            hi = min(lo + (1 << 16), len(order))
            hi = int(np.searchsorted(sorted_h, sorted_h[hi - 1], side="right"))
            run = order[lo:hi]
            lo = hi
            x, y = _ranks(left[run], reach), _ranks(right[run], reach)
            for k in range(reach + 1):
                ok = run[(before[run] >= k) & (after[run] >= reach - k)]
                if len(ok) < 2:
                    continue
                keep = (before[run] >= k) & (after[run] >= reach - k)
                key = mix(h[ok] + x[k][keep] * np.uint64(0xD1342543DE82EF95) + mix(y[reach - k][keep] + np.uint64(k)))
                by = np.lexsort((doc[ok], key))
                s = key[by]
                cut = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
                first = np.repeat(doc[ok][by][cut], np.diff(np.concatenate((cut, [len(s)]))))
                found[ok[by]] |= np.where(doc[ok][by] > first, np.uint64(1) << np.uint64(k), np.uint64(0))
        hit = found > 0
        return _by_block(gid[hit], at[hit], found[hit])

    rows = blocks.select("block", "ids", "sizes", "z").join(near, "block").mapInPandas(
        deal, "bucket long, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary, c5 binary, c6 binary, c7 binary")
    return rows.groupBy("bucket").applyInPandas(meet, "block long, c0 binary, c1 binary")


def removed(blocks: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left)."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                ids, ends, buf = _unpack(r)
                step = np.zeros(len(buf) + 1, dtype=np.int32)
                if r.c0 is not None:
                    for p, m in zip(r.c0, r.c1):
                        p, m = np.frombuffer(p, dtype=np.uint32).astype(np.int64), np.frombuffer(m, dtype=np.uint64)
                        for k in range(64):
                            at = p[(m >> np.uint64(k)) & np.uint64(1) == 1] - k
                            np.add.at(step, at, 1)
                            np.add.at(step, at + length, -1)
                gone = np.cumsum(step[:-1]) > 0
                for i in r.copy if r.copy is not None else ():
                    gone[ends[i]:ends[i + 1]] = True
                total = np.concatenate(([0], np.cumsum(gone)))
                rise = gone & ~np.concatenate(([False], gone[:-1]))
                rise[ends[:-1][ends[:-1] < len(buf)]] |= gone[ends[:-1][ends[:-1] < len(buf)]]
                spans = np.concatenate(([0], np.cumsum(rise)))
                kept = [buf[a:b][~gone[a:b]].tobytes() if total[b] > total[a] else buf[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                yield pd.DataFrame({"doc_id": pd.array([None if d == LAST else d for d in ids.tolist()], dtype="Int64"), "n_bytes": np.diff(ends),
                                    "n_removed": np.diff(total[ends]), "n_spans": np.diff(spans[ends]),
                                    "kept_sha256": [hashlib.sha256(t).hexdigest() for t in kept], "kept": kept})
    return blocks.select("block", "ids", "sizes", "z").join(hits, "block", "left").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def dedup_strings(docs: DataFrame, length: int = 50, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left)."""
    blocks = materialize(pack(docs))
    buckets = 256
    while buckets * BLOCKS_PER_BUCKET < blocks.count():
        buckets *= 2
    same = materialize(copies(blocks, length))
    near = suspects(blocks, length, gram, buckets).groupBy("block").agg(F.collect_list("c0").alias("c0"))
    hits = shared_strings(blocks, near.join(same, "block", "left"), length, gram, buckets)
    hits = hits.groupBy("block").agg(F.collect_list("c0").alias("c0"), F.collect_list("c1").alias("c1"))
    return removed(blocks, hits.join(same, "block", "full"), length)

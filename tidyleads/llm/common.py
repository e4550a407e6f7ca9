"""Shared helpers: table access, ASCII word rule, lineage cuts in the shared
folder, and vectorised word hashing for Arrow batches.

Words are runs of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only; on UTF-8
bytes both rules are byte-wise, so tasks work on encoded text directly.
"""

from __future__ import annotations

import string
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task hashes at once; bounds the temporary arrays.
CHUNK_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text) -> Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_bucket(doc_id, mod: int) -> Column:
    """crc32 of the doc_id as text, modulo ``mod`` (null id: the text 'null')."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")), F.lit(mod))


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder of ``spark.checkpoint.dir`` and read back: a
    lineage cut that any executor can read again after a loss."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """A written table; what the job that made it leaves, which nothing reads any more, is given back:
    Spark's cleaner removes its shuffle files once the driver's heap has been collected, and that heap,
    of a driver that plans many jobs, shrinks again."""
    out = materialize(df)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


# ---------------------------------------------------------------------------
# Word hashing on byte buffers
# ---------------------------------------------------------------------------
_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 65536)
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        have = _powers[base] = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def spans(texts: list[bytes]):
    """Words of a list of texts.  Returns (lower-cased byte buffer, word starts,
    word ends, first word index of every text plus the total)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return _LOWER[buf], starts, ends, np.searchsorted(starts, first)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the first word index of every text plus
    the total (``h[first[i]:first[i + 1]]`` are the words of text i)."""
    buf, starts, ends, first = spans(texts)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), first
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[buf] * _power(_BASE, len(buf)), dtype=np.uint64)))
    h = (total[ends] - total[starts]) * _power(_BASE_INV, len(buf))[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93)), first


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles of one text; shorter texts count as one
    shingle of all their words, no word gives none."""
    if not len(words):
        return words
    n = min(n, len(words))
    m = len(words) - n + 1
    h = words[:m].copy()
    for i in range(1, n):
        h = (h ^ (h >> _U(29))) * _U(_BASE) + words[i:i + m]
    return mix(h + _U(n))


def encoded(column) -> list[bytes]:
    """UTF-8 bytes of a pandas string column (null: empty)."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in column]


def byte_chunks(texts: list[bytes], limit: int = CHUNK_BYTES):
    """(start, end) index ranges of about ``limit`` bytes, at least one text each."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def split(batches, rows: int = 2000):
    """Arrow batches in slices of some rows, so that a task encodes few texts at a time."""
    for pdf in batches:
        for lo in range(0, len(pdf), rows):
            yield pdf.iloc[lo:lo + rows]


class Counts:
    """Bounded map-side combine of (64-bit key, count): call `add`, and emit what `full` or `rest` give."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.size = limit, [], 0

    def add(self, keys: np.ndarray, weights: np.ndarray | None = None) -> None:
        if len(keys):
            self.parts.append(_summed(keys, weights))
            self.size += len(self.parts[-1][0])

    def full(self):
        """(keys, counts) to emit now, or None while they still fit."""
        if self.size <= self.limit:
            return None
        merged = _summed(*(np.concatenate(x) for x in zip(*self.parts)))
        if len(merged[0]) > self.limit // 2:
            self.parts, self.size = [], 0
            return merged
        self.parts, self.size = [merged], len(merged[0])
        return None

    def rest(self):
        if not self.parts:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        return _summed(*(np.concatenate(x) for x in zip(*self.parts)))


def _summed(keys, weights=None):
    if weights is None:
        u, c = np.unique(keys, return_counts=True)
        return u, c.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(weights, at)

"""Partial similarity of many text pairs at once: matching blocks over code-point arrays.

A pair's matching blocks are its longest common run (the first of equal ones, by the shorter
text, then by the longer), and likewise left and right of it.  Here a whole batch of pairs is aligned
together: every open stretch of every pair is one row of a dynamic program over the
diagonals, stepped one character of the shorter texts at a time, and rows whose run is found
give up to two new stretches.  Work is the sum of stretch areas, in array operations, with no
loop over pairs.

The partial ratio (0 to 100) aligns the shorter text with the longer one, lays a window of the
shorter text's length on the longer one along each block's diagonal, and takes the best
2 x matched / (characters of both) of any window.
"""

from __future__ import annotations

import numpy as np

#: Cells of one dynamic program row over all stretches; bounds the temporary arrays.
CELLS = 1 << 20


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(padded matrix of code points, -1 beyond the end; lengths)."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    out = np.full((len(texts), max(int(lengths.max(initial=0)), 1)), -1, dtype=np.int32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out, lengths


def _longest_runs(a, b, alo, ahi, blo, bhi):
    """(i, j, size) of the first longest common run of a[alo:ahi] and b[blo:bhi], per row."""
    k = len(a)
    best, bi, bj = np.zeros(k, dtype=np.int64), alo.copy(), blo.copy()
    column = np.arange(b.shape[1])
    inside = (column >= blo[:, None]) & (column < bhi[:, None])
    run = np.zeros((k, b.shape[1] + 1), dtype=np.int32)
    rows = np.arange(k)
    for i in range(int(alo.min()), int(ahi.max())):
        hit = inside & (b == a[:, i, None]) & ((i >= alo) & (i < ahi))[:, None]
        nxt = np.zeros_like(run)
        nxt[:, 1:] = np.where(hit, run[:, :-1] + 1, 0)
        run = nxt
        at = run.argmax(axis=1)
        size = run[rows, at].astype(np.int64)
        more = size > best
        best = np.where(more, size, best)
        bi = np.where(more, i - size + 1, bi)
        bj = np.where(more, at - size, bj)
    return bi, bj, best


def matching_blocks(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray):
    """(row, i, j, size) of all matching blocks of each row's pair, in no order."""
    rows = np.arange(len(a))
    stretch = np.stack([rows, np.zeros_like(n), n, np.zeros_like(m), m], axis=1)
    found = []
    while len(stretch := stretch[(stretch[:, 1] < stretch[:, 2]) & (stretch[:, 3] < stretch[:, 4])]):
        r, alo, ahi, blo, bhi = stretch.T
        bi, bj, size = _longest_runs(a[r], b[r], alo, ahi, blo, bhi)
        hit = size > 0
        r, alo, ahi, blo, bhi, bi, bj, size = (x[hit] for x in (r, alo, ahi, blo, bhi, bi, bj, size))
        found.append(np.stack([r, bi, bj, size], axis=1))
        stretch = np.concatenate([np.stack([r, alo, bi, blo, bj], axis=1), np.stack([r, bi + size, ahi, bj + size, bhi], axis=1)])
    return np.concatenate(found) if found else np.empty((0, 4), dtype=np.int64)


def _chunk(short: list[str], long_: list[str]) -> np.ndarray:
    a, n = code_points(short)
    b, m = code_points(long_)
    blocks = matching_blocks(a, n, b, m)
    # a window per block's diagonal, and one at the end of the longer text
    row = np.concatenate([blocks[:, 0], np.arange(len(short))])
    start = np.concatenate([np.maximum(blocks[:, 2] - blocks[:, 1], 0), np.maximum(m - n, 0)])
    row, start = np.unique(np.stack([row, start], axis=1), axis=0).T
    width = np.minimum(n[row], m[row] - start)
    at = start[:, None] + np.arange(max(int(width.max(initial=0)), 1))
    window = np.where(np.arange(at.shape[1]) < width[:, None], b[row[:, None], np.minimum(at, b.shape[1] - 1)], -1)
    inner = matching_blocks(a[row], n[row], window, width)
    matched = np.bincount(inner[:, 0].astype(np.int64), weights=inner[:, 3], minlength=len(row))
    ratio = 2.0 * matched / (n[row] + width)
    best = np.zeros(len(short))
    np.maximum.at(best, row, np.where(ratio > 0.995, 1.0, ratio))
    return np.rint(100 * best).astype(np.int32)


def partial_ratios(a: list[str | None], b: list[str | None]) -> np.ndarray:
    """Partial ratio of each pair; a missing text gives 0, equal texts 100, else an empty one 0."""
    out = np.zeros(len(a), dtype=np.int32)
    todo, same = [], []
    for i, (x, y) in enumerate(zip(a, b)):
        if x is None or y is None:
            continue
        if x == y:
            same.append(i)
        elif x and y:
            todo.append((max(len(x), len(y)), i))
    out[same] = 100
    todo.sort()  # pairs of like length share a matrix
    lo = 0
    while lo < len(todo):
        hi = lo + 1
        while hi < len(todo) and (hi - lo) * todo[hi][0] < CELLS:
            hi += 1
        ids = [i for _, i in todo[lo:hi]]
        pairs = [(a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i]) for i in ids]
        out[ids] = _chunk([p[0] for p in pairs], [p[1] for p in pairs])
        lo = hi
    return out

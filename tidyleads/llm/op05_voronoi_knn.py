"""Exact top-k search by a Voronoi kNN join on integer inner products.

Vectors become integers floor(scale * x).  The largest inner product is a
nearest neighbour: give every vector x the extra coordinate sqrt(M^2 - |x|^2),
M the longest, and every query 0; then |q - x|^2 = |q|^2 + M^2 - 2 q.x.

1. Pivots: at most `PIVOTS` vectors (least hashed vec_id).  Every vector knows its
   distance to each pivot and its nearest pivot's cell.
2. Summaries: of each cell, its queries' radius and the k + 1 least distances of distinct vec_ids
   (of a repeated vec_id its nearest row counts).
3. Bounds: the k-th neighbour of any query of cell r is no farther than
   theta_r, the (k + 1)-th least of d(x, p_x) + d(p_x, p_r) + radius_r over the summaries' distinct
   vec_ids: without the query's own, k are left, however many rows it has.
4. A vector goes to the queries of cell r only if d(x, p_r) - radius_r <= theta_r.
5. Each (cell, block of queries, block of vectors) is solved on its own, exactly in integers;
   blocks are cut by rows, so a vec_id on many rows is spread and memory is bounded; a query's best of
   all its rows and blocks are merged.

Vectors that are null, or hold a null or a non-finite component, take no part;
shorter vectors count as zero-padded; of repeated vec_ids each row is a candidate, but no
row of the query's own vec_id; ties go to the smaller vec_id; fewer than k candidates give
all; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, mix

PIVOTS = 32
#: Vectors and queries that one task holds.
BLOCK, QUERIES = 32_768, 4_096


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v, norm2): integer vectors, without null and non-finite ones."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long"), F.transform(x, lambda e: F.floor(scale * e)).alias("v"))
    return rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e))


def _matrix(column, width: int) -> np.ndarray:
    if len(column) and all(len(v) == width for v in column):
        return np.stack(list(column)).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T: in doubles where every partial sum fits them."""
    most = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if most < 2 ** 53 else a @ b.T


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each row whose vec_id
    ``every`` divides with all rows of other vec_ids."""
    spark = vectors.sparkSession
    rows = materialize(integers(vectors, scale).withColumn("rid", F.monotonically_increasing_id()))
    width, longest, n = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max("norm2"), F.lit(0.0)), F.count("*")).first()
    near = rows.orderBy(F.md5(F.col("vec_id").cast("string").cast("binary")), "vec_id", "v").limit(pivots).toPandas()
    centre = _matrix(near["v"], width).astype(np.float64)
    centre = np.hstack((centre, np.sqrt(np.maximum(longest - (centre ** 2).sum(1, keepdims=True), 0))))
    sent = spark.sparkContext.broadcast(centre)
    between = np.sqrt(np.maximum(((centre[:, None] - centre[None]) ** 2).sum(2), 0)) if len(centre) < 257 else None

    def far(v: np.ndarray, query: bool) -> np.ndarray:
        """Distances to all pivots."""
        c = sent.value
        x = v.astype(np.float64)
        extra = np.zeros((len(x), 1)) if query else np.sqrt(np.maximum(longest - (x ** 2).sum(1, keepdims=True), 0))
        x = np.hstack((x, extra))
        return np.sqrt(np.maximum((x ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None] - 2 * x @ c.T, 0))

    def summarise(batches):
        for pdf in batches:
            v, ids = _matrix(pdf["v"], width), pdf["vec_id"].to_numpy()
            d = far(v, False)
            cell = d.argmin(1)
            out = []
            for c in np.unique(cell):
                own, far_ = ids[cell == c], d[cell == c, c]
                order = np.argsort(far_, kind="stable")
                first = np.sort(np.unique(own[order], return_index=True)[1])[:k + 1]  # of each vec_id its nearest row
                out += [(int(c), False, i, x) for i, x in zip(own[order][first].tolist(), far_[order][first])]
            asked = ids % every == 0
            if asked.any():
                d = far(v[asked], True)
                cell = d.argmin(1)
                out += [(int(c), True, 0, -d[cell == c, c].max()) for c in np.unique(cell)]
            yield pd.DataFrame(out, columns=["cell", "asked", "vec_id", "d"])
    least = rows.select("vec_id", "v").mapInPandas(summarise, "cell int, asked boolean, vec_id long, d double").groupBy("cell", "asked", "vec_id").agg(F.min("d").alias("d"))
    rank = F.row_number().over(W.partitionBy("cell", "asked").orderBy("d", "vec_id"))
    summary = least.withColumn("r", rank).where(F.col("r") <= k + 1).toPandas()
    radius = {int(c): -d for c, d in summary[summary["asked"]][["cell", "d"]].itertuples(index=False)}
    known = summary[~summary["asked"]]
    theta = {}
    for r, u in radius.items():
        bound = pd.Series(known["d"].to_numpy() + between[known["cell"].to_numpy(dtype=int), r] + u)
        bound = np.sort(bound.groupby(known["vec_id"].to_numpy()).min().to_numpy())
        theta[r] = float(bound[k]) if len(bound) > k else float("inf")
    cells = sorted(radius)
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    q_blocks, d_blocks = max(1, -(-asked.count() // QUERIES)), max(1, -(-n // BLOCK))
    d_blocks = max(d_blocks, 12)

    def deal_queries(batches):
        for pdf in batches:
            v = _matrix(pdf["v"], width)
            cell = far(v, True).argmin(1)
            qb = (mix(pdf["rid"].to_numpy().view(np.uint64)) % np.uint64(q_blocks)).astype(np.int64)
            out = [(int(c), int(q), b, pdf["vec_id"].to_numpy()[m].tobytes(), v[m].tobytes())
                   for c in np.unique(cell) for q in np.unique(qb) if (m := (cell == c) & (qb == q)).any() for b in range(d_blocks)]
            yield pd.DataFrame(out, columns=["cell", "qb", "db", "ids", "v"])

    def deal_vectors(batches):
        for pdf in batches:
            v, ids = _matrix(pdf["v"], width), pdf["vec_id"].to_numpy()
            d = far(v, False)
            db = np.arange(len(ids)) % d_blocks
            small = v.astype(np.int32) if np.abs(v).max(initial=0) < 2 ** 31 else v
            out = []
            for r in cells:
                go = d[:, r] - radius[r] <= theta[r] * (1 + 1e-9) + 1e-6
                for b in range(d_blocks):
                    m = go & (db == b)
                    if m.any():
                        out += [(r, q, b, ids[m].tobytes(), small[m].tobytes()) for q in range(q_blocks)]
            yield pd.DataFrame(out, columns=["cell", "qb", "db", "ids", "v"])

    def unpack(pdf):
        if not len(pdf):
            return np.empty(0, np.int64), np.empty((0, width), np.int64)
        ids = [np.frombuffer(x, dtype=np.int64) for x in pdf["ids"]]
        v = [np.frombuffer(x, dtype=np.int64 if len(x) == 8 * len(i) * width else np.int32).reshape(len(i), width).astype(np.int64)
             for x, i in zip(pdf["v"], ids)]
        return np.concatenate(ids), np.concatenate(v)

    def solve(left, right):
        (qi, qv), (xi, xv) = unpack(left), unpack(right)
        out = []
        order = np.argsort(xi, kind="stable")  # ties: the stable sorts below keep smaller ids first
        xi, xv = xi[order], xv[order]
        for lo in range(0, len(qi) if len(xi) else 0, 256):
            s = _products(qv[lo:lo + 256], xv)
            for q, row in zip(qi[lo:lo + 256], s):
                own = np.flatnonzero(xi != q)
                row = row[own]
                if len(row) > k:
                    edge = np.partition(row, len(row) - k)[len(row) - k]
                    pick = np.flatnonzero(row >= edge)
                else:
                    pick = np.arange(len(row))
                pick = pick[np.argsort(-row[pick], kind="stable")][:k]
                out += zip([q] * len(pick), xi[own[pick]], row[pick])
        best = pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")
        if len(np.unique(qi)) < len(qi):  # a vec_id's rows share its k places
            best = best.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k)
        return best

    deal = "cell int, qb int, db int, ids binary, v binary"
    left = asked.select("vec_id", "v", "rid").mapInPandas(deal_queries, deal).groupBy("cell", "qb", "db")
    right = rows.select("vec_id", "v").mapInPandas(deal_vectors, deal).groupBy("cell", "qb", "db")
    found = left.cogroup(right).applyInPandas(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)

"""Benchmark decontamination and top-k search."""
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidyleads.llm import op05_voronoi_knn, op08_decontaminate


# ---- decontamination -------------------------------------------------------
def _nearest(pattern, text):
    row, best = list(range(len(pattern) + 1)), len(pattern)
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
def test_myers_is_edit_distance(pattern, text):
    assert op08_decontaminate.myers(pattern, text)[0] == _nearest(pattern, text)


def test_planted_passages(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(40)] + [(100, "short one"), (101, None), (102, "!!"), (0, "again " + " ".join(word() for _ in range(20)))]
    docs, want = [], set()
    for d in range(300):
        t = [word() for _ in range(60)]
        i, item = items[d % 40]
        if d % 3 == 0:
            text = list(item)
            budget = len(op08_decontaminate.normalise(item)) // 20
            for _ in range(rng.randrange(budget + 1) if d % 2 else budget + 14):
                p = rng.randrange(len(text))
                text[p:p + 1] = rng.choice([[], ["z"], [text[p], "z"]])
            t[20:20] = ["".join(text).upper() if d % 5 == 0 else "".join(text)]
        docs.append((d, " ".join(t)))
    docs += [(900, "Short, ONE!"), (901, "a short one here"), (902, None), (902, ""), (None, items[3][1]), (903, items[5][1] * 40)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for d, t in docs:
        for i, item in items:
            a, b = op08_decontaminate.normalise(item), op08_decontaminate.normalise(t)
            if a and (_nearest(a, b) <= len(a) // 20 if len(a) >= 20 else a == b):
                want.add((d, i, _nearest(a, b) if len(a) >= 20 else 0))
    for chars in (op08_decontaminate.BLOCK_CHARS, 1000):
        got = op08_decontaminate.leaks(df, bench, block_chars=chars).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in got} == want
    out = op08_decontaminate.decontaminated(df.withColumn("item_id", F.lit("x")), bench, block_chars=1000)
    bad = {d for d, *_ in want}
    assert out.columns == ["doc_id", "text", "item_id"] and sorted(str(r.doc_id) for r in out.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_no_items_and_no_documents(spark, clashing, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "Plain words of a first document that says nothing")], "item_id long, text string")
    assert op08_decontaminate.leaks(clashing, none).count() == 0 and op08_decontaminate.leaks(empty, some).count() == 0
    assert op08_decontaminate.decontaminated(clashing, none).count() == clashing.count()
    assert sorted(r.doc_id for r in op08_decontaminate.leaks(clashing, some).collect()) == [1, 2, 2]


# ---- top-k -----------------------------------------------------------------
def brute(rows, k, every):
    fine = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in fine:
        if q % every == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_like_brute_force_with_ties_and_nulls(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, [0.5, 0.25, 0.0, 0.0, -0.5, 1.0]) for i in range(150)]
    rows += [(600, None), (650, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (700, [float("nan")] * 6), (750, [float("inf")] + [0.0] * 5), (None, [1.0] * 6),
             (800, [1.0, 2.0]), (850, []), (900, [1e5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit("x"))
    for pivots in (1, 16):
        got = op05_voronoi_knn.top_k(df, pivots=pivots).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 5, 50)


def test_cells_prune_and_stay_exact(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 12)) * 4
    rows = [(i, (centres[i % 8] + 0.05 * rng.normal(size=12)).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = op05_voronoi_knn.top_k(df, k=3, every=40).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 3, 40)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert op05_voronoi_knn.top_k(spark.createDataFrame([], schema)).count() == 0
    got = op05_voronoi_knn.top_k(spark.createDataFrame([(0, [1.0]), (3, [0.5]), (50, [2.0])], schema)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 50, 131072), (0, 2, 3, 32768), (50, 1, 0, 131072), (50, 2, 3, 65536)]


def test_query_id_on_many_rows(spark, monkeypatch):
    """Copies of the query's own vec_id must not fill the bound, nor one query block."""
    schema = "vec_id long, embedding array<float>"

    def pooled(rows, k, every):  # the k best of all rows of a query's vec_id, as the SQL has it
        rows = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
        out = []
        for q in sorted({i for i, _ in rows if i % every == 0}):
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for j, v in rows if j == q for i, w in rows if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
        return out
    rng = np.random.default_rng(9)
    far = [(0, [2.0])] * 6 + [(i, [1.0]) for i in range(1, 6)]
    hot = [(100, [4.0, 0.0, 0.0])] * 40 + [(100, rng.normal(size=3).astype(np.float32).tolist()) for _ in range(40)]
    hot += [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(1, 90)] + [(7, [1.0, 1.0, 1.0])] * 30
    monkeypatch.setattr(op05_voronoi_knn, "QUERIES", 16)
    for rows in (far, hot):
        for pivots in (2, 32):
            got = op05_voronoi_knn.top_k(spark.createDataFrame(rows, schema), pivots=pivots).collect()
            assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == pooled(rows, 5, 50)

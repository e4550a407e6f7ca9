import random
from collections import Counter

from pyspark.sql import functions as F

from tidyleads.llm import op10_near_dedup as op


def _sets(rows, n):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        m = min(n, len(w))
        out.append({tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if w else set())
    return out


def brute(rows, n, percent):
    """Component (least non-null id) and shingle count of every row."""
    sets, parent = _sets(rows, n), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (d, least.get(r)) if x is not None), default=None)
    return [(d, len(s), d if not s else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))], [find(i) for i in range(len(rows))]


def family(seed=5):
    """Near copies, a passage that unlike documents share, and a chain."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    core, rows = [word() for _ in range(120)], []
    for i in range(60):
        w = list(core)
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = word()
        rows.append((i * 3 + 7, " ".join(w)))
    passage = [word() for _ in range(60)]
    rows += [(1000 + i, " ".join(passage + [word() for _ in range(rng.choice((20, 60)))])) for i in range(60)]
    w = [word() for _ in range(100)]
    for i in range(12):
        rows.append((500 - i, " ".join(w)))
        w = list(w)
        w[(i * 17) % 100] = word()
    return rows


def check(spark, rows, n, percent, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = op.near_duplicates(df, n, percent, **more).collect()
    want, _ = brute(rows, n, percent)
    assert Counter((r.doc_id, r.n_shingles, r.component) for r in got) == Counter(want)
    assert all(r.kept == (r.doc_id == r.component) for r in got)


def test_like_brute_force(spark, docs):
    check(spark, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 3, 85)


def test_long_lists_lose_no_link(spark):
    check(spark, family(), 3, 85, light=3, block=7)


def test_five_words_and_lists_in_one_go(spark):
    check(spark, family(9), 5, 80)


def test_edge_rows(spark, clashing):
    rows = [(r.doc_id, r.text) for r in clashing.collect()]
    got = op.near_duplicates(clashing, 3, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component) for r in got) == Counter(brute(rows, 3, 85)[0])


def test_one_row_of_each_group_stays(spark, clashing):
    out = op.deduplicated(clashing, 3, 85)
    assert out.columns == clashing.columns
    rows = [(r.doc_id, r.text) for r in clashing.collect()]
    _, groups = brute(rows, 3, 85)
    sets = _sets(rows, 3)
    kept = Counter((r.doc_id, r.text) for r in out.collect())
    want = Counter(rows[i] for i in range(len(rows)) if not sets[i])
    for g in {g for g, s in zip(groups, sets) if s}:
        members = [rows[i] for i in range(len(rows)) if groups[i] == g and sets[i]]
        want[min(members, key=lambda r: (r[0] is not None, r[0] or 0))] += 1
    assert kept == want


def test_empty(empty):
    assert op.near_duplicates(empty).count() == 0 and op.deduplicated(empty).count() == 0


def test_sketch_is_the_k_least_hashes(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(500)))), (2, "a b c")], "doc_id long, text string")
    rows = {r.doc_id: r for r in op.sketches(df, 3, 16).collect()}
    assert len(rows[1].sketch) == 16 and rows[1].sketch == sorted(rows[1].sketch) and rows[2].n == 1
    assert op.sketches(df, 3, 64).where(F.col("doc_id") == 1).first().sketch[:16] == rows[1].sketch

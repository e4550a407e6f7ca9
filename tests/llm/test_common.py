import random

import numpy as np

from tidyleads.llm import common
from tidyleads.llm.components import components


def test_word_hashes_follow_the_ascii_word_rule():
    texts = ["A b  a\tB\x0bc", "", "ÄÖ ÄÖ x", "\n", "last"]
    h, first = common.word_hashes([t.encode() for t in texts])
    words = [t.encode().lower().split() for t in texts]
    assert [b - a for a, b in zip(first, first[1:])] == [len(w) for w in words]
    seen = {}
    for w, x in zip([w for ws in words for w in ws], h):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_do_not_depend_on_neighbours():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "ba", "aab", "é"]) for _ in range(rng.randrange(40))).encode() for _ in range(50)]
    h, first = common.word_hashes(texts)
    for i, t in enumerate(texts):
        assert (common.word_hashes([t])[0] == h[first[i]:first[i + 1]]).all()


def test_counts_combine_within_bounds():
    c, out = common.Counts(limit=100), {}
    rng = np.random.default_rng(0)
    all_keys = rng.integers(0, 500, 5000).astype(np.uint64)
    for part in np.array_split(all_keys, 40):
        c.add(part)
        if (got := c.full()) is not None:
            for k, n in zip(*got):
                out[int(k)] = out.get(int(k), 0) + int(n)
    for k, n in zip(*c.rest()):
        out[int(k)] = out.get(int(k), 0) + int(n)
    assert out == {int(k): int(n) for k, n in zip(*np.unique(all_keys, return_counts=True))}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(60)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0

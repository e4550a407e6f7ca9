"""Perspective rotation, curriculum mixing and hash-tree sharding."""
import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oracle import compare, duck
from tidyleads.llm import op02_perspectives, op03_mixing, op09_sharding, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf_small, name):
    ok, said = compare(queries.QUERIES[name](spark, sf_small), duck(sf_small), queries.ORACLE[name])
    assert ok, said


# ---- perspectives ----------------------------------------------------------
def test_perspectives_render_every_participant(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Yo"), (1, 2, "bob", "Yo"), (1, None, None, None),
             (None, 0, "ann", "alone"), (2, 0, "system", "nobody")] + [(3, i, "ab"[i % 2], f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("x"))
    got = {}
    for r in op02_perspectives.perspectives(df).collect():
        got.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (3, "a"), (3, "b")}
    for (conv, who), rows in got.items():
        rows.sort(key=lambda r: r.seq)
        assert [r.seq for r in rows] == list(range(len(rows)))
        text = "".join(r.segment for r in rows)
        mine = sorted([t for t in turns if t[0] == conv], key=lambda t: (t[1] is None, t[1] or 0, t[2] or "unknown", t[3] or ""))
        want = "".join(f"<|{'system' if (s := t[2] or 'unknown') == 'system' else 'assistant' if s == who else 'user name=' + s}|>\n{t[3] or ''}<|end|>\n"
                       for t in mine)
        assert text == want
        for r, t in zip(rows, mine):
            assert text[r.start:r.end] == (t[3] or "") + "<|end|>" and r.in_loss == ((t[2] or "unknown") == who)


def test_perspectives_of_no_turns(spark):
    assert op02_perspectives.perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# ---- mixing ----------------------------------------------------------------
def _targets(sizes, weights):
    """Resharing, literally: cap, share the excess by weight, until none is above."""
    total, target, open_ = 1.5 * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / w > 2 * sizes[i]}
        for i in (over or open_):
            target[i] = 2.0 * sizes[i] if over else left * weights[i] / w
        left -= sum(target[i] for i in over)
        open_ = open_ - over if over else set()
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1000, 10, 0, 300], [1], [0, 0], [7, 7, 7, 7, 7, 7, 1]])
def test_targets_are_what_resharing_arrives_at(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    got = {r.src: r.target for r in op03_mixing.source_targets(spark.createDataFrame(rows, "src string, size long")).collect()}
    want = _targets(sizes, [[3, 1, 2][i % 3] for i in range(len(sizes))])
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(want)


def test_mix_takes_its_targets_and_repeats_itself(spark, clashing):
    rows = op03_mixing.mix_documents(clashing).collect()
    again = op03_mixing.mix_documents(clashing.repartition(7)).collect()
    assert Counter(rows) == Counter(again) and len(rows) == clashing.count()
    for s in {r.source for r in rows}:
        mine = [r for r in rows if r.source == s]
        assert sum(r.taken for r in mine) == math.floor(mine[0].target) and mine[0].source_size == sum(r.size for r in mine)
    assert all(0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0) for r in rows)
    assert all(0 <= r.position <= 1 for r in rows if r.taken)


def test_positions_invert_the_integrated_schedule(spark):
    for shape in op03_mixing.SHAPES + (((0.0, 0.0), (0.3, 2.0), (1.0, 0.0)),):
        segs = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("t0", "len", "w", "m", "y0"), s)]) for s in op03_mixing.segments(shape)])
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(shape, shape[1:]))
        for r in spark.range(1, 20).select((F.col("id") / 20).alias("y"), op03_mixing.position(F.col("id") / 20, segs).alias("t")).collect():
            done = 0.0
            for (t0, a), (t1, b) in zip(shape, shape[1:]):
                x = min(max(r.t - t0, 0), t1 - t0)
                done += a * x + (b - a) / (t1 - t0) * x * x / 2
            assert done / area == pytest.approx(r.y, abs=1e-9)


def test_mixed_rows_keep_columns_and_repeat_documents(spark, clashing):
    out = op03_mixing.mixed_rows(clashing)
    assert out.columns == clashing.columns
    want = Counter()
    for r in op03_mixing.mix_documents(clashing).collect():
        if r.size:
            want[r.source] += r.taken
    got = Counter()
    for r in out.collect():
        got[r.source] += len((r.text or "").encode().split())
    for s in want:  # a document that the target cuts comes whole
        assert got[s] >= want[s]


def test_empty_mix(empty):
    assert op03_mixing.mix_documents(empty).count() == 0 and op03_mixing.mixed_rows(empty).count() == 0


# ---- sharding --------------------------------------------------------------
def _descend(key, tree):
    def draw(nodes):
        def score(x):
            u = (int(hashlib.md5(f"{key}|{x[0]}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            return -math.log(u) / x[1]
        return min(((score(x), x[0]) for x in nodes if x[1] > 0))[1]
    region = draw([(r, sum(sum(s.values()) for s in k.values())) for r, k in tree.items()])
    rack = draw([(k, sum(s.values())) for k, s in tree[region].items()])
    return int(draw([(f"{rack}/{n}", w) for n, w in tree[region][rack].items()]).rsplit("/", 1)[1])


def test_shards_follow_the_tree(clashing):
    rows = op09_sharding.shard_documents(clashing).collect()
    assert len(rows) == clashing.count()
    texts = {(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in clashing.collect()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == texts
    for r in rows:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert r.shard == _descend(key, op09_sharding.default_tree(16)) and r.grown_shard == _descend(key, op09_sharding.default_tree(17))
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_weight_changes_move_rows_of_the_changed_subtree_only(spark):
    tree = {"x": {"x/0": {0: 1.0, 1: 2.0}, "x/1": {2: 1.0}}, "y": {"y/0": {3: 1.0, 4: 1.0}}}
    more = {"x": {"x/0": {0: 1.0, 1: 2.0}, "x/1": {2: 1.0}}, "y": {"y/0": {3: 1.0, 4: 3.0}}}
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    df = op09_sharding.place(op09_sharding.place(df, F.col("k"), tree, "a_"), F.col("k"), more, "b_")
    moved = {(r.a_shard, r.b_shard): r["count"] for r in df.groupBy("a_shard", "b_shard").count().collect()}
    assert all(a == b or b in (3, 4) for a, b in moved)
    assert all(b == 4 for a, b in moved if a in (3, 4) and a != b)
    share = Counter()
    for (_, b), n in moved.items():
        share[b] += n / 20000
    for s, want in {0: 1 / 8, 1: 2 / 8, 2: 1 / 8, 3: 1 / 8, 4: 3 / 8}.items():
        assert share[s] == pytest.approx(want, abs=0.02)


def test_empty_shards(empty):
    assert op09_sharding.shard_documents(empty).count() == 0



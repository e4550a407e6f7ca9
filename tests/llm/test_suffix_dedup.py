import hashlib
import random

import pytest

from tidyleads.llm import op07_suffix_dedup as op


def brute(rows, length):
    big = 1 << 62
    order = sorted(rows, key=lambda r: big if r[0] is None else r[0])
    first, out = {}, []
    for d, t in order:
        b, key = (t or "").encode(), big if d is None else d
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first.setdefault(b[p:p + length], key) < key:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(df, length=50, **more):
    got = op.dedup_strings(df, length, **more).collect()
    want = brute([(r.doc_id, r.text) for r in df.collect()], length)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_like_brute_force(docs):
    check(docs)


def test_edge_rows(clashing):
    check(clashing)


@pytest.mark.parametrize("seed", range(3))
def test_short_strings_of_few_letters(spark, seed):
    """Small alphabets make ties everywhere, inside and across documents."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé"[:2 + seed % 2]) for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    rows = [(rng.randrange(40), "".join(rng.choice(pool) for _ in range(rng.randrange(5)))) for _ in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 20, gram=6)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_DOCS", 3)
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(80))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(200))) + shared[rng.randrange(30):] + str(i) * 9) for i in range(70)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_empty(empty):
    assert op.dedup_strings(empty).count() == 0

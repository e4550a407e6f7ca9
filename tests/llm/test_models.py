"""Quality, toxicity, suffix-tree scoring."""
import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from tidyleads.llm import op01_quality, op04_toxicity, op06_suffix_tree

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mid(spark):
    return spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")


def _fold(doc_id, n):
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % n


# ---- quality ---------------------------------------------------------------
def test_held_out_quality(spark, mid):
    docs, labels = mid
    known = {r.doc_id: r for r in labels.collect()}
    train = labels.where("doc_id % 3 <> 0")
    got = {r.doc_id: r for r in op01_quality.grade_documents(docs, op01_quality.graded(train)).collect()}
    test = [d for d in known if d % 3 == 0]
    good = [got[d].kept for d in test if known[d].quality == 1]
    poor = [got[d].kept for d in test if known[d].quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(poor) <= 0.25
    for r in got.values():  # the tails of ordered thresholds fall, and sum to the expectation
        assert r.tails[0] >= r.tails[1] and r.expected_grade == pytest.approx(sum(r.tails)) and r.tail == r.tails[0]


def test_ordinal_fit_finds_ordered_grades():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        x = rng.normal()
        grade = int(np.digitize(x + 0.1 * rng.normal(), [-0.8, 0.0, 0.9]))
        rows.append((i, grade, np.array([0, 5]), np.array([1.0, x])))
    model = op01_quality.Ordinal(4).fit(pd.DataFrame(rows, columns=["doc_id", "grade", "slots", "values"]), rounds=400, l2=0.0)
    assert (np.diff(model.thresholds()) > 0).all()
    eta = np.array([model.weights[[0, 5]] @ np.array([1.0, x]) for x in (-2.0, -0.4, 0.5, 2.0)])
    assert model.tails(eta).sum(1) == pytest.approx([0, 1, 2, 3], abs=0.25)


def test_sample_is_bounded_when_a_rated_id_has_many_rows(spark):
    rows = [(1, "copied text")] * 3000 + [(2, f"text number {i}") for i in range(500)] + [(3, None), (3, ""), (4, "once")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(1, 2), (1, 2), (2, 0), (3, 1), (4, 2)], "doc_id long, grade int")
    whole = op01_quality.rated_sample(docs, ratings, 6000)
    assert len(whole) == 1 + 500 + 1 + 1 and whole.set_index("doc_id")["times"][[1, 3, 4]].tolist() == [2, 1, 1]
    few = op01_quality.rated_sample(docs, ratings, 40)
    again = op01_quality.rated_sample(docs.repartition(7), ratings, 40)
    assert len(few) == 40 and set(zip(few["doc_id"], few["digest"])) == set(zip(again["doc_id"], again["digest"]))


def test_grades_against_the_formula(spark, mid):
    """Tails and expected grade of every document from the fitted weights, one feature at a time."""
    docs, labels = mid
    ratings = op01_quality.graded(labels)
    model, texts = op01_quality.fit(docs, ratings, 3), {r.doc_id: r.text for r in docs.collect()}
    for r in op01_quality.grade_documents(docs, ratings).collect():
        eta = sum(model.weights[s] * v for s, v in zip(*op01_quality.features((texts[r.doc_id] or "").encode())))
        want = [1 / (1 + math.exp(t - eta)) for t in model.thresholds()]
        assert list(r.tails) == pytest.approx(want, abs=1e-6) and r.expected_grade == pytest.approx(sum(want), abs=1e-6) and r.kept == (want[0] >= 0.5)


def test_quality_of_edge_rows(spark, clashing, empty):
    ratings = spark.createDataFrame([(1, 2), (2, 0), (2, 2), (None, 1), (99, 1), (6, None), (7, 1)], "doc_id long, grade int")
    assert op01_quality.grade_documents(clashing, ratings).count() == clashing.count()
    out = op01_quality.good_documents(clashing, ratings.where("false"))
    assert out.columns == clashing.columns and out.count() == clashing.count()
    assert op01_quality.grade_documents(empty, ratings).count() == 0


# ---- toxicity --------------------------------------------------------------
def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_automaton_is_levenshtein_on_the_trie():
    terms = ["idiot$", "scum$", "lowei", "lostra", "clown$"]
    a, rng = op04_toxicity.Automaton(terms), random.Random(2)
    words = ["", "idiot", "idi0t", "diot", "idiott", "iidiot", "idoit", "scum", "scam", "loweixyz", "lowexyz", "loweei", "clowns", "lostr", "lstra"]
    words += ["".join(rng.choice("idotlwescumranx") for _ in range(rng.randrange(1, 9))) for _ in range(2000)]
    words += ["".join(c for c in t.strip("$") if rng.random() > 0.1) + rng.choice(["", "q"]) for t in terms for _ in range(100)]
    for w, got in zip(words, a.find(words)):
        best = {}
        for i, t in enumerate(terms):
            body = t.rstrip("$")
            d = _distance(body, w)[-1] if t.endswith("$") else min(_distance(body, w[:n])[-1] for n in range(len(w) + 1))
            if d == 0 or d == 1 and len(body) >= op04_toxicity.FUZZY_FROM:
                best[i] = d
        assert (got >= 0) == bool(best), w
        if best:
            assert best[got // 2] == got % 2 == min(best.values()), w


def test_held_out_toxicity(spark, mid):
    docs, labels = mid
    known = {r.doc_id: r.toxic for r in labels.collect()}
    rows = op04_toxicity.score_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.held_out == (_fold(r.doc_id, 4) == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([p == y for y, p in held]) >= 0.9


def test_misspelled_terms_and_quotations(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioubcdfg") for _ in range(6))
    text = lambda *more: " ".join([word() for _ in range(30)] + list(more) + [word() for _ in range(20)])
    rows = [(i, text("moron", "and", "worthless")) if i % 4 == 0 else (i, text()) for i in range(400)]
    rows += [(1000, text("m0ron")), (1001, text("he", "said", '"moron"')), (1002, text("MORON!")), (1003, text()), (1004, None), (1005, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(7, None), (None, 1), (5000, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in op04_toxicity.score_documents(docs, labels).collect()}
    assert got[1000].predicted == got[1002].predicted == 1 and got[1003].score == got[1004].score == got[1005].score == 0
    assert got[1001].n_quoted == 1 and 0 < got[1001].score < got[1002].score


def test_toxicity_of_edge_rows(spark, clashing, empty):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    rows = op04_toxicity.score_documents(clashing, labels).collect()
    assert len(rows) == clashing.count() and all(r.score == 0 for r in rows)
    assert op04_toxicity.score_documents(empty, labels).count() == 0


# ---- suffix tree -----------------------------------------------------------
def test_base_scores_and_gain(spark, mid):
    docs, _ = mid
    texts = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in docs.collect()]
    c = Counter(w for d, ws in texts if _fold(d, 7) != 2 for w in ws)
    n, v, want = sum(c.values()), len(c), dict(texts)
    rows = op06_suffix_tree.score_documents(docs, heavy=1e-3).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = want[r.doc_id]
        assert r.held_out == (_fold(r.doc_id, 7) == 2) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(ws), sum(c[w] > 0 for w in ws))
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in ws))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_longest_suffix_and_smoothing(spark):
    """The tables against suffixes looked up one by one, also of grams never seen; distributions sum to 1."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["aba", "ab", "cab", "x", "Yé"]) for _ in range(rng.randrange(30))) for _ in range(80)] + ["", None]
    code = np.full(256, op06_suffix_tree.OTHER, dtype=np.uint8)
    for i, b in enumerate(b"abcxy"):
        code[b] = i + 2
    depth, encoded = 3, [(t or "").encode() for t in texts]
    grams = op06_suffix_tree.gram_table(spark.createDataFrame([(t,) for t in texts], "text string"), code, depth)
    total = sum(r.c for r in grams.collect())
    tables = op06_suffix_tree.probabilities(op06_suffix_tree.shorter(grams, depth), 0.01, 2)
    stream, begin = op06_suffix_tree._symbols(encoded, code, depth)
    seqs = []
    for t in encoded:
        s = []
        for w in t.lower().split():
            s += ([op06_suffix_tree.SEP] if s else []) + [int(code[b]) for b in w]
        seqs.append([0] * depth + s + [0])
    assert stream.tolist() == [x for s in seqs for x in s] and total == sum(len(s) - depth for s in seqs)
    # plain counting
    counts = [{} for _ in range(depth + 1)]
    for s in seqs:
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                counts[d].setdefault(tuple(s[i - d:i]), Counter())[s[i]] += 1
    prob = {(): {x: (counts[0][()][x] + 0.5) / (total + 0.5 * 64) for x in range(64)}}

    def state(ctx):
        while ctx not in prob:
            ctx = ctx[1:]
        return ctx
    for d in range(1, depth + 1):
        for ctx, c in counts[d].items():
            n = sum(c.values())
            if n >= 2:
                up = prob[state(ctx[1:])]
                if sum(k / n * math.log(k / n / up[x]) for x, k in c.items()) >= 0.01:
                    prob[ctx] = {x: (c[x] + len(c) * up[x]) / (n + len(c)) for x in range(64)}
    kept = sum(t.where("back < 1").select(F.shiftright("g", op06_suffix_tree.BITS).alias("ctx")).distinct().count() for t in tables[1:])
    assert len(prob) == kept + 1 > 6
    contexts = sorted({tuple(s[i - depth:i]) for s in seqs for i in range(depth, len(s))}) + [(5, 5, 5), (0, 6, 2), (2, 3, 6)]
    want = {}
    for ctx in contexts:
        p = prob[state(ctx)]
        assert sum(p.values()) == pytest.approx(1)
        for x in range(64):
            want[sum(k << 6 * i for i, k in enumerate(reversed(ctx + (x,))))] = p[x]
    asked = spark.createDataFrame([(7, g) for g in want], "block long, g long")
    got = {r.g: r.p for r in op06_suffix_tree.looked_up(asked, tables).collect()}
    assert got == pytest.approx(want, rel=1e-5)


def test_mixed_score_against_plain_counting(spark):
    """Whole scores, tree and base mixed, from Python counters alone."""
    rng, depth, share = random.Random(8), 5, 0.4
    words = ["lorem", "Ipsum", "dolor", "sit", "amet", "consectetur", "a", "Ωmega"]
    texts = {i: " ".join(rng.choice(words) for _ in range(rng.randrange(25))) for i in range(60)} | {60: None, 61: "unseen words: zyx", 62: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    split = {i: [w.encode() for w in "".join(c.lower() if c.isascii() else c for c in t or "").split()] for i, t in texts.items()}
    train = [i for i in texts if _fold(i, 7) != 2]
    bytes_ = Counter(b for i in train for w in split[i] for b in w)
    code = op06_suffix_tree.byte_code(np.array([bytes_[b] for b in range(256)]))
    symbols = lambda w: [s for b in w for s in ([int(code[b])] if code[b] < 64 else [int(code[b]) >> 6, int(code[b]) & 63])]

    def stream(i):
        """Context ends, then each word's symbols with what follows it."""
        parts = [symbols(w) + [1] for w in split[i]]
        if not parts:
            return [0] * depth, [[0]]
        parts[-1][-1] = 0
        return [0] * depth, parts
    counts = [{} for _ in range(depth + 1)]
    for i in train:
        s, parts = stream(i)
        s = s + [x for p in parts for x in p]
        for j in range(depth, len(s)):
            for d in range(depth + 1):
                counts[d].setdefault(tuple(s[j - d:j]), Counter())[s[j]] += 1
    total = sum(counts[0][()].values())
    prob = {(): {x: (counts[0][()][x] + 0.5) / (total + 32) for x in range(64)}}

    def state(ctx):
        while ctx not in prob:
            ctx = ctx[1:]
        return ctx
    for d in range(1, depth + 1):
        for ctx, c in counts[d].items():
            n, up = sum(c.values()), prob[state(ctx[1:])]
            if n >= 2 and sum(k / n * math.log(k / n / up[x]) for x, k in c.items()) >= op06_suffix_tree.MIN_KL:
                prob[ctx] = {x: (c[x] + len(c) * up[x]) / (n + len(c)) for x in range(64)}
    base = Counter(w for i in train for w in split[i] + [None])
    norm = sum(base.values()) + len(base) + 1
    for r in op06_suffix_tree.score_documents(docs, p_min=0.01, heavy=0.05).collect():
        s, parts = stream(r.doc_id)
        want = 0.0
        for j, part in enumerate(parts):
            tree = 1.0
            for x in part:
                tree *= prob[state(tuple(s[-depth:]))][x]
                s.append(x)
            end = (base[None] + 1) / norm if j == len(parts) - 1 else 1.0
            word = (base[split[r.doc_id][j]] + 1) / norm if split[r.doc_id] else 1.0
            want += math.log10(share * word * end + (1 - share) * tree)
        assert r.score == pytest.approx(want, abs=1e-4), r


def test_rare_contexts_and_bytes_are_learned(spark):
    """What is learned of rare contexts and byte values does not depend on how much else there is."""
    frequent = bytes(range(ord("!"), ord("!") + 94)).decode()
    rng = random.Random(4)
    plain = [(i, " ".join("".join(rng.choice(frequent) for _ in range(4)) for _ in range(40))) for i in range(300)]
    foreign = [(1000 + i, "ωψφω ψωφψ qzjxk vwpyq " * 2) for i in range(8)]
    docs = spark.createDataFrame(plain + foreign, "doc_id long, text string")
    rows = {p_min: {r.doc_id: r.score for r in op06_suffix_tree.score_documents(docs, p_min=p_min, share=0.0, held=-1).collect()} for p_min in (1e-5, 0.05)}
    assert rows[1e-5] == pytest.approx(rows[0.05], abs=1e-2)  # what is broadcast changes nothing
    assert all(rows[0.05][1000 + i] > -35 for i in range(8))  # flat bytes and no rare contexts gave -146

    code = op06_suffix_tree.byte_code(np.arange(256))
    stream, begin = op06_suffix_tree._symbols([bytes(range(256)), b"", "Ωω a".encode()], code, 5)
    assert len(set(code.tolist())) == 256 and stream.max() < op06_suffix_tree.SIZE and begin[-1] - 5 == len(stream)
    assert ((stream == op06_suffix_tree.SEP).sum(), (stream[5:] == op06_suffix_tree.END).sum()) == (3, 5 * 2 + 3)


def test_scores_of_edge_rows(clashing, empty):
    rows = op06_suffix_tree.score_documents(clashing).collect()
    assert len(rows) == clashing.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert op06_suffix_tree.score_documents(empty).count() == 0


def test_few_texts_and_keys_are_held_at_once():
    texts = [b"ab", b"", b"c" * 50, b"", b"defg", b"h"]
    row = SimpleNamespace(sizes=np.array([len(t) for t in texts], np.int64).tobytes(), z=zstandard.ZstdCompressor().compress(b"".join(texts)))
    parts = list(op06_suffix_tree._texts(row, 5))
    assert [t for *_, part in parts for t in part] == texts and [a for a, *_ in parts] == [0, *[b for _, b, _ in parts][:-1]]
    assert all(len(part) == 1 or sum(map(len, part)) <= 5 for *_, part in parts) and len(parts) > 2
    none = SimpleNamespace(sizes=b"", z=zstandard.ZstdCompressor().compress(b""))
    assert list(op06_suffix_tree._texts(none, 5)) == []

    rng = np.random.default_rng(5)
    keys = [rng.integers(-1 << 40, 1 << 40, 400_000) for _ in range(6)] + [np.array([7, 7, 3])]
    often = np.unique(keys[0][:1000])
    want = np.setdiff1d(np.concatenate(keys), often)
    assert np.array_equal(op06_suffix_tree._asked(iter(keys), often), want)
    assert not len(op06_suffix_tree._asked(iter([]), often))
    known = op06_suffix_tree.Known((often, np.full(len(often), 2.0)), want[::-1], np.full(len(want), 3.0))
    x = np.concatenate((keys[0][:3000], [1 << 41]))
    assert np.array_equal(known.of(x), np.where(x == 1 << 41, 0.0, np.where(np.isin(x, often), 2.0, 3.0)))
    assert np.array_equal(known.of(abs(x[:0])), np.zeros(0))

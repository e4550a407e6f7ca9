"""Merkle manifest, importance resampling and secret scan against plain versions."""
import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidyleads.llm import op11_merkle, op12_resampling, op13_secrets


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- manifest --------------------------------------------------------------
def _tree(digests):
    """(root, proofs): every run of three becomes its hash while several nodes remain."""
    proofs = [[] for _ in digests]
    level = [(d, [i]) for i, d in enumerate(digests)]
    while len(level) > 1:
        above = []
        for a in range(0, len(level), 3):
            run = level[a:a + 3]
            for j, (_, members) in enumerate(run):
                for i in members:
                    proofs[i].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1:])))
            above.append((sha("".join(d for d, _ in run)), [i for _, m in run for i in m]))
        level = above
    return level[0][0], proofs


def _manifest(rows):
    """{row: [(leaf, subroot, root, proof, folded, verified)]}."""
    def enc(r):
        return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r)
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, sha(enc(r))))
        trees[s] = _tree([sha(enc(r)) for r in by[s]])
    root, over = _tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, over):
        for r, proof in zip(by[s], trees[s][1]):
            text = r[4]
            if text is not None and zlib.crc32(("null" if r[0] is None else str(r[0])).encode()) % 2 == 0:
                text = text.replace("\n", "")
            d = sha(enc(r[:4] + (text,)))
            for left, right in proof + top:
                d = sha(left + d + right)
            out.append((r[0], sha(enc(r)), trees[s][0], root, sha("".join(a + b for a, b in proof + top)), d, d == root))
    return sorted(out, key=str)


def _got(docs):
    df = op11_merkle.verified_manifest(docs, op11_merkle.tampered_text())
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_manifest_of_edge_rows(spark, edge, clashing):
    want = _manifest([tuple(r[c] for c in op11_merkle.FIELDS) for r in edge.collect()])
    assert _got(edge) == want
    assert _got(clashing) == want


def test_manifest_of_a_hot_source_over_several_tiers(spark, monkeypatch):
    monkeypatch.setattr(op11_merkle, "LEVELS", 2)  # blocks of nine rows: four tiers
    rows = [(i, "hot" if i % 3 else f"s{i % 41}", "en", i, f"text {i}\nline") for i in range(1, 900)] + [(7, "hot", "en", 7, "same\n")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert _got(docs) == _manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_manifest_of_few_rows(spark, n, monkeypatch):
    monkeypatch.setattr(op11_merkle, "LEVELS", 1)
    rows = [(i, "a", None, None, f"{i}\n") for i in range(n)]
    assert _got(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == _manifest(rows)


def test_manifest_of_no_rows(spark, empty):
    assert op11_merkle.verified_manifest(empty, op11_merkle.tampered_text()).count() == 0


def test_manifest_windows_are_over_blocks(spark, docs):
    plan = op11_merkle.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "_block" in plan


# ---- resampling ------------------------------------------------------------
def _features(text, n=1):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(op12_resampling.WORD, low)
    return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def _resampled(rows, target, n=1, percent=10, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for _, t in rows for f in _features(t, n)[1])
    t = Counter(bucket(f) for x in target for f in _features(x, n)[1])
    ns, nt = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        words, found = _features(text, n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ns + 10_000) / ((s[b] + 1) * (nt + 10_000)))) for b in map(bucket, found))
        h = int(sha(f"2024:{'null' if i is None else i}")[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=str)


def _drawn(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_resampling_of_edge_rows(spark, edge, clashing, docs):
    target = docs.select("text").limit(5)
    texts = [r.text for r in target.collect()]
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want = _resampled(rows, texts, percent=50, least=5)
    assert _drawn(op12_resampling.resample(edge, target, percent=50, least_words=5)) == want
    assert _drawn(op12_resampling.resample(clashing, target, percent=50, least_words=5)) == want


def test_resampling_by_word_pairs(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = docs.where("doc_id % 10 = 3").select("text")
    want = _resampled(rows, [t for i, t in rows if i % 10 == 3], n=2)
    assert _drawn(op12_resampling.resample(docs, target, max_n=2)) == want


def test_resampling_of_no_rows(spark, empty, docs):
    assert op12_resampling.resample(empty, docs.select("text")).count() == 0
    assert op12_resampling.resample(docs, empty.select("text")).count() == docs.count()


def test_words_have_offsets():
    text = "Ünü x\x00y 1-2 日本_A"
    found = op12_resampling.splitter().pre_tokenize_str(text.lower())
    assert [w for w, _ in found] == ["ünü", "x", "y", "1", "2", "日本", "a"] and all(text.lower()[a:b] == w for w, (a, b) in found)
    assert op12_resampling.windows(found, text.lower(), 2)[:2] == ["ünü x", "x y"]


# ---- secrets ---------------------------------------------------------------
_PLAIN = {"assign": r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
                    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "access": r"()(AKIA[A-Z0-9]+)", "hex": r"()([0-9a-f]+)"}
_LEAST = {"assign": 6, "access": 20, "hex": 24}
SNIPPETS = [
    "password=hunter22 and Token : 'abcdef1234' api_key=x apikey=AAAAAA", "secret=token:abcdefgh password==abc", "AKIA" + "A" * 16 + " AKIAAKIA AKIA" + "B" * 15,
    "deadbeef" * 3 + " " + "deadbeef" * 2 + "g" + "0" * 24, "ſecret=abcdef toKen=abcdef PASSWD\"  :  \"abc.def/ghi", "token=" + "a" * 40, "", "日本 secret='äöü' token=日本abcdef",
]


def _base(text):
    found = [(m.start(), list(_PLAIN).index(k), f"{k}:{m.start()}:{m.end()}") for k, p in _PLAIN.items() for m in re.finditer(p, text) if len(m.group(2)) >= _LEAST[k]]
    return [s for _, _, s in sorted(found)]


def test_base_spans_are_the_plain_patterns(spark, docs):
    rows = [(i, t) for i, t in enumerate(SNIPPETS)] + [(1000 + r.doc_id, r.text) for r in docs.collect()] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit("theirs"))
    got = {r.doc_id: r for r in op13_secrets.report(op13_secrets.secrets(df)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = _base(t or "")
        r = got[i]
        assert r.base_sha256 == sha(",".join(want))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        assert [s for s in r.spans.split(",") if s and not s.startswith("literal")] == want


@pytest.mark.parametrize("text, literals", [
    ('a = "hunter2!xyz"\nb = a\npassword = b', ["hunter2!xyz"]),
    ('db.pwd: "p@ss!word#9"', ["p@ss!word#9"]),
    ("export DB_PASS=Zx81!kk9qq", ["Zx81!kk9qq"]),
    ('password: str = "s3cr3t-valu3!"', ["s3cr3t-valu3!"]),
    ("<password>hunter2xx99!</password>", ["hunter2xx99!"]),
    ('passphrase = "abc123" + "def456" + tail', ["abc123", "def456"]),
    ('K="z9x8c7v6b5"\ncurl -u ${K}\nAPI_SECRET=${K}', ["z9x8c7v6b5"]),
    ('part = "z9x8!c7v6b5"\nclientSecret = "pre-${part}"', ["z9x8!c7v6b5"]),
    ('key = "8f3kd93jd93jd93kd0s"', ["8f3kd93jd93jd93kd0s"]),
    ('token_count = "12345678x!"; public_key: "abc123!def456"', []),
    ("The password: very important to keep, and the key: nothing much", []),
    ('password = "${PASSWORD}"; pwd = "changeme"; secret: "<your secret>"', []),
    ('note = "a=b: c"; title: "Chapter 12: The End"', []),
])
def test_literals_that_reach_sensitive_names(text, literals):
    assert [text[a:b] for a, b, _, _ in op13_secrets.literal_spans(text)] == literals


def test_literals_stand_beside_the_base():
    text = 'token = "04dbebab91ab85687d33eeaa"; pwd = "p@ss!word#9"'
    assert [s[0] for s in op13_secrets.spans(text)] == ["assign", "hex", "literal"]


@pytest.mark.parametrize("unit", ['="', "a=", "a:", "<a>", "password=", "a=b+", '="a', "a'b\\", "x = ", 'a="b"+a\n', "secret=a\na=secret\n"])
def test_lexing_is_linear(unit):
    import time
    op13_secrets.spans(unit * 100)
    t = time.process_time()
    op13_secrets.spans(unit * 40_000)
    assert time.process_time() - t < 10


def test_secrets_of_no_rows(spark, empty):
    assert op13_secrets.report(op13_secrets.secrets(empty)).count() == 0

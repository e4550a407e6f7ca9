"""Exact partial similarity: properties, and Spark results against a plain
Python evaluation of the same rule on a small fixture (brute force)."""

import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidyleads.operators import similarity as S
from tidyleads.operators.align import partial_ratios
from tidyleads.plans.q_reports import _people

def plain_ratio(a, b):
    """The rule by difflib, pair by pair."""
    from difflib import SequenceMatcher
    if a is None or b is None:
        return 0
    if a == b:
        return 100
    if not a or not b:
        return 0
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    best = 0.0
    for i, j, _ in SequenceMatcher(None, short, long_, autojunk=False).get_matching_blocks():
        window = long_[max(j - i, 0):][:len(short)]
        r = SequenceMatcher(None, short, window, autojunk=False).ratio()
        if r > 0.995:
            return 100
        best = max(best, r)
    return int(round(100 * best))


texts = st.text(alphabet="abcdefgh.@-", min_size=0, max_size=30)


@settings(max_examples=300, deadline=None)
@given(texts, texts)
def test_partial_ratio_range_and_containment(a, b):
    r = S.partial_ratio(a, b)
    assert 0 <= r <= 100
    if a == b:
        assert r == 100
    elif a and b and (a in b or b in a):
        assert r == 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abcdé€😀.@", max_size=14), st.text(alphabet="abcdé€😀.@", max_size=40)), max_size=40))
def test_aligner_equals_difflib(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert partial_ratios(a, b).tolist() == [plain_ratio(x, y) for x, y in pairs]


def test_aligner_on_long_and_missing_texts():
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdef ", k=rnd.randint(0, 600))) for _ in range(20)]
    a, b = words + [None, "", "x"], words[::-1] + ["x", "x", None]
    assert partial_ratios(a, b).tolist() == [plain_ratio(x, y) for x, y in zip(a, b)]
    assert partial_ratios([], []).tolist() == []


def test_bound_is_never_below_the_ratio(spark):
    rnd = random.Random(5)
    rows = [("".join(rnd.choices("abcdö", k=rnd.randint(0, 9))), "".join(rnd.choices("abcdefgö@.", k=rnd.randint(0, 25)))) for _ in range(3000)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", S.ratio_bound("a", "b").alias("u"), S.common_characters("a", "b").alias("c")).collect()
    for r in got:
        assert r.c == sum((Counter(r.a) & Counter(r.b)).values())
        assert plain_ratio(r.a, r.b) <= r.u + 0.5


def test_few_triples_reach_the_aligner(spark, sf_small):
    """Of the rows with an e-mail, under a tenth is aligned: containment and initials decide most, the bound a third of the rest."""
    p = S.bad_email_prepare(_people(spark, sf_small).select("row_key", "first_name", "last_name", "email"))
    lookup = S.bad_email_lookup(p)
    aligned, undecided = lookup.agg(F.count_if("_aligned"), F.count("_e")).first()
    rows = p.where(F.col("email").isNotNull()).count()
    assert aligned < 0.7 * undecided and aligned < 0.1 * rows


def test_partial_ratio_known_values():
    assert S.partial_ratio("smith", "j.smyth@x.com") == 80
    assert S.partial_ratio("", "abc") == 0
    assert S.partial_ratio(None, "abc") == 0
    assert S.partial_ratio("abc", "abc") == 100


def test_windowed_similarity_native(spark):
    df = spark.createDataFrame([("smith", "j.smyth@x.com"), ("", "x"), ("ab", "ab"), (None, "a")], "a string, b string")
    got = [r[0] for r in df.select(S.windowed_similarity("a", "b")).collect()]
    assert got == [80, 0, 100, None]


def _company_clean_py(name):
    import re
    from tidyleads import refdata
    s = (name or "").lower()
    runs = re.findall(r"\w+|\W+", s)
    s = "".join(r for r in runs if r not in refdata.LEGAL_WORDS)
    for a, b in [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss")]:
        s = s.replace(a, b)
    return re.sub(r"[^a-zA-Z0-9]", "", s)


def _domain_core_py(email):
    e = email.lower()
    return _company_clean_py(e.split("@", 1)[1].split(".", 1)[0]) if "@" in e else None


def test_domain_score_equals_brute_force(spark, sf_small):
    p = _people(spark, sf_small).select("row_key", "account_name", F.lower("email").alias("email"))
    got = {r.row_key: r.domain_score for r in S.domain_score(p).collect()}
    for r in p.collect():
        want = None
        if r.email is not None and "@" in r.email:
            c, d = _company_clean_py(r.account_name), _domain_core_py(r.email)
            if c and d:
                want = plain_ratio(c, d)
        assert got[r.row_key] == want, (r, got[r.row_key], want)


def test_bad_email_equals_brute_force(spark, sf_small):
    p = _people(spark, sf_small).select("row_key", "first_name", "last_name", "email")
    got = {r.row_key: r.bad_email for r in S.flag_bad_email(p).collect()}
    for r in p.collect():
        f, l_, e = (r.first_name or "").lower(), (r.last_name or "").lower(), (r.email or "").lower()
        if not e.strip() or not f.strip() or not l_.strip():
            want = False
        else:
            want = not (plain_ratio(f, e) > 75 or plain_ratio(l_, e) > 75 or (f[0] + l_[0]) in e)
        assert got[r.row_key] == want, (r, got[r.row_key], want)


def test_python_runs_only_on_undecided_pairs(spark):
    rows = [(f"anna{i}", "x", f"anna{i}.x@corp.de") for i in range(50)] + [("max", "muster", "zz@q.de")]
    df = spark.createDataFrame(rows, "first_name string, last_name string, email string")
    p = S.bad_email_prepare(df)
    assert p.where("_need").count() == 1
    assert [r.bad_email for r in S.flag_bad_email(df).where("bad_email").collect()] == [True]


def test_random_pairs_scored_like_python(spark):
    rnd = random.Random(7)
    pairs = [("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 8))),
              "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a string, b string").distinct()
    got = {(r.a, r.b): r.score for r in S.score_pairs(df).collect()}
    for (a, b), s in got.items():
        assert s == plain_ratio(a, b)

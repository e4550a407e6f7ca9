"""Name/domain similarity scored on distinct pairs.

Exact mode gives the partial-ratio score (matching-block alignment of the
shorter text against windows of the longer one) by filter and verify: native
short-cuts (containment, initials) and, where only a cut-off counts, a native
upper bound from the characters in common decide most pairs; the distinct pairs that are
left reach Python in Arrow batches, aligned a batch at a time over code-point
arrays (``align``); the scores are joined back on the pair.  Native mode
(``windowed_similarity``) is a different, all-Catalyst score: best
Levenshtein similarity of the shorter text against every window of the longer.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .. import refdata
from ..functions._util import as_col
from ..functions.contact import domain_core
from ..functions.text import fold_text, strip_words
from ..functions.values import is_blank
from .align import partial_ratios
from .joins import left_lookup


def partial_ratio(a: str | None, b: str | None) -> int:
    """Partial similarity 0..100 of two texts (argument order matters when
    both have the same length).  Decision: no character counts as junk, at any
    length, so containment of the shorter text always means 100."""
    return int(partial_ratios([a], [b])[0])


@pandas_udf(T.IntegerType())
def partial_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(partial_ratios(a.tolist(), b.tolist()))


def common_characters(a, b) -> Column:
    """Characters that two texts have in common, repeats counted (order ignored)."""
    pair = F.struct(as_col(a).alias("a"), as_col(b).alias("b"))

    def count(p):
        def times(t, c):
            return F.length(t) - F.length(F.replace(t, c, F.lit("")))
        return F.aggregate(F.array_distinct(F.split(p["a"], "")), F.lit(0),
                           lambda n, c: n + F.when(c == "", 0).otherwise(F.least(times(p["a"], c), times(p["b"], c))))
    return F.element_at(F.transform(F.array(pair), count), 1)


def ratio_bound(a, b) -> Column:
    """No partial ratio of the two texts is above this (0..100, a double).  A window of the longer
    text has at most the c characters that both share, so 2M / T is at most 2c / (n + c), n the
    shorter text's length."""
    a, b = as_col(a), as_col(b)
    c, n = common_characters(a, b), F.least(F.length(a), F.length(b))
    return F.when(a == b, 100.0).when(n > 0, 200.0 * c / (n + c)).otherwise(0.0)


def contains_shortcut(a, b) -> Column:
    """Native decision for a score of 100 (NULL when undecided)."""
    a, b = as_col(a), as_col(b)
    short = F.when(F.length(a) <= F.length(b), a).otherwise(b)
    long_ = F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return F.when(a == b, F.lit(100)).when(
        (F.length(short) > 0) & F.contains(long_, short), F.lit(100))


def score_pairs(pairs: DataFrame, a: str = "a", b: str = "b", out: str = "score") -> DataFrame:
    """Exact partial ratio for a DataFrame of (distinct) pairs: native
    short-cut where it decides, Python for the rest (rows hash-spread by the
    preceding ``distinct``)."""
    quick = contains_shortcut(a, b)
    return pairs.withColumn("_quick", quick).withColumn(
        out, F.coalesce(F.col("_quick"), partial_ratio_udf(F.col(a), F.col(b)))).drop("_quick")


def windowed_similarity(a, b) -> Column:
    """Native similarity 0..100: the shorter text against every window of the
    longer one, best ``100 * (1 - levenshtein / len(shorter))`` rounded.

    The (shorter, longer) pair is bound once through a one-element
    ``transform`` so the generated code does not repeat the CASE expressions.
    """
    a, b = as_col(a), as_col(b)
    pair = F.when(F.length(a) <= F.length(b), F.struct(a.alias("s"), b.alias("l"))) \
            .otherwise(F.struct(b.alias("s"), a.alias("l")))

    def body(p):
        short, long_ = p["s"], p["l"]
        n = F.length(short)
        wins = F.sequence(F.lit(1), F.length(long_) - n + 1)
        best = F.array_max(F.transform(wins, lambda i: F.round(
            F.lit(100.0) * (F.lit(1.0) - F.levenshtein(short, long_.substr(i, n)) / n))))
        return (F.when(short.isNull() | long_.isNull(), F.lit(None))
                .when(short == long_, F.lit(100))
                .when(n == 0, F.lit(0))
                .otherwise(best.cast("int")))

    return F.element_at(F.transform(F.array(pair), body), 1)


def company_clean(name) -> Column:
    return fold_text(strip_words(F.lower(as_col(name))))


def with_company_clean(df: DataFrame, name: str, out: str, words: DataFrame | None = None) -> DataFrame:
    """``company_clean`` of a column; with a table of legal words (word) of any size these are
    joined, once per distinct name, in place of the built-in ones."""
    if words is None:
        return df.withColumn(out, company_clean(name))
    stop = words.select(F.lower(F.trim("word")).alias("_w")).where(F.col("_w") != "").distinct()
    # folding drops what stands between words, so only the words are joined
    runs = df.select(F.col(name).alias("_n")).distinct().select("_n", F.posexplode(F.regexp_extract_all(F.lower("_n"), F.lit(r"([\p{L}\p{N}_]+)"), 0)).alias("_pos", "_w"))
    kept = runs.join(stop, "_w", "left_anti").groupBy("_n").agg(F.array_sort(F.collect_list(F.struct("_pos", "_w"))).alias("_kept"))
    kept = kept.select(F.col("_n").alias(name), fold_text(F.array_join(F.col("_kept._w"), "")).alias(out))
    return left_lookup(df, kept, [name]).withColumn(out, F.coalesce(out, F.lit("")))


def domain_clean(email) -> Column:
    return fold_text(domain_core(email))


# Each scored rule is split into prepare (row-level key columns), lookup (a
# small table built from the prepared rows) and attach (one left join), so a
# caller running several rules derives every lookup from the same prepared
# rows instead of chaining them (which would re-evaluate the upstream plan
# once per branch and level).
def domain_prepare(df: DataFrame, company: str = "account_name", email: str = "email",
                   eligible: Column | None = None) -> DataFrame:
    eligible = eligible if eligible is not None else F.lit(True)
    base = df.withColumns({"_ca": F.lower(F.col(company)), "_cb": domain_core(email)})
    return base.withColumn("_sc_ok", eligible & F.col(email).contains("@"))


# Lookups null the key of rows outside the rule instead of filtering them: a
# filter on a derived flag would be pushed down with every aliased expression
# substituted into it, while a NULL key is one extra group that never joins.
def domain_lookup(prepared: DataFrame, words: DataFrame | None = None) -> DataFrame:
    ok = F.col("_sc_ok")
    pairs = prepared.select(F.when(ok, F.col("_ca")).alias("a"), F.when(ok, F.col("_cb")).alias("b")).distinct()
    # legal words are removed and letters folded once per distinct pair, not per row
    clean = with_company_clean(pairs, "a", "_clean", words)
    clean = clean.select(F.col("a").alias("_ca"), F.col("b").alias("_cb"), F.col("_clean").alias("a"), fold_text("b").alias("b"))
    both = (F.col("a") != "") & (F.col("b") != "")
    return score_pairs(clean).select("_ca", "_cb", F.when(both, F.col("score")).alias("_score"))


def domain_attach(prepared: DataFrame, lookup: DataFrame, out: str = "domain_score") -> DataFrame:
    j = left_lookup(prepared.withColumns({c: F.when(F.col("_sc_ok"), F.col(c)) for c in ("_ca", "_cb")}), lookup, ["_ca", "_cb"])
    return j.withColumn(out, F.when(F.col("_sc_ok"), F.col("_score"))).drop("_ca", "_cb", "_score", "_sc_ok")


def domain_score(df: DataFrame, company: str = "account_name", email: str = "email",
                 eligible: Column | None = None, out: str = "domain_score", words: DataFrame | None = None) -> DataFrame:
    """Company name (legal words removed, folded) vs. e-mail domain core
    (folded): NULL when the e-mail has no '@' or either side is empty.
    Scored once per distinct (company, domain) pair."""
    p = domain_prepare(df, company, email, eligible)
    return domain_attach(p, domain_lookup(p, words), out)


@pandas_udf(T.BooleanType())
def _bad_email_udf(f: pd.Series, l_: pd.Series, e: pd.Series, cut: pd.Series) -> pd.Series:
    e, cut = e.tolist(), cut.to_numpy()
    return pd.Series((partial_ratios(f.tolist(), e) <= cut) & (partial_ratios(l_.tolist(), e) <= cut))


# not marked deterministic, so that a filter on the verdict stays above: pushed below the
# distinct, it would carry every expression that the names and the e-mail are made of
_bad_email_udf = _bad_email_udf.asNondeterministic()


def bad_email_prepare(df: DataFrame, first: str = "first_name", last: str = "last_name",
                      email: str = "email", eligible: Column | None = None) -> DataFrame:
    eligible = eligible if eligible is not None else F.lit(True)
    base = df.withColumns({"_f": F.lower(F.col(first)), "_l": F.lower(F.col(last)), "_e": F.lower(F.col(email))})
    scope = eligible & ~is_blank("_e") & ~is_blank("_f") & ~is_blank("_l")
    initials = F.concat(F.substring("_f", 1, 1), F.substring("_l", 1, 1))
    native_ok = (F.col("_e").contains(initials)
                 | contains_shortcut("_f", "_e").isNotNull()
                 | contains_shortcut("_l", "_e").isNotNull())
    return base.withColumn("_need", scope & ~native_ok)


def bad_email_lookup(prepared: DataFrame, cutoff: int = refdata.BAD_EMAIL_CUTOFF) -> DataFrame:
    """(_f, _l, _e, _bad) of the distinct undecided triples; ``_aligned`` says that the bound did not decide."""
    need = F.col("_need")
    triples = prepared.select(*[F.when(need, F.col(c)).alias(c) for c in ("_f", "_l", "_e")]).distinct()
    # a triple whose names share too few characters with the e-mail is bad without alignment
    near = F.coalesce((ratio_bound("_f", "_e") > cutoff) | (ratio_bound("_l", "_e") > cutoff), F.lit(False))
    triples = triples.withColumn("_aligned", near)
    asked = [F.when(F.col("_aligned"), F.col(c)) for c in ("_f", "_l", "_e")]
    return triples.withColumn("_bad", _bad_email_udf(*asked, F.lit(cutoff)))  # what is not asked has no ratio: bad


def bad_email_attach(prepared: DataFrame, lookup: DataFrame, out: str = "bad_email") -> DataFrame:
    j = left_lookup(prepared.withColumns({c: F.when(F.col("_need"), F.col(c)) for c in ("_f", "_l", "_e")}), lookup.drop("_aligned"), ["_f", "_l", "_e"])
    return j.withColumn(out, F.col("_need") & F.coalesce(F.col("_bad"), F.lit(False))) \
            .drop("_f", "_l", "_e", "_need", "_bad")


def flag_bad_email(df: DataFrame, first: str = "first_name", last: str = "last_name",
                   email: str = "email", eligible: Column | None = None,
                   cutoff: int = refdata.BAD_EMAIL_CUTOFF, out: str = "bad_email") -> DataFrame:
    """Bad Email: neither partial(first, email) nor partial(last, email) is
    above ``cutoff`` and the initials are not in the e-mail (all lower case).
    Missing e-mail -> not bad; blank first or last name -> not scored (that
    row is a Bad Name).  Containment, initials and too few characters in common are decided
    natively; only the undecided rows' distinct (first, last, e-mail) triples are aligned in
    Python, and one join brings the verdict back."""
    p = bad_email_prepare(df, first, last, email, eligible)
    return bad_email_attach(p, bad_email_lookup(p, cutoff), out)


def native_pair_scores(df: DataFrame, company: str = "company", email: str = "email", words: DataFrame | None = None) -> DataFrame:
    """Distinct (company_clean, domain_clean) pairs with the native windowed
    score, label and Bad Domain flag.  Raw pairs are de-duplicated first (map-side
    combined), then cleaned, de-duplicated again and scored once per pair."""
    from ..functions.contact import bad_domain, domain_score_label
    raw = df.where(F.col(email).contains("@")).select(F.lower(F.col(company)).alias("c"), domain_core(email).alias("d")).distinct()
    pairs = with_company_clean(raw, "c", "company_clean", words).select("company_clean", fold_text("d").alias("domain_clean"))
    # an aggregate decides what is scored: a filter would be pushed below and clean every text once more
    scored = F.max((F.col("company_clean") != "") & (F.col("domain_clean") != ""))
    pairs = pairs.groupBy("company_clean", "domain_clean").agg(scored.alias("_scored")).where("_scored").drop("_scored")
    scored = pairs.withColumn("similarity", windowed_similarity("company_clean", "domain_clean"))
    return scored.withColumns({"label": domain_score_label("similarity"),
                               "bad_domain": bad_domain("similarity")})

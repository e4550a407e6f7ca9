"""Reports: counts, coverage, completeness, profiles (DataFrame -> DataFrame).

Every report is one aggregation (partial, map-side combined) whose result is
a small DataFrame; nothing is collected to the driver and no per-step
``count()`` action is taken just to log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contact import valid_url
from ..functions.values import trimmed
from .link import positive_id_of, with_prospect_counts


def value_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """Frequency table (value, count); NULLs dropped unless ``keep_null``."""
    src = df if keep_null else df.where(F.col(col).isNotNull())
    return src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def distinct_count(df: DataFrame, *cols: str) -> DataFrame:
    """One row: distinct non-NULL count per column (``n_<col>``)."""
    return distinct_values(df, {f"n_{c}": F.col(c) for c in cols})


def nonblank(c) -> Column:
    t = trimmed(c)
    return F.when(t != "", t)


def distinct_nonblank(df: DataFrame, *cols: str) -> DataFrame:
    """One row: distinct non-blank trimmed values per column."""
    return distinct_values(df, {f"n_{c}": nonblank(c) for c in cols})


def distinct_values(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
    """One row: the number of distinct non-NULL values of each figure.  All figures are stacked as
    (figure, value) in one read, made distinct map-side and then per pair, and counted per figure,
    so a hot value is one row per task and no figure needs an exchange of its own."""
    names = list(figures)
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), figures[n].cast("string").alias("v")) for i, n in enumerate(names)])
    # the outer form and the filter on the pair's place keep the value's expression out of the scan's filters
    stacked = df.select(F.explode_outer(pairs).alias("p")).select(F.col("p.f").alias("f"), F.col("p.v").alias("v"))
    counts = stacked.groupBy("f", "v").agg(F.lit(1).alias("one")).groupBy("f").agg(F.count("v").alias("n"))
    return counts.agg(*[F.coalesce(F.max(F.when(F.col("f") == i, F.col("n"))), F.lit(0)).alias(n) for i, n in enumerate(names)])


def _account_figures(df: DataFrame, when: Column | None = None, id_col: str = "custom_id", name_col: str = "account_name") -> dict[str, Column]:
    """Figures whose counts `_accounts` puts together: distinct positive IDs and trimmed names."""
    pid = F.nullif(positive_id_of(df, id_col), F.lit(0))
    keep = (lambda c: c) if when is None else (lambda c: F.when(when, c))
    return {"ids": keep(pid), "names": keep(trimmed(name_col))}


def _accounts(ids, names) -> Column:
    """Distinct positive IDs if any exists, else distinct names."""
    return F.when(F.col(ids) > 0, F.col(ids)).otherwise(F.col(names))


def distinct_accounts(df: DataFrame) -> DataFrame:
    """One row: distinct positive IDs if any exists, else distinct trimmed names."""
    return distinct_values(df, _account_figures(df)).select(_accounts("ids", "names").alias("distinct_accounts"))


def row_audit(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One row: total rows and rows passing each stage predicate, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in stages.items()])


def sufficiency(accounts: DataFrame, prospects: DataFrame, threshold: int) -> DataFrame:
    """Accounts with ``prospect_count`` and ``segment``: none (0), few
    (0 < n < threshold), sufficient."""
    counted = with_prospect_counts(accounts, prospects)
    n = F.col("prospect_count")
    return counted.withColumn(
        "segment", F.when(n == 0, F.lit("none")).when(n < threshold, F.lit("few")).otherwise(F.lit("sufficient")))


def insufficient_accounts(accounts: DataFrame, prospects: DataFrame, threshold: int) -> DataFrame:
    """Accounts needing more prospects: segment none, then few."""
    return sufficiency(accounts, prospects, threshold).where(F.col("segment") != "sufficient")


def coverage_report(accounts: DataFrame, prospects: DataFrame, threshold: int, population: DataFrame | None = None) -> DataFrame:
    """One-row coverage report with the nine figures of the reference.

    ``population`` are the accounts to report on; prospects are counted against it (default: ``accounts``).
    Prospects are read once for all distinct figures and the total, accounts once for theirs
    (`distinct_values`); the two rows meet as scalar subqueries."""
    seg = sufficiency(population if population is not None else accounts, prospects, threshold)
    p = _account_figures(prospects)
    found = distinct_values(prospects, {"emails": nonblank("email"), "linkedins": nonblank("linkedin_url"), "ids": p["ids"], "names": p["names"]})
    found = found.select(F.struct("emails", "linkedins", _accounts("ids", "names").alias("accounts")).alias("s")).scalar()
    n = F.col("prospect_count")
    all_, few = _account_figures(seg), _account_figures(seg, n < threshold)
    known = distinct_values(seg, {"ids": all_["ids"], "names": all_["names"], "few_ids": few["ids"], "few_names": few["names"]})
    known = known.select(F.struct(_accounts("ids", "names").alias("submitted"), _accounts("few_ids", "few_names").alias("needing")).alias("s")).scalar()
    total = prospects.agg(F.count(F.lit(1))).scalar()
    acc = seg.agg(F.count(F.lit(1)).alias("accounts_submitted"), F.count_if(n == 0).alias("accounts_without_prospects"),
                  F.count_if((n > 0) & (n < threshold)).alias("accounts_with_few_prospects"))
    with_figures = acc.withColumns({"_found": found, "_known": known})
    return with_figures.select(
        "accounts_submitted",
        total.alias("prospects_found"),
        F.col("_found.emails").alias("prospects_with_emails"),
        F.col("_found.linkedins").alias("prospects_with_linkedin"),
        F.col("_found.accounts").alias("accounts_with_prospects"),
        F.when(F.col("_known.submitted") > 0, F.ceil(F.lit(100.0) * F.col("_found.accounts") / F.col("_known.submitted")))
         .otherwise(F.lit(0)).cast("bigint").alias("enrichment_rate"),
        "accounts_without_prospects", "accounts_with_few_prospects",
        F.col("_known.needing").alias("accounts_needing_more"),
    )


def issue_summary(df: DataFrame, col: str = "issues") -> DataFrame:
    """Count per issue label, and of the rows that have any."""
    each = F.when(F.size(col) > 0, F.array_append(F.col(col), F.lit("Rows with issues")))
    return (df.select(F.explode(each).alias("issue"))
            .groupBy("issue").agg(F.count(F.lit(1)).alias("count")))


def over_quota_accounts(df: DataFrame, threshold: int, group: str = "account_name") -> DataFrame:
    """One row: distinct accounts with more than ``threshold`` prospects."""
    per = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count_if(F.col("n") > threshold).alias("accounts_over_quota"))


def completeness(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (column, present, missing, any_value): per requested column
    whether it exists, how many rows are NULL or '' and whether any value is
    non-NULL.  One aggregation over all present columns."""
    present = [c for c in cols if c in df.columns]
    aggs = []
    for i, c in enumerate(present):
        aggs += [F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias(f"m{i}"),
                 F.count_if(F.col(c).isNotNull()).alias(f"a{i}")]
    if not present:
        aggs = [F.count(F.lit(1)).alias("_n")]
    row = df.agg(*aggs)
    parts = []
    for c in cols:
        if c in present:
            i = present.index(c)
            parts.append(F.struct(F.lit(c).alias("column"), F.lit(True).alias("present"),
                                  F.col(f"m{i}").alias("missing"), (F.col(f"a{i}") > 0).alias("any_value")))
        else:
            parts.append(F.struct(F.lit(c).alias("column"), F.lit(False).alias("present"),
                                  F.lit(None).cast("bigint").alias("missing"),
                                  F.lit(False).alias("any_value")))
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def pair_checks(df: DataFrame, pairs: dict[str, tuple[str, str, str]]) -> DataFrame:
    """(check, first, second, proceed) per pair (kind, column, column): kind ``present`` asks for the
    column, ``any_value`` for a non-NULL value in it.  One aggregation over all columns asked for."""
    named = sorted({c for _, a, b in pairs.values() for c in (a, b)})
    have = {c: F.count_if(F.col(f"`{c}`").isNotNull()) > 0 for c in named if c in df.columns}
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[e.alias(c) for c, e in have.items()])

    def has(kind, c):
        return F.col(f"`{c}`") if kind == "any_value" and c in have else F.lit(c in have and kind == "present")
    checks = [F.struct(F.lit(n).alias("check"), has(k, a).alias("first"), has(k, b).alias("second"), (has(k, a) | has(k, b)).alias("proceed"))
              for n, (k, a, b) in pairs.items()]
    return row.select(F.explode(F.array(*checks)).alias("r")).select("r.*")


def repeated_keys(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys on several rows, with the number of rows and of different values (such as prospects
    that a deliverable tags twice): what a keep-first join passes over."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(value).alias("values")).where(F.col("rows") > 1))


def invalid_url_count(df: DataFrame, col: str = "website_url") -> DataFrame:
    return df.agg(F.count_if(~valid_url(col)).alias("invalid_urls"))


def column_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long form (column, max_len): longest text per column, one aggregation."""
    cols = cols or df.columns
    row = df.agg(*[F.max(F.length(F.coalesce(F.col(c).cast("string"), F.lit("")))).alias(f"l{i}")
                   for i, c in enumerate(cols)])
    parts = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"l{i}"), F.lit(0)).alias("max_len"))
             for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")

"""Keep-first deduplication and account linking joins.

Linking is a left equi-join of the large prospect side to an account side
that is first reduced to one row per key.  No broadcast hint is given for the
account side: it can hold 10^7 rows, so the choice is left to AQE, which turns
the join into a broadcast at run time only when the materialised side is below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the
sort-merge join (with skew splitting for hot keys on the prospect side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_col
from ..functions.values import null_if_missing, positive_id, trimmed
from .joins import left_lookup


def order_struct(order_by) -> Column:
    """Ascending, nulls-last ordering as one comparable struct."""
    fields = []
    for i, c in enumerate(order_by):
        c = as_col(c)
        fields += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*fields)


def first_per_key(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    """Keep the first row per key in ``order_by`` order (ascending, nulls last).

    A grouped ``min_by`` over a struct: partial aggregation runs map-side, so
    a hot key is combined before the shuffle.  Unlike ``dropDuplicates`` the
    kept row is deterministic."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    out = df.groupBy(*keys).agg(F.min_by(row, order_struct(order_by)).alias("_first"))
    return out.select(*keys, *[F.col("_first")[c].alias(c) for c in rest])


LINK_KEYS = {"custom_id", "website_url", "account_name", "company"}


def choose_link_key(columns: list[str], strategy: str) -> str:
    """Key choice by availability (driver side): custom_id -> website_url ->
    account_name (query name) -> error."""
    if strategy == "custom_id":
        return "custom_id"
    if strategy == "company_name":
        return "company"
    if strategy == "zi_fallback":
        for k in ("custom_id", "website_url", "account_name"):
            if k in columns:
                return k
        raise ValueError(f"cannot link accounts: none of custom_id, website_url, account_name in {columns}")
    raise ValueError(f"unknown link strategy {strategy!r}")


def link_accounts(df: DataFrame, accounts: DataFrame, on: str, dedupe: bool = True,
                  order_by=None, take=("account_name", "account_country", "tags")) -> DataFrame:
    """Attach account columns to prospects by one key (left join).

    ``on``: custom_id | website_url | account_name | company (company is
    matched against the account name).  Account keys are deduplicated keep-first;
    ``dedupe=False`` lets a prospect meet every account of its key.  Missing keys
    (NULL, blank, 'nan', '#' for URLs) and ID 0 never match.  Columns in ``take``
    replace same-named prospect columns.
    """
    acc_key = "account_name" if on == "company" else on
    order_by = order_by or ["account_name", "custom_id"]
    wanted = ([] if on == "custom_id" else ["custom_id"]) + list(take)
    bring = [c for c in wanted if c in accounts.columns and c != on]
    if on == "custom_id":
        key_r, key_l = positive_id_of(accounts, acc_key), positive_id_of(df, on)
        key_r, key_l = F.nullif(key_r, F.lit(0)), F.nullif(key_l, F.lit(0))
    else:
        tokens = ("#",) if on == "website_url" else ()
        key_r, key_l = null_if_missing(acc_key, tokens), null_if_missing(on, tokens)
    side = accounts.withColumn("_lk", key_r).where(F.col("_lk").isNotNull())
    if dedupe:
        side = first_per_key(side, ["_lk"], order_by)
    side = side.select("_lk", *[F.col(c).alias(f"_acc_{c}") for c in bring])
    joined = left_lookup(df.withColumn("_lk", key_l), side, ["_lk"])
    keep = [c for c in df.columns if c not in bring]
    return joined.select(*[F.col(f"`{c}`") for c in keep],
                         *[F.col(f"_acc_{c}").alias(c) for c in bring])


def enrich_from(accounts: DataFrame, master: DataFrame, key: str = "custom_id",
                fill=("website_url", "country"), min_id: int = 10000, order_by=("crm_row",)) -> DataFrame:
    """Fill missing fields of accounts with ID >= ``min_id`` from a master
    table (deduplicated keep-first on the key); each field independently."""
    m = first_per_key(master.where(F.col(key).isNotNull()), [key], list(order_by))
    m = m.select(F.col(key).alias("_mk"), *[F.col(c).alias(f"_m_{c}") for c in fill])
    j = accounts.join(m, accounts[key] == m["_mk"], "left")
    eligible = (F.col(key) >= min_id) & F.col("_mk").isNotNull()
    missing = {c: null_if_missing(c).isNull() for c in fill}
    out = {c: F.when(eligible & missing[c], F.col(f"_m_{c}")).otherwise(F.col(c)) for c in fill}
    return j.withColumns(out).select(*accounts.columns)


def repair_ids(df: DataFrame, accounts: DataFrame, order_by=("account_name", "custom_id")) -> DataFrame:
    """Missing account ID -> ID of the first account with the same name; no
    match -> 0.  A blank name (or 'nan') is no name and takes no ID.  Decision: a row without an ID is repaired whether or not other rows
    have one, so a row's result does not depend on the rest of its file."""
    named = accounts.withColumn("_an", null_if_missing("account_name")).where(F.col("_an").isNotNull())
    m = first_per_key(named, ["_an"], list(order_by)).select("_an", F.col("custom_id").alias("_cid"))
    j = left_lookup(df.withColumn("_an", null_if_missing("account_name")), m, ["_an"])
    return j.withColumn("custom_id", F.coalesce(F.col("custom_id"), F.col("_cid"), F.lit(0).cast("bigint"))) \
            .select(*df.columns)


def positive_id_of(df: DataFrame, col: str) -> Column:
    """Positive-ID expression that skips the text round trip for integral
    columns."""
    if isinstance(df.schema[col].dataType, T.IntegralType):
        return F.greatest(F.coalesce(F.col(col).cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
    return positive_id(col)


def with_prospect_counts(accounts: DataFrame, prospects: DataFrame) -> DataFrame:
    """Add ``prospect_count`` per account: by positive ID when any prospect has
    one, else by trimmed account name; accounts without prospects get 0.

    The choice is a scalar subquery inside the same plan (evaluated once), so
    both the count and the join stay distributed.  The join key is a pair of
    typed columns (ID, name) of which the unused one is NULL, matched
    null-safely, so a numeric ID is never turned into text.
    """
    p_id = positive_id_of(prospects, "custom_id")
    a_id = positive_id_of(accounts, "custom_id")
    has_ids = prospects.select(F.max(p_id) > 0).scalar()
    null_id, null_name = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    counts = (prospects.select(F.when(has_ids, F.when(p_id > 0, p_id)).otherwise(null_id).alias("_ck_id"),
                               F.when(has_ids, null_name).otherwise(trimmed("account_name")).alias("_ck_nm"))
              .where(F.col("_ck_id").isNotNull() | F.col("_ck_nm").isNotNull())
              .groupBy("_ck_id", "_ck_nm").agg(F.count(F.lit(1)).alias("_cnt")))
    keyed = accounts.withColumns({
        "_ck_id": F.when(has_ids, a_id).otherwise(null_id),
        "_ck_nm": F.when(has_ids, null_name).otherwise(trimmed("account_name"))})
    a, c = keyed.alias("a"), counts.alias("c")
    j = a.join(c, F.col("a._ck_id").eqNullSafe(F.col("c._ck_id")) & F.col("a._ck_nm").eqNullSafe(F.col("c._ck_nm")),
               "left")
    return j.select("a.*", F.coalesce(F.col("c._cnt"), F.lit(0)).cast("bigint").alias("prospect_count")) \
            .drop("_ck_id", "_ck_nm")

"""Order-dependent identity operators: duplicates, dense IDs, quota numbers.

No operator here numbers rows through a window without partition (that plans
``Exchange SinglePartition``) and no group is ever collected into one task.

``range_index`` numbers rows in a global order (or one per partition) by sampled ranges
and a two-level prefix sum.  ``ordered_index`` gives each row its 1-based position in a total order
(optionally within a partition) by tiers: counts per key prefix are
aggregated map-side, running offsets are computed on those small aggregated
tables, and only the finest tier is numbered row by row.  A hot prefix (say a
third of all prospects without an account) is therefore split by the next
order key before any row-level window runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..functions.values import is_blank, trimmed
from ..session import written
from .joins import left_lookup


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def ordered_index(df: DataFrame, order_by: list, tiers: list[int], partition_by: list[str] = (),
                  name: str = "_idx") -> DataFrame:
    """Add ``name`` = position (1..n) of each row in ``order_by`` (ascending,
    nulls last) within ``partition_by``.

    ``tiers`` are increasing prefix lengths of ``order_by``: e.g. ``[1, 2]``
    numbers (account) groups, then (account, first name) groups inside them,
    then rows inside those.  ``order_by`` must be a total order (end it with a
    unique tie-break) for the numbering to be deterministic.
    """
    partition_by = list(partition_by)
    keys = [f"_ok{i}" for i in range(len(order_by))]
    base = df.withColumns({k: as_col(c) for k, c in zip(keys, order_by)})
    finest = tiers[-1]
    group = partition_by + keys[:finest]

    w_rows = Window.partitionBy(*group).orderBy(*[F.col(k).asc_nulls_last() for k in keys[finest:]])
    rows = base.withColumn("_rn", F.row_number().over(w_rows))

    counts = base.groupBy(*group).agg(F.count(F.lit(1)).alias("_n0"))
    offsets = None
    prev = 0
    for t_i, t in enumerate(tiers):
        tier_keys = partition_by + keys[:t]
        agg = counts.groupBy(*tier_keys).agg(F.sum("_n0").alias("_n")) if t != finest else \
            counts.withColumnRenamed("_n0", "_n")
        w = (Window.partitionBy(*(partition_by + keys[:prev]))
             .orderBy(*[F.col(k).asc_nulls_last() for k in keys[prev:t]])
             .rowsBetween(Window.unboundedPreceding, -1))
        off = agg.select(*tier_keys, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(f"_off{t_i}"))
        offsets = off if offsets is None else _join_tier(off, offsets, partition_by + keys[:prev])
        prev = t
    total = reduce(lambda a, b: a + b, [F.col(f"_off{i}") for i in range(len(tiers))])
    offsets = offsets.select(*group, total.alias("_off"))
    r, o = rows.alias("r"), offsets.alias("o")
    joined = r.join(o, reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in group]),
                    "left")
    out = joined.select("r.*", (F.col("o._off") + F.col("r._rn")).alias(name))
    return out.drop("_rn", *keys)


def range_index(df: DataFrame, order_by: list, partition_by: list[str] = (), name: str = "_idx") -> DataFrame:
    """Add ``name`` = position (1..n) of each row in ``order_by`` (Columns or names; asc or
    desc as given) within ``partition_by``, whatever the number of rows or their skew.

    Rows are dealt by ranges of (partition_by, order_by) whose splitters Spark samples from
    the data, sorted inside each range and written with their range number and place, so no
    reader can see other ranges.  A two-level prefix sum gives the rest: rows per range, and
    the offset of each range among those of its partition.  Only one row per range (and
    partition) is summed up.  A hot partition spans many ranges; rows that are equal in all
    of ``order_by`` share one range, so end it with a tie-break where many may be equal.
    The written table is narrow if ``df`` is: select what is needed first."""
    partition_by = list(partition_by)
    keys = [F.col(f"`{c}`").asc() for c in partition_by] + [F.col(c) if isinstance(c, str) else c for c in order_by]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = written(dealt.withColumns({"_range": F.spark_partition_id(),
                                      "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    runs = rows.groupBy(*partition_by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    else:
        before, offsets = 0, []
        for r, n in sorted((r["_range"], r["_n"]) for r in runs.select("_range", "_n").collect()):  # one row per range
            offsets.append((r, before, 0))
            before += n
        runs = df.sparkSession.createDataFrame(offsets, "_range int, _before long, _first long")
    r, o = rows.alias("r"), F.broadcast(runs.alias("o")) if not partition_by else runs.alias("o")
    on = reduce(lambda a, b: a & b, [F.col(f"r.`{c}`").eqNullSafe(F.col(f"o.`{c}`")) for c in [*partition_by, "_range"]])
    at = F.col("o._before") + F.col("r._at") - F.col("o._first") + 1
    return r.join(o, on).select(*[F.col(f"r.`{c}`") for c in df.columns], at.alias(name))


def _join_tier(finer: DataFrame, coarser: DataFrame, coarse_keys: list[str]) -> DataFrame:
    """Attach a coarser tier's offset to every row of a finer tier table."""
    f, c = finer.alias("f"), coarser.alias("c")
    cond = reduce(lambda a, b: a & b, [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in coarse_keys])
    off_cols = [x for x in coarser.columns if x.startswith("_off")]
    return f.join(c, cond, "left").select("f.*", *[F.col(f"c.{x}") for x in off_cols])


def assign_ids(df: DataFrame, prefix: str, order_by: list, col: str = "prospect_id") -> DataFrame:
    """Dense global prospect IDs in ``order_by`` order (ascending, nulls last): prefix + number
    padded to four digits (wider past 9999).  ``format_string`` is used because
    ``lpad`` would truncate 12345 to 1234.  Numbered by ``range_index``: no task sees
    more than its range, and no window runs over all rows or all accounts."""
    out = range_index(df, [as_col(c).asc_nulls_last() for c in order_by], name="_seq")
    return out.withColumn(col, F.format_string(prefix + "%04d", F.col("_seq"))).drop("_seq")


def duplicates_prepare(df: DataFrame, keys: list, eligible: Column | None = None, tag: str = "") -> DataFrame:
    eligible = eligible if eligible is not None else F.lit(True)
    kcols = [f"_dk{tag}{i}" for i in range(len(keys))]
    base = df.withColumns({k: as_col(c) for k, c in zip(kcols, keys)})
    return base.withColumn(f"_elig{tag}", eligible & reduce(lambda a, b: a & b,
                                                             [F.col(k).isNotNull() for k in kcols]))


def duplicates_lookup(prepared: DataFrame, tag: str = "") -> DataFrame:
    kcols = [c for c in prepared.columns if c.startswith(f"_dk{tag}") and c[len(f"_dk{tag}"):].isdigit()]
    elig = F.col(f"_elig{tag}")
    return (prepared.select(*[F.when(elig, F.col(k)).alias(k) for k in kcols])
            .groupBy(*kcols).agg(F.count(F.lit(1)).alias(f"_c{tag}"))
            .where(F.col(f"_c{tag}") > 1).select(*kcols, F.lit(True).alias(f"_dup{tag}")))


def duplicates_attach(prepared: DataFrame, lookup: DataFrame, name: str, tag: str = "") -> DataFrame:
    kcols = [c for c in lookup.columns if c.startswith(f"_dk{tag}")]
    j = left_lookup(prepared, lookup, kcols)
    return j.withColumn(name, F.col(f"_elig{tag}") & F.coalesce(F.col(f"_dup{tag}"), F.lit(False))) \
            .drop(*kcols, f"_elig{tag}", f"_dup{tag}")


def flag_duplicates(df: DataFrame, keys: list, eligible: Column | None = None,
                    name: str = "is_duplicate") -> DataFrame:
    """Mark every member of a group of two or more rows sharing ``keys``.

    Count-then-join: the counts are a map-side-combined aggregation (a hot
    key costs one partial row per task), and only duplicate keys are joined
    back.  Rows with a NULL key or outside ``eligible`` are never flagged."""
    p = duplicates_prepare(df, keys, eligible)
    return duplicates_attach(p, duplicates_lookup(p), name)


def person_key(first, last) -> Column:
    """lower(trim(first)) + '_' + lower(trim(last)); NULL when either is blank.
    Decision: a row with one blank name is never a duplicate (the rule for missing
    names reports it), though others may share the name that it has."""
    f, l = as_col(first), as_col(last)
    return F.when(~is_blank(f) & ~is_blank(l),
                  F.concat(F.lower(trimmed(f)), F.lit("_"), F.lower(trimmed(l))))


def swapped_key(first, last) -> Column:
    """Order-free person key: the sorted pair of lower/trimmed names."""
    f, l = as_col(first), as_col(last)
    return F.when(~is_blank(f) & ~is_blank(l),
                  F.array_join(F.sort_array(F.array(F.lower(trimmed(f)), F.lower(trimmed(l)))), "_"))


def flag_person_duplicates(df: DataFrame, swapped: bool = False, first="first_name", last="last_name",
                           name: str = "is_duplicate") -> DataFrame:
    """Duplicate people over the whole set.  ``swapped`` also matches reversed
    first/last names."""
    key = swapped_key(first, last) if swapped else person_key(first, last)
    return flag_duplicates(df, [key], name=name)


def quota_label(df: DataFrame, threshold: int, order_by: list, group: str = "account_name",
                tiers: list[int] = ()) -> DataFrame:
    """``account_range``: 'OK' when the account has at most ``threshold``
    prospects, else 'Extra k' with k = 1..n in ``order_by`` order for every
    member (the reference labels all members); ``beyond_quota`` = k > threshold.
    NULL account -> NULL label.

    Counts come from a grouped aggregation and only rows of over-quota
    accounts are numbered.  With ``tiers`` (prefix lengths of ``order_by``,
    e.g. source rank and an ID bucket) a hot account is numbered in
    order-preserving pieces instead of one window partition."""
    counts = (df.where(F.col(group).isNotNull()).groupBy(group)
              .agg(F.count(F.lit(1)).alias("_gcount")))
    j = left_lookup(df, counts, [group])
    over = j.where(F.col("_gcount") > threshold)
    rest = j.where(F.col("_gcount").isNull() | (F.col("_gcount") <= threshold))
    if tiers:
        numbered = ordered_index(over, list(order_by), list(tiers), partition_by=[group], name="_k")
    else:
        numbered = over.withColumn("_k", F.row_number().over(
            Window.partitionBy(group).orderBy(*[as_col(c).asc_nulls_last() for c in order_by])))
    numbered = numbered.withColumns({
        "account_range": F.concat(F.lit("Extra "), F.col("_k").cast("string")),
        "beyond_quota": F.col("_k") > threshold})
    rest = rest.withColumns({
        "account_range": F.when(F.col("_gcount").isNotNull(), F.lit("OK")),
        "beyond_quota": F.when(F.col("_gcount").isNotNull(), F.lit(False))})
    return numbered.drop("_k", "_gcount").unionByName(rest.drop("_gcount"))

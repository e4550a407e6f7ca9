"""Multi-source union, edit reconciliation and the final tag join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import drop_existing, upload_names
from .link import first_per_key

# Columns whose edited value always wins (the human-owned part of the sheet).
PROTECTED = {
    "issue", "account_range", "custom_id", "account_name", "first_name", "last_name", "title",
    "gender", "email", "domain_score_label", "linkedin_url", "company_linkedin", "work_phone",
    "mobile_phone", "city", "state", "zip", "country", "tags", "prospect_id",
}


def union_sources(sources: list[tuple[DataFrame, int]], rank_col: str = "source_rank") -> DataFrame:
    """Union by column name (missing columns NULL), earlier sources first via
    ``source_rank``.  Narrow: no shuffle."""
    out = None
    for df, rank in sources:
        d = df.withColumn(rank_col, F.lit(rank))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def reconcile(edited: DataFrame, original: DataFrame, key: str = "prospect_id",
              protected: set[str] = frozenset(PROTECTED), order_by=None, unique: bool = False) -> DataFrame:
    """Edited rows enriched from the original sample on ``key``.

    Protected columns keep the edited value; other shared columns are
    ``coalesce(edited, original)``; columns only in the original are added;
    rows missing from the edit stay gone.  The original is reduced to one row per key so the
    join never fans out: the first by ``order_by``, else by a hash of the whole row (the same
    row every time, whatever the partitions).  ``unique`` says that the key is unique in the
    original (IDs that `identity.assign_ids` gave), which saves that step."""
    orig = original.where(F.col(key).isNotNull())
    if not unique:
        orig = first_per_key(orig, [key], order_by or [F.xxhash64(*[F.col(f"`{c}`") for c in sorted(orig.columns)])])
    e, o = edited.alias("e"), orig.alias("o")
    j = e.join(o, F.col(f"e.{key}") == F.col(f"o.{key}"), "left")
    cols = []
    for c in edited.columns:
        if c in orig.columns and c not in protected and c != key:
            cols.append(F.coalesce(F.col(f"e.`{c}`"), F.col(f"o.`{c}`")).alias(c))
        else:
            cols.append(F.col(f"e.`{c}`").alias(c))
    cols += [F.col(f"o.`{c}`").alias(c) for c in orig.columns if c not in edited.columns]
    return j.select(*cols)


def final_tags(prospects: DataFrame, deliverable: DataFrame, drop_source: bool = False,
               key: str = "prospect_id") -> DataFrame:
    """Prospect export with the deliverable's tags: upload renames, own tags
    replaced by the deliverable's (one per prospect, keep-first by tag), then
    the key (and for some sources the source) dropped."""
    p = upload_names(prospects)
    p = drop_existing(p, ["tags"])
    tags = first_per_key(deliverable.select(key, "tags").where(F.col(key).isNotNull()), [key], ["tags"])
    out = p.join(tags, key, "left")
    drop = [key] + (["source"] if drop_source else [])
    return drop_existing(out, drop)

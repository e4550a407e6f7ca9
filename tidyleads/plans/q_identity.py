"""Registered queries for identity, order, union and reconciliation
(W-2..W-5, A-12, U-1, P-10, P-12, J-8, J-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import title_case
from ..operators import columns as cols
from ..operators import identity, link, reconcile, report
from . import sqltext as S
from .catalogue import register
from .fixtures import fixture, sql_with
from .q_linking import ACC_ORDER, ACC_SQL, PRO_SQL, _ACC_FIRST_BY_ID, accounts_typed, prospects_typed

QUOTA = 10
SRANK_SQL = "CASE vendor WHEN 'O' THEN 0 WHEN 'Z' THEN 1 ELSE 2 END"


def _srank():
    return F.when(F.col("vendor") == "O", 0).when(F.col("vendor") == "Z", 1).otherwise(2)


_PK = f"""CASE WHEN NOT {S.is_blank('first_name')} AND NOT {S.is_blank('last_name')}
  THEN lower({S.trimmed('first_name')}) || '_' || lower({S.trimmed('last_name')}) END"""
_SK = f"""CASE WHEN NOT {S.is_blank('first_name')} AND NOT {S.is_blank('last_name')}
  THEN array_to_string(list_sort([lower({S.trimmed('first_name')}), lower({S.trimmed('last_name')})]), '_') END"""


@register("person_duplicates", sql_with("fx_prospects") + f"""
, k AS (SELECT row_key, {_PK} AS key FROM fx_prospects),
d AS (SELECT key FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1)
SELECT row_key, (key IS NOT NULL AND key IN (SELECT key FROM d)) AS is_duplicate FROM k""")
def q_person_duplicates(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select("row_key", "first_name", "last_name")
    return identity.flag_person_duplicates(p).select("row_key", "is_duplicate")


@register("swapped_duplicates", sql_with("fx_prospects") + f"""
, k AS (SELECT row_key, {_SK} AS key FROM fx_prospects),
d AS (SELECT key FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1)
SELECT row_key, (key IS NOT NULL AND key IN (SELECT key FROM d)) AS is_duplicate FROM k""")
def q_swapped_duplicates(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select("row_key", "first_name", "last_name")
    return identity.flag_person_duplicates(p, swapped=True).select("row_key", "is_duplicate")


@register("prospect_ids", sql_with("fx_prospects") + """
SELECT row_key, printf('O%04d', row_number() OVER (
         ORDER BY company NULLS LAST, first_name NULLS LAST, last_name NULLS LAST, row_key)) AS prospect_id
FROM fx_prospects""")
def q_prospect_ids(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select("row_key", "company", "first_name", "last_name")
    out = identity.assign_ids(p, "O", ["company", "first_name", "last_name", "row_key"])
    return out.select("row_key", "prospect_id")


@register("quota_labels", sql_with("fx_prospects") + f"""
, q AS (SELECT row_key, company,
               count(*) OVER (PARTITION BY company) AS n,
               row_number() OVER (PARTITION BY company ORDER BY {SRANK_SQL}, row_key) AS k
        FROM fx_prospects)
SELECT row_key, CASE WHEN n <= {QUOTA} THEN 'OK' ELSE 'Extra ' || CAST(k AS VARCHAR) END AS account_range,
       (n > {QUOTA} AND k > {QUOTA}) AS beyond_quota
FROM q""")
def q_quota_labels(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select("row_key", F.col("company").alias("account_name"), "vendor")
    order = [_srank(), F.floor(F.col("row_key") / 1024), F.col("row_key")]
    out = identity.quota_label(p, QUOTA, order_by=order, group="account_name", tiers=[2])
    return out.select("row_key", "account_range", "beyond_quota")


@register("over_quota", sql_with("fx_prospects") + f"""
SELECT count(*) AS accounts_over_quota FROM (
  SELECT company FROM fx_prospects WHERE company IS NOT NULL GROUP BY company HAVING count(*) > {QUOTA})""")
def q_over_quota(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select(F.col("company").alias("account_name"))
    return report.over_quota_accounts(p, QUOTA)


@register("source_union", sql_with("fx_prospects") + """
SELECT * FROM (
  SELECT row_key, custom_id, first_name, last_name, email, 0 AS source_rank FROM fx_prospects WHERE vendor = 'O'
  UNION ALL BY NAME
  SELECT row_key, custom_id, first_name, last_name, email, linkedin_url, country, 1 AS source_rank
  FROM fx_prospects WHERE vendor = 'Z'
  UNION ALL BY NAME
  SELECT row_key, custom_id, first_name, last_name, title, gender, work_phone, 2 AS source_rank
  FROM fx_prospects WHERE vendor = 'L')""")
def q_source_union(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    base = ["row_key", "custom_id", "first_name", "last_name"]
    o = p.where("vendor = 'O'").select(*base, "email")
    z = p.where("vendor = 'Z'").select(*base, "email", "linkedin_url", "country")
    l_ = p.where("vendor = 'L'").select(*base, "title", "gender", "work_phone")
    return reconcile.union_sources([(o, 0), (z, 1), (l_, 2)])


@register("same_country", sql_with("fx_prospects") + """
SELECT row_key, country FROM fx_prospects WHERE account_country = country""")
def q_same_country(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select("row_key", "country", "account_country")
    return cols.same_country(p).select("row_key", "country")


@register("tagged", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + _ACC_FIRST_BY_ID + f"""
SELECT p.row_key, a1.tags
FROM pro p LEFT JOIN a1 ON a1.custom_id = (CASE WHEN p.custom_id > 0 THEN p.custom_id END)
WHERE {S.null_if_missing('a1.tags')} IS NOT NULL""")
def q_tagged(spark, sf):
    p = prospects_typed(spark, sf).select("row_key", "custom_id")
    linked = link.link_accounts(p, accounts_typed(spark, sf), on="custom_id", order_by=ACC_ORDER)
    return cols.tagged_only(linked).select("row_key", "tags")


def _original(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.withColumn("prospect_id", F.concat(F.lit("P"), F.col("row_key").cast("string"))) \
            .withColumnRenamed("company", "account_name")


@register("reconcile_edits", sql_with("fx_edits") + """
, o AS (SELECT *, 'P' || CAST(row_key AS VARCHAR) AS prospect_id FROM fx_prospects)
SELECT e.prospect_id, e.custom_id, e.account_name, e.first_name, e.last_name, e.title, e.gender, e.email,
       e.linkedin_url, e.work_phone, e.mobile_phone, e.city, e.state, e.zip, e.country,
       coalesce(e.source, o.source) AS source,
       o.row_key, o.vendor, o.website, o.account_country, o.contact_status
FROM fx_edits e LEFT JOIN o ON o.prospect_id = e.prospect_id""")
def q_reconcile_edits(spark, sf):
    edited = fixture(spark, sf, "fx_edits")
    return reconcile.reconcile(edited, _original(spark, sf))


@register("final_tags", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + _ACC_FIRST_BY_ID + """
, d AS (SELECT 'P' || CAST(p.row_key AS VARCHAR) AS prospect_id, a1.tags
        FROM pro p LEFT JOIN a1 ON a1.custom_id = (CASE WHEN p.custom_id > 0 THEN p.custom_id END))
SELECT p.row_key, p.custom_id AS account_custom_id, p.company, p.first_name, p.last_name, p.email, d.tags
FROM pro p LEFT JOIN d ON d.prospect_id = 'P' || CAST(p.row_key AS VARCHAR)""")
def q_final_tags(spark, sf):
    p = prospects_typed(spark, sf)
    p = p.withColumn("prospect_id", F.concat(F.lit("P"), F.col("row_key").cast("string")))
    linked = link.link_accounts(p.select("prospect_id", "custom_id"), accounts_typed(spark, sf),
                                on="custom_id", order_by=ACC_ORDER)
    export = p.select("row_key", "custom_id", "company", "first_name", "last_name", "email", "source",
                      F.lit("old").alias("tags"), "prospect_id")
    return reconcile.final_tags(export, linked, drop_source=True)


@register("title_cased_people", sql_with("fx_prospects") + f"""
SELECT row_key, {S.title_case('first_name')} AS first_name, {S.title_case('last_name')} AS last_name,
       ({S.is_blank(S.title_case('first_name'))} OR {S.is_blank(S.title_case('last_name'))}) AS bad_name
FROM fx_prospects""")
def q_title_cased_people(spark, sf):
    from ..functions.contact import bad_name
    p = fixture(spark, sf, "fx_prospects")
    t = p.select("row_key", title_case("first_name").alias("first_name"), title_case("last_name").alias("last_name"))
    return t.withColumn("bad_name", bad_name("first_name", "last_name"))

"""Registered queries for the jobs (L-2..L-6): whole-fixture runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import link, report
from ..session import written
from . import jobs
from . import sqltext as S
from .catalogue import register
from .fixtures import fixture, sql_with
from .q_linking import ACC_ORDER, ACC_SQL, PRO_SQL, _ACC_FIRST_BY_ID, accounts_typed, prospects_typed

THRESHOLD = 3


def vendor_rows(spark, sf, spec):
    """The vendor's rows of the prospect fixture under the headers of its files."""
    p = fixture(spark, sf, "fx_prospects").where(F.col("vendor") == spec.prefix)
    named = {c: h for h, c in spec.headers.items() if c != "account_name"}
    return p.select(*[F.col(c).alias(named[c]) for c in p.columns if c in named])


def _issues(spec):
    def run(spark, sf):
        main = vendor_rows(spark, sf, spec)
        acc = accounts_typed(spark, sf)
        sample = written(jobs.prepare_source(spec, main, acc))
        out = jobs.prospect_issues(spec, sample, acc, threshold=THRESHOLD)
        return out.select("prospect_id", "account_name", "first_name", "last_name", "gender",
                          "email", "country", "work_phone", "source", "issue", "account_range",
                          "domain_score_label", "plausible_gender")
    return run


register("issues_source_o")(_issues(jobs.OUTREACH))
register("issues_source_z")(_issues(jobs.ZOOMINFO))
register("issues_source_l")(_issues(jobs.LEADGENIUS))


def _sample(spark, sf):
    p = prospects_typed(spark, sf).withColumn("prospect_id", F.concat(F.lit("P"), F.col("row_key").cast("string")))
    return link.link_accounts(p, accounts_typed(spark, sf), on="custom_id", order_by=ACC_ORDER)


@register("deliverable", sql_with("fx_accounts", "fx_prospects", "fx_edits") + ACC_SQL + PRO_SQL + _ACC_FIRST_BY_ID + f"""
, s AS (SELECT 'P' || CAST(p.row_key AS VARCHAR) AS prospect_id, p.source, a1.tags
        FROM pro p LEFT JOIN a1 ON a1.custom_id = (CASE WHEN p.custom_id > 0 THEN p.custom_id END))
SELECT {S.positive_id('e.custom_id')} AS custom_id, {S.trimmed('e.account_name')} AS account_name, s.tags,
       e.first_name, e.last_name, e.title, e.gender, e.email, e.linkedin_url, e.work_phone, e.mobile_phone,
       coalesce(e.source, s.source) AS source, e.city, e.state, e.zip, e.country, e.prospect_id
FROM fx_edits e LEFT JOIN s ON s.prospect_id = e.prospect_id
WHERE {S.null_if_missing('s.tags')} IS NOT NULL""")
def q_deliverable(spark, sf):
    return jobs.deliverable(fixture(spark, sf, "fx_edits"), _sample(spark, sf))


def _upload(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.select(F.col("custom_id").alias(" custom_id "), F.col("first_name").alias("first_name  "),
                    "last_name", "email", "work_phone", "country", "source", "gender", "title")


@register("upload_export", sql_with("fx_prospects") + S.COUNTRY_CODES + f"""
SELECT {S.to_long0('custom_id')} AS account_custom_id, first_name, last_name, email,
       {S.phone_plus('work_phone')} AS work_phone,
       {S.option_code(S.country_to_code('country'))} AS country, source, gender, title
FROM fx_prospects""")
def q_upload_export(spark, sf):
    return jobs.upload_export(_upload(spark, sf))


def _upload_checks_sql():
    parts = []
    for c in jobs.UPLOAD_CHECK_COLS + ["custom_id", "account_name"]:
        if c == "account_name":
            parts.append(f"SELECT '{c}' AS \"column\", false AS present, CAST(NULL AS BIGINT) AS missing, "
                         f"false AS any_value")
        else:
            parts.append(f"SELECT '{c}' AS \"column\", true AS present, "
                         f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS missing, "
                         f"count({c}) > 0 AS any_value FROM fx_prospects")
    return "\nUNION ALL ".join(parts)


@register("upload_checks", sql_with("fx_prospects") + _upload_checks_sql())
def q_upload_checks(spark, sf):
    return jobs.upload_checks(_upload(spark, sf))


@register("upload_pairs", sql_with("fx_prospects") + """
SELECT 'ID or name' AS "check", true AS first, false AS second, true AS proceed
UNION ALL SELECT 'email or phone', count(email) > 0, count(work_phone) > 0, count(email) > 0 OR count(work_phone) > 0 FROM fx_prospects""")
def q_upload_pairs(spark, sf):
    return jobs.upload_pairs(_upload(spark, sf))


@register("deliverable_labelled", sql_with("fx_accounts", "fx_prospects", "fx_edits") + ACC_SQL + PRO_SQL + _ACC_FIRST_BY_ID + f"""
, s AS (SELECT 'P' || CAST(p.row_key AS VARCHAR) AS prospect_id, p.source, a1.tags
        FROM pro p LEFT JOIN a1 ON a1.custom_id = (CASE WHEN p.custom_id > 0 THEN p.custom_id END))
SELECT e.prospect_id, CASE WHEN {S.is_blank('coalesce(e.source, s.source)')} THEN 'ZoomInfo' ELSE coalesce(e.source, s.source) END AS source
FROM fx_edits e LEFT JOIN s ON s.prospect_id = e.prospect_id
WHERE {S.null_if_missing('s.tags')} IS NOT NULL""")
def q_deliverable_labelled(spark, sf):
    """J-9: rows without a source take the vendor's label."""
    found = jobs.deliverable(fixture(spark, sf, "fx_edits"), _sample(spark, sf), label=jobs.ZOOMINFO.label, unique=True)
    return found.select("prospect_id", "source")


@register("repeated_tags", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + f"""
, linked AS (SELECT p.row_key, a.tags FROM pro p JOIN acc a ON a.account_name = p.company AND {S.null_if_missing('p.company')} IS NOT NULL)
SELECT row_key, count(*) AS rows, count(DISTINCT tags) AS values FROM linked GROUP BY row_key HAVING count(*) > 1""")
def q_repeated_tags(spark, sf):
    """J-10: prospects that several accounts of their name tag."""
    p = prospects_typed(spark, sf).select("row_key", "company")
    linked = link.link_accounts(p, accounts_typed(spark, sf), on="company", dedupe=False)
    return report.repeated_keys(linked, "row_key", "tags")

"""Registered queries for account setup and linking (W-1, J-1..J-7, A-1, L-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import contact as C
from ..functions import geo
from ..functions.values import is_blank, to_long0
from ..operators import columns as cols
from ..operators import link, report
from ..operators.identity import flag_duplicates, range_index
from . import sqltext as S
from .catalogue import register
from .fixtures import fixture, sql_with

ACC_ORDER = ["account_name", "row_key"]


def accounts_typed(spark, sf):
    """The cleaned account list as the prospect jobs read it."""
    a = fixture(spark, sf, "fx_accounts")
    return a.select("row_key", to_long0("custom_id").alias("custom_id"), "account_name",
                    F.col("country").alias("account_country"), "tags", "website_url")


def prospects_typed(spark, sf):
    return fixture(spark, sf, "fx_prospects").withColumn("custom_id", to_long0("custom_id"))


ACC_SQL = f""", acc AS (
  SELECT row_key, {S.to_long0('custom_id')} AS custom_id, account_name, country AS account_country,
         tags, website_url FROM fx_accounts)
"""
PRO_SQL = f""", pro AS (SELECT * REPLACE ({S.to_long0('custom_id')} AS custom_id) FROM fx_prospects)
"""
NUM_ACC_SQL = f""", a AS (
  SELECT row_key, {S.to_long0('custom_id')} AS custom_id, account_name, tags, website_url, country
  FROM fx_accounts WHERE {S.is_numeric('custom_id')})
"""


def numeric_accounts(spark, sf):
    a = cols.keep_numeric(fixture(spark, sf, "fx_accounts"), "custom_id")
    return a.withColumn("custom_id", to_long0("custom_id"))


def crm_typed(spark, sf):
    m = cols.keep_numeric(fixture(spark, sf, "fx_crm"), "business_partner_id")
    return m.select(to_long0("business_partner_id").alias("custom_id"),
                    F.col("account_web_address").alias("website_url"),
                    F.col("country_descr").alias("country"), "crm_row")


def _dup_flags(a):
    a = flag_duplicates(a, ["custom_id"], eligible=F.col("custom_id") >= 10000, name="dup_id")
    return flag_duplicates(a, ["account_name"], eligible=~is_blank("account_name"), name="dup_name")


_DUP_SQL = f""", di AS (SELECT custom_id FROM a WHERE custom_id >= 10000 GROUP BY custom_id HAVING count(*) > 1),
dn AS (SELECT account_name FROM a WHERE NOT {S.is_blank('account_name')} GROUP BY account_name HAVING count(*) > 1)
"""
_DUP_COLS = f"""(a.custom_id >= 10000 AND a.custom_id IN (SELECT custom_id FROM di)) AS dup_id,
       (NOT {S.is_blank('a.account_name')} AND a.account_name IN (SELECT account_name FROM dn)) AS dup_name"""


@register("account_duplicates", sql_with("fx_accounts") + NUM_ACC_SQL + _DUP_SQL + f"""
SELECT a.row_key, a.custom_id, a.account_name, {_DUP_COLS} FROM a""")
def q_account_duplicates(spark, sf):
    a = numeric_accounts(spark, sf).select("row_key", "custom_id", "account_name")
    return _dup_flags(a)


_CRM_SQL = f""", m0 AS (
  SELECT {S.to_long0('business_partner_id')} AS k, account_web_address AS url, country_descr AS ctry,
         row_number() OVER (PARTITION BY {S.to_long0('business_partner_id')} ORDER BY crm_row) AS rn
  FROM fx_crm WHERE {S.is_numeric('business_partner_id')}),
m AS (SELECT * FROM m0 WHERE rn = 1),
e AS (
  SELECT a.* REPLACE (
    CASE WHEN a.custom_id >= 10000 AND m.k IS NOT NULL
              AND ({S.null_if_missing('a.website_url')} IS NULL) THEN m.url
         ELSE a.website_url END AS website_url,
    CASE WHEN a.custom_id >= 10000 AND m.k IS NOT NULL
              AND ({S.null_if_missing('a.country')} IS NULL) THEN m.ctry
         ELSE a.country END AS country)
  FROM a LEFT JOIN m ON m.k = a.custom_id)
"""


@register("crm_enrichment", sql_with("fx_accounts", "fx_crm") + NUM_ACC_SQL + _CRM_SQL + """
SELECT row_key, custom_id, website_url, country FROM e""")
def q_crm_enrichment(spark, sf):
    a = numeric_accounts(spark, sf)
    e = link.enrich_from(a, crm_typed(spark, sf), key="custom_id", fill=("website_url", "country"))
    return e.select("row_key", "custom_id", "website_url", "country")


def account_setup(accounts_raw, crm):
    """Job L-1: numeric IDs, duplicate and name flags, CRM fill-in, URL hosts,
    standard country names.  One lazy plan."""
    a = cols.keep_numeric(accounts_raw, "custom_id").withColumn("custom_id", to_long0("custom_id"))
    a = _dup_flags(a)
    a = cols.account_flags(a)
    a = link.enrich_from(a, crm, key="custom_id", fill=("website_url", "country"))
    a = a.withColumn("website_url", F.when(C.valid_url("website_url"), C.url_host("website_url")))
    return a.withColumn("country", geo.standardise_country("country"))


@register("account_setup", sql_with("fx_accounts", "fx_crm") + NUM_ACC_SQL + _DUP_SQL + _CRM_SQL + f"""
SELECT e.row_key, e.custom_id, e.account_name, e.tags,
       CASE WHEN {S.valid_url('e.website_url')} THEN {S.url_host('e.website_url')} END AS website_url,
       {S.standardise_country('e.country')} AS country,
       {_DUP_COLS.replace('a.', 'e.')},
       {S.is_blank('e.account_name')} AS blank_name,
       coalesce(contains(lower(e.account_name), 'dummy'), false) AS dummy_name
FROM e""")
def q_account_setup(spark, sf):
    a = account_setup(fixture(spark, sf, "fx_accounts"), crm_typed(spark, sf))
    return a.select("row_key", "custom_id", "account_name", "tags", "website_url", "country",
                    "dup_id", "dup_name", "blank_name", "dummy_name")


_ACC_FIRST_BY_ID = """, a1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY custom_id ORDER BY account_name NULLS LAST, row_key) rn
                 FROM acc) WHERE rn = 1 AND custom_id > 0)
"""


@register("link_by_id", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + _ACC_FIRST_BY_ID + """
SELECT p.row_key, p.custom_id, a1.account_name, a1.account_country, a1.tags
FROM pro p LEFT JOIN a1 ON a1.custom_id = (CASE WHEN p.custom_id > 0 THEN p.custom_id END)""")
def q_link_by_id(spark, sf):
    p = prospects_typed(spark, sf).select("row_key", "custom_id")
    return link.link_accounts(p, accounts_typed(spark, sf), on="custom_id", order_by=ACC_ORDER)


_BY_URL_SQL = """
SELECT p.row_key, a.custom_id, a.account_name, a.account_country, a.tags
FROM pro p LEFT JOIN (
  SELECT * FROM acc WHERE trim(website_url) NOT IN ('', '#') AND lower(trim(website_url)) <> 'nan'
  QUALIFY row_number() OVER (PARTITION BY website_url ORDER BY account_name NULLS LAST, custom_id, row_key) = 1) a
  ON a.website_url = p.website"""


@register("link_by_url", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + _BY_URL_SQL)
def q_link_by_url(spark, sf):
    p = prospects_typed(spark, sf).select("row_key", F.col("website").alias("website_url"))
    out = link.link_accounts(p, accounts_typed(spark, sf), on="website_url", order_by=["account_name", "custom_id", "row_key"])
    return out.select("row_key", "custom_id", "account_name", "account_country", "tags")


@register("link_fallback", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + _BY_URL_SQL)
def q_link_fallback(spark, sf):
    """Vendor file without an account ID: the key falls back to the URL."""
    p = prospects_typed(spark, sf).select("row_key", F.col("website").alias("website_url"),
                                          F.col("company").alias("account_name"))
    key = link.choose_link_key(p.columns, "zi_fallback")
    out = link.link_accounts(p.drop("account_name") if key != "account_name" else p,
                             accounts_typed(spark, sf), on=key, order_by=["account_name", "custom_id", "row_key"])
    return out.select("row_key", "custom_id", "account_name", "account_country", "tags")


@register("link_by_name", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + """
, a1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_name ORDER BY row_key) rn
                        FROM acc WHERE account_name IS NOT NULL) WHERE rn = 1)
SELECT p.row_key, p.company AS account_name, a1.custom_id, a1.account_country, a1.tags
FROM pro p LEFT JOIN a1 ON a1.account_name = p.company""")
def q_link_by_name(spark, sf):
    p = prospects_typed(spark, sf).select("row_key", F.col("company").alias("account_name"))
    return link.link_accounts(p, accounts_typed(spark, sf), on="account_name", order_by=ACC_ORDER)


@register("link_by_company", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + """
SELECT p.row_key, p.company, a.custom_id, a.account_name, a.account_country, a.tags
FROM pro p LEFT JOIN (
  SELECT * FROM acc WHERE trim(account_name) <> ''
  QUALIFY row_number() OVER (PARTITION BY account_name ORDER BY custom_id, row_key) = 1) a
  ON a.account_name = p.company""")
def q_link_by_company(spark, sf):
    p = prospects_typed(spark, sf).select("row_key", "company")
    return link.link_accounts(p, accounts_typed(spark, sf), on="company", order_by=["account_name", "custom_id", "row_key"])


@register("repair_ids", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + f"""
, a1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_name ORDER BY row_key) rn
                        FROM acc WHERE {S.null_if_missing('account_name')} IS NOT NULL) WHERE rn = 1)
SELECT p.row_key, coalesce(CASE WHEN {S.positive_id('p.custom_id')} > 0 THEN {S.positive_id('p.custom_id')} END,
                           a1.custom_id, 0) AS custom_id
FROM fx_prospects p LEFT JOIN a1 ON a1.account_name = p.company""")
def q_repair_ids(spark, sf):
    from ..functions.values import positive_id
    p = fixture(spark, sf, "fx_prospects").select(
        "row_key", F.when(positive_id("custom_id") > 0, positive_id("custom_id")).alias("custom_id"),
        F.col("company").alias("account_name"))
    out = link.repair_ids(p, accounts_typed(spark, sf), order_by=("row_key",))
    return out.select("row_key", "custom_id")


@register("prospect_counts", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + """
, c AS (SELECT custom_id, count(*) AS n FROM pro WHERE custom_id > 0 GROUP BY custom_id)
SELECT a.row_key, a.custom_id, CAST(coalesce(c.n, 0) AS BIGINT) AS prospect_count
FROM acc a LEFT JOIN c ON c.custom_id = greatest(a.custom_id, 0)""")
def q_prospect_counts(spark, sf):
    a = accounts_typed(spark, sf).select("row_key", "custom_id", "account_name")
    p = prospects_typed(spark, sf).select("custom_id", F.col("company").alias("account_name"))
    return link.with_prospect_counts(a, p).select("row_key", "custom_id", "prospect_count")


#: Prospects that an account should have; the fixture holds about ten per account.
ENOUGH = 8


@register("insufficient_accounts", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + f"""
, cnt AS (SELECT custom_id, count(*) AS n FROM pro WHERE custom_id > 0 GROUP BY custom_id)
, c AS (SELECT acc.row_key, acc.custom_id, acc.account_name, acc.tags, CAST(coalesce(cnt.n, 0) AS BIGINT) AS prospect_count
        FROM acc LEFT JOIN cnt ON cnt.custom_id = acc.custom_id AND acc.custom_id > 0)
SELECT *, CASE WHEN prospect_count = 0 THEN 'none' ELSE 'few' END AS segment FROM c WHERE prospect_count < {ENOUGH}""")
def q_insufficient_accounts(spark, sf):
    """Flagship: accounts with too few prospects (A-7, A-8), over the whole fixtures."""
    a = accounts_typed(spark, sf).select("row_key", "custom_id", "account_name", "tags")
    p = prospects_typed(spark, sf).select("custom_id", F.col("company").alias("account_name"))
    return report.insufficient_accounts(a, p, ENOUGH)


@register("accounts_in_order", sql_with("fx_accounts") + """
SELECT row_key, row_number() OVER (ORDER BY tags NULLS LAST, account_name NULLS LAST, row_key) AS position FROM fx_accounts""")
def q_accounts_in_order(spark, sf):
    """O-1: each account's place in the sorted output, by sampled ranges."""
    a = fixture(spark, sf, "fx_accounts").select("row_key", "tags", "account_name")
    order = [F.col(c).asc_nulls_last() for c in ("tags", "account_name", "row_key")]
    return range_index(a, order, name="position").select("row_key", "position")


@register("required_contacts", sql_with("fx_prospects") + """
SELECT row_key, email, contact_status FROM fx_prospects
WHERE contact_status = 'Verified' AND email IS NOT NULL AND custom_id IS NOT NULL""")
def q_required_contacts(spark, sf):
    """P-8, P-9: verified rows with an e-mail and an ID."""
    p = cols.where_equals(fixture(spark, sf, "fx_prospects"), "contact_status", "Verified")
    return cols.require(p, ["email", "custom_id"]).select("row_key", "email", "contact_status")


@register("prefixed", sql_with("fx_prospects") + """
SELECT row_key, linkedin_url FROM fx_prospects WHERE starts_with(linkedin_url, 'https://')""")
def q_prefixed(spark, sf):
    """P-11."""
    return cols.with_prefix(fixture(spark, sf, "fx_prospects"), "linkedin_url", "https://").select("row_key", "linkedin_url")


@register("defaulted_source", sql_with("fx_prospects") + f"""
SELECT row_key, CASE WHEN {S.is_blank('source')} THEN 'Outreach' ELSE source END AS source, CAST(NULL AS VARCHAR) AS fax, 'n/a' AS segment
FROM fx_prospects""")
def q_defaulted_source(spark, sf):
    """P-4, P-14: missing columns with a constant, blank sources with a label."""
    p = cols.ensure_columns(fixture(spark, sf, "fx_prospects"), {"fax": None, "segment": "n/a", "email": "never used"})
    return cols.default_source(p, "Outreach").select("row_key", "source", "fax", "segment")

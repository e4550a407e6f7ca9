"""Registered queries for the column-level rules (P-*, F-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import refdata
from ..functions import contact as C
from ..functions import geo, text, values
from ..operators import columns as cols
from ..operators.validate import allowed_values
from . import sqltext as S
from .catalogue import register
from .fixtures import fixture, sql_with, table

EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_IN_TEXT = r"\+?[0-9][0-9 ()/-]{6,}[0-9]"


@register("typed_ids", sql_with("fx_prospects") + f"""
SELECT row_key, custom_id AS custom_id_raw,
       {S.to_long0('custom_id')} AS id_long0,
       {S.positive_id('custom_id')} AS id_positive,
       {S.is_numeric('custom_id')} AS is_numeric
FROM fx_prospects""")
def q_typed_ids(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.select("row_key", F.col("custom_id").alias("custom_id_raw"),
                    values.to_long0("custom_id").alias("id_long0"),
                    values.positive_id("custom_id").alias("id_positive"),
                    values.is_numeric("custom_id").alias("is_numeric"))


@register("numeric_accounts", sql_with("fx_accounts") + f"""
SELECT row_key, {S.to_long0('custom_id')} AS custom_id, account_name
FROM fx_accounts WHERE {S.is_numeric('custom_id')}""")
def q_numeric_accounts(spark, sf):
    a = cols.keep_numeric(fixture(spark, sf, "fx_accounts"), "custom_id")
    return a.select("row_key", values.to_long0("custom_id").alias("custom_id"), "account_name")


@register("missing_normalised", sql_with("fx_accounts") + f"""
SELECT row_key,
       {S.null_if_missing('website_url', ('', '#', 'None'))} AS website_url,
       {S.null_if_missing('country')} AS country,
       {S.null_if_missing('tags')} AS tags,
       {S.null_if_missing('account_name', ('',), nan=False)} AS account_name
FROM fx_accounts""")
def q_missing_normalised(spark, sf):
    a = fixture(spark, sf, "fx_accounts")
    a = cols.normalise_missing(a, {"website_url": ("", "#", "None"), "country": ("",), "tags": ("",)})
    return a.select("row_key", "website_url", "country", "tags",
                    values.null_if_missing("account_name", ("",), nan=False).alias("account_name"))


@register("account_flags", sql_with("fx_accounts") + f"""
SELECT row_key, {S.is_blank('account_name')} AS blank_name,
       coalesce(contains(lower(account_name), 'dummy'), false) AS dummy_name
FROM fx_accounts""")
def q_account_flags(spark, sf):
    a = cols.account_flags(fixture(spark, sf, "fx_accounts"))
    return a.select("row_key", "blank_name", "dummy_name")


@register("url_hosts", f"""
SELECT page_id, url, {S.url_host('url')} AS host, {S.valid_url('url')} AS valid_url FROM pages""")
def q_url_hosts(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", "url", C.url_host("url").alias("host"), C.valid_url("url").alias("valid_url"))


@register("account_hosts", sql_with("fx_accounts") + f"""
SELECT row_key, CASE WHEN {S.valid_url('website_url')} THEN {S.url_host('website_url')} END AS host
FROM fx_accounts""")
def q_account_hosts(spark, sf):
    a = fixture(spark, sf, "fx_accounts")
    return a.select("row_key", F.when(C.valid_url("website_url"), C.url_host("website_url")).alias("host"))


@register("invalid_urls", sql_with("fx_accounts") + f"""
SELECT count(*) FILTER (WHERE NOT {S.valid_url('website_url')}) AS invalid_urls FROM fx_accounts""")
def q_invalid_urls(spark, sf):
    from ..operators.report import invalid_url_count
    return invalid_url_count(fixture(spark, sf, "fx_accounts"))


@register("title_case", sql_with("fx_prospects") + f"""
SELECT row_key, {S.title_case('first_name')} AS first_name, {S.title_case('last_name')} AS last_name,
       {S.title_case('city')} AS city
FROM fx_prospects""")
def q_title_case(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.select("row_key", text.title_case("first_name").alias("first_name"),
                    text.title_case("last_name").alias("last_name"), text.title_case("city").alias("city"))


@register("company_clean", sql_with("fx_accounts") + f"""
SELECT row_key, {S.strip_words('account_name')} AS stripped,
       {S.fold_text('account_name')} AS folded,
       {S.fold_text(S.strip_words('account_name'))} AS company_clean
FROM fx_accounts""")
def q_company_clean(spark, sf):
    a = fixture(spark, sf, "fx_accounts")
    return a.select("row_key", text.strip_words("account_name").alias("stripped"),
                    text.fold_text("account_name").alias("folded"),
                    text.fold_text(text.strip_words("account_name")).alias("company_clean"))


@register("folded_names", sql_with("fx_prospects") + f"""
SELECT row_key, {S.fold_text('first_name')} AS first_folded, {S.fold_text('last_name')} AS last_folded
FROM fx_prospects""")
def q_folded_names(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.select("row_key", text.fold_text("first_name").alias("first_folded"),
                    text.fold_text("last_name").alias("last_folded"))


@register("country_standardised", sql_with("fx_accounts") + f"""
SELECT row_key, {S.standardise_country('country')} AS country FROM fx_accounts""")
def q_country_standardised(spark, sf):
    a = fixture(spark, sf, "fx_accounts")
    return a.select("row_key", geo.standardise_country("country").alias("country"))


@register("country_codes", sql_with("fx_prospects") + S.COUNTRY_CODES + f"""
SELECT row_key, {S.country_to_code('country')} AS country,
       {S.country_to_code('account_country')} AS account_country
FROM fx_prospects""")
def q_country_codes(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.select("row_key", geo.country_to_code("country").alias("country"),
                    geo.country_to_code("account_country").alias("account_country"))



@register("country_from_option", sql_with("fx_prospects") + S.COUNTRY_CODES + f"""
SELECT row_key, option AS option_text, {S.option_code('option')} AS country_code
FROM (SELECT row_key, CASE WHEN country IS NULL THEN NULL
                           ELSE {S.country_to_code('country')} || ' - ' || country END AS option
      FROM fx_prospects)""")
def q_country_from_option(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    opt = F.when(F.col("country").isNotNull(),
                 F.concat(geo.country_to_code("country"), F.lit(" - "), F.col("country")))
    return p.select("row_key", opt.alias("option_text"), geo.option_code(opt).alias("country_code"))


@register("emails_in_text", f"""
SELECT doc_id, email, {S.is_private_email('email')} AS private_email,
       {S.bad_email_format('email')} AS bad_format, {S.email_domain('email')} AS domain
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL_IN_TEXT}')) AS email FROM documents)""")
def q_emails_in_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    e = d.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(EMAIL_IN_TEXT), 0)).alias("email"))
    return e.select("doc_id", "email", C.is_private_email("email").alias("private_email"),
                    C.bad_email_format("email").alias("bad_format"), C.email_domain("email").alias("domain"))


@register("email_export", sql_with("fx_prospects") + "SELECT email FROM fx_prospects")
def q_email_export(spark, sf):
    from ..sources.files import emails
    return emails(fixture(spark, sf, "fx_prospects"))


@register("phones_in_text", f"""
SELECT doc_id, phone, {S.phone_plus('phone')} AS phone_plus
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{PHONE_IN_TEXT}')) AS phone FROM documents)""")
def q_phones_in_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    p = d.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(PHONE_IN_TEXT), 0)).alias("phone"))
    return p.select("doc_id", "phone", C.phone_plus("phone").alias("phone_plus"))


@register("phones_plus", sql_with("fx_prospects") + f"""
SELECT row_key, {S.phone_plus('work_phone')} AS work_phone, {S.phone_plus('mobile_phone')} AS mobile_phone
FROM fx_prospects""")
def q_phones_plus(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.select("row_key", C.phone_plus("work_phone").alias("work_phone"),
                    C.phone_plus("mobile_phone").alias("mobile_phone"))


_PHONE_SQL = f""", plan AS MATERIALIZED (SELECT * FROM {refdata.sql_calling_codes()})
, ph AS (SELECT row_key, {S.country_to_code('country')} AS country, unnest(['work_phone', 'mobile_phone']) AS which, unnest([work_phone, mobile_phone]) AS p FROM fx_prospects)
, dg AS (SELECT *, {S.trimmed('p')} AS s, regexp_replace({S.trimmed('p')}, '[^0-9]', '', 'g') AS d FROM ph)
, found AS (
  SELECT dg.*, n.cc, n.trunk, i.cc AS icc
  FROM dg LEFT JOIN plan n ON n.country = upper({S.trimmed('dg.country')}) LEFT JOIN (SELECT DISTINCT cc FROM plan) i ON starts_with(d, i.cc))
, ok AS (
  SELECT found.*, EXISTS (SELECT 1 FROM plan x WHERE x.cc = icc AND contains(x.lengths, ',' || CAST(length(d) - length(icc) AS VARCHAR) || ',')) AS whole,
         substr(d, length(icc) + 1, 1) = '0' AND EXISTS (SELECT 1 FROM plan x WHERE x.cc = icc AND x.trunk = '0')
           AND EXISTS (SELECT 1 FROM plan x WHERE x.cc = icc AND contains(x.lengths, ',' || CAST(length(d) - length(icc) - 1 AS VARCHAR) || ',')) AS after_trunk,
         CASE WHEN trunk <> '' AND starts_with(d, trunk) THEN substr(d, length(trunk) + 1) ELSE d END AS national
  FROM found)
, e164 AS (
  SELECT row_key, country, which,
         CASE WHEN p IS NULL OR s = '' THEN p WHEN starts_with(s, '+') OR regexp_matches(s, '\\p{{L}}') THEN s
              WHEN starts_with(d, '00') AND length(d) > 4 THEN '+' || substr(d, 3)
              WHEN after_trunk THEN '+' || icc || substr(d, length(icc) + 2) WHEN whole THEN '+' || d
              WHEN cc IS NOT NULL AND length(national) BETWEEN 2 AND 17 THEN '+' || cc || national ELSE s END AS phone
  FROM ok)
"""


@register("phones_e164", sql_with("fx_prospects") + S.COUNTRY_CODES + _PHONE_SQL + """
SELECT row_key, country, max(phone) FILTER (which = 'work_phone') AS work_phone, max(phone) FILTER (which = 'mobile_phone') AS mobile_phone
FROM e164 GROUP BY row_key, country""")
def q_phones_e164(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select(
        "row_key", "work_phone", "mobile_phone", geo.country_to_code("country").alias("country"))
    return geo.with_phone_e164(p, ["work_phone", "mobile_phone"], "country")


@register("rule_flags", sql_with("fx_prospects") + f"""
SELECT row_key,
       {S.bad_email_format('email')} AS bad_email_format,
       {S.is_private_email('email')} AS private_email,
       ({S.is_blank(S.title_case('first_name'))} OR {S.is_blank(S.title_case('last_name'))}) AS bad_name,
       {S.bad_linkedin('linkedin_url')} AS bad_linkedin,
       {S.bad_country('country', 'account_country')} AS bad_country,
       {S.normalise_gender('gender')} AS gender
FROM fx_prospects""")
def q_rule_flags(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return p.select("row_key",
                    C.bad_email_format("email").alias("bad_email_format"),
                    C.is_private_email("email").alias("private_email"),
                    C.bad_name(text.title_case("first_name"), text.title_case("last_name")).alias("bad_name"),
                    C.bad_linkedin("linkedin_url").alias("bad_linkedin"),
                    C.bad_country("country", "account_country").alias("bad_country"),
                    C.normalise_gender("gender").alias("gender"))


@register("allowed_values", sql_with("fx_prospects") + f"""
, dv AS {refdata.sql_domain_values()},
vals AS (
  SELECT 'source' AS col, 'Source' AS dom, source AS v FROM fx_prospects
  UNION ALL SELECT 'gender', 'Gender', gender FROM fx_prospects)
SELECT col AS "column", v AS value, count(*) AS count
FROM vals WHERE NOT {S.is_blank('v')}
  AND v NOT IN (SELECT value FROM dv WHERE domain = vals.dom)
GROUP BY col, v""")
def q_allowed_values(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return allowed_values(p, {"source": "Source", "gender": "Gender"})


@register("allowed_values_country", sql_with("fx_prospects") + f"""
, dv AS {refdata.sql_domain_values()}
SELECT 'country' AS "column", country AS value, count(*) AS count
FROM fx_prospects WHERE NOT {S.is_blank('country')}
  AND country NOT IN (SELECT value FROM dv WHERE domain = 'Country')
GROUP BY country""")
def q_allowed_values_country(spark, sf):
    return allowed_values(fixture(spark, sf, "fx_prospects"), {"country": "Country"})

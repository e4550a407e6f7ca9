"""Registered queries for reports, gender, similarity and validation
(A-2..A-13, A-15, F-11..F-17, F-21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import refdata
from ..functions import contact as C
from ..functions.text import title_case
from ..operators import report, similarity
from ..operators.validate import plausible_gender, validate
from . import sqltext as S
from .catalogue import register
from .fixtures import fixture, sql_with
from .q_linking import ACC_SQL, PRO_SQL, accounts_typed, prospects_typed

THRESHOLD = 3


def _dist_acc(id_expr: str, name_expr: str, cond: str = "true") -> str:
    return (f"CASE WHEN max(CASE WHEN {cond} THEN greatest({id_expr}, 0) END) > 0 "
            f"THEN count(DISTINCT CASE WHEN {cond} AND {id_expr} > 0 THEN {id_expr} END) "
            f"ELSE count(DISTINCT CASE WHEN {cond} THEN {S.trimmed(name_expr)} END) END")


@register("coverage_report", sql_with("fx_accounts", "fx_prospects") + ACC_SQL + PRO_SQL + f"""
, pstats AS (
  SELECT count(*) AS prospects_found,
         count(DISTINCT nullif({S.trimmed('email')}, '')) AS prospects_with_emails,
         count(DISTINCT nullif({S.trimmed('linkedin_url')}, '')) AS prospects_with_linkedin,
         {_dist_acc('custom_id', 'company')} AS accounts_with_prospects
  FROM pro),
c AS (SELECT custom_id, count(*) AS n FROM pro WHERE custom_id > 0 GROUP BY custom_id),
seg AS (SELECT a.*, coalesce(c.n, 0) AS n FROM acc a LEFT JOIN c ON c.custom_id = greatest(a.custom_id, 0)),
astats AS (
  SELECT count(*) AS accounts_submitted,
         {_dist_acc('custom_id', 'account_name')} AS ds,
         count(*) FILTER (WHERE n = 0) AS accounts_without_prospects,
         count(*) FILTER (WHERE n > 0 AND n < {THRESHOLD}) AS accounts_with_few_prospects,
         {_dist_acc('custom_id', 'account_name', f'n < {THRESHOLD}')} AS accounts_needing_more
  FROM seg)
SELECT accounts_submitted, prospects_found, prospects_with_emails, prospects_with_linkedin,
       accounts_with_prospects,
       CAST(CASE WHEN ds > 0 THEN ceil(100.0 * accounts_with_prospects / ds) ELSE 0 END AS BIGINT) AS enrichment_rate,
       accounts_without_prospects, accounts_with_few_prospects, accounts_needing_more
FROM astats, pstats""")
def q_coverage_report(spark, sf):
    a = accounts_typed(spark, sf).select("custom_id", "account_name")
    p = prospects_typed(spark, sf).select("custom_id", F.col("company").alias("account_name"),
                                          "email", "linkedin_url")
    return report.coverage_report(a, p, THRESHOLD)


_COMPLETE_COLS = ["email", "title", "first_name", "last_name", "gender", "work_phone", "fax"]


def _completeness_sql() -> str:
    parts = []
    for c in _COMPLETE_COLS:
        if c == "fax":
            parts.append(f"SELECT '{c}' AS \"column\", false AS present, CAST(NULL AS BIGINT) AS missing, "
                         f"false AS any_value")
        else:
            parts.append(f"SELECT '{c}' AS \"column\", true AS present, "
                         f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS missing, "
                         f"count({c}) > 0 AS any_value FROM fx_prospects")
    return "\nUNION ALL ".join(parts)


@register("completeness", sql_with("fx_prospects") + _completeness_sql())
def q_completeness(spark, sf):
    return report.completeness(fixture(spark, sf, "fx_prospects"), _COMPLETE_COLS)


_PROFILE_COLS = ["custom_id", "company", "first_name", "last_name", "title", "email", "linkedin_url",
                 "work_phone", "mobile_phone", "city", "zip", "country", "source"]


@register("column_profile", sql_with("fx_prospects") + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(max(length(coalesce({c}, ''))), 0) AS max_len FROM fx_prospects"
    for c in _PROFILE_COLS))
def q_column_profile(spark, sf):
    return report.column_profile(fixture(spark, sf, "fx_prospects"), _PROFILE_COLS)


@register("country_value_counts", sql_with("fx_accounts") + """
SELECT country AS value, count(*) AS count FROM fx_accounts GROUP BY country""")
def q_country_value_counts(spark, sf):
    return report.value_counts(fixture(spark, sf, "fx_accounts"), "country", keep_null=True)


@register("tag_value_counts", sql_with("fx_accounts") + """
SELECT tags AS value, count(*) AS count FROM fx_accounts WHERE tags IS NOT NULL GROUP BY tags""")
def q_tag_value_counts(spark, sf):
    return report.value_counts(fixture(spark, sf, "fx_accounts"), "tags")


@register("distinct_contacts", sql_with("fx_prospects") + f"""
SELECT count(DISTINCT nullif({S.trimmed('email')}, '')) AS n_email,
       count(DISTINCT nullif({S.trimmed('linkedin_url')}, '')) AS n_linkedin_url,
       count(DISTINCT custom_id) AS n_custom_id
FROM fx_prospects""")
def q_distinct_contacts(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return report.distinct_values(p, {"n_email": report.nonblank("email"), "n_linkedin_url": report.nonblank("linkedin_url"), "n_custom_id": F.col("custom_id")})


@register("distinct_nonblank", sql_with("fx_prospects") + f"""
SELECT count(DISTINCT nullif({S.trimmed('city')}, '')) AS n_city, count(DISTINCT nullif({S.trimmed('country')}, '')) AS n_country FROM fx_prospects""")
def q_distinct_nonblank(spark, sf):
    return report.distinct_nonblank(fixture(spark, sf, "fx_prospects"), "city", "country")


@register("distinct_count", sql_with("fx_prospects") + """
SELECT count(DISTINCT email) AS n_email, count(DISTINCT company) AS n_company, count(DISTINCT zip) AS n_zip FROM fx_prospects""")
def q_distinct_count(spark, sf):
    return report.distinct_count(fixture(spark, sf, "fx_prospects"), "email", "company", "zip")


@register("distinct_accounts", sql_with("fx_prospects") + PRO_SQL + f"""
SELECT {_dist_acc('custom_id', 'company')} AS distinct_accounts FROM pro""")
def q_distinct_accounts(spark, sf):
    p = prospects_typed(spark, sf).select("custom_id", F.col("company").alias("account_name"))
    return report.distinct_accounts(p)


@register("row_audit", sql_with("fx_prospects") + """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE contact_status = 'Verified') AS verified,
       count(*) FILTER (WHERE email IS NOT NULL AND custom_id IS NOT NULL) AS with_email_and_id,
       count(*) FILTER (WHERE account_country = country) AS same_country
FROM fx_prospects""")
def q_row_audit(spark, sf):
    p = fixture(spark, sf, "fx_prospects")
    return report.row_audit(p, {
        "verified": F.col("contact_status") == "Verified",
        "with_email_and_id": F.col("email").isNotNull() & F.col("custom_id").isNotNull(),
        "same_country": F.col("account_country") == F.col("country"),
    })


_DECISIVE_SQL = ("CASE f.gender_class WHEN 'male' THEN 'Male' WHEN 'mostly_male' THEN 'Male' "
                 "WHEN 'female' THEN 'Female' WHEN 'mostly_female' THEN 'Female' END")
_GENDER_SQL = f"""
, nm AS (SELECT row_key, gender, {S.trimmed(S.title_case('first_name'))} AS n FROM fx_prospects),
parts AS (SELECT row_key, unnest(string_split(n, '-')) AS part,
                 unnest(range(1, len(string_split(n, '-')) + 1)) AS pos
          FROM nm WHERE NOT {S.is_blank('n')}),
fn AS {refdata.sql_first_names()},
dec AS (SELECT p.row_key, arg_min({_DECISIVE_SQL}, p.pos) AS g
        FROM parts p JOIN fn f ON lower(p.part) = f.name
        WHERE f.gender_class IN ('male', 'mostly_male', 'female', 'mostly_female')
        GROUP BY p.row_key),
pg AS (SELECT nm.row_key, nm.gender, coalesce(dec.g, 'Unknown') AS plausible_gender
       FROM nm LEFT JOIN dec ON dec.row_key = nm.row_key)
"""


@register("plausible_gender", sql_with("fx_prospects") + _GENDER_SQL + """
SELECT row_key, plausible_gender FROM pg""")
def q_plausible_gender(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select("row_key", title_case("first_name").alias("first_name"))
    return plausible_gender(p).select("row_key", "plausible_gender")


@register("gender_issues", sql_with("fx_prospects") + _GENDER_SQL + f"""
SELECT row_key, {S.normalise_gender('gender')} AS gender, plausible_gender,
       {S.gender_issue(S.normalise_gender('gender'), 'plausible_gender')} AS issue_mode_a,
       CASE WHEN plausible_gender = 'Unknown' THEN 'Unknown Gender' END AS issue_mode_b
FROM pg""")
def q_gender_issues(spark, sf):
    p = fixture(spark, sf, "fx_prospects").select("row_key", title_case("first_name").alias("first_name"),
                                                  "gender")
    g = plausible_gender(p).withColumn("gender", C.normalise_gender("gender"))
    return g.select("row_key", "gender", "plausible_gender",
                    C.gender_issue("gender", "plausible_gender").alias("issue_mode_a"),
                    F.when(F.col("plausible_gender") == "Unknown", F.lit("Unknown Gender")).alias("issue_mode_b"))


_PAIRS_SQL = f"""
, pr AS (SELECT DISTINCT {S.fold_text(S.strip_words('lower(company)'))} AS company_clean,
                {S.fold_text(S.domain_core('email'))} AS domain_clean
         FROM fx_prospects WHERE contains(email, '@')),
sc AS (SELECT company_clean, domain_clean, {S.windowed_similarity('company_clean', 'domain_clean')} AS similarity
       FROM pr WHERE company_clean <> '' AND domain_clean <> '')
"""


@register("windowed_similarity", sql_with("fx_prospects") + _PAIRS_SQL + f"""
SELECT company_clean, domain_clean, similarity, {S.domain_score_label('similarity')} AS label,
       coalesce(similarity < {refdata.BAD_DOMAIN_CUTOFF}, false) AS bad_domain
FROM sc""")
def q_windowed_similarity(spark, sf):
    return similarity.native_pair_scores(fixture(spark, sf, "fx_prospects"))


# ---- exact similarity and full validation ----------------------------------
_PEOPLE_SQL = f"""
, people AS MATERIALIZED (
  SELECT row_key, company, lower(email) AS e, lower({S.title_case('first_name')}) AS f, lower({S.title_case('last_name')}) AS l,
         {S.fold_text(S.strip_words('lower(company)'))} AS cc, {S.fold_text(S.domain_core('email'))} AS dc FROM fx_prospects)"""
_DOMAIN_SQL = f"""
, dpair AS (SELECT cc AS a, dc AS b FROM people WHERE contains(e, '@') AND cc <> '' AND dc <> '')
{S.partial_ratios('dpair', 'dsim')}
, dom AS (SELECT row_key, dsim.score AS domain_score FROM people LEFT JOIN dsim ON contains(e, '@') AND cc <> '' AND dc <> '' AND a = cc AND b = dc)"""
_BAD_EMAIL_SQL = f"""
, asked AS (SELECT * FROM people WHERE NOT {S.is_blank('e')} AND NOT {S.is_blank('f')} AND NOT {S.is_blank('l')} AND NOT contains(e, substr(f, 1, 1) || substr(l, 1, 1)))
, epair AS (SELECT f AS a, e AS b FROM asked UNION SELECT l, e FROM asked)
{S.partial_ratios('epair', 'esim')}
, bad AS (
  SELECT people.row_key, coalesce(x.score <= {refdata.BAD_EMAIL_CUTOFF} AND y.score <= {refdata.BAD_EMAIL_CUTOFF}, false) AS bad_email
  FROM people LEFT JOIN asked USING (row_key) LEFT JOIN esim x ON x.a = asked.f AND x.b = asked.e LEFT JOIN esim y ON y.a = asked.l AND y.b = asked.e)"""


def _recursive(sql: str) -> str:
    """CTEs that may refer to themselves."""
    return sql.replace("WITH", "WITH RECURSIVE", 1)


def _people(spark, sf):
    p = prospects_typed(spark, sf)
    return p.withColumnRenamed("company", "account_name").withColumns(
        {"first_name": title_case("first_name"), "last_name": title_case("last_name")})


@register("domain_score", _recursive(sql_with("fx_prospects")) + _PEOPLE_SQL + _DOMAIN_SQL + f"""
SELECT row_key, domain_score, {S.domain_score_label('domain_score')} AS domain_score_label FROM dom""")
def q_domain_score(spark, sf):
    p = _people(spark, sf).select("row_key", "account_name", F.lower(F.col("email")).alias("email"))
    s = similarity.domain_score(p)
    return s.select("row_key", "domain_score", C.domain_score_label("domain_score").alias("domain_score_label"))


@register("bad_email", _recursive(sql_with("fx_prospects")) + _PEOPLE_SQL + _BAD_EMAIL_SQL + """
SELECT row_key, bad_email FROM bad""")
def q_bad_email(spark, sf):
    p = _people(spark, sf).select("row_key", "first_name", "last_name", "email")
    return similarity.flag_bad_email(p).select("row_key", "bad_email")


def validated(spark, sf):
    """Validation of all vendors' rows of the fixture, each under its vendor's rules; the
    input is checkpointed first (as the job does) so the lookups and the main branch share one scan."""
    from ..session import cut_lineage
    p = _people(spark, sf).select("row_key", "custom_id", "account_name", "first_name", "last_name",
                                  "title", "gender", "email", "linkedin_url", "country", "account_country",
                                  "vendor")
    return validate(cut_lineage(p), gender_mode=F.when(F.col("vendor") == "Z", "B").otherwise("A"),
                    check_country=F.col("vendor") == "L")


#: Labels that need the exact similarity score.
SCORED = ("Bad Email", "Bad Domain")


def _without_scores(v):
    return v.withColumn("issues", F.array_except("issues", F.array(*[F.lit(x) for x in SCORED])))


_RULES_SQL = _GENDER_SQL + f"""
, t AS (SELECT *, {S.title_case('first_name')} AS fn1, {S.title_case('last_name')} AS ln1 FROM fx_prospects)
, k AS (SELECT row_key, CASE WHEN NOT {S.is_blank('fn1')} AND NOT {S.is_blank('ln1')}
               THEN lower({S.trimmed('fn1')}) || '_' || lower({S.trimmed('ln1')}) END AS key FROM t)
, twice AS (SELECT key FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1)
, r AS (SELECT t.row_key, t.vendor, pg.plausible_gender,
        CASE WHEN t.vendor = 'Z' THEN pg.plausible_gender ELSE {S.normalise_gender('t.gender')} END AS gender,
        list_filter([
          CASE WHEN {S.bad_email_format('t.email')} THEN 'Bad Email Format' END,
          CASE WHEN {S.is_private_email('t.email')} THEN 'Private Email' END,
          CASE WHEN {S.is_blank('fn1')} OR {S.is_blank('ln1')} THEN 'Bad Name' END,
          CASE WHEN {S.bad_linkedin('t.linkedin_url')} THEN 'Bad LinkedIn' END,
          CASE WHEN t.vendor = 'L' AND {S.bad_country('t.country', 't.account_country')} THEN 'Bad Country' END,
          CASE WHEN t.vendor = 'Z' THEN CASE WHEN pg.plausible_gender = 'Unknown' THEN 'Unknown Gender' END
               ELSE {S.gender_issue(S.normalise_gender('t.gender'), 'pg.plausible_gender')} END,
          CASE WHEN k.key IN (SELECT key FROM twice) THEN 'Duplicate' END], lambda x: x IS NOT NULL) AS issues
  FROM t JOIN pg USING (row_key) JOIN k USING (row_key))
"""


@register("all_issues_rules", sql_with("fx_prospects") + _RULES_SQL + """
SELECT row_key, array_to_string(issues, '+') AS issue, plausible_gender, gender FROM r""")
def q_all_issues_rules(spark, sf):
    v = _without_scores(validated(spark, sf))
    return v.select("row_key", F.array_join("issues", "+").alias("issue"), "plausible_gender", "gender")


@register("issue_summary_rules", sql_with("fx_prospects") + _RULES_SQL + """
SELECT issue, count(*) AS count FROM (
  SELECT unnest(list_append(issues, 'Rows with issues')) AS issue FROM r WHERE len(issues) > 0) GROUP BY issue""")
def q_issue_summary_rules(spark, sf):
    return report.issue_summary(_without_scores(validated(spark, sf)))


_ALL_SQL = _PEOPLE_SQL + _DOMAIN_SQL + _BAD_EMAIL_SQL + _RULES_SQL + f"""
, scored AS (
  SELECT r.row_key, list_concat(list_concat(list_filter(issues, lambda x: x IN ('Bad Email Format', 'Private Email', 'Bad Name')),
           list_filter([CASE WHEN bad_email THEN 'Bad Email' END, CASE WHEN domain_score < {refdata.BAD_DOMAIN_CUTOFF} THEN 'Bad Domain' END], lambda x: x IS NOT NULL)),
           list_filter(issues, lambda x: x NOT IN ('Bad Email Format', 'Private Email', 'Bad Name'))) AS issues,
         plausible_gender, {S.domain_score_label('domain_score')} AS domain_score_label, gender
  FROM r JOIN dom USING (row_key) JOIN bad USING (row_key))
"""


@register("all_issues", _recursive(sql_with("fx_prospects")) + _ALL_SQL + """
SELECT row_key, array_to_string(issues, '+') AS issue, plausible_gender, domain_score_label, gender FROM scored""")
def q_all_issues(spark, sf):
    v = validated(spark, sf)
    return v.select("row_key", "issue", "plausible_gender", "domain_score_label", "gender")


@register("issue_summary", _recursive(sql_with("fx_prospects")) + _ALL_SQL + """
SELECT issue, count(*) AS count FROM (
  SELECT unnest(list_append(issues, 'Rows with issues')) AS issue FROM scored WHERE len(issues) > 0) GROUP BY issue""")
def q_issue_summary(spark, sf):
    return report.issue_summary(validated(spark, sf))

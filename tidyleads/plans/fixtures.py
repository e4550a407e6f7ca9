"""Fixture views derived from the driver tables.

Each fixture is one SQL text that runs unchanged on Spark (tables passed as
DataFrame arguments of ``spark.sql``) and on DuckDB (tables named directly).
Defects are injected deterministically from the row key, so both engines see
the same rows.  Every fixture is a projection (plus one equi-join) of a whole
driver table: its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Country text per nation key: ISO names, codes, lower case, unknown text.
NATION_COUNTRY = [
    "Germany", "DE", "france", "United States", "GB", "Atlantis", "Austria",
    "CH", "netherlands", "Spain", "IT", "Poland", "BE", "Denmark", "se",
    "Norway", "FI", "Ireland", "PT", "Czech Republic", "Narnia", "Japan", "CN",
    "Brazil", "bosnia and herzegovina",
]
# First names of the prospect fixture by row key modulo 12.
FX_FIRST_NAMES = [
    "Anna", "Peter", "Marie-Claire", "Jürgen", "Zoë", "Hans-Peter", "D'Arcy",
    "Lena", "Mohammed", "Sophie", "Kaito", "Xyzzy",
]


def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(
        f"WHEN {i} THEN '{v.replace(chr(39), chr(39) * 2)}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _suffix(k: str) -> str:
    return f"CASE ({k}) % 4 WHEN 0 THEN ' GmbH' WHEN 1 THEN ' AG' WHEN 2 THEN ' Co. KG' ELSE '' END"


def _base_name(k: str) -> str:
    return f"concat('Customer#', lpad(CAST({k} AS STRING), 9, '0'), {_suffix(k)})"


def _base_url(k: str) -> str:
    return (f"concat(CASE ({k}) % 3 WHEN 0 THEN 'https://www.' WHEN 1 THEN 'HTTP://www2.' "
            f"ELSE '' END, 'customer', CAST({k} AS STRING), '.de/x')")


FX_ACCOUNTS = f"""
SELECT
  c.c_custkey AS row_key,
  CASE WHEN c.c_custkey % 50 = 7 THEN NULL
       WHEN c.c_custkey % 50 = 8 THEN 'n/a'
       ELSE CAST(9000 + c.c_custkey AS STRING) END AS custom_id,
  CASE WHEN c.c_custkey % 97 = 5 THEN ' '
       WHEN c.c_custkey % 101 = 9 THEN concat('dummy ', c.c_name)
       WHEN c.c_custkey % 40 = 3 THEN {_base_name('c.c_custkey - 1')}
       ELSE concat(c.c_name, {_suffix('c.c_custkey')}) END AS account_name,
  CASE WHEN c.c_custkey % 10 = 9 THEN NULL ELSE c.c_mktsegment END AS tags,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL
       WHEN c.c_custkey % 60 = 1 THEN '#'
       WHEN c.c_custkey % 60 = 2 THEN 'nan'
       WHEN c.c_custkey % 30 = 4 THEN {_base_url('c.c_custkey - 1')}
       ELSE {_base_url('c.c_custkey')} END AS website_url,
  CASE WHEN c.c_custkey % 33 = 6 THEN NULL
       ELSE {_case('c.c_nationkey % 25', NATION_COUNTRY)} END AS country
FROM {{customer}} c
"""

# CRM master: one row per customer; every third customer carries an ID the
# account list does not have, every 20th ID appears twice (second copy with
# another URL), every 25th URL is missing.
FX_CRM = f"""
SELECT
  CASE WHEN c.c_custkey % 3 = 0 THEN CAST(900000 + c.c_custkey AS STRING)
       ELSE CAST(9000 + c.c_custkey AS STRING) END AS business_partner_id,
  concat('CRM ', c.c_name) AS organization_name,
  CASE WHEN c.c_custkey % 25 = 0 THEN NULL
       ELSE concat('www.customer', CAST(c.c_custkey AS STRING), '.de') END AS account_web_address,
  {_case('(c.c_nationkey + 1) % 25', NATION_COUNTRY)} AS country_descr,
  2 * c.c_custkey AS crm_row
FROM {{customer}} c
UNION ALL
SELECT
  CAST(9000 + c.c_custkey AS STRING) AS business_partner_id,
  concat('CRM ', c.c_name, ' (copy)') AS organization_name,
  concat('www.customer', CAST(c.c_custkey AS STRING), '-alt.de') AS account_web_address,
  'Atlantis' AS country_descr,
  2 * c.c_custkey + 1 AS crm_row
FROM {{customer}} c
WHERE c.c_custkey % 20 = 0
"""

_K = "b.row_key"
_C = "b.custkey"
_FIRST = "b.base_first"
_LAST = "b.base_last"
_LOCAL = "b.local_part"
_MAIL_HOST = "b.mail_host"
_DIGITS = "b.digits"
_NAT = "b.nation_text"

# Two levels: the inner select names the shared pieces once, so the outer
# expressions reference them instead of repeating them.
_BASE = f"""
SELECT k.*, lower(concat(k.base_first, '.', k.base_last)) AS local_part
FROM (
  SELECT ok.o_orderkey AS row_key, ok.o_custkey AS custkey, ok.o_orderstatus AS orderstatus,
         p.p_type AS p_type,
         {_case('ok.o_orderkey % 12', FX_FIRST_NAMES)} AS base_first,
         concat(upper(substr(split_part(p.p_name, ' ', 2), 1, 1)), substr(split_part(p.p_name, ' ', 2), 2),
                chr(CAST(97 + ok.o_custkey % 26 AS INT)), chr(CAST(97 + ok.o_orderkey % 26 AS INT))) AS base_last,
         concat('customer', CAST(ok.o_custkey AS STRING), '.de') AS mail_host,
         lpad(CAST(ok.o_orderkey % 10000000 AS STRING), 7, '0') AS digits,
         {_case('ok.o_custkey % 25', NATION_COUNTRY)} AS nation_text,
         {_case('(ok.o_custkey + 1) % 25', NATION_COUNTRY)} AS next_nation_text
  FROM (SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus,
               o.o_orderkey % (SELECT count(*) FROM {{part}}) AS pk
        FROM {{orders}} o) ok
  LEFT JOIN {{part}} p ON p.p_partkey = ok.pk) k
"""

FX_PROSPECTS = f"""
SELECT
  {_K} AS row_key,
  CASE {_K} % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'Z' ELSE 'L' END AS vendor,
  CASE WHEN {_K} % 40 = 1 THEN 'abc'
       WHEN {_K} % 40 = 2 THEN NULL
       WHEN {_K} % 40 = 3 THEN '12.7'
       ELSE CAST(9000 + {_C} AS STRING) END AS custom_id,
  {_base_name(_C)} AS company,
  {_base_url(_C)} AS website,
  CASE WHEN {_K} % 70 = 5 THEN NULL
       WHEN {_K} % 70 = 6 THEN '  '
       WHEN {_K} % 90 = 7 THEN {_LAST}
       WHEN {_K} % 9 = 2 THEN lower({_FIRST})
       ELSE {_FIRST} END AS first_name,
  CASE WHEN {_K} % 71 = 5 THEN NULL
       WHEN {_K} % 90 = 7 THEN {_FIRST}
       ELSE {_LAST} END AS last_name,
  concat(b.p_type, ' Manager') AS title,
  CASE {_K} % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'unknown' ELSE NULL END AS gender,
  CASE {_K} % 13
       WHEN 1 THEN concat({_LOCAL}, '@gmail.com')
       WHEN 2 THEN concat({_LOCAL}, '.', {_MAIL_HOST})
       WHEN 3 THEN concat('max.mustermann@', {_MAIL_HOST})
       WHEN 4 THEN concat({_LOCAL}, '@othercorp.com')
       WHEN 5 THEN NULL
       WHEN 6 THEN upper(concat({_LOCAL}, '@', {_MAIL_HOST}))
       WHEN 7 THEN concat(lower({_FIRST}), '@', lower({_LAST}), '@', {_MAIL_HOST})
       ELSE concat({_LOCAL}, '@', {_MAIL_HOST}) END AS email,
  CASE {_K} % 17
       WHEN 1 THEN concat('https://www.xing.com/profile/', CAST({_K} AS STRING))
       WHEN 2 THEN NULL
       ELSE concat('https://www.linkedin.com/in/', CAST({_K} AS STRING)) END AS linkedin_url,
  CASE WHEN {_K} % 19 = 1 THEN NULL
       WHEN {_K} % 19 = 2 THEN 'ask reception'
       ELSE CASE {_K} % 4 WHEN 0 THEN concat('+49 30 ', {_DIGITS})
                          WHEN 1 THEN concat('030 ', {_DIGITS})
                          WHEN 2 THEN concat('4930', {_DIGITS})
                          ELSE concat('30', {_DIGITS}) END END AS work_phone,
  CASE WHEN {_K} % 23 = 2 THEN NULL
       ELSE CASE {_K} % 5 WHEN 0 THEN concat('+49 151 ', {_DIGITS})
                          WHEN 1 THEN concat('0151 ', {_DIGITS})
                          WHEN 2 THEN concat('49151', {_DIGITS})
                          WHEN 3 THEN concat('151', {_DIGITS})
                          ELSE concat('0044 7700 ', {_DIGITS}) END END AS mobile_phone,
  concat('City ', CAST({_C} % 100 AS STRING)) AS city,
  b.orderstatus AS state,
  lpad(CAST(({_C} * 7) % 100000 AS STRING), 5, '0') AS zip,
  CASE WHEN {_K} % 21 IN (5, 6) THEN NULL ELSE {_NAT} END AS country,
  CASE WHEN {_K} % 21 = 6 THEN NULL
       WHEN {_K} % 21 = 4 THEN b.next_nation_text
       ELSE {_NAT} END AS account_country,
  CASE WHEN {_K} % 23 = 1 THEN ''
       WHEN {_K} % 23 = 3 THEN NULL
       ELSE CASE {_K} % 7 WHEN 6 THEN 'Web' WHEN 5 THEN 'AE Sourced' WHEN 4 THEN 'AE Sourced'
                          ELSE 'SDE Sourced' END END AS source,
  CASE WHEN {_K} % 5 = 0 THEN 'Rejected' ELSE 'Verified' END AS contact_status
FROM ({_BASE}) b
"""

# Edited issues sheet: every prospect except those deleted by hand (%16=4);
# every 8th has a changed title and last name, every 12th lost its source.
FX_EDITS = """
SELECT
  concat('P', CAST(f.row_key AS STRING)) AS prospect_id,
  f.custom_id, f.company AS account_name, f.first_name,
  CASE WHEN f.row_key % 8 = 0 THEN f.last_name || '-Edited' ELSE f.last_name END AS last_name,
  CASE WHEN f.row_key % 8 = 0 THEN 'Head of Data' ELSE f.title END AS title,
  f.gender, f.email, f.linkedin_url, f.work_phone, f.mobile_phone,
  f.city, f.state, f.zip, f.country,
  CASE WHEN f.row_key % 12 = 0 THEN NULL ELSE f.source END AS source
FROM {fx_prospects} f
WHERE f.row_key % 16 <> 4
"""

FIXTURES = {
    "fx_accounts": (FX_ACCOUNTS, ["customer"]),
    "fx_crm": (FX_CRM, ["customer"]),
    "fx_prospects": (FX_PROSPECTS, ["orders", "part"]),
    "fx_edits": (FX_EDITS, ["fx_prospects"]),
}


#: Tables that the fixtures derive much from, and their keys.
SPREAD_BY = {"orders": "o_orderkey", "documents": "doc_id"}


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than cores is dealt out once, by its key, so that what is derived
    from it does not run in one task; a table of many files is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    key = next(k for k in SPREAD_BY.values() if k in df.columns)
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in SPREAD_BY else df


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture view on Spark from the whole driver tables."""
    text, deps = FIXTURES[name]
    args = {d: (fixture(spark, sf_dir, d) if d in FIXTURES else table(spark, sf_dir, d))
            for d in deps}
    return spark.sql(text, **args)


def sql_with(*names: str) -> str:
    """DuckDB ``WITH`` prefix defining the named fixtures (and their deps)."""
    order: list[str] = []

    def visit(n):
        for d in FIXTURES[n][1]:
            if d in FIXTURES:
                visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        text, deps = FIXTURES[n]
        parts.append(f"{n} AS ({text.format(**{d: d for d in deps})})")
    return "WITH " + ",\n".join(parts) + "\n"

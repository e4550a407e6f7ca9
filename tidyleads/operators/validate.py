"""Contact validation: every rule is a boolean column; the issue list is an
array built in the fixed label order (``array_join('+')`` only on output).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import refdata
from ..functions import contact as C
from ..functions.text import title_case
from ..functions.values import is_blank, trimmed
from . import similarity
from .joins import left_lookup
from .identity import duplicates_attach, duplicates_lookup, duplicates_prepare, person_key

DECISIVE = {"male": "Male", "mostly_male": "Male", "female": "Female", "mostly_female": "Female"}


def _names_dim(spark, names: DataFrame | None) -> DataFrame:
    if names is None:
        names = F.broadcast(refdata.first_names_df(spark))  # the fixed table of refdata; a user's table is left to AQE
    dec = F.create_map(*[x for k, v in DECISIVE.items() for x in (F.lit(k), F.lit(v))])
    return names.select(F.lower(F.col("name")).alias("_part"),
                        F.try_element_at(dec, F.lower(F.col("gender_class"))).alias("_g")) \
                .where(F.col("_g").isNotNull())


def gender_prepare(df: DataFrame, first: str = "first_name", eligible: Column | None = None) -> DataFrame:
    eligible = eligible if eligible is not None else F.lit(True)
    return df.withColumns({"_gn": F.when(eligible & ~is_blank(first), trimmed(first)),
                           "_g_in": eligible})


def gender_lookup(prepared: DataFrame, names: DataFrame | None = None) -> DataFrame:
    dim = _names_dim(prepared.sparkSession, names)
    distinct = prepared.select("_gn").distinct()
    # outer: for an inner one Spark asks the scan for names that split into something, spelled out in full
    parts = distinct.select("_gn", F.posexplode_outer(F.split(F.col("_gn"), "-")).alias("_pos", "_p")) \
                    .withColumn("_part", F.lower(F.col("_p")))
    return (parts.join(dim, "_part", "inner").groupBy("_gn")
            .agg(F.min_by(F.col("_g"), F.col("_pos")).alias("_pg")))


def gender_attach(prepared: DataFrame, lookup: DataFrame, out: str = "plausible_gender") -> DataFrame:
    j = left_lookup(prepared, lookup, ["_gn"])
    return j.withColumn(out, F.when(F.col("_g_in"), F.coalesce(F.col("_pg"), F.lit("Unknown")))) \
            .drop("_gn", "_pg", "_g_in")


def plausible_gender(df: DataFrame, first: str = "first_name", names: DataFrame | None = None,
                     eligible: Column | None = None, out: str = "plausible_gender") -> DataFrame:
    """First name -> Male / Female / Unknown with a name table (name,
    gender_class; the small table of ``refdata`` if none is given).  Hyphenated names take
    the first decisive part; mostly_x counts as x.  Looked up case-insensitively, once per
    distinct first name, then joined back."""
    p = gender_prepare(df, first, eligible)
    return gender_attach(p, gender_lookup(p, names), out)


def validate(df: DataFrame, in_scope: Column | None = None, gender_mode: str | Column = "A",
             check_country: bool | Column = False, names: DataFrame | None = None,
             legal_words: DataFrame | None = None) -> DataFrame:
    """Run every rule on the rows in ``in_scope`` (duplicates on all rows).

    Adds ``issues`` (array, fixed order), ``issue`` ('+'-joined),
    ``plausible_gender``, ``domain_score`` (int) and ``domain_score_label``;
    title-cases names and lower-cases e-mails of in-scope rows; normalises
    gender (mode A) or replaces it with the plausible one (mode B).  Mode and country
    check may differ by row (a column), for sources validated together.
    ``names`` (name, gender_class) and ``legal_words`` (word) replace the built-in tables.

    All row-level rules are one projection; the four lookups (e-mail pairs,
    company/domain pairs, first names, person keys) are each derived from
    that same projection and attached with one left join apiece.
    """
    check_country = F.lit(check_country) if isinstance(check_country, bool) else check_country
    mode_a = F.lit(gender_mode == "A") if isinstance(gender_mode, str) else gender_mode == "A"
    scope = in_scope if in_scope is not None else F.lit(True)
    x = df.withColumn("_in", F.coalesce(scope, F.lit(False)))
    inn = F.col("_in")
    x = x.withColumns({
        "_r_fmt": inn & C.bad_email_format("email"),
        "_r_priv": inn & C.is_private_email("email"),
        "first_name": F.when(inn, title_case("first_name")).otherwise(F.col("first_name")),
        "last_name": F.when(inn, title_case("last_name")).otherwise(F.col("last_name")),
        "email": F.when(inn, F.lower(F.col("email"))).otherwise(F.col("email")),
    })
    x = x.withColumns({
        "_r_name": inn & C.bad_name("first_name", "last_name"),
        "_r_li": inn & C.bad_linkedin("linkedin_url"),
        "_r_country": inn & check_country & C.bad_country("country", "account_country"),
    })
    x = similarity.bad_email_prepare(x, eligible=inn)
    x = similarity.domain_prepare(x, company="account_name", email="email", eligible=inn)
    x = gender_prepare(x, eligible=inn)
    x = duplicates_prepare(x, [person_key("first_name", "last_name")], tag="p")
    lookups = (similarity.bad_email_lookup(x), similarity.domain_lookup(x, legal_words), gender_lookup(x, names),
               duplicates_lookup(x, tag="p"))
    x = similarity.bad_email_attach(x, lookups[0], out="_r_bademail")
    x = similarity.domain_attach(x, lookups[1], out="domain_score")
    x = gender_attach(x, lookups[2], out="plausible_gender")
    x = duplicates_attach(x, lookups[3], name="_r_dup", tag="p")
    x = x.withColumns({
        "domain_score_label": C.domain_score_label("domain_score"),
        "_r_domain": inn & C.bad_domain("domain_score"),
    })
    x = x.withColumn("gender", F.when(inn & mode_a, C.normalise_gender("gender")).when(inn, F.col("plausible_gender"))
                     .otherwise(F.col("gender")))
    x = x.withColumn("_r_gender", F.when(inn & mode_a, C.gender_issue("gender", "plausible_gender"))
                     .when(inn & (F.col("gender") == "Unknown"), F.lit("Unknown Gender")))
    labels = [
        F.when(F.col("_r_fmt"), F.lit("Bad Email Format")),
        F.when(F.col("_r_priv"), F.lit("Private Email")),
        F.when(F.col("_r_name"), F.lit("Bad Name")),
        F.when(F.col("_r_bademail"), F.lit("Bad Email")),
        F.when(F.col("_r_domain"), F.lit("Bad Domain")),
        F.when(F.col("_r_li"), F.lit("Bad LinkedIn")),
        F.when(F.col("_r_country"), F.lit("Bad Country")),
        F.col("_r_gender"),
        F.when(F.col("_r_dup"), F.lit("Duplicate")),
    ]
    x = x.withColumn("issues", F.array_compact(F.array(*labels)))
    x = x.withColumn("issue", F.array_join("issues", "+"))
    return x.drop("_in", "_r_fmt", "_r_priv", "_r_name", "_r_bademail", "_r_domain", "_r_li",
                  "_r_country", "_r_gender", "_r_dup")


def allowed_values(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Violations of the template value lists: (column, value, count) for
    non-blank values of ``checks`` (column -> domain name) not in the list.
    The value lists are fixed and small, so they are broadcast."""
    pairs = [(c, d) for c, d in checks.items() if c in df.columns]
    allowed = F.broadcast(refdata.domain_values_df(df.sparkSession).select(F.col("domain").alias("_d"), F.col("value")))
    # one pass: (column, domain, value) stacked, counted map-side, then held against the lists
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(d).alias("_d"), F.col(f"`{c}`").cast("string").alias("value"))
                                  for c, d in pairs])) if pairs else None
    if stacked is None:
        return df.sparkSession.createDataFrame([], "column string, value string, count long")
    counts = df.select(stacked.alias("_x")).select("_x.*").where(~is_blank("value")).groupBy("column", "_d", "value").agg(F.count(F.lit(1)).alias("count"))
    return counts.join(allowed, ["_d", "value"], "left_anti").select("column", "value", "count")

"""Contact-field rules and labels (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import refdata
from ._util import as_col
from .values import is_blank, trimmed


# ---- URLs -----------------------------------------------------------------
def valid_url(c) -> Column:
    """Not NULL, not blank, not '#', 'None' or any-case 'nan' (without white space of any kind around)."""
    t = trimmed(c)
    return (t.isNotNull() & (t != "") & (t != "#") & (t != "None")
            & (F.lower(t) != "nan"))


def url_host(c) -> Column:
    """Website URL -> host: lower, drop scheme, cut at the first '/', drop a
    leading ``www``/``www2.``; port, query and other subdomains stay."""
    x = F.lower(trimmed(c))
    x = F.regexp_replace(x, r"^https?://", "")
    x = F.substring_index(x, "/", 1)
    return F.regexp_replace(x, r"^www[0-9]*\.", "")


# ---- e-mail ---------------------------------------------------------------
def bad_email_format(c) -> Column:
    """Non-blank e-mail that does not match the format; not trimmed."""
    c = as_col(c)
    return F.coalesce(~is_blank(c) & ~c.rlike(refdata.EMAIL_PATTERN), F.lit(False))


def email_domain(c) -> Column:
    """Text after the last '@', lower case."""
    return F.lower(F.substring_index(as_col(c), "@", -1))


def is_private_email(c, domains=None) -> Column:
    domains = list(domains if domains is not None else refdata.PRIVATE_DOMAINS)
    return F.coalesce(email_domain(c).isin(domains), F.lit(False))


def domain_core(c) -> Column:
    """Text between the first '@' and the next '.', NULL without '@'."""
    e = F.lower(as_col(c))
    after = F.substring(e, F.instr(e, "@") + 1, 1 << 30)
    return F.when(F.instr(e, "@") > 0, F.substring_index(after, ".", 1))


def domain_score_label(score) -> Column:
    s = as_col(score)
    txt = s.cast("string")
    return (F.when(s.isNull(), F.lit(""))
            .when(s == 0, F.lit("0 - No Match"))
            .when(s <= 49, F.concat(txt, F.lit(" - Poor Match")))
            .otherwise(F.concat(txt, F.lit(" - Good Match"))))


def bad_domain(score, cutoff: int = refdata.BAD_DOMAIN_CUTOFF) -> Column:
    return F.coalesce(as_col(score) < cutoff, F.lit(False))


# ---- names, gender, LinkedIn, country -------------------------------------
def bad_name(first, last) -> Column:
    """First or last name blank; NULL counts as blank."""
    return is_blank(first) | is_blank(last)


def normalise_gender(c) -> Column:
    g = F.lower(trimmed(c))
    return (F.when(g == "male", F.lit("Male")).when(g == "female", F.lit("Female"))
            .otherwise(F.lit("Unknown")))


def gender_issue(given, plausible) -> Column:
    """Mode A: 'Bad Gender' when a known plausible gender differs from the
    given one, 'Unknown Gender' when both are unknown, else NULL."""
    g, p = as_col(given), as_col(plausible)
    return (F.when((g != p) & (p != "Unknown"), F.lit("Bad Gender"))
            .when((g == "Unknown") & (p == "Unknown"), F.lit("Unknown Gender")))


def bad_linkedin(c) -> Column:
    c = as_col(c)
    return F.coalesce(~is_blank(c) & ~F.lower(c).contains("linkedin"), F.lit(False))


def bad_country(country, account_country) -> Column:
    """Person country differs from account country; a missing side counts as
    different (NULL vs NULL too)."""
    return F.coalesce(as_col(country) != as_col(account_country), F.lit(True))


# ---- phones ---------------------------------------------------------------
def phone_plus(c) -> Column:
    """Remove spaces; digits only -> prefix '+'; anything else unchanged."""
    c = as_col(c)
    s = F.replace(trimmed(c), F.lit(" "), F.lit(""))
    return F.when(s.rlike("^[0-9]+$"), F.concat(F.lit("+"), s)).otherwise(c)

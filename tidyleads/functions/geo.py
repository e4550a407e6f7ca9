"""Country and phone normalisation against the fixed reference tables.

The tables are hashed literals (``lookup``): one probe per row whatever their size, inside the
projection (no join, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import refdata
from ._util import as_col
from .lookup import HashedTable
from .text import title_case
from .values import trimmed

_BY_NAME = HashedTable({n.lower(): c for n, c in reversed(refdata.country_names())})
_BY_KEY = HashedTable(refdata.country_by_key())
_BY_CODE = HashedTable(dict(refdata.COUNTRIES))
_DIAL = HashedTable({c: {"cc": cc, "trunk": trunk} for c, cc, trunk, _ in refdata.CALLING_CODES}, "struct<cc:string,trunk:string>")
_PLAN = HashedTable(refdata.calling_plan(), "struct<trunk:string,lengths:int>")
#: No calling code begins with another, so the first digits tell a code's length.
_ONE_DIGIT = sorted(c for c in refdata.calling_plan() if len(c) == 1)
_TWO_DIGITS = sorted(c for c in refdata.calling_plan() if len(c) == 2)


def standardise_country(c) -> Column:
    """Two letters -> ISO short name when known; anything else (and unknown
    codes) -> title case of the trimmed text."""
    t = trimmed(c)
    return F.coalesce(F.when(F.length(t) == 2, _BY_CODE.get(F.upper(t))), title_case(t))


_FILLERS = r"\b(" + "|".join(refdata.COUNTRY_FILLERS) + r")\b"
_OFFICIAL = r"\b(" + "|".join(refdata.OFFICIAL_WORDS) + r")\b"


def _sorted_words(text) -> Column:
    return F.array_join(F.array_remove(F.sort_array(F.split(text, r"[^\p{L}\p{N}_]+")), ""), " ")


def country_key(c) -> Column:
    """Canonical form of a country's name, as `refdata.country_key`."""
    text = F.regexp_replace(F.translate(F.lower(as_col(c)), *refdata.ACCENTS), "[.'’`]", "")
    return _sorted_words(F.regexp_replace(F.regexp_replace(text, r"\bst\b", "saint"), _FILLERS, ""))


def country_to_code(c) -> Column:
    """Country name -> alpha-2; not found -> the value unchanged (untrimmed).  A known spelling is
    found at once, in any letter case.  Others are matched by their canonical form: accents, punctuation,
    fillers and the order of words do not count, and a name that is not found is tried without
    the words of official forms ("Federal Republic of Germany")."""
    c = as_col(c)

    def by_key(key):
        return F.coalesce(_BY_KEY.get(key), _BY_KEY.get(_sorted_words(F.regexp_replace(key, _OFFICIAL, ""))))
    return F.coalesce(_BY_NAME.get(F.lower(trimmed(c))), F.element_at(F.transform(F.array(country_key(c)), by_key), 1), c)


def option_code(c) -> Column:
    """'XX - Name' -> 'XX' (text before the first '-', trimmed); blank stays."""
    c = as_col(c)
    return F.when(c.isNull() | (trimmed(c) == ""), c).otherwise(trimmed(F.split_part(c, F.lit("-"), F.lit(1))))


def phone_e164(phone, country) -> Column:
    """Phone -> E.164 by the ITU's calling codes.

    NULL/blank -> unchanged; '+...' -> trimmed as is; letters -> trimmed as is;
    an international '00' prefix -> '+' and the digits after it; digits that start with a calling
    code (found as in a digit trie: codes are prefix-free, so the first two digits tell its length) and go
    on with a valid number of national digits -> '+digits', without a trunk zero behind the code; else,
    with a known country, drop the trunk prefix and prepend that country's code; else trimmed as is.

    Decision: a national number of a known country is formatted at any length of 2 to 17
    digits, as the reference's rule does (its library checks lengths on the international path only).

    The digits and the table entries are bound once through one-element ``transform``s, so
    no branch repeats them.
    """
    p = as_col(phone)
    s = trimmed(p)
    d = F.regexp_replace(s, "[^0-9]", "")
    digits = F.when(F.substring(d, 1, 1).isin(_ONE_DIGIT), 1).when(F.substring(d, 1, 2).isin(_TWO_DIGITS), 2).otherwise(3)
    bound = F.struct(p.alias("p"), s.alias("s"), d.alias("d"), digits.alias("k"), F.upper(trimmed(country)).alias("c"))

    def with_entries(b):
        return F.struct(b["p"].alias("p"), b["s"].alias("s"), b["d"].alias("d"), b["k"].alias("k"),
                        _PLAN.get(F.substring(b["d"], F.lit(1), b["k"])).alias("plan"), _DIAL.get(b["c"]).alias("m"))

    def body(b):
        p_, s_, d, k, plan, m = b["p"], b["s"], b["d"], b["k"], b["plan"], b["m"]

        def valid(n):
            return (n > 0) & (n < 31) & (plan["lengths"].bitwiseAND(F.call_function("shiftleft", F.lit(1), n)) != 0)
        n = F.length(d) - k
        no_trunk = (plan["trunk"] == "0") & (F.substring(d, k + 1, F.lit(1)) == "0") & valid(n - 1)
        intl = (F.when(no_trunk, F.concat(F.lit("+"), F.substring(d, F.lit(1), k), F.substring(d, k + 2, F.length(d))))
                .when(valid(n), F.concat(F.lit("+"), d)))
        trunk = m["trunk"]
        national = F.when((trunk != "") & F.startswith(d, trunk), F.substring(d, F.length(trunk) + 1, F.length(d))).otherwise(d)
        as_nat = F.when(m.isNotNull() & F.length(national).between(2, 17), F.concat(F.lit("+"), m["cc"], national))
        return (F.when(p_.isNull() | (s_ == ""), p_)
                .when(F.startswith(s_, F.lit("+")), s_)
                .when(s_.rlike(r"\p{L}"), s_)
                .when(F.startswith(d, F.lit("00")) & (F.length(d) > 4), F.concat(F.lit("+"), F.substring(d, F.lit(3), F.length(d))))
                .otherwise(F.coalesce(intl, as_nat, s_)))

    return F.element_at(F.transform(F.transform(F.array(bound), with_entries), body), 1)


def with_phone_e164(df, phones: list[str], country: str):
    """DataFrame form of ``phone_e164`` for several phone columns."""
    return df.withColumns({c: phone_e164(c, country) for c in phones})

"""Typing and missing-value helpers (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


#: Decimal numbers, with or without fraction and exponent.
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: White space at the ends of a cell: spaces, tabs, line breaks, no-break space.
BLANKS = " \t\n\r\x0b\x0c\u00a0"


def trimmed(c) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(as_col(c), F.lit(BLANKS))


def to_long0(c) -> Column:
    """Tolerant numeric cast: integer text as is, other numbers truncated
    toward zero, anything unparseable or missing -> 0.

    The integer path comes first so IDs beyond 2**53 keep their precision.
    """
    c = as_col(c)
    s = trimmed(c.cast("string"))
    s = F.when(s.rlike(NUMBER), s)
    return F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def is_numeric(c) -> Column:
    """True when the text is a decimal number (instruction/note rows are not; nor are
    'nan', 'Infinity' and Java's suffixed literals such as '12d')."""
    return F.coalesce(trimmed(as_col(c).cast("string")).rlike(NUMBER), F.lit(False))


def null_if_missing(c, tokens=("",), nan: bool = True) -> Column:
    """Map blank text, the given exact tokens and (optionally) any-case
    ``nan`` to NULL.  Tokens are per column: ``#`` only for URLs, ``None``
    exact-case; never apply this to names ("None" is a real surname)."""
    c = as_col(c)
    t = trimmed(c)
    miss = t.isin(list(tokens)) | (t == "")
    if nan:
        miss = miss | (F.lower(t) == "nan")
    return F.when(c.isNull() | miss, F.lit(None).cast("string")).otherwise(c)


def is_blank(c) -> Column:
    """NULL or only whitespace."""
    return F.coalesce(trimmed(as_col(c)), F.lit("")) == ""


def positive_id(c) -> Column:
    """Clean ID: valid positive integer, else 0."""
    return F.greatest(to_long0(c), F.lit(0).cast("bigint"))


def is_dummy(name) -> Column:
    """Account name contains 'dummy' (any case); NULL name -> false."""
    return F.coalesce(F.lower(as_col(name)).contains("dummy"), F.lit(False))

"""Text normalisation (Column -> Column), all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import refdata
from ._util import as_col

_LETTER_RUNS = r"(\p{L}+|\P{L}+)"
_WORD_RUNS = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"


def title_case(c) -> Column:
    """Python-style title case: the first letter of every letter run is upper,
    the rest lower ("o'brien" -> "O'Brien", "guinea-bissau" -> "Guinea-Bissau",
    "3m" -> "3M").  ``initcap`` differs: it only capitalises after spaces."""
    runs = F.regexp_extract_all(F.lower(as_col(c)), F.lit(_LETTER_RUNS), 0)
    return F.array_join(
        F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))),
        "")


# Fixed folding of German umlauts and sharp s, in this order.
_FOLDS = [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss")]


def fold_text(c) -> Column:
    """Fold umlauts, then keep only ASCII letters and digits; NULL -> ''."""
    x = as_col(c).cast("string")
    for a, b in _FOLDS:
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.coalesce(F.regexp_replace(x, r"[^a-zA-Z0-9]", ""), F.lit(""))


def strip_words(c, words=None) -> Column:
    """Lower-case and remove whole words that are in ``words`` (legal forms).

    The text is split into maximal word / non-word runs and word runs found in
    the set are dropped, which equals removing each ``\\bword\\b`` in turn."""
    words = list(words if words is not None else refdata.LEGAL_WORDS)
    runs = F.regexp_extract_all(F.lower(as_col(c)), F.lit(_WORD_RUNS), 0)
    stop = F.array(*[F.lit(w) for w in words])
    return F.array_join(F.filter(runs, lambda x: ~F.array_contains(stop, x)), "")

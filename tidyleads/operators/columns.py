"""Projection, filter and cast operators (DataFrame -> DataFrame).

All of them are single narrow projections or filters: no shuffle, and the
filters sit directly above the scan so Catalyst can push them down.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import is_blank, is_numeric, null_if_missing, positive_id, to_long0, trimmed


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Simultaneous rename; names not present are ignored.  ``{A:B, B:C}`` on
    (A, B) gives (B, C) - unlike chained renames."""
    return df.select([F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def project(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Ordered wish-list projection that skips absent columns."""
    return df.select([f"`{c}`" for c in wanted if c in df.columns])


def drop_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add missing columns with a constant (typed string unless a Column)."""
    missing = {c: (v if isinstance(v, Column) else F.lit(v).cast("string"))
               for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def cast_long0(df: DataFrame, cols: list[str]) -> DataFrame:
    """Tolerant numeric cast of the present columns (failure/missing -> 0)."""
    present = {c: to_long0(c) for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def keep_numeric(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose ID parses as a number (drops notes, blanks, headers)."""
    return df.where(is_numeric(col))


def normalise_missing(df: DataFrame, spec: dict[str, tuple]) -> DataFrame:
    """Per-column missing tokens -> NULL (see ``null_if_missing``)."""
    return df.withColumns({c: null_if_missing(c, tokens) for c, tokens in spec.items() if c in df.columns})


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with NULL in any required column."""
    return df.na.drop(subset=cols)


def where_equals(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter applied only when the column exists."""
    return df.where(F.col(col) == value) if col in df.columns else df


def same_country(df: DataFrame, a: str = "account_country", b: str = "country") -> DataFrame:
    """Keep rows whose two country columns are equal; NULL never equal."""
    if a in df.columns and b in df.columns:
        return df.where(F.col(a) == F.col(b))
    return df


def with_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.where(F.col(col).startswith(prefix))


def tagged_only(df: DataFrame, col: str = "tags") -> DataFrame:
    """Rows with a non-blank tag ('nan' counts as blank); all rows without a
    tag column."""
    if col not in df.columns:
        return df
    return df.where(null_if_missing(col).isNotNull())


def clean_id_and_name(df: DataFrame, id_col: str = "custom_id", name_col: str = "account_name") -> DataFrame:
    """Invalid / non-positive ID -> 0, name trimmed."""
    out = {}
    if id_col in df.columns:
        out[id_col] = positive_id(id_col)
    if name_col in df.columns:
        out[name_col] = trimmed(name_col)
    return df.withColumns(out)


def default_source(df: DataFrame, label: str, col: str = "source") -> DataFrame:
    """Blank/NULL source -> label (original value kept otherwise); create it
    when missing."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(label))
    return df.withColumn(col, F.when(is_blank(col), F.lit(label)).otherwise(F.col(col)))


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim header names and collapse inner whitespace (driver-side names)."""
    return df.toDF(*[re.sub(r"\s+", " ", c.strip()) for c in df.columns])


def upload_names(df: DataFrame, id_col: str = "custom_id", name_col: str = "account_name") -> DataFrame:
    """Rename the ID column to ``account_custom_id`` when any ID is non-zero,
    and the account name to ``company`` when there is no company column.

    The only place where data decides the schema: one tiny ``limit(1)`` probe.
    """
    if id_col in df.columns:
        nonzero = df.where(F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)) != 0).limit(1).count() > 0
        if nonzero:
            df = rename(df, {id_col: "account_custom_id"}).withColumn(
                "account_custom_id", to_long0("account_custom_id"))
    if "company" not in df.columns and name_col in df.columns:
        df = rename(df, {name_col: "company"})
    return df


def deliverable_columns(hide_email: bool, extra: list[str] = ()) -> list[str]:
    """Output column order of the deliverable (fixed values)."""
    keep = ["custom_id", "account_name", "tags", "first_name", "last_name", "title", "gender"]
    if not hide_email:
        keep.append("email")
    keep += list(extra)
    keep += ["linkedin_url", "work_phone", "mobile_phone", "source", "city", "state", "zip",
             "country", "prospect_id"]
    return keep


def account_flags(df: DataFrame, name_col: str = "account_name") -> DataFrame:
    """Blank-name and 'dummy' flags as columns."""
    from ..functions.values import is_dummy
    return df.withColumns({"blank_name": is_blank(name_col), "dummy_name": is_dummy(name_col)})


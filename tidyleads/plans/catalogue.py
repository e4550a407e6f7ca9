"""Query catalogue: every registered query as a Spark plan plus its DuckDB
oracle text.  Each query reads whole driver tables (or fixtures Spark derives
from them), so its work grows with the scale factor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all():
    """Import the query modules so their ``register`` calls run."""
    from . import q_identity, q_jobs, q_linking, q_reports, q_scalars  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)

"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck
from tidyleads.plans import catalogue

ORACLE = catalogue.all_oracles()  # those of the training-data operators are in tests/llm


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, msg


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["row_key", "custom_id", "account_name", "tags", "prospect_count", "segment"]

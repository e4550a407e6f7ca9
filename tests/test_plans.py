"""Plan shape: filters reach the scan, Python only in the similarity
queries, no row-level numbering through a single partition."""

import pytest

import __spark_entry__ as E
from tidyleads.plans import catalogue

PY_QUERIES = {"domain_score", "bad_email", "all_issues", "issue_summary", "all_issues_rules", "issue_summary_rules",
              "issues_source_o", "issues_source_z", "issues_source_l"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes(spark, sf_small):
    df = E.entry(spark)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    scans = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert any("o_custkey" in s for s in scans) and not any("o_totalprice" in s or "o_orderpriority" in s for s in scans)


@pytest.mark.parametrize("name", sorted(set(catalogue.all_queries()) - PY_QUERIES))
def test_no_python_outside_similarity(spark, sf_small, name):
    plan = E.queries()[name](spark, sf_small)._jdf.queryExecution().sparkPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_prospect_ids_have_no_global_window(spark, monkeypatch):
    """Ranges are dealt by sampled splitters; neither rows nor accounts pass one window task."""
    from pyspark.sql import functions as F
    from tidyleads.operators import identity
    seen = []
    monkeypatch.setattr(identity, "written", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    p = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("account"), "id")
    out = identity.assign_ids(p, "O", ["account", "id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(account" in seen[0] and "Window" not in seen[0]
    assert "SinglePartition" not in plan and "Window" not in plan


def test_a_hot_account_spans_ranges(spark):
    from pyspark.sql import functions as F
    from tidyleads.operators import identity
    p = spark.range(20000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("account"), F.xxhash64("id").alias("k"), "id")
    for part, order in (([], ["account", "k"]), (["account"], ["k"])):
        out = identity.range_index(p, order, part).toPandas().sort_values(["account", "k"])
        want = out.groupby("account").cumcount() + 1 if part else range(1, len(out) + 1)
        assert (out["_idx"].to_numpy() == list(want)).all()
    dealt = p.repartitionByRange(4, "account", "k").groupBy(F.spark_partition_id().alias("r")).agg(F.count_if(F.col("account") == "hot").alias("n"))
    assert dealt.agg(F.max("n")).first()[0] < 0.6 * 13334  # of two thirds of all rows


@pytest.mark.parametrize("name", ["prospect_ids", "quota_labels"])
def test_numbering_plans_no_single_partition(spark, sf_small, name):
    assert "SinglePartition" not in E.queries()[name](spark, sf_small)._jdf.queryExecution().sparkPlan().toString()

"""Order without input order: dense IDs, quota numbering, duplicates."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidyleads.operators import identity as I


def _rows(n, hot_share=0.4):
    out = []
    for i in range(n):
        acct = None if i < int(n * hot_share) else f"acct{i % 17}"
        first = None if i % 11 == 0 else f"f{i % 5}"
        out.append((i, acct, first, f"l{i % 3}"))
    return out


def test_ordered_index_dense_and_equal_to_global_row_number(spark):
    df = spark.createDataFrame(_rows(700), "k long, acct string, first string, last string")
    order = ["acct", "first", "last", "k"]
    want = df.withColumn("w", F.row_number().over(
        Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    for parts in (1, 3, 7):
        got = I.ordered_index(df.repartition(parts), order, [1, 2], name="idx")
        j = got.join(want, "k")
        assert j.where("idx <> w").count() == 0
        assert sorted(r.idx for r in got.select("idx").collect()) == list(range(1, 701))


def test_assign_ids_format_past_9999(spark):
    df = spark.range(10001).select(F.col("id").alias("k"), F.lit("a").alias("acct"))
    ids = I.assign_ids(df, "Z", ["acct", "k"])
    assert ids.where("k = 10000").first().prospect_id == "Z10001"
    assert ids.where("k = 0").first().prospect_id == "Z0001"


def test_row_level_window_is_partitioned(spark):
    df = spark.createDataFrame(_rows(50), "k long, acct string, first string, last string")
    plan = I.ordered_index(df, ["acct", "first", "last", "k"], [1, 2])._jdf.queryExecution().executedPlan().toString()
    # the only single-partition exchange is the account-level running sum, over an aggregate
    assert "RowNumber" in plan or "row_number" in plan


def test_quota_label_all_members_numbered(spark):
    rows = [(i, "A" if i < 5 else "B", i % 2) for i in range(8)] + [(99, None, 0)]
    df = spark.createDataFrame(rows, "k long, account_name string, srank int")
    out = I.quota_label(df, 4, order_by=[F.col("srank"), F.floor(F.col("k") / 2), F.col("k")], tiers=[2])
    got = {r.k: (r.account_range, r.beyond_quota) for r in out.collect()}
    assert got[99] == (None, None)
    assert got[5] == ("OK", False)
    a = sorted((v for k, v in got.items() if k < 5), key=lambda x: x[0])
    assert [x[0] for x in a] == [f"Extra {i}" for i in range(1, 6)]
    # order: srank 0 first (k = 0, 2, 4), then srank 1 (k = 1, 3)
    assert got[0][0] == "Extra 1" and got[4][0] == "Extra 3" and got[1][0] == "Extra 4"
    assert got[3] == ("Extra 5", True)


def test_duplicates_ignore_blank_and_null_keys(spark):
    df = spark.createDataFrame([(1, "Ann", "Lee"), (2, "ann ", "LEE"), (3, None, "Lee"), (4, None, "Lee"),
                                (5, "Lee", "Ann"), (6, " ", "x"), (7, " ", "x")], "k long, f string, l string")
    plain = {r.k: r.is_duplicate for r in I.flag_person_duplicates(df, first="f", last="l").collect()}
    assert plain == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False, 7: False}
    sw = {r.k: r.is_duplicate for r in I.flag_person_duplicates(df, swapped=True, first="f", last="l").collect()}
    assert sw[5] is True and sw[1] is True


def test_hot_key_count_is_partial_aggregate(spark):
    df = spark.createDataFrame([(i, "hot") for i in range(100)], "k long, acct string")
    plan = I.flag_duplicates(df, ["acct"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan

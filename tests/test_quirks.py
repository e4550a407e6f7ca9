"""One test per decided behaviour (follow or fix) of the reference."""

from pyspark.sql import functions as F

from tidyleads.operators import columns as cols
from tidyleads.operators import link, reconcile
from tidyleads.operators.validate import validate


def test_rename_is_simultaneous(spark):
    df = spark.createDataFrame([(1, 2)], "A int, B int")
    assert cols.rename(df, {"A": "B", "B": "C"}).columns == ["B", "C"]


def test_null_keys_and_id_zero_never_link(spark):
    accounts = spark.createDataFrame([(0, "Zero", "DE", "t0"), (5, "Five", "AT", "t5"), (6, None, "CH", None)],
                                     "custom_id long, account_name string, account_country string, tags string")
    pro = spark.createDataFrame([(1, 0), (2, 5), (3, None)], "k int, custom_id long")
    got = {r.k: r.account_name for r in link.link_accounts(pro, accounts, on="custom_id").collect()}
    assert got == {1: None, 2: "Five", 3: None}
    urls = spark.createDataFrame([(1, None)], "k int, website_url string")
    acc_u = accounts.withColumn("website_url", F.lit(None).cast("string"))
    assert link.link_accounts(urls, acc_u, on="website_url").first().account_name is None


def test_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, None, 0)], "k int, v string, o int")
    for parts in (1, 3):
        r = link.first_per_key(df.repartition(parts), ["k"], ["v", "o"]).first()
        assert r.v == "a"


def test_crm_fill_only_for_large_ids(spark):
    acc = spark.createDataFrame([(9999, None, None), (10001, "nan", "DE"), (10002, "x.de", None)],
                                "custom_id long, website_url string, country string")
    crm = spark.createDataFrame([(9999, "c.de", "AT", 0), (10001, "d.de", "CH", 0), (10001, "e.de", "FR", 1),
                                 (10002, "f.de", "IT", 0)], "custom_id long, website_url string, country string, crm_row int")
    got = {r.custom_id: (r.website_url, r.country) for r in link.enrich_from(acc, crm).collect()}
    assert got == {9999: (None, None), 10001: ("d.de", "DE"), 10002: ("x.de", "IT")}


def test_prospect_counts_by_name_without_ids(spark):
    acc = spark.createDataFrame([(0, "A "), (0, "B")], "custom_id long, account_name string")
    pro = spark.createDataFrame([(0, "A"), (0, " A")], "custom_id long, account_name string")
    got = {r.account_name: r.prospect_count for r in link.with_prospect_counts(acc, pro).collect()}
    assert got == {"A ": 2, "B": 0}


def test_reconcile_protected_and_filled(spark):
    edited = spark.createDataFrame([("P1", "New", None), ("P2", None, None)], "prospect_id string, title string, source string")
    orig = spark.createDataFrame([("P1", "Old", "Web", "O"), ("P2", "T", "AE", "Z"), ("P3", "x", "y", "L")],
                                 "prospect_id string, title string, source string, vendor string")
    got = {r.prospect_id: r.asDict() for r in reconcile.reconcile(edited, orig).collect()}
    assert set(got) == {"P1", "P2"}
    assert got["P1"]["title"] == "New" and got["P2"]["title"] is None
    assert got["P1"]["source"] == "Web" and got["P2"]["vendor"] == "Z"


def test_issue_order_and_scope(spark):
    rows = [(1, "anna", "lee", "ANNA.LEE@gmail.com", "Acme GmbH", "x.com/in", "DE", None, "female", True),
            (2, "", "lee", "bad", "Acme", "https://linkedin.com/in/x", "DE", "DE", "male", True),
            (3, "anna", "lee", "anna.lee@acme.de", "Acme", None, "DE", "DE", "female", False)]
    df = spark.createDataFrame(rows, "k long, first_name string, last_name string, email string, account_name string, "
                                     "linkedin_url string, country string, account_country string, gender string, s boolean")
    out = {r.k: r for r in validate(df, in_scope=F.col("s"), check_country=True).collect()}
    assert out[1].issue == "Private Email+Bad Domain+Bad LinkedIn+Bad Country+Duplicate"
    assert out[1].first_name == "Anna" and out[1].email == "anna.lee@gmail.com" and out[1].gender == "Female"
    assert out[2].issue.startswith("Bad Email Format+Bad Name")
    assert "Bad Email+" not in out[2].issue + "+"
    # out of scope: untouched except the whole-set duplicate rule
    assert out[3].issue == "Duplicate" and out[3].gender == "female" and out[3].plausible_gender is None


def test_tagged_only_treats_nan_as_blank(spark):
    df = spark.createDataFrame([(1, "nan"), (2, " "), (3, "T")], "k int, tags string")
    assert [r.k for r in cols.tagged_only(df).collect()] == [3]
    assert cols.tagged_only(df.drop("tags")).count() == 3


def test_upload_names_depend_on_data(spark):
    df = spark.createDataFrame([(0, "A"), (3, "B")], "custom_id long, account_name string")
    assert cols.upload_names(df).columns == ["account_custom_id", "company"]
    zero = spark.createDataFrame([(0, "A")], "custom_id long, account_name string")
    assert cols.upload_names(zero).columns == ["custom_id", "company"]

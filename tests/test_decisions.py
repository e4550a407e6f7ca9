"""Literal cases of rules, written apart from the Spark code and its SQL."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidyleads.functions import geo, values
from tidyleads.operators import joins, link, similarity, validate
from tidyleads.session import checkpoint_dir
from tidyleads.sources import files


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn("x").alias("y")).first().y


@pytest.mark.parametrize("text, number", [("12d", 0), ("7F", 0), ("nan", 0), ("Infinity", 0), ("-3", -3), (" 12.9\t", 12), ("1e3", 1000),
                                          (".5", 0), ("9007199254740993", 9007199254740993), ("", 0), (None, 0)])
def test_numbers_of_ids(spark, text, number):
    assert one(spark, text, values.to_long0) == number
    assert one(spark, text, values.is_numeric) == (text in ("-3", " 12.9\t", "1e3", ".5", "9007199254740993"))


def test_any_white_space_is_blank(spark):
    for blank in ("", " ", "\t", "  \n", None):
        assert one(spark, blank, values.is_blank) and one(spark, blank, values.null_if_missing) is None


@pytest.mark.parametrize("phone, country, want", [
    ("0044 7700 1234567", "DE", "+4477001234567"), ("0030 210 1234567", "DE", "+302101234567"), ("302101234567", "DE", "+302101234567"),
    ("210 1234567", "GR", "+302101234567"), ("030 123456", "DE", "+4930123456"), ("+49 1", "DE", "+49 1"), ("call me", "DE", "call me"),
    (None, "DE", None), ("123", "XX", "123")])
def test_phones(spark, phone, country, want):
    df = spark.createDataFrame([(phone, country)], "p string, c string")
    assert df.select(geo.phone_e164("p", "c").alias("y")).first().y == want


@pytest.mark.parametrize("phone, country, want", [
    ("254712345678", None, "+254712345678"), ("0712 345678", "KE", "+254712345678"), ("0803 123 4567", "NG", "+2348031234567"),
    ("92 300 1234567", "", "+923001234567"), ("0300-1234567", "PK", "+923001234567"), ("01712345678", "BD", "+8801712345678"),
    ("8801712345678", None, "+8801712345678"), ("022 123 456", "LB", "+96122123456"), ("233 24 123 4567", None, "+233241234567"),
    ("37498765432", None, "+37498765432"), ("593991234567", None, "+593991234567"), ("0991234567", "EC", "+593991234567"),
    ("5215512345678", "MX", "+525215512345678"), ("502 2345 6789", None, "+50223456789"), ("8096001234", "DO", "+18096001234"),
    ("1 876 555 1234", "JM", "+18765551234"), ("9647901234567", None, "+9647901234567"), ("98 912 345 6789", None, "+989123456789"),
    ("6795551234", None, "+6795551234"), ("38349123456", None, "+38349123456"), ("97517123456", None, "+97517123456"),
    ("8562055512345", None, "+8562055512345"), ("25377831001", None, "+25377831001"), ("94712345678", None, "+94712345678"),
    ("490301234567", None, "+49301234567"), ("12", "DE", "+4912"), ("\t030 1234567\xa0", "DE", "+49301234567"), ("999123", None, "999123")])
def test_phones_of_all_codes(spark, phone, country, want):
    df = spark.createDataFrame([(phone, country)], "p string, c string")
    assert df.select(geo.phone_e164("p", "c").alias("y")).first().y == want


def test_calling_codes_are_prefix_free():
    from tidyleads import refdata
    codes = sorted(refdata.calling_plan())
    assert not [(a, b) for a in codes for b in codes if a != b and b.startswith(a)]
    with_code = {c for c, _, _, _ in refdata.CALLING_CODES}
    assert {c for c, _ in refdata.COUNTRIES} - with_code == {"BV", "HM", "TF", "UM"}  # nobody lives there


def test_every_name_of_a_country_converts(spark):
    from tidyleads import refdata
    rows = refdata.country_names()
    df = spark.createDataFrame([(n, c) for n, c in rows], "n string, c string")
    out = df.select("n", "c", geo.country_to_code("n").alias("code"), geo.country_key("n").alias("key")).collect()
    assert [(r.n, r.code) for r in out if r.code != r.c] == []
    assert all(r.key == refdata.country_key(r.n) for r in out)


@pytest.mark.parametrize("name, code", [
    ("Viet Nam", "VN"), ("vietnam", "VN"), ("Republic of Korea", "KR"), ("Korea, Republic of", "KR"), ("Ivory Coast", "CI"), ("COTE D'IVOIRE", "CI"),
    ("Côte d’Ivoire", "CI"), ("Federal Republic of Germany", "DE"), ("Kingdom of the Netherlands", "NL"), ("The Gambia", "GM"), ("St. Lucia", "LC"),
    ("Saint Lucia", "LC"), ("Bosnia and Herzegovina", "BA"), ("Bosnia And Herzegovina", "BA"), ("Bosnia & Herzegovina", "BA"), ("Democratic Republic of the Congo", "CD"),
    ("Republic of China", "TW"), ("People's Republic of China", "CN"), ("U.S. Virgin Islands", "VI"), ("Lao People's Democratic Republic", "LA"),
    ("Turkiye", "TR"), ("TURKEY", "TR"), ("Iran, Islamic Republic of", "IR"), ("Korea", "Korea"), (" Narnia ", " Narnia "), ("", ""), ("Republic", "Republic"), ("DE", "DE")])
def test_country_names(spark, name, code):
    assert one(spark, name, geo.country_to_code) == code


def test_codes_become_short_names(spark):
    for code, name in (("VN", "Viet Nam"), ("kr", "Korea, Republic of"), ("CI", "Côte d'Ivoire"), ("\tgb ", "United Kingdom"), ("XX", "Xx")):
        assert one(spark, code, geo.standardise_country) == name


def test_template_has_the_reference_options():
    from tidyleads import refdata
    options = refdata.country_options()
    assert len(options) == len(set(options)) == 207
    assert {"GB - Brit.Ind.Oc.Ter", "TP - Timor-Leste", "KN - St Kitts&Nevis", "VN - Vietnam", "MR - Mauretania", "US - United States"} <= set(options)


def test_every_country_has_its_code(spark):
    got = [one(spark, c, geo.country_to_code) for c in ("Thailand", "germany", "Peru", "Viet Nam", "Czech Republic", "Kenya")]
    assert got == ["TH", "DE", "PE", "VN", "CZ", "KE"]
    from tidyleads import refdata
    assert len(refdata.COUNTRIES) == 249 and len({c for c, _ in refdata.COUNTRIES}) == 249


def test_missing_keys_link_nothing_and_keys_link_once(spark):
    acc = spark.createDataFrame([(1, "A", "#"), (2, "B", "nan"), (3, "C", ""), (4, "D", " "), (5, "F", "x.de"), (6, "E", "x.de"), (7, None, None)],
                                "custom_id long, account_name string, website_url string")
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(["#", "nan", "", " ", "x.de", None])], "n long, website_url string")
    got = {r.n: r.account_name for r in link.link_accounts(rows, acc, "website_url", take=("account_name",)).collect()}
    assert got == {0: None, 1: None, 2: None, 3: None, 4: "E", 5: None}
    assert link.link_accounts(rows, acc, "website_url", dedupe=False, take=("account_name",)).count() == 7


def test_rows_without_key_are_spread(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, v string")
    out = joins.left_lookup(rows, lookup, ["k"])
    assert set(out.columns) == {"id", "k", "v"} and out.count() == 3000
    assert out.where("k is null and v is not null").count() == 0 and out.where("k = 1 and v = 'b'").count() == out.where("k = 1").count() > 0
    # no partition of the join holds all rows without a key
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        at = joins.left_lookup(rows, lookup, ["k"]).withColumn("p", F.spark_partition_id()).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert at[at["k"].isna()]["p"].nunique() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_similarity_does_not_depend_on_length():
    long_ = "abcdefgh" + "x" * 240 + "needles!" + "y" * 232
    assert len(long_) == 488 and similarity.partial_ratio("needles!", long_) == 100
    assert similarity.partial_ratio("needles?", long_) >= 85


def test_allowed_values_in_one_pass(spark):
    df = spark.createDataFrame([("Male", "SDE Sourced"), ("male?", "X"), ("male?", None), (" ", "X")], "gender string, source string")
    got = {(r.column, r.value, r["count"]) for r in validate.allowed_values(df, {"gender": "Gender", "source": "Source", "none": "Country"}).collect()}
    assert got == {("gender", "male?", 2), ("source", "X", 2)}


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a\n2,1\n"two\nlines",3\n')
    df = files.read_table(spark, str(tmp_path / "a.csv"), columns=["a", "b"], multi_line=True)
    assert sorted(map(tuple, df.collect())) == [("1", "2"), ("3", "two\nlines")]
    with pytest.raises(ValueError, match="no column"):
        files.read_table(spark, str(tmp_path / "a.csv"), columns=["a", "c"])
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_table(spark, str(folder)).collect()


def test_a_cluster_must_name_its_checkpoint_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_queries_run_from_any_folder(tmp_path):
    import __spark_entry__ as E
    code = (f"import sys; sys.path.insert(0, {E.ROOT!r})\nfrom pyspark.sql import SparkSession\nimport __spark_entry__ as E\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
            "print('rows', E.queries()['bad_email'](s, '/root/testdata/sf0.001').where('bad_email').count())")
    import os
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in run.stdout, run.stderr[-2000:]


def test_own_name_and_legal_word_tables(spark):
    names = spark.createDataFrame([("Xanthippe", "female")], "name string, gender_class string")
    words = spark.createDataFrame([(w,) for w in ("Oyj", "dd", "Société", "the", "oyj")], "word string")
    rows = [("Nokia Oyj", "a@nokia.com"), ("Café-Société d.d. THE", "b@cafe.com"), ("oyj dd", "c@x.com"), (None, "d@x.com"), ("Acme GmbH", "e@acme.com")]
    df = spark.createDataFrame(rows, "account_name string, email string")
    got = {r.account_name: r.c for r in similarity.with_company_clean(df, "account_name", "c", words).collect()}
    assert got == {"Nokia Oyj": "nokia", "Café-Société d.d. THE": "cafdd", "oyj dd": "", None: "", "Acme GmbH": "acmegmbh"}
    want = similarity.with_company_clean(df, "account_name", "c")
    from tidyleads import refdata
    same = similarity.with_company_clean(df, "account_name", "c", spark.createDataFrame([(w,) for w in refdata.LEGAL_WORDS], "word string"))
    assert sorted(map(str, want.collect())) == sorted(map(str, same.collect()))
    scored = {r.account_name: r.domain_score for r in similarity.domain_score(df, words=words).collect()}
    assert scored["Nokia Oyj"] == 100 and scored[None] is None and scored["oyj dd"] is None


def test_jobs_take_own_tables(spark, sf_small):
    from pyspark.sql import functions as F
    from tidyleads.plans import jobs
    import inspect
    assert {"names", "legal_words"} <= set(inspect.signature(jobs.prospect_issues).parameters)
    p = spark.createDataFrame([("Xanthippe", "Bo", "x@nokia.com", "Nokia Oyj")], "first_name string, last_name string, email string, account_name string")
    p = p.withColumns({c: F.lit(None).cast("string") for c in ("title", "gender", "linkedin_url", "country", "account_country")})
    names = spark.createDataFrame([("xanthippe", "female")], "name string, gender_class string")
    words = spark.createDataFrame([("oyj",)], "word string")
    r = validate.validate(p, in_scope=F.lit(True), gender_mode="B", names=names, legal_words=words).first()
    assert (r.plausible_gender, r.gender, r.domain_score) == ("Female", "Female", 100)


def test_country_list_is_checked(spark, sf_small):
    """The query's rows against its SQL, and violations there at all."""
    import duckdb
    import __spark_entry__
    sql = __spark_entry__.oracle_sql()["allowed_values_country"]
    got = sorted(map(tuple, __spark_entry__.queries()["allowed_values_country"](spark, sf_small).collect()))
    con = duckdb.connect()
    for t in ("orders", "part", "customer", "nation", "supplier", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    assert got and got == sorted(con.execute(sql).fetchall())

"""Edge values of the column rules."""

import pytest
from pyspark.sql import functions as F

from tidyleads.functions import contact as C
from tidyleads.functions import geo, text, values


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("v,want", [
    ("o'brien", "O'Brien"), ("guinea-bissau", "Guinea-Bissau"), ("3m", "3M"), ("école", "École"),
    ("JÜRGEN", "Jürgen"), ("", ""), ("  ", "  "), (None, None), ("mc donald", "Mc Donald"),
])
def test_title_case_matches_python_title(spark, v, want):
    assert one(spark, text.title_case, v) == want
    if v is not None:
        assert want == v.title()


@pytest.mark.parametrize("v,want", [
    ("12.7", 12), ("abc", 0), (None, 0), (" 42 ", 42), ("-3.9", -3), ("9007199254740993", 9007199254740993),
    ("1e3", 1000), ("", 0),
])
def test_to_long0(spark, v, want):
    assert one(spark, values.to_long0, v) == want


def test_positive_id_and_numeric(spark):
    assert one(spark, values.positive_id, "-5") == 0
    assert one(spark, values.is_numeric, "n/a") is False
    assert one(spark, values.is_numeric, "12.5") is True


@pytest.mark.parametrize("v,want", [
    ("HTTPS://WWW.Example.com/path", "example.com"), ("http://www2.shop.de/x?y", "shop.de"),
    ("example.com:8080/a", "example.com:8080"), ("sub.example.com", "sub.example.com"),
    ("  www.x.de  ", "x.de"),
])
def test_url_host(spark, v, want):
    assert one(spark, C.url_host, v) == want


@pytest.mark.parametrize("v,want", [("#", False), ("nan", False), ("NaN", False), ("None", False),
                                    ("", False), (None, False), ("x.de", True), ("none", True)])
def test_valid_url(spark, v, want):
    assert one(spark, C.valid_url, v) is want


def test_null_if_missing_tokens_are_per_column(spark):
    assert one(spark, lambda c: values.null_if_missing(c, ("#",)), " # ") is None
    assert one(spark, lambda c: values.null_if_missing(c), "NaN") is None
    assert one(spark, lambda c: values.null_if_missing(c, ("",), nan=False), "None") == "None"


@pytest.mark.parametrize("v,want", [
    ("a.b@x.de", False), ("bad", True), ("", False), (None, False), ("a@b@x.de", True), ("jürgen@x.de", True),
])
def test_bad_email_format(spark, v, want):
    assert one(spark, C.bad_email_format, v) is want


def test_private_email_uses_last_at(spark):
    assert one(spark, C.is_private_email, "a@x.de@GMAIL.com") is True
    assert one(spark, C.is_private_email, None) is False


def test_strip_words_and_fold(spark):
    assert one(spark, text.strip_words, "Müller GmbH & Co. KG") == "müller  & . "
    assert one(spark, text.fold_text, "Müller & Söhne") == "MuellerSoehne"
    assert one(spark, text.fold_text, None) == ""
    # a legal word inside another word stays
    assert one(spark, text.strip_words, "agco") == "agco"


def test_country_functions(spark):
    assert one(spark, geo.standardise_country, "de") == "Germany"
    assert one(spark, geo.standardise_country, "XX") == "Xx"
    assert one(spark, geo.standardise_country, "bosnia and herzegovina") == "Bosnia And Herzegovina"
    assert one(spark, geo.country_to_code, " germany ") == "DE"
    assert one(spark, geo.country_to_code, "Narnia ") == "Narnia "
    assert one(spark, geo.option_code, "DE - Germany") == "DE"
    assert one(spark, geo.option_code, "  ") == "  "


@pytest.mark.parametrize("v,want", [("0 30 123", "+030123"), ("12a", "12a"), (None, None), ("+49 1", "+49 1")])
def test_phone_plus(spark, v, want):
    assert one(spark, C.phone_plus, v) == want


def test_phone_e164(spark):
    df = spark.createDataFrame([("030 1234567", "DE"), ("4930 1234567", None), ("+44 20", "DE"),
                                ("call", "DE"), ("12345", "ZZ"), (None, "DE")], "p string, c string")
    got = [r[0] for r in df.select(geo.phone_e164("p", "c")).collect()]
    assert got == ["+49301234567", "+49301234567", "+44 20", "call", "12345", None]
    got2 = [r["p"] for r in geo.with_phone_e164(df, ["p"], "c").collect()]
    assert got2 == got


def test_gender_rules(spark):
    df = spark.createDataFrame([(" MALE ", "Male"), ("unknown", "Unknown"), (None, "Female"), ("female", "Unknown")],
                               "g string, p string")
    out = df.select(C.normalise_gender("g").alias("g"), "p") \
            .select(C.gender_issue("g", "p").alias("i")).collect()
    assert [r.i for r in out] == [None, "Unknown Gender", "Bad Gender", None]


def test_bad_country_null_counts_as_different(spark):
    df = spark.createDataFrame([("DE", "DE"), ("DE", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(C.bad_country("a", "b")).collect()] == [False, True, True]


def test_domain_score_label(spark):
    df = spark.createDataFrame([(None,), (0,), (49,), (50,)], "s int")
    assert [r[0] for r in df.select(C.domain_score_label("s")).collect()] == \
        ["", "0 - No Match", "49 - Poor Match", "50 - Good Match"]

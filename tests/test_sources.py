"""File sources and sinks on temporary files."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyleads.sources import files


def write(p, text, bom=False):
    p.write_bytes((("﻿" if bom else "") + text).encode("utf-8"))
    return str(p)


def test_bom_and_semicolon(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Custom Id;Account Name\n1;\"Foo, Bar\"\n2;Baz\n", bom=True)
    assert files.sniff_delimiter(spark, path) == ";"
    df = files.read_table(spark, path)
    assert df.columns == ["Custom Id", "Account Name"]
    assert [r[1] for r in df.orderBy("Custom Id").collect()] == ["Foo, Bar", "Baz"]


@pytest.mark.parametrize("pre", [0, 3, 9])
def test_header_below_preamble(spark, tmp_path, pre):
    lines = [f"note {i},," for i in range(pre)] + ["Account ID,Account Name,Country", "10,A,DE",
                                                     "instructions,,", "11,\"B, Inc\",AT"]
    path = write(tmp_path / f"p{pre}.csv", "\n".join(lines) + "\n")
    df = files.read_with_preamble(spark, path, ["Account ID", "Account Name"], "Account ID")
    assert sorted((r["Account ID"], r["Account Name"]) for r in df.collect()) == [("10", "A"), ("11", "B, Inc")]


def test_missing_header_raises(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError):
        files.read_with_preamble(spark, path, ["Account ID", "Account Name"], "Account ID")


def test_fixed_preamble(spark, tmp_path):
    lines = ["t1", "t2", "", "t4", "t5", "t6", "First Name,Email", "Ann,a@x.de", "Bob,"]
    path = write(tmp_path / "u.csv", "\n".join(lines) + "\n")
    df = files.read_fixed_preamble(spark, path, skip=6)
    assert df.columns == ["First Name", "Email"]
    assert sorted(r["First Name"] for r in df.collect()) == ["Ann", "Bob"]


def test_files_with_other_preambles_and_columns(spark, tmp_path):
    """Three files: other preambles, delimiters, orders and sets of columns."""
    d = tmp_path / "accounts"
    d.mkdir()
    (d / "a.csv").write_text("Account ID,Account Name,Country\n1,A,DE\n")
    (d / "b.csv").write_bytes("\ufeffnotes; please read\n;;\nfill in below;;\nCountry; Account  Name ;Account ID;Tags\nAT;\"B; Inc\";2;t\nnote;x;none;\n".encode())
    (d / "c.csv").write_text("\n".join([f"line {i}" for i in range(9)]) + "\nAccount Name,Website,Account ID\n" + "".join(f"N{i},w{i},{i}\n" for i in range(100, 3000)))
    df = files.read_with_preamble(spark, str(d), ["Account ID", "Account Name"], "Account ID")
    got = {r["Account ID"]: r for r in df.collect()}
    assert set(got) == {"1", "2", *map(str, range(100, 3000))}
    assert (got["2"]["Account Name"], got["2"]["Country"], got["2"]["Tags"], got["2"]["Website"]) == ("B; Inc", "AT", "t", None)
    assert (got["1"]["Country"], got["150"]["Website"], got["150"]["Country"]) == ("DE", "w150", None)
    (d / "d.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="d.csv"):
        files.read_with_preamble(spark, str(d), ["Account ID", "Account Name"], "Account ID")


def test_fixed_preambles_of_several_files(spark, tmp_path):
    d = tmp_path / "uploads"
    d.mkdir()
    (d / "a.csv").write_text("t1\nt2,\"x\"\n\n,\nt5\nt6\nFirst  Name,Email\nAnn,a@x.de\nBob,\nt9,zz\n")
    (d / "b.csv").write_text("t9,zz\n2\n3\n4\n5\n6\nEmail,First Name\nc@x.de,Cy\n\"t2\",x\n")
    df = files.read_fixed_preamble(spark, str(d), skip=6)
    got = sorted((r["First Name"], r["Email"]) for r in df.collect())
    # a line of the other file's preamble is a row here
    assert got == sorted([("Ann", "a@x.de"), ("Bob", None), ("t9", "zz"), ("Cy", "c@x.de"), ("x", "t2")])


def test_publish_is_all_or_nothing(spark, tmp_path):
    base = str(tmp_path / "book")
    old = spark.createDataFrame([(1, "old")], "id long, v string")
    assert files.published(spark, base) is None
    with pytest.raises(ValueError):
        files.read_published(spark, base, "One")
    files.publish({"One": old, "Two": old}, base)
    new = spark.createDataFrame([(2, "new")], "id long, v string")
    broken = new.select("id", F.raise_error(F.lit("lost")).cast("string").alias("v"))
    with pytest.raises(Exception):
        files.publish({"One": new, "Two": broken}, base)
    assert [files.read_published(spark, base, n).first().v for n in ("One", "Two")] == ["old", "old"]
    first = files.published(spark, base)
    files.publish({"One": new, "Two": new}, base)
    assert [files.read_published(spark, base, n).first().v for n in ("One", "Two")] == ["new", "new"]
    assert files.published(spark, base)["version"] == first["version"] + 1
    assert spark.read.parquet(first["tables"]["One"]).first().v == "old"  # earlier versions stay


def test_sorted_outputs_read_back_in_order(spark, tmp_path):
    import glob
    import pyarrow.parquet as pq
    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), (F.col("id") * 37 % 101).cast("string"))).alias("tags"),
                                  (F.col("id") * 7919 % 5000).alias("n")).repartition(6)
    files.publish({"All": df}, str(tmp_path / "s"), sort_by={"All": ["tags", "no such column", "n"]})
    path = files.published(spark, str(tmp_path / "s"))["tables"]["All"].removeprefix("file:")
    rows = [tuple(r.values()) for f in sorted(glob.glob(path + "/part-*")) for r in pq.read_table(f).to_pylist()]
    assert len(rows) == 5000 and rows == sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    plan = df.orderBy(F.col("tags").asc_nulls_last())._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan


def test_optional_source_missing_and_present(spark, tmp_path):
    schema = T.StructType([T.StructField("prospect_id", T.StringType()), T.StructField("email", T.StringType())])
    assert files.read_optional(spark, str(tmp_path / "nope"), schema).count() == 0
    src = spark.createDataFrame([("O0001", "a@x.de"), ("Z0001", "b@x.de")], "prospect_id string, email string")
    files.write_table(src, str(tmp_path / "opt"))
    got = files.read_optional(spark, str(tmp_path / "opt"), schema, prefix="O")
    assert [r.prospect_id for r in got.collect()] == ["O0001"]


def test_stage_and_publish_and_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    staged = files.stage(df, str(tmp_path / "stage"))
    assert staged.count() == 1
    out = files.publish({"Prospect Upload": df}, str(tmp_path / "book"), fmt="csv")
    back = spark.read.option("header", True).csv(out["Prospect Upload"])
    assert back.columns == ["id", "v"]
    assert files.emails(spark.createDataFrame([("a@x",), ("a@x",)], "email string")).count() == 2

"""File-source staging stream: new files are staged exactly once."""

from tidyleads.streaming.ingest import stage_stream

COLS = ["custom_id", "first_name", "email", "country", "work_phone"]


def test_stage_stream_appends_new_files_once(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.csv").write_text("custom_id,first_name,email,country,work_phone\n"
                               "10,Ann,ann@gmail.com,Germany,030 1\n11,Bob,bad,nan,\n")
    q = stage_stream(spark, str(src), COLS, str(out), checkpoint=str(tmp_path / "checkpoint"))
    q.awaitTermination(120)
    rows = {r.custom_id: r for r in spark.read.parquet(str(out)).collect()}
    assert rows[10].private_email is True and rows[10].country_code == "DE" and rows[10].work_phone == "+0301"
    assert rows[11].bad_email_format is True and rows[11].country is None
    (src / "b.csv").write_text("custom_id,first_name,email,country,work_phone\n12.7,Cy,c@x.de,DE,\n")
    q = stage_stream(spark, str(src), COLS, str(out), checkpoint=str(tmp_path / "checkpoint"))
    q.awaitTermination(120)
    assert sorted(r.custom_id for r in spark.read.parquet(str(out)).collect()) == [10, 11, 12]

"""The jobs from vendor files to published tables."""

import glob

import pyarrow.parquet as pq
import pytest

from tidyleads.plans import filejobs, jobs
from tidyleads.sources import files

ACCOUNTS = {
    "a.csv": "Please fill in,,,\n,,,\nAccount ID,Account Name,Country,Assigned to\n10001,Beta AG,de,T2\nnote,,,\n10002,Acme GmbH,Viet Nam,T1\n",
    "b.csv": "Account Name;Account ID;Website URL;Country\nCeta;10003;https://www.ceta.at/x;AT\nDelta Dummy;0;#;\n",
}
MASTER = "Report,,,\nOrganization Name1,Business Partner ID,Account Web Address,GEO Level 3 Country Descr\nBETA,10001,www.beta.de,Germany\nX,total,,\nACME,10002,acme.de,FR\n"
OUTREACH = ("First Name,Last Name,Email,Custom Field 32,LinkedIn,Country\nEva,Lang,eva.lang@beta.de,10001,,Germany\n"
            "Max,Muster,max@acme.de,10002,https://linkedin.com/in/m,France\nNo,Mail,,10002,,\n")
ZOOMINFO = ("customId,First Name,Last Name,Job Title,Email Address,Country,ZoomInfo Contact ID\n"
            "10001,Ann,Other,CTO,ann@gmail.com,Germany,5\n10002,Eva,Lang,CEO,eva@acme.de,Viet Nam,6\n10003,Out,Side,CEO,o@ceta.at,France,7\n")
LEADGENIUS = ("Contact Status,customId,Company Name,First Name,Last Name,Job Title,gender,Email,Company Phone,Contact Country,LinkedIn URL,source\n"
              "Verified,10001,Beta AG,chai,DEE,CFO,male,chai.dee@beta.de,0044 7700 123456,Germany,li/beta,\nRejected,10001,Beta AG,R,J,CFO,male,r@beta.de,,Germany,,\n")


@pytest.fixture(scope="module")
def vendor(tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("vendors")
    for folder, content in (("accounts", ACCOUNTS), ("master", {"m.csv": MASTER}), ("o", {"o.csv": OUTREACH}), ("z", {"z.csv": ZOOMINFO}), ("l", {"l.csv": LEADGENIUS})):
        (tmp_path / folder).mkdir()
        for name, text in content.items():
            (tmp_path / folder / name).write_text(text)
    return tmp_path


def _in_order(path):
    return [r for f in sorted(glob.glob(path.removeprefix("file:") + "/part-*")) for r in pq.read_table(f).to_pylist()]


@pytest.fixture(scope="module")
def built(spark, vendor):
    """All jobs of the three vendors, once: base folder, what each published."""
    base = str(vendor / "base")
    accounts = filejobs.setup_accounts(spark, str(vendor / "accounts"), str(vendor / "master"), base)
    issues, out = {}, {}
    for spec in (jobs.OUTREACH, jobs.ZOOMINFO, jobs.LEADGENIUS):
        issues[spec.prefix] = filejobs.find_issues(spark, spec, str(vendor / spec.prefix.lower()), base, threshold=2)
        out[spec.prefix] = filejobs.publish_source(spark, spec, base, threshold=2)
    return base, accounts, issues, out


def test_accounts_from_files(built):
    rows = _in_order(built[1]["Accounts"])
    assert [(r["custom_id"], r["account_name"], r["country"], r["website_url"], r["tags"]) for r in rows] == [
        (10002, "Acme GmbH", "Viet Nam", "acme.de", "T1"), (10001, "Beta AG", "Germany", "beta.de", "T2"),
        (10003, "Ceta", "Austria", "ceta.at", None), (0, "Delta Dummy", None, None, None)]


def test_three_vendors_from_file_to_file(built):
    _, _, issues, out = built
    shown = {p: _in_order(issues[p]["Issues"]) for p in "OZL"}
    # each source's table has its own columns, its own rows and those published before it, sorted
    assert [list(shown[p][0]) for p in "OZL"] == [[c for c in jobs.SPECS[p].issue_columns if c != "company_linkedin"] for p in "OZL"]
    samples = {p: {(r["prospect_id"], r["email"]) for r in _in_order(issues[p]["Sample"])} for p in "OZL"}
    samples["Z"] = {x for x in samples["Z"] if x[1] != "o@ceta.at"}  # another country than its account's
    people = {p: {(r["prospect_id"], r["email"]) for r in shown[p]} for p in "OZL"}
    assert people == {"O": samples["O"], "Z": samples["O"] | samples["Z"], "L": samples["O"] | samples["Z"] | samples["L"]}
    assert {p: len(samples[p]) for p in "OZL"} == {"O": 2, "Z": 2, "L": 1}
    for rows in shown.values():
        key = [tuple((r[c] is None, r[c] or "") for c in jobs.ISSUES_ORDER) for r in rows]
        assert key == sorted(key)
    duplicates = {r["prospect_id"] for r in shown["L"] if "Duplicate" in (r["issue"] or "")}
    assert duplicates == {r["prospect_id"] for r in shown["L"] if (r["first_name"], r["last_name"]) == ("Eva", "Lang")}
    deliverable = _in_order(out["L"]["Deliverable"])
    assert [r["tags"] for r in deliverable] == sorted(r["tags"] for r in deliverable) and all(r["source"] for r in deliverable)
    assert "issue" not in _in_order(out["L"]["Prospects"])[0]


def test_a_repeated_job_gives_the_same_tables(spark, vendor, built):
    base, _, issues, _ = built
    again = filejobs.find_issues(spark, jobs.OUTREACH, str(vendor / "o"), base, threshold=2)
    assert _in_order(again["Issues"]) == _in_order(issues["O"]["Issues"])
    assert files.published(spark, f"{base}/o/issues")["version"] == 2


def test_uploads(spark, vendor, built):
    base = built[0]
    sheet = vendor / "sheet"
    sheet.mkdir()
    (sheet / "u.csv").write_text("1\n2\n3\n4\n5\n6\nCustom  Id,First Name,Last Name,Email,Work Phone,Country\n10001.0,Ann,Bee,,49 30 1,DE - Germany\n,Cy,,,,Viet Nam\n")
    filejobs.export_uploads(spark, base, jobs.ZOOMINFO, str(sheet))
    where = f"{base}/uploads"
    upload = [(r.account_custom_id, r.work_phone, r.country) for r in files.read_published(spark, where, "Prospect Upload").collect()]
    assert sorted(upload) == [("0", None, "VN"), ("10001", "+49301", "DE")]
    pairs = {r.check: (r["first"], r.second, r.proceed) for r in files.read_published(spark, where, "Upload Pairs").collect()}
    assert pairs == {"ID or name": ("true", "false", "true"), "email or phone": ("false", "true", "true")}
    outreach = files.read_published(spark, where, "Outreach Prospects")
    assert "prospect_id" not in outreach.columns and "source" not in outreach.columns and outreach.count() == 2
    assert files.read_published(spark, where, "Repeated Tags").count() == 0


def test_a_failed_publish_leaves_the_last_version(spark, built, monkeypatch):
    base, _, _, out = built
    real, calls = files.write_table, []

    def fails(*args, **kw):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("the driver is gone")
        real(*args, **kw)
    monkeypatch.setattr(files, "write_table", fails)
    with pytest.raises(RuntimeError):
        filejobs.publish_source(spark, jobs.OUTREACH, base, threshold=1)
    assert files.published(spark, f"{base}/o/out")["tables"] == out["O"]

"""Jobs end to end on the smallest fixture."""

from pyspark.sql import functions as F

from tidyleads.plans import jobs
from tidyleads.plans.fixtures import fixture
from tidyleads.plans.q_jobs import vendor_rows
from tidyleads.plans.q_linking import accounts_typed, account_setup, crm_typed


def test_prospect_issues_with_earlier_source(spark, sf_small):
    acc = accounts_typed(spark, sf_small)
    o = jobs.prepare_source(jobs.OUTREACH, vendor_rows(spark, sf_small, jobs.OUTREACH), acc)
    o_out = jobs.prospect_issues(jobs.OUTREACH, o, acc, threshold=3)
    z = jobs.prepare_source(jobs.ZOOMINFO, vendor_rows(spark, sf_small, jobs.ZOOMINFO), acc)
    z_out = jobs.prospect_issues(jobs.ZOOMINFO, z, acc, earlier=[o_out], threshold=3)
    n_o, n_z = o_out.count(), jobs.prospect_issues(jobs.ZOOMINFO, z, acc, threshold=3).count()
    assert z_out.count() == n_o + n_z
    # only the Z rows are validated in the Z job; O rows keep their own issues
    ranks = {r.source_rank for r in z_out.select("source_rank").distinct().collect()}
    assert ranks == {0, 1}
    assert z_out.where("prospect_id LIKE 'O%' AND plausible_gender IS NOT NULL").count() == 0
    ids = [r.prospect_id for r in o.select("prospect_id").collect()]
    assert len(ids) == len(set(ids)) and min(ids) == "O0001"


def test_publish_outputs(spark, sf_small):
    edits = fixture(spark, sf_small, "fx_edits")
    main = fixture(spark, sf_small, "fx_prospects").withColumn(
        "prospect_id", F.concat(F.lit("P"), F.col("row_key").cast("string")))
    acc = accounts_typed(spark, sf_small)
    out = jobs.publish_prospects(jobs.OUTREACH, edits, main.withColumnRenamed("company", "account_name")
                                 .withColumn("tags", F.lit("T")), acc, threshold=3)
    assert set(out) >= {"Deliverable", "Coverage", "Emails", "Accounts with Insufficient Prospects"}
    assert out["Coverage"].count() == 1
    assert out["Emails"].count() == edits.count()
    assert out["Deliverable"].columns[:3] == ["custom_id", "account_name", "tags"]


def test_account_setup_job(spark, sf_small):
    a = account_setup(fixture(spark, sf_small, "fx_accounts"), crm_typed(spark, sf_small))
    assert a.where("website_url LIKE 'http%' OR website_url LIKE 'www%'").count() == 0
    assert a.where("custom_id <= 0").count() == 0


def test_vendor_files_to_issue_tables(spark, tmp_path):
    """Real vendor headers, from CSV to the issues table, without any column of ours."""
    accounts = spark.createDataFrame([(10001, "Acme GmbH", "DE", "T1", "acme.de"), (10002, "Beta AG", "TH", None, None)],
                                     "custom_id long, account_name string, account_country string, tags string, website_url string")
    lead = tmp_path / "lead"
    lead.mkdir()
    (lead / "a.csv").write_text(
        "Contact Status,Company Status,customId,Company Name,Website URL,LinkedIn URL,LinkedIn Profile URL,First Name,Last Name,Job Title,gender,"
        "Email,Company Phone,otherPhones,City,Contact City,Country,Contact Country,Contact Zip code,source\n"
        "Verified,ok,10001.0,Acme GmbH,acme.de,li/acme,https://www.linkedin.com/in/x,anna,SMITH,CTO,female,Anna.Smith@acme.de,0044 7700 123456,,"
        "Firmenstadt,Bonn,France,Germany,53111,\n"
        "Rejected,ok,10001,Acme GmbH,acme.de,,,Bob,Jones,CEO,male,bob@acme.de,,,X,Y,France,Germany,1,\n"
        "Verified,ok,10002,Beta AG,,,,Chai,Dee,CFO,male,chai@gmail.com,,,X,Bangkok,France,Thailand,1,LeadGen\n")
    df = jobs.read_source(spark, str(lead), jobs.LEADGENIUS)
    sample = jobs.prepare_source(jobs.LEADGENIUS, df, accounts)
    assert sample.columns == [c for c in jobs.LEADGENIUS_KEPT if c in sample.columns] + ["prospect_id"]
    from tidyleads.sources.files import read_optional, write_table
    issues = jobs.prospect_issues(jobs.LEADGENIUS, sample, accounts, threshold=3)
    write_table(issues.drop("issues"), str(tmp_path / "issues"))
    back = read_optional(spark, str(tmp_path / "issues"), issues.drop("issues").schema)
    rows = {r.first_name: r for r in back.collect()}
    assert set(rows) == {"Anna", "Chai"}
    anna, chai = rows["Anna"], rows["Chai"]
    assert (anna.prospect_id, anna.last_name, anna.city, anna.country, anna.account_country) == ("L0001", "Smith", "Bonn", "DE", "DE")
    assert anna.work_phone == "+447700123456" and anna.source == "LeadGenius" and anna.custom_id == 10001 and anna.tags == "T1"
    assert chai.country == "TH" and "Private Email" in chai.issue and chai.source == "LeadGen"
    out = tmp_path / "out"
    out.mkdir()
    (out / "o.csv").write_text("First Name;Last Name;Email;Custom Field 32;LinkedIn;Street;Zipcode;Custom Field 18\n"
                               "Eva;Lang;eva@beta.de;10002;;S 1;1;77\nNo;Mail;;10002;;;;\nNo;Account;a@b.de;;;;;\n")
    o = jobs.prepare_source(jobs.OUTREACH, jobs.read_source(spark, str(out), jobs.OUTREACH), accounts).collect()
    assert [(r.prospect_id, r.account_name, r.zip, r.address) for r in o] == [("O0001", "Beta AG", "1", "S 1")]
    zoom = tmp_path / "zoom"
    zoom.mkdir()
    (zoom / "z.csv").write_text("Website URL,First Name,Last Name,Job Title,Email Address,Direct Phone Number,Country,ZoomInfo Contact ID,Founded Year\n"
                                "acme.de,Max,Muster,CTO,max@acme.de,123,DE,5,1999\n#,Ann,Other,CTO,ann@x.de,1,DE,6,\n")
    z = jobs.prepare_source(jobs.ZOOMINFO, jobs.read_source(spark, str(zoom), jobs.ZOOMINFO), accounts).collect()
    assert sorted([(r.first_name, r.account_name, r.company_founded_date) for r in z], reverse=True) == [("Max", "Acme GmbH", 1999), ("Ann", None, 0)]


def test_rules_run_once_before_the_quota_labels(spark, sf_small):
    """Counting, numbering and passing rows on read the validated rows; none of them runs the rules again."""
    acc = accounts_typed(spark, sf_small)
    o = jobs.prepare_source(jobs.OUTREACH, vendor_rows(spark, sf_small, jobs.OUTREACH), acc)
    out = jobs.prospect_issues(jobs.OUTREACH, o, acc, threshold=3)
    lazy = jobs.prospect_issues(jobs.OUTREACH, o, acc, threshold=3, materialize=False)
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (out, lazy)]
    assert plans[1].count("ArrowEvalPython") > 1 and "ArrowEvalPython" not in plans[0]
    assert out.columns == lazy.columns and out.exceptAll(lazy).isEmpty() and lazy.exceptAll(out).isEmpty()

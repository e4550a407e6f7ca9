"""The jobs from files to published tables.

Each job reads vendor files or what earlier jobs published, and publishes its tables all at
once (`files.publish`): a lost job leaves the last version in place, a repeated one gives the
same tables again.  Tables are sorted when written.  Layout under ``base``: ``accounts``, and per
source (o, z, l) ``<source>/issues`` (the sample and the table that people edit) and ``<source>/out``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import to_long0
from ..operators import columns as cols
from ..operators import reconcile
from ..session import written
from ..sources import files
from . import jobs

# Headers of the account template and of the master data report, and the columns that each one feeds.
ACCOUNT_HEADERS = {
    "Account ID": "custom_id", "Account Name": "account_name", "Website URL (if Account ID is not available)": "website_url",
    "Website URL": "website_url", "Country": "country", "Assigned to": "tags", "Tags": "tags",
}
MASTER_HEADERS = {
    "Business Partner ID": "custom_id", "Organization Name1": "account_name", "Account Web Address": "website_url",
    "GEO Level 3 Country Descr": "country",
}
UPLOAD_HEADERS = {
    "Custom Id": "custom_id", "Account Name": "account_name", "First Name": "first_name", "Last Name": "last_name", "Title": "title",
    "Gender": "gender", "Email": "email", "Work Phone": "work_phone", "Country": "country", "Source": "source", "Tags": "tags",
}


def _order(names) -> dict[str, list[str]]:
    return {n: list(jobs.OUTPUT_ORDER[n]) for n in names if n in jobs.OUTPUT_ORDER}


def setup_accounts(spark: SparkSession, accounts_path: str, master_path: str, base: str) -> dict[str, str]:
    """L-1: account templates and master data reports, each file with its own preamble and header,
    to the cleaned account list, sorted by name."""
    from .q_linking import account_setup
    raw = files.read_with_preamble(spark, accounts_path, ["Account ID", "Account Name"], "Account ID")
    raw = cols.rename(raw, {h: c for h, c in ACCOUNT_HEADERS.items() if h in raw.columns})
    raw = cols.ensure_columns(raw, {"website_url": None, "country": None})
    master = files.read_with_preamble(spark, master_path, ["Business Partner ID", "Organization Name1"], "Business Partner ID")
    master = cols.rename(master, {h: c for h, c in MASTER_HEADERS.items() if h in master.columns})
    master = cols.ensure_columns(master, {"website_url": None, "country": None})
    master = master.select(to_long0("custom_id").alias("custom_id"), "website_url", "country",
                           F.xxhash64("account_name", "website_url", "country").alias("crm_row"))
    tables = {"Accounts": account_setup(raw, master)}
    return files.publish(tables, f"{base}/accounts", sort_by=_order(tables))


def accounts(spark: SparkSession, base: str) -> DataFrame:
    """The published account list as the prospect jobs take it."""
    return cols.rename(files.read_published(spark, f"{base}/accounts", "Accounts"), {"country": "account_country"})


def _folder(base: str, spec: jobs.SourceSpec, part: str) -> str:
    return f"{base}/{spec.prefix.lower()}/{part}"


def earlier_prospects(spark: SparkSession, base: str, spec: jobs.SourceSpec) -> list[DataFrame]:
    """What the sources before this one have published: their own rows, under canonical columns.
    A source that has published nothing yet is left out."""
    out = []
    for prefix in spec.earlier:
        folder = _folder(base, jobs.SPECS[prefix], "out")
        if files.published(spark, folder) is not None:
            df = cols.with_prefix(files.read_published(spark, folder, "Prospects"), "prospect_id", prefix)
            out.append(cols.ensure_columns(df, {c: None for c in jobs.CANONICAL}).select(*jobs.CANONICAL))
    return out


def find_issues(spark: SparkSession, spec: jobs.SourceSpec, vendor_path: str, base: str, threshold: int,
                names: DataFrame | None = None, legal_words: DataFrame | None = None) -> dict[str, str]:
    """L-2/3/4, job A: a vendor's files, linked, numbered, united with the earlier sources' published
    rows and validated; publishes the sample and the issues table."""
    acc = accounts(spark, base)
    sample = written(jobs.prepare_source(spec, jobs.read_source(spark, vendor_path, spec), acc))
    issues = jobs.prospect_issues(spec, sample, acc, earlier=earlier_prospects(spark, base, spec), threshold=threshold,
                                  names=names, legal_words=legal_words)
    tables = {"Sample": sample, "Issues": jobs.issues_table(spec, issues)}
    return files.publish(tables, _folder(base, spec, "issues"), sort_by=_order(tables))


def publish_source(spark: SparkSession, spec: jobs.SourceSpec, base: str, threshold: int, hide_email: bool = False,
                   edited: DataFrame | None = None) -> dict[str, str]:
    """L-6, job B: the edited issues table (the published one, unless given) to all outputs of the source."""
    folder = _folder(base, spec, "issues")
    edited = files.read_published(spark, folder, "Issues") if edited is None else edited
    tables = jobs.publish_prospects(spec, edited, files.read_published(spark, folder, "Sample"), accounts(spark, base), threshold, hide_email)
    return files.publish(tables, _folder(base, spec, "out"), sort_by=_order(tables))


def export_uploads(spark: SparkSession, base: str, deliverable_of: jobs.SourceSpec, upload_path: str | None = None) -> dict[str, str]:
    """L-5: each source's published prospects with the deliverable's tags, the prospects whose tags the
    deliverable states more than once, and the upload sheets (six lines above the header), checked and exported."""
    from ..operators import report
    deliverable = files.read_published(spark, _folder(base, deliverable_of, "out"), "Deliverable")
    tables = {"Repeated Tags": report.repeated_keys(deliverable, "prospect_id", "tags")}
    for spec in jobs.SPECS.values():
        folder = _folder(base, spec, "out")
        if files.published(spark, folder) is not None:
            tables[f"{spec.label} Prospects"] = reconcile.final_tags(files.read_published(spark, folder, "Prospects"), deliverable,
                                                                     drop_source=spec.prefix == "O")
    if upload_path is not None:
        upload = cols.normalise_headers(files.read_fixed_preamble(spark, upload_path))
        upload = cols.rename(upload, {h: c for h, c in UPLOAD_HEADERS.items() if h in upload.columns})
        tables |= {"Prospect Upload": jobs.upload_export(upload), "Upload Checks": jobs.upload_checks(upload), "Upload Pairs": jobs.upload_pairs(upload)}
    return files.publish(tables, f"{base}/uploads", fmt="csv")

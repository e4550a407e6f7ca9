"""Jobs: the reference's scripts as lazy Spark plans over canonical columns.

* account setup (L-1): ``q_linking.account_setup``
* prospect issues per source (L-2/3/4): ``prospect_issues(spec, ...)`` - job A,
  ends by writing the issues table that people edit
* publish (L-6 and the deliverable/coverage/exports): ``publish_prospects`` -
  job B, starts from the edited table
* upload export (L-5): ``upload_export``

The manual edit in the middle is a job boundary: job A writes a table, job B
reads it.  Inside a job, a table reused by several branches (the prospect
sample) is cut from its lineage with a reliable checkpoint in the shared
checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.values import to_long0
from ..operators import columns as cols
from ..operators import identity, link, reconcile, report
from ..operators.validate import validate
from ..session import cut_lineage, written
from ..sources import files

CANONICAL = ["custom_id", "account_name", "tags", "first_name", "last_name", "title", "gender", "email",
             "linkedin_url", "work_phone", "mobile_phone", "city", "state", "zip", "country",
             "account_country", "source", "prospect_id"]


# ---------------------------------------------------------------------------
# Vendor headers and the canonical column each one feeds.
# ---------------------------------------------------------------------------
COMMON_HEADERS = {
    "customId": "custom_id", "First Name": "first_name", "Middle Name": "middle_name", "Last Name": "last_name",
    "Gender": "gender", "Title": "title", "Email": "email", "Country": "country",
}
OUTREACH_HEADERS = {
    "Custom Field 32": "custom_id", "Custom Field 18": "zoominfo_contact_id", "Custom Field 29": "lg_source_evidence",
    "Custom Field 19": "zoominfo_company_id", "Custom Field 12": "company_sic_code", "Custom Field 11": "company_naics_code",
    "LinkedIn": "linkedin_url", "Work Phone": "work_phone", "Mobile Phone": "mobile_phone", "Street": "address",
    "City": "city", "State": "state", "Zipcode": "zip", "Company Natural": "company_natural", "Company Founded At": "company_founded_date",
}
ZOOMINFO_HEADERS = {
    "ZoomInfo Contact ID": "zoominfo_contact_id", "Query Name": "account_name", "Website URL": "website_url", "Job Title": "title",
    "Direct Phone Number": "work_phone", "Email Address": "email", "Mobile phone": "mobile_phone",
    "ZoomInfo Contact Profile URL": "lg_source_evidence", "LinkedIn Contact Profile URL": "linkedin_url",
    "Person Street": "address", "Person City": "city", "Person State": "state", "Person Zip Code": "zip",
    "ZoomInfo Company ID": "zoominfo_company_id", "Company Name": "company_natural", "Website": "website",
    "Founded Year": "company_founded_date", "SIC Code 1": "company_sic_code", "NAICS Code 1": "company_naics_code",
}
LEADGENIUS_HEADERS = {
    "Contact Status": "contact_status", "Company Status": "company_status", "Website URL": "website", "Company Name": "company",
    "otherPhones": "mobile_phone", "Company Phone": "work_phone", "LinkedIn URL": "company_linkedin", "Job Title": "title",
    "LinkedIn Profile URL": "linkedin_url", "Contact City": "city", "Contact State": "state", "Contact Country": "country",
    "Contact Zip code": "zip", "gender": "gender", "Prospect Persona": "persona_name", "Prospect Stage": "stage",
    "WBS Code": "wbs_code", "LG_Outcome_Status": "lg_outcome_status", "source": "source",
}
# The company's own address and bookkeeping columns of LeadGenius files.
LEADGENIUS_DROPPED = (
    "Street", "City", "State", "Country", "Zip", "industry", "Employee Range", "Revenue Range", "tags", "Prospect.tags",
    "Last Updated", "Created Date", "Account CRM ID", "Contact CRM ID", "LG Account ID", "LG Contact ID",
)
# Columns that hold whole numbers.
NUMERIC = ("custom_id", "zoominfo_contact_id", "zoominfo_company_id", "company_founded_date", "company_sic_code", "company_naics_code")
OUTREACH_KEPT = (
    "custom_id", "account_name", "account_country", "tags", "first_name", "middle_name", "last_name", "gender", "title", "email",
    "work_phone", "mobile_phone", "linkedin_url", "address", "city", "state", "zip", "country",
)
ZOOMINFO_KEPT = (
    "custom_id", "account_name", "account_country", "company_natural", "tags", "zoominfo_contact_id", "last_name", "first_name",
    "middle_name", "gender", "title", "work_phone", "email", "mobile_phone", "lg_source_evidence", "linkedin_url", "address",
    "city", "state", "zip", "country", "zoominfo_company_id", "website", "company_founded_date", "company_sic_code", "company_naics_code",
)
LEADGENIUS_KEPT = (
    "company_status", "contact_status", "custom_id", "account_name", "account_country", "company", "tags", "website", "first_name",
    "last_name", "title", "gender", "email", "linkedin_url", "city", "state", "country", "zip", "work_phone", "mobile_phone",
    "company_linkedin", "persona_name", "stage", "wbs_code", "lg_outcome_status", "source",
)

# Columns of each source's issues table, in order, and columns that its prospects export leaves out.
ISSUE_COLUMNS = (
    "issue", "account_range", "custom_id", "account_name", "first_name", "last_name", "title", "gender", "plausible_gender", "email",
    "domain_score_label", "linkedin_url", "work_phone", "mobile_phone", "city", "state", "zip", "country", "tags", "prospect_id",
)
ZOOMINFO_ISSUE_COLUMNS = tuple(c for c in ISSUE_COLUMNS if c != "plausible_gender") + ("source",)
LEADGENIUS_ISSUE_COLUMNS = ISSUE_COLUMNS[:12] + ("company_linkedin",) + ISSUE_COLUMNS[12:] + ("source",)
NOT_EXPORTED = ("issue", "account_range", "plausible_gender", "domain_score_label")
# Sort columns of the outputs.
ISSUES_ORDER = ("tags", "account_name", "first_name", "last_name", "issue")
EXPORT_ORDER = ("tags", "account_name", "first_name", "last_name", "source")
INSUFFICIENT_ORDER = ("tags", "account_name")


@dataclass(frozen=True)
class SourceSpec:
    """Configuration of one prospect source: the headers of its files, what to keep, how to link and validate."""
    label: str
    prefix: str
    link_strategy: str
    headers: dict = field(default_factory=dict)
    drop_before_rename: tuple = ()
    keep: tuple = ()
    require: tuple = ()
    verified_only: bool = False
    same_country: bool = False
    convert_country: bool = False
    convert_account_country: bool = False
    format_phones: bool = False
    gender_mode: str = "A"
    check_country: bool = False
    deliverable_extra: tuple = ()
    issue_columns: tuple = ()
    not_exported: tuple = ()
    earlier: tuple = ()
    rank: int = 0


OUTREACH = SourceSpec(label="Outreach", prefix="O", link_strategy="custom_id", headers=COMMON_HEADERS | OUTREACH_HEADERS,
                      keep=OUTREACH_KEPT, require=("email", "custom_id"), issue_columns=ISSUE_COLUMNS, not_exported=NOT_EXPORTED, rank=0)
ZOOMINFO = SourceSpec(label="ZoomInfo", prefix="Z", link_strategy="zi_fallback", headers=COMMON_HEADERS | ZOOMINFO_HEADERS,
                      keep=ZOOMINFO_KEPT, same_country=True, convert_country=True, gender_mode="B", issue_columns=ZOOMINFO_ISSUE_COLUMNS,
                      not_exported=("company_status", "contact_status", *NOT_EXPORTED), earlier=("O",), rank=1)
LEADGENIUS = SourceSpec(label="LeadGenius", prefix="L", link_strategy="company_name", headers=COMMON_HEADERS | LEADGENIUS_HEADERS,
                        drop_before_rename=LEADGENIUS_DROPPED, keep=LEADGENIUS_KEPT, verified_only=True,
                        convert_country=True, convert_account_country=True, format_phones=True,
                        check_country=True, deliverable_extra=("company_linkedin",), issue_columns=LEADGENIUS_ISSUE_COLUMNS,
                        not_exported=("company_status", "contact_status", *NOT_EXPORTED), earlier=("O", "Z"), rank=2)
SPECS = {s.prefix: s for s in (OUTREACH, ZOOMINFO, LEADGENIUS)}
#: Columns of a vendor's row by which equal names are ordered: the rest of what a person's row may hold.
TIEBREAK = ("email", "title", "linkedin_url", "work_phone", "mobile_phone", "city", "state", "zip", "country", "custom_id")


def _order_key():
    """Numeric part of the prospect ID (text order breaks past 9999)."""
    return F.regexp_extract(F.col("prospect_id"), r"([0-9]+)$", 1).cast("bigint")


def read_source(spark, path: str, spec: SourceSpec, **options) -> DataFrame:
    """A vendor's file or folder of files, by its headers."""
    return files.read_table(spark, path, **options)


def prepare_source(spec: SourceSpec, main: DataFrame, accounts: DataFrame) -> DataFrame:
    """One vendor's rows as its files have them: filter, drop, rename to canonical columns, type, link to
    accounts, keep the source's columns and number the rows (the sample that edits are later reconciled against).

    Decision: LeadGenius' own company address is dropped before the contact's takes its
    names, so the contact's city and country survive."""
    df = cols.drop_existing(main, list(spec.drop_before_rename))
    df = cols.rename(df, {h: c for h, c in spec.headers.items() if h in df.columns})
    if spec.verified_only:
        df = cols.where_equals(df, "contact_status", "Verified")
    if spec.require:
        df = cols.require(df, list(spec.require))
    df = cols.cast_long0(df, [c for c in NUMERIC if c in df.columns])
    key = link.choose_link_key(df.columns, spec.link_strategy)
    order = [c for c in ("account_name", "custom_id", "account_country", "website_url", "tags") if c in accounts.columns]
    df = link.link_accounts(df, accounts, on=key, order_by=order)
    df = cols.ensure_columns(df, {"gender": F.lit("").cast("string")})
    df = cols.project(df, [c for c in spec.keep if c in df.columns]) if spec.keep else df
    order = ["account_name", "first_name", "last_name", *[c for c in TIEBREAK if c in df.columns]]
    return identity.assign_ids(df, spec.prefix, order)


def prospect_issues(spec: SourceSpec, sample: DataFrame, accounts: DataFrame,
                    earlier: list[DataFrame] = (), threshold: int = 3, materialize: bool = True,
                    names: DataFrame | None = None, legal_words: DataFrame | None = None) -> DataFrame:
    """Job A for one source: country/phone normalisation, ID repair, source
    label, union with earlier sources' outputs, validation and quota labels.

    With ``materialize`` the unioned prospects are written before
    validation: its four lookups and the main branch then read that table, each its
    own columns, instead of re-running the linking joins and ID numbering five times.
    The validated rows are written likewise: counting, numbering and passing
    the rows on for the quota labels would else run all rules and lookups each.
    ``names`` (name, gender_class) and ``legal_words`` (word) replace the built-in tables."""
    df = sample
    if spec.same_country:
        df = cols.same_country(df)
    if spec.convert_country and "country" in df.columns:
        df = df.withColumn("country", geo.country_to_code("country"))
    if spec.convert_account_country and "account_country" in df.columns:
        df = df.withColumn("account_country", geo.country_to_code("account_country"))
    if spec.format_phones:
        df = geo.with_phone_e164(df, [c for c in ("work_phone", "mobile_phone") if c in df.columns], "country")
    df = link.repair_ids(df.withColumn("custom_id", F.when(F.col("custom_id") > 0, F.col("custom_id"))),
                         accounts, order_by=("account_name", "custom_id")) \
        if "account_name" in df.columns else df
    df = cols.default_source(df, spec.label)
    main = cols.ensure_columns(df, {c: F.lit(None).cast("string") for c in CANONICAL if c not in df.columns})
    main = main.select(*CANONICAL)
    parts = [(e.select(*[c for c in CANONICAL if c in e.columns]), i)
             for i, e in enumerate(earlier)] + [(main, len(earlier))]
    prospects = reconcile.union_sources(parts)
    if materialize:
        prospects = written(prospects)
    v = validate(prospects, in_scope=F.col("prospect_id").startswith(spec.prefix),
                 gender_mode=spec.gender_mode, check_country=spec.check_country,
                 names=names, legal_words=legal_words)
    if materialize:
        v = written(v)
    order = [F.col("source_rank"), F.floor(_order_key() / 1024), _order_key()]
    return identity.quota_label(v, threshold, order_by=order, group="account_name", tiers=[2])


def issues_table(spec: SourceSpec, issues: DataFrame) -> DataFrame:
    """What people edit: the source's own issue columns, in its order."""
    return cols.project(issues, list(spec.issue_columns))


def deliverable(edited: DataFrame, sample: DataFrame, hide_email: bool = False,
                extra: tuple = (), label: str | None = None, unique: bool = False) -> DataFrame:
    """Job B core: edits reconciled with the sample, tagged rows only, IDs
    and names cleaned, a missing source set to the ``label``, deliverable columns in order."""
    rec = reconcile.reconcile(edited, sample, unique=unique)
    tagged = cols.tagged_only(rec)
    if label is not None:
        tagged = cols.default_source(tagged, label)
    clean = cols.clean_id_and_name(tagged)
    return cols.project(clean, cols.deliverable_columns(hide_email, list(extra)))


def publish_prospects(spec: SourceSpec, edited: DataFrame, sample: DataFrame, accounts: DataFrame,
                      threshold: int, hide_email: bool = False) -> dict[str, DataFrame]:
    """All job-B outputs as named tables (one directory each when written; `OUTPUT_ORDER` sorts them)."""
    sample = cut_lineage(sample)
    deliv = deliverable(edited, sample, hide_email, spec.deliverable_extra, spec.label)
    prospects = cols.clean_id_and_name(edited)
    counted = report.sufficiency(accounts, prospects, threshold)
    return {
        "Deliverable": deliv,
        "Prospects": cols.drop_existing(reconcile.reconcile(edited, sample), list(spec.not_exported)),
        "Emails": cols.project(edited, ["email"]),
        "Accounts with Insufficient Prospects": counted.where(F.col("segment") != "sufficient"),
        "Accounts without Prospects": counted.where(F.col("segment") == "none"),
        "Coverage": report.coverage_report(accounts, prospects, threshold),
    }


#: Sort columns of the published tables.
OUTPUT_ORDER = {"Deliverable": EXPORT_ORDER, "Prospects": EXPORT_ORDER, "Issues": ISSUES_ORDER, "Accounts": ("account_name",),
                "Accounts with Insufficient Prospects": INSUFFICIENT_ORDER, "Accounts without Prospects": INSUFFICIENT_ORDER}

UPLOAD_CHECK_COLS = ["email", "title", "first_name", "last_name", "gender", "source", "country"]


def upload_export(upload: DataFrame) -> DataFrame:
    """Upload table (L-5): headers normalised, countries to codes, then
    'XX - Name' options to codes, phones '+'-prefixed, account ID typed and
    renamed."""
    df = cols.normalise_headers(upload)
    if "country" in df.columns:
        df = df.withColumn("country", geo.option_code(geo.country_to_code("country")))
    if "work_phone" in df.columns:
        from ..functions.contact import phone_plus
        df = df.withColumn("work_phone", phone_plus("work_phone"))
    df = cols.rename(df, {"custom_id": "account_custom_id"})
    if "account_custom_id" in df.columns:
        df = df.withColumn("account_custom_id", to_long0("account_custom_id"))
    return df


def upload_checks(upload: DataFrame) -> DataFrame:
    """Completeness of the upload table (missing per column, presence)."""
    return report.completeness(cols.normalise_headers(upload), UPLOAD_CHECK_COLS + ["custom_id", "account_name"])


#: Pairs of which an upload needs one: an account's ID or name (as a column), an e-mail or a phone (as any value).
UPLOAD_PAIRS = {"ID or name": ("present", "custom_id", "account_name"), "email or phone": ("any_value", "email", "work_phone")}


def upload_pairs(upload: DataFrame) -> DataFrame:
    """(check, first, second, proceed): which of a pair the upload has, and whether that is enough."""
    return report.pair_checks(cols.normalise_headers(upload), UPLOAD_PAIRS)

"""Reference data: small, fixed dimension tables.

Every table here has a fixed, known size (at most a few hundred rows), so it
is safe to ship as a literal map inside an expression or as a broadcast side.
The same rows are rendered as ``VALUES`` text for the DuckDB oracle, so both
engines see identical reference data.

Country, calling-code and first-name tables are written from public standards
(ISO 3166-1, ITU-T E.164) and common usage; they are of our own size.
"""

from __future__ import annotations

import re
from importlib import resources
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# Mail domains counted as private (not a company mailbox).
PRIVATE_DOMAINS = [
    "gmail.com", "yahoo.com", "yahoo.de", "hotmail.com", "aol.com",
    "outlook.com", "icloud.com", "mail.com", "live.com", "t-online.de",
    "web.de", "gmx.de", "info.com",
]
# Issue categories, genders and sources accepted in the upload template.
ISSUE_CATEGORIES = [
    "Bad Name", "Bad Email", "Gender", "Duplicate", "Bad Domain",
    "No longer with the company", "Private Email", "Bad Country",
]
UPLOAD_GENDERS = ["Male", "Female"]
UPLOAD_SOURCES = ["SDE Sourced", "AE Sourced"]
# Email shape accepted by the format rule.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Issue labels in the order they are accumulated.
ISSUE_ORDER = [
    "Bad Email Format", "Private Email", "Bad Name", "Bad Email", "Bad Domain",
    "Bad LinkedIn", "Bad Country", "Bad Gender", "Unknown Gender", "Duplicate",
]
# Cut-offs of the similarity rules.
BAD_EMAIL_CUTOFF = 75
BAD_DOMAIN_CUTOFF = 50

# ---------------------------------------------------------------------------
# Our own tables.
# ---------------------------------------------------------------------------
# Legal-form and filler words removed from company names before scoring.
LEGAL_WORDS = [
    "ab", "ag", "and", "as", "aps", "bv", "co", "company", "corp",
    "corporation", "cv", "eg", "ev", "gbr", "gmbh", "group", "holding",
    "inc", "incorporated", "kft", "kg", "kgaa", "limited", "llc", "llp",
    "lp", "ltd", "mbh", "nv", "ohg", "oy", "plc", "pty", "sa", "sarl",
    "sas", "se", "spa", "sp", "srl", "sro", "the", "ug", "und", "zoo",
]

# ISO 3166-1 short names where the public country table (see _countries) spells another.
ISO_NAMES = {
    "AG": "Antigua and Barbuda", "AS": "American Samoa", "BA": "Bosnia and Herzegovina", "BL": "Saint Barthélemy",
    "BN": "Brunei Darussalam", "BO": "Bolivia, Plurinational State of", "BQ": "Bonaire, Sint Eustatius and Saba",
    "CD": "Congo, The Democratic Republic of the", "CF": "Central African Republic", "CG": "Congo", "CI": "Côte d'Ivoire",
    "CV": "Cabo Verde", "CZ": "Czechia", "FK": "Falkland Islands (Malvinas)", "FM": "Micronesia, Federated States of",
    "GB": "United Kingdom", "GS": "South Georgia and the South Sandwich Islands", "HM": "Heard Island and McDonald Islands",
    "IR": "Iran, Islamic Republic of", "KN": "Saint Kitts and Nevis", "KP": "Korea, Democratic People's Republic of",
    "KR": "Korea, Republic of", "LA": "Lao People's Democratic Republic", "LC": "Saint Lucia", "MD": "Moldova, Republic of",
    "MF": "Saint Martin (French part)", "MM": "Myanmar", "MO": "Macao", "PM": "Saint Pierre and Miquelon",
    "PS": "Palestine, State of", "RU": "Russian Federation", "SH": "Saint Helena, Ascension and Tristan da Cunha",
    "SJ": "Svalbard and Jan Mayen", "ST": "Sao Tome and Principe", "SX": "Sint Maarten (Dutch part)",
    "SY": "Syrian Arab Republic", "SZ": "Eswatini", "TC": "Turks and Caicos Islands", "TF": "French Southern Territories",
    "TL": "Timor-Leste", "TR": "Türkiye", "TT": "Trinidad and Tobago", "TW": "Taiwan, Province of China",
    "TZ": "Tanzania, United Republic of", "UM": "United States Minor Outlying Islands", "VA": "Holy See (Vatican City State)",
    "VC": "Saint Vincent and the Grenadines", "VE": "Venezuela, Bolivarian Republic of", "VG": "Virgin Islands, British",
    "VI": "Virgin Islands, U.S.", "VN": "Viet Nam", "WF": "Wallis and Futuna", "WS": "Samoa",
}


def _table_names() -> dict[str, str]:
    """Code and name of every ISO 3166-1 country: the public-domain table that comes with the
    time zone database (package tzdata, else the system's)."""
    try:
        text = (resources.files("tzdata.zoneinfo") / "iso3166.tab").read_text(encoding="utf-8")
    except (ModuleNotFoundError, FileNotFoundError):
        text = Path("/usr/share/zoneinfo/iso3166.tab").read_text(encoding="utf-8")
    return dict(line.split("\t")[:2] for line in text.splitlines() if line and not line.startswith("#"))


_TABLE_NAMES = _table_names()
#: (code, ISO short name) of all countries.
COUNTRIES = sorted((_TABLE_NAMES | ISO_NAMES).items())
# Other common names; spelling, order of words, accents and official forms ("Republic of ...") need none (see country_key).
COUNTRY_ALIASES = [
    ("BO", "Bolivia"), ("BN", "Brunei"), ("CD", "DR Congo"), ("CD", "Congo Kinshasa"), ("CG", "Republic of the Congo"),
    ("CG", "Congo Brazzaville"), ("CI", "Ivory Coast"), ("CZ", "Czech Republic"), ("FM", "Micronesia"), ("FR", "French Republic"),
    ("GB", "Great Britain"), ("GB", "UK"), ("GB", "Britain"), ("GB", "England"), ("GB", "Scotland"), ("GB", "Wales"),
    ("GB", "Northern Ireland"), ("GB", "United Kingdom of Great Britain and Northern Ireland"), ("GR", "Hellenic Republic"),
    ("HK", "Hong Kong SAR"), ("IR", "Iran"), ("IT", "Italian Republic"), ("KG", "Kyrgyz Republic"), ("KP", "North Korea"),
    ("KR", "South Korea"), ("LA", "Laos"), ("MD", "Moldova"), ("MD", "Moldavia"), ("MK", "Macedonia"), ("MM", "Burma"), ("MO", "Macau"),
    ("NL", "Holland"), ("PS", "Palestine"), ("PT", "Portuguese Republic"), ("RU", "Russia"), ("SH", "Saint Helena"), ("SK", "Slovak Republic"),
    ("CH", "Swiss Confederation"), ("SY", "Syria"), ("SZ", "Swaziland"), ("TL", "East Timor"), ("TR", "Turkey"), ("TW", "Taiwan"),
    ("TW", "Republic of China"), ("TZ", "Tanzania"), ("US", "USA"), ("US", "US"), ("US", "United States of America"), ("US", "America"), ("UY", "Oriental Republic of Uruguay"),
    ("VA", "Vatican City"), ("VA", "Vatican"), ("VC", "Saint Vincent"), ("VE", "Venezuela"), ("VI", "US Virgin Islands"), ("CV", "Cape Verde"),
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's: the upload template's country list.
# Built by rule: every country but these codes, under its name of the public table, but for the names below.
# ---------------------------------------------------------------------------
_NO_OPTION = (
    "AQ AS AX BL BV BY CC CF CU CX EH FK GF GS GW HM IO IR KI KM KP MF MH MP MS NA NF NR NU PM PN PW SH SJ SO SY TF TK TL TV UM WF WS"
).split()
OPTION_NAMES = {
    "AE": "Unit.Arab Emir.", "AG": "Antigua/Barbuda", "BA": "Bosnia/Herzeg.", "BN": "Brunei Daruss.", "BQ": "Bonaire, Saba",
    "CD": "Dem. Rep. Congo", "CG": "Rep. of Congo", "CI": "Ivory coast", "CV": "Cabo Verde", "DO": "Dominican Rep.",
    "GB": "Brit.Ind.Oc.Ter", "KN": "St Kitts&Nevis", "KR": "South Korea", "LC": "St. Lucia", "MD": "Moldavia", "MK": "Macedonia",
    "MM": "Myanmar", "MO": "Macao", "MR": "Mauretania", "PF": "Frenc.Polynesia", "PG": "Pap. New Guinea", "PS": "Palestine Reg.",
    "RE": "Reunion", "ST": "S.Tome,Principe", "SX": "Sint Maarten", "SZ": "Eswatini", "TC": "Turksh Caicosin", "TP": "Timor-Leste",
    "TT": "Trinidad,Tobago", "VC": "St. Vincent", "VG": "Brit.Virgin Is.", "VI": "Amer.Virgin Is.",
}
#: Template codes that ISO gives to another country or to none.
OPTION_CODES_OF_ISO = {"GB": "IO", "TP": "TL"}


def country_options() -> list[str]:
    """Upload-template country choices as ``XX - Name``."""
    names = {c: n for c, n in _TABLE_NAMES.items() if c not in _NO_OPTION} | OPTION_NAMES
    return [f"{code} - {name}" for code, name in sorted(names.items())]


def country_names() -> list[tuple[str, str]]:
    """(name, code) of every spelling that means a country: ISO short names, those of the public
    table, common names and the template's."""
    ours = [(n, c) for c, n in COUNTRIES] + [(n, c) for c, n in COUNTRY_ALIASES]
    template = [(n, OPTION_CODES_OF_ISO.get(c, c)) for c, n in OPTION_NAMES.items()]
    return ours + [(n, c) for c, n in _TABLE_NAMES.items()] + template


# Words that do not tell countries apart, and those of official forms that a short name lacks.
COUNTRY_FILLERS = ["the", "of", "and", "part"]
OFFICIAL_WORDS = ["republic", "federal", "kingdom", "state", "states", "democratic", "peoples", "islamic", "plurinational", "bolivarian",
                  "federative", "federated", "federation", "principality", "grand", "duchy", "sultanate", "commonwealth", "union",
                  "independent", "socialist", "united", "arab", "cooperative", "co", "operative", "hashemite"]
ACCENTS = ("áàâäãåāăąçćčďéèêëēėęěíìîïīįłñńňóòôöõøōőřśšşțťúùûüūůűýÿźžż", "aaaaaaaaacccdeeeeeeeeiiiiiilnnnoooooooorssstt" + "uuuuuuuyyzzz")


def country_key(name: str) -> str:
    """Canonical form of a country's name: lower case, without accents, dots and fillers, 'st' as
    'saint', words in alphabetical order (so "Korea, Republic of" is "Republic of Korea")."""
    text = name.lower().translate(str.maketrans(*ACCENTS))
    words = re.split(r"[^\w]+", re.sub(r"[.'’`]", "", text))
    words = ["saint" if w == "st" else w for w in words if w and w not in COUNTRY_FILLERS]
    return " ".join(sorted(words))


def country_by_key() -> dict[str, str]:
    """Canonical name -> code; the first name that gives a key has it."""
    out: dict[str, str] = {}
    for name, code in country_names():
        out.setdefault(country_key(name), code)
    return out


# Calling codes of the ITU's numbering plan by world zone: country, code, trunk prefix ('-': none) and the
# lengths of national numbers.
_NORTH_AMERICA = "US CA AG AI AS BB BM BS DM DO GD GU JM KN KY LC MP MS PR SX TC TT VC VG VI".split()
_CALLING = """
EG 20 0 8-10, SS 211 0 9, MA 212 0 9, EH 212 0 9, DZ 213 0 8-9, TN 216 - 8, LY 218 0 8-9, GM 220 - 7, SN 221 - 9, MR 222 - 8,
ML 223 - 8, GN 224 - 9, CI 225 - 10, BF 226 - 8, NE 227 - 8, TG 228 - 8, BJ 229 - 8/10, MU 230 - 7-8, LR 231 0 7-9, SL 232 0 8,
GH 233 0 9, NG 234 0 8/10, TD 235 - 8, CF 236 - 8, CM 237 - 9, CV 238 - 7, ST 239 - 7, GQ 240 - 9, GA 241 - 7-8, CG 242 - 9,
CD 243 0 7-9, AO 244 - 9, GW 245 - 7/9, IO 246 - 7, SC 248 - 7, SD 249 0 9, RW 250 0 9, ET 251 0 9, SO 252 0 7-9, DJ 253 - 8,
KE 254 0 7-10, TZ 255 0 9, UG 256 0 9, BI 257 - 8, MZ 258 - 8-9, ZM 260 0 9, MG 261 0 9, RE 262 0 9, YT 262 0 9, ZW 263 0 5-10,
NA 264 0 8-9, MW 265 0 7-9, LS 266 - 8, BW 267 - 7-8, SZ 268 - 8, KM 269 - 7, ZA 27 0 9, SH 290 - 4-5, ER 291 0 7, AW 297 - 7,
FO 298 - 6, GL 299 - 6

GR 30 - 10, NL 31 0 9, BE 32 0 8-9, FR 33 0 9, ES 34 - 9, GI 350 - 8, PT 351 - 9, LU 352 - 4-11, IE 353 0 7-9, IS 354 - 7/9,
AL 355 0 8-9, MT 356 - 8, CY 357 - 8, FI 358 0 5-12, AX 358 0 5-12, BG 359 0 7-9, HU 36 06 8-9, LT 370 8 8, LV 371 - 8,
EE 372 - 7-8, MD 373 0 8, AM 374 0 8, BY 375 8 9, AD 376 - 6/8-9, MC 377 0 8-9, SM 378 - 6-10, UA 380 0 9, RS 381 0 8-9,
ME 382 0 8, XK 383 0 8, HR 385 0 8-9, SI 386 0 8, BA 387 0 8-9, MK 389 0 8, IT 39 - 6-11, VA 39 - 6-11

RO 40 0 9, CH 41 0 9, CZ 420 - 9, SK 421 0 9, LI 423 - 7/9, AT 43 0 4-13, GB 44 0 9-10, GG 44 0 10, IM 44 0 10, JE 44 0 10,
DK 45 - 8, SE 46 0 7-10, NO 47 - 8, SJ 47 - 8, PL 48 - 9, DE 49 0 6-13

FK 500 - 5, GS 500 - 5, BZ 501 - 7, GT 502 - 8, SV 503 - 8, HN 504 - 8, NI 505 - 8, CR 506 - 8, PA 507 - 7-8, PM 508 0 6/9,
HT 509 - 8, PE 51 0 8-9, MX 52 - 10, CU 53 0 6-8, AR 54 0 10-11, BR 55 0 10-11, CL 56 - 9, CO 57 - 8/10, VE 58 0 10,
GP 590 0 9, BL 590 0 9, MF 590 0 9, BO 591 0 8, GY 592 - 7, EC 593 0 8-9, GF 594 0 9, PY 595 0 7-9, MQ 596 0 9, SR 597 - 6-7,
UY 598 0 8, CW 599 - 7-8, BQ 599 - 7

MY 60 0 8-10, AU 61 0 9, CC 61 0 9, CX 61 0 9, ID 62 0 8-12, PH 63 0 8-10, NZ 64 0 8-10, PN 64 0 8-10, SG 65 - 8, TH 66 0 8-9,
TL 670 - 7-8, AQ 672 - 6, NF 672 - 6, BN 673 - 7, NR 674 - 7, PG 675 - 7-8, TO 676 - 5/7, SB 677 - 5/7, VU 678 - 5/7, FJ 679 - 7,
PW 680 - 7, WF 681 - 6, CK 682 - 5, NU 683 - 4/7, WS 685 - 5-7, KI 686 - 5/8, NC 687 - 6, TV 688 - 5-7, PF 689 - 6/8, TK 690 - 4-7,
FM 691 - 7, MH 692 - 7

RU 7 8 10, KZ 7 8 10

JP 81 0 9-10, KR 82 0 8-10, VN 84 0 9-10, KP 850 0 8-10, HK 852 - 8, MO 853 - 8, KH 855 0 8-9, LA 856 0 8-10, CN 86 0 9-11,
BD 880 0 8-10, TW 886 0 8-9

TR 90 0 10, IN 91 0 10, PK 92 0 9-10, AF 93 0 9, LK 94 0 9, MM 95 0 7-10, MV 960 - 7, LB 961 0 7-8, JO 962 0 8-9, SY 963 0 8-9,
IQ 964 0 8-10, KW 965 - 8, SA 966 0 8-9, YE 967 0 7-9, OM 968 - 8, PS 970 0 8-9, AE 971 0 8-9, IL 972 0 8-9, BH 973 - 8, QA 974 - 8,
BT 975 - 7-8, MN 976 0 8/10, NP 977 0 8/10, IR 98 0 10, TJ 992 - 9, TM 993 8 8, AZ 994 0 9, GE 995 0 9, KG 996 0 9, UZ 998 - 9
"""


def _calling_codes() -> list[tuple[str, str, str, list[int]]]:
    rows = [(c, "1", "1", [10]) for c in _NORTH_AMERICA]
    for entry in re.split(r",\s*|\n+", _CALLING.strip()):
        country, code, trunk, lengths = entry.split()
        spans = [[int(x) for x in part.split("-")] for part in lengths.split("/")]
        rows.append((country, code, trunk.strip("-"), [n for s in spans for n in range(s[0], s[-1] + 1)]))
    return rows


#: (country, calling code, trunk prefix, lengths of national numbers).
CALLING_CODES = _calling_codes()


def calling_plan() -> dict[str, dict]:
    """Calling code -> trunk prefix and, as bits, the valid national lengths of all its countries."""
    plan: dict[str, dict] = {}
    for _, code, trunk, lengths in CALLING_CODES:
        at = plan.setdefault(code, {"trunk": trunk, "lengths": 0})
        for n in lengths:
            at["lengths"] |= 1 << n
    return plan


# First name -> gender class (male, female, mostly_male, mostly_female, andy).
FIRST_NAMES = [
    ("adam", "male"), ("alex", "andy"), ("alexander", "male"), ("andrea", "mostly_female"),
    ("andreas", "male"), ("anna", "female"), ("anne", "female"), ("antonia", "female"),
    ("ben", "male"), ("carla", "female"), ("charlie", "andy"), ("chris", "mostly_male"),
    ("christian", "male"), ("claire", "female"), ("daniel", "male"), ("david", "male"),
    ("elena", "female"), ("emma", "female"), ("eva", "female"), ("felix", "male"),
    ("florian", "male"), ("francesca", "female"), ("hans", "male"), ("jan", "mostly_male"),
    ("jean", "mostly_male"), ("johanna", "female"), ("jonas", "male"), ("julia", "female"),
    ("jürgen", "male"), ("kai", "mostly_male"), ("karin", "female"), ("kim", "andy"),
    ("klaus", "male"), ("laura", "female"), ("lea", "female"), ("lena", "female"),
    ("luc", "male"), ("lukas", "male"), ("maria", "female"), ("marie", "female"),
    ("mario", "male"), ("markus", "male"), ("martin", "male"), ("max", "male"),
    ("michael", "male"), ("mohammed", "male"), ("nicola", "mostly_female"),
    ("nina", "female"), ("oliver", "male"), ("patrick", "male"), ("paul", "male"),
    ("peter", "male"), ("petra", "female"), ("robin", "andy"), ("sabine", "female"),
    ("sandra", "female"), ("sarah", "female"), ("simon", "male"), ("sophie", "female"),
    ("stefan", "male"), ("susanne", "female"), ("thomas", "male"), ("tim", "male"),
    ("tobias", "male"), ("ulrike", "female"), ("wolfgang", "male"), ("zoë", "female"),
]


# ---------------------------------------------------------------------------
# Spark side: small DataFrames (functions.lookup makes hashed literals).
# ---------------------------------------------------------------------------
def first_names_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("name", T.StringType(), False),
                           T.StructField("gender_class", T.StringType(), False)])
    return spark.createDataFrame(FIRST_NAMES, schema)


def domain_values_df(spark: SparkSession) -> DataFrame:
    rows = ([("Issue Category", v) for v in ISSUE_CATEGORIES]
            + [("Gender", v) for v in UPLOAD_GENDERS]
            + [("Source", v) for v in UPLOAD_SOURCES]
            + [("Country", v) for v in country_options()])
    schema = T.StructType([T.StructField("domain", T.StringType(), False),
                           T.StructField("value", T.StringType(), False)])
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------------------
# SQL side: the same rows as VALUES lists for the oracle.
# ---------------------------------------------------------------------------
def _q(v) -> str:
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def values_sql(rows, columns) -> str:
    body = ", ".join("(" + ", ".join(_q(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(columns)}))"


def sql_countries() -> str:
    return values_sql(COUNTRIES, ["code", "name"])


def sql_country_names() -> str:
    return values_sql([(i, n, c) for i, (n, c) in enumerate(country_names())], ["place", "name", "code"])


def sql_calling_codes() -> str:
    return values_sql([(c, cc, trunk, "," + ",".join(map(str, lengths)) + ",") for c, cc, trunk, lengths in CALLING_CODES],
                      ["country", "cc", "trunk", "lengths"])


def sql_first_names() -> str:
    return values_sql(FIRST_NAMES, ["name", "gender_class"])


def sql_private_domains() -> str:
    return values_sql([(d,) for d in PRIVATE_DOMAINS], ["domain"])


def sql_legal_words() -> str:
    return values_sql([(w,) for w in LEGAL_WORDS], ["word"])


def sql_domain_values() -> str:
    rows = ([("Issue Category", v) for v in ISSUE_CATEGORIES]
            + [("Gender", v) for v in UPLOAD_GENDERS]
            + [("Source", v) for v in UPLOAD_SOURCES]
            + [("Country", v) for v in country_options()])
    return values_sql(rows, ["domain", "value"])

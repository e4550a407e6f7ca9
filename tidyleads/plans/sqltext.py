"""DuckDB expression text for the oracle side: the same rule written in SQL.

These are plain string builders used only by ``oracle_sql()``.
"""

from __future__ import annotations

from .. import refdata


def lit_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"


def trimmed(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"


def to_long0(x: str) -> str:
    u = trimmed(f"CAST({x} AS VARCHAR)")
    t = f"(CASE WHEN regexp_full_match({u}, '{NUMBER}') THEN {u} END)"
    return (f"coalesce(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS BIGINT) END, "
            f"TRY_CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS BIGINT), CAST(0 AS BIGINT))")


def positive_id(x: str) -> str:
    return f"greatest({to_long0(x)}, CAST(0 AS BIGINT))"


def is_numeric(x: str) -> str:
    t = trimmed(f"CAST({x} AS VARCHAR)")
    return f"coalesce(regexp_full_match({t}, '{NUMBER}'), false)"


def is_blank(x: str) -> str:
    return f"(coalesce({trimmed(x)}, '') = '')"


def null_if_missing(x: str, tokens=("",), nan=True) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in tokens)
    t = trimmed(x)
    cond = f"{x} IS NULL OR {t} IN ({toks}) OR {t} = ''"
    if nan:
        cond += f" OR lower({t}) = 'nan'"
    return f"(CASE WHEN {cond} THEN NULL ELSE {x} END)"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda r: upper(substr(r, 1, 1)) || substr(r, 2)), '')")


def fold_text(x: str) -> str:
    y = f"CAST({x} AS VARCHAR)"
    for a, b in [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss")]:
        y = f"replace({y}, '{a}', '{b}')"
    return f"coalesce(regexp_replace({y}, '[^a-zA-Z0-9]', '', 'g'), '')"


def strip_words(x: str, words=None) -> str:
    words = words if words is not None else refdata.LEGAL_WORDS
    return (f"array_to_string(list_filter(regexp_extract_all(lower({x}), "
            f"'([\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+)'), "
            f"lambda r: NOT list_contains({lit_list(words)}, r)), '')")


def valid_url(x: str) -> str:
    t = trimmed(x)
    return (f"({t} IS NOT NULL AND {t} <> '' AND {t} <> '#' AND {t} <> 'None' "
            f"AND lower({t}) <> 'nan')")


def url_host(x: str) -> str:
    return (f"regexp_replace(split_part(regexp_replace(lower({trimmed(x)}), '^https?://', ''), '/', 1), "
            f"'^www[0-9]*\\.', '')")


def email_domain(x: str) -> str:
    return f"lower(regexp_extract({x}, '([^@]*)$', 1))"


def is_private_email(x: str) -> str:
    return f"coalesce({email_domain(x)} IN (SELECT domain FROM {refdata.sql_private_domains()}), false)"


def bad_email_format(x: str) -> str:
    return (f"coalesce(NOT {is_blank(x)} AND NOT regexp_matches({x}, '{refdata.EMAIL_PATTERN}'), false)")


def domain_core(x: str) -> str:
    e = f"lower({x})"
    return (f"(CASE WHEN instr({e}, '@') > 0 THEN split_part(substr({e}, instr({e}, '@') + 1), '.', 1) END)")


def bad_linkedin(x: str) -> str:
    return f"coalesce(NOT {is_blank(x)} AND NOT contains(lower({x}), 'linkedin'), false)"


def bad_country(a: str, b: str) -> str:
    return f"coalesce({a} <> {b}, true)"


def normalise_gender(x: str) -> str:
    g = f"lower({trimmed(x)})"
    return f"(CASE WHEN {g} = 'male' THEN 'Male' WHEN {g} = 'female' THEN 'Female' ELSE 'Unknown' END)"


def gender_issue(g: str, p: str) -> str:
    return (f"(CASE WHEN {g} <> {p} AND {p} <> 'Unknown' THEN 'Bad Gender' "
            f"WHEN {g} = 'Unknown' AND {p} = 'Unknown' THEN 'Unknown Gender' END)")


def phone_plus(x: str) -> str:
    s = f"replace({trimmed(x)}, ' ', '')"
    return f"(CASE WHEN regexp_full_match({s}, '[0-9]+') THEN '+' || {s} ELSE {x} END)"


def standardise_country(x: str) -> str:
    t = trimmed(x)
    name = f"(SELECT name FROM {refdata.sql_countries()} WHERE code = upper({t}))"
    return f"coalesce(CASE WHEN length({t}) = 2 THEN {name} END, {title_case(t)})"


def country_words(x: str) -> str:
    text = f"translate(lower({x}), '{refdata.ACCENTS[0]}', '{refdata.ACCENTS[1]}')"
    words = f"regexp_split_to_array(regexp_replace({text}, '[.''’`]', '', 'g'), '[^\\p{{L}}\\p{{N}}_]+')"
    return (f"list_sort(list_filter(list_transform({words}, lambda w: CASE WHEN w = 'st' THEN 'saint' ELSE w END), "
            f"lambda w: w <> '' AND NOT list_contains({lit_list(refdata.COUNTRY_FILLERS)}, w)))")


#: CTEs: `codes` (key, code), the first of the names that give a key.
COUNTRY_CODES = f"""
, codes AS MATERIALIZED (SELECT array_to_string({country_words('name')}, ' ') AS key, arg_min(code, place) AS code FROM {refdata.sql_country_names()} GROUP BY key)"""


def country_to_code(x: str) -> str:
    """Needs the CTEs of `COUNTRY_CODES`."""
    w = country_words(x)
    short = f"list_filter({w}, lambda v: NOT list_contains({lit_list(refdata.OFFICIAL_WORDS)}, v))"
    return (f"coalesce((SELECT code FROM codes WHERE key = array_to_string({w}, ' ')), "
            f"(SELECT code FROM codes WHERE key = array_to_string({short}, ' ')), {x})")


def option_code(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {trimmed(x)} = '' THEN {x} ELSE {trimmed(f'split_part({x}, chr(45), 1)')} END)"


def domain_score_label(s: str) -> str:
    return (f"(CASE WHEN {s} IS NULL THEN '' WHEN {s} = 0 THEN '0 - No Match' "
            f"WHEN {s} <= 49 THEN CAST({s} AS VARCHAR) || ' - Poor Match' "
            f"ELSE CAST({s} AS VARCHAR) || ' - Good Match' END)")


def windowed_similarity(a: str, b: str) -> str:
    s = f"(CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END)"
    l_ = f"(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END)"
    n = f"length({s})"
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {a} = {b} THEN 100 WHEN {n} = 0 THEN 0 "
            f"ELSE CAST(list_max(list_transform(range(1, length({l_}) - {n} + 2), "
            f"lambda i: round(100.0 * (1.0 - levenshtein({s}, substr({l_}, i, {n})) / {n})))) AS INTEGER) END)")


def _blocks(name: str, pairs: str) -> str:
    """CTEs: ``name`` has the matching blocks (id, i, j, k) of the pairs (id, s, l): the longest common
    run of a stretch (first by i, then by j), then those left and right of it, by recursion."""
    return f"""
, {name}_s AS MATERIALIZED (SELECT id, x, substr(s, CAST(x AS INT) + 1, 1) AS c FROM (SELECT id, s, unnest(range(length(s))) AS x FROM {pairs}))
, {name}_l AS MATERIALIZED (SELECT id, y, substr(l, CAST(y AS INT) + 1, 1) AS c FROM (SELECT id, l, unnest(range(length(l))) AS y FROM {pairs}))
, {name} AS (
  SELECT id, CAST(0 AS BIGINT) AS alo, length(s) AS ahi, CAST(0 AS BIGINT) AS blo, length(l) AS bhi,
         CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS k FROM {pairs}
  UNION ALL
  SELECT id, alo, ahi, blo, bhi, best.i, best.j, best.k FROM (
    SELECT id, alo, ahi, blo, bhi, arg_min({{'i': i, 'j': j, 'k': k}}, {{'n': -k, 'i': i, 'j': j}}) AS best FROM (
      SELECT id, alo, ahi, blo, bhi, min(x) AS i, min(y) AS j, count(*) AS k FROM (
        SELECT st.*, x, y, x - row_number() OVER (PARTITION BY st.id, alo, blo, y - x ORDER BY x) AS run
        FROM (SELECT id, o.alo, o.ahi, o.blo, o.bhi FROM (
                SELECT id, unnest([{{'alo': alo, 'ahi': i, 'blo': blo, 'bhi': j}}, {{'alo': i + k, 'ahi': ahi, 'blo': j + k, 'bhi': bhi}}]) AS o FROM {name})) st
        JOIN {name}_s a ON a.id = st.id AND a.x >= alo AND a.x < ahi
        JOIN {name}_l b ON b.id = st.id AND b.c = a.c AND b.y >= blo AND b.y < bhi)
      GROUP BY id, alo, ahi, blo, bhi, y - x, run)
    GROUP BY id, alo, ahi, blo, bhi))"""


def partial_ratios(pairs: str, out: str) -> str:
    """CTEs: ``out`` has (a, b, score), the partial ratio of the distinct pairs (a, b) of a CTE."""
    return f"""
, {out}_p AS MATERIALIZED (
  SELECT row_number() OVER () AS id, a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s,
         CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l
  FROM (SELECT DISTINCT a, b FROM {pairs} WHERE a <> b AND a <> '' AND b <> ''))
{_blocks(out + '_o', out + '_p')}
, {out}_w AS MATERIALIZED (
  SELECT row_number() OVER () AS id, pid, s, substr(l, CAST(start AS INT) + 1, length(s)) AS l FROM (
    SELECT p.id AS pid, s, l, greatest(j - i, 0) AS start FROM {out}_o o JOIN {out}_p p USING (id) WHERE k > 0
    UNION SELECT id, s, l, greatest(length(l) - length(s), 0) FROM {out}_p))
{_blocks(out + '_i', out + '_w')}
, {out}_r AS (
  SELECT w.pid, max(2.0::DOUBLE * coalesce(m, 0) / (length(s) + length(l))) AS r
  FROM {out}_w w LEFT JOIN (SELECT id, sum(k) AS m FROM {out}_i GROUP BY id) USING (id) GROUP BY w.pid)
, {out} AS MATERIALIZED (
  SELECT a, b, CAST(CASE WHEN r > 0.995 THEN 100 ELSE round_even(100 * r, 0) END AS INT) AS score FROM {out}_p JOIN {out}_r ON id = pid
  UNION ALL SELECT DISTINCT a, b, CASE WHEN a = b THEN 100 ELSE 0 END FROM {pairs} WHERE a = b OR a = '' OR b = '')"""

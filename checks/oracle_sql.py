"""DuckDB oracle SQL for every registered query.

Each query is written independently in plain SQL over the driver's
pre-registered views (orders, customer, nation, lineitem, ...).  Shared
stages are CTEs: ``raw`` (the FIXTURES adapter), ``clean``, ``areas``,
``idx``.  Doubles are computed with the same operation order as the Spark
code; rounding is numpy's (scale, round half to even, unscale).
"""

from __future__ import annotations

YEAR = 1998

RAW = """
raw AS (
SELECT
  o_orderkey AS case_id,
  356 AS event_code,
  'case' AS event_name,
  year(o_orderdate) AS epi_year,
  weekofyear(o_orderdate) AS epi_week,
  CAST(CAST(o_orderdate AS date) AS varchar) AS notified_text,
  CASE WHEN o_orderkey % 101 = 0 THEN 'bad'
       ELSE CAST(CAST(s.first_ship AS date) AS varchar) END AS onset_text,
  CAST(make_date(CAST(year(o_orderdate) - CAST(floor(o_totalprice) AS bigint) % 95
       - CASE WHEN o_orderkey % 211 = 0 THEN 5 ELSE 0 END AS int),
       CAST(1 + o_orderkey % 12 AS int), CAST(1 + o_orderkey % 28 AS int)) AS varchar) AS born_text,
  CAST(floor(o_totalprice) AS bigint) % 95 AS age,
  1 AS age_unit,
  CASE WHEN o_orderkey % 89 = 0 THEN 'f'
       WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M'
       WHEN o_orderkey % 50 = 0 THEN 'X'
       WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
  CAST(substr(o_orderpriority, 1, 1) AS int) AS area_type,
  CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 2 END AS hospital_code,
  CAST(n_nationkey AS varchar) AS region_code,
  CAST(m.seg AS varchar) AS local_code,
  CASE WHEN n_nationkey = 24 THEN 'EXTERIOR'
       WHEN o_orderkey % 997 = 0 THEN NULL
       WHEN o_orderkey % 4 = 1 THEN lower(n_name)
       WHEN o_orderkey % 4 = 2 THEN concat('  ', n_name, ' ')
       WHEN o_orderkey % 4 = 3 THEN replace(n_name, '_', ' ')
       ELSE n_name END AS region_name,
  c_mktsegment AS local_name,
  CASE WHEN o_custkey % 7  = 0 THEN 1 ELSE 2 END AS gp_psychiatric,
  CASE WHEN o_custkey % 11 = 0 THEN 1 ELSE 2 END AS gp_migrant,
  CASE WHEN o_custkey % 13 = 0 THEN 1 ELSE 2 END AS gp_pregnant,
  CASE WHEN o_orderkey % 3 = 0 THEN '   '
       ELSE concat(' g', CAST(o_custkey % 4 AS varchar)) END AS group_name,
  CASE WHEN o_orderkey % 5 = 0 THEN ' ' WHEN o_orderkey % 77 = 0 THEN 'n/a'
       ELSE concat(CAST(1 + o_custkey % 6 AS varchar), '  ') END AS stratum
FROM orders
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation   ON c_nationkey = n_nationkey
LEFT JOIN (VALUES ('AUTOMOBILE',1),('BUILDING',2),('FURNITURE',3),('HOUSEHOLD',4),('MACHINERY',5))
     AS m(name, seg) ON c_mktsegment = m.name
LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) s
  ON o_orderkey = s.l_orderkey
)"""

POP = """
pop AS (
SELECT concat(lpad(CAST(n_nationkey AS varchar), 2, '0'), lpad(CAST(m.seg AS varchar), 3, '0')) AS area_code,
       CAST(20000 + 1000 * ((n_nationkey * 7 + m.seg * 13) % 50) AS double) AS population
FROM nation CROSS JOIN (VALUES (1),(2),(3),(4),(5)) AS m(seg)
WHERE (n_nationkey * 5 + m.seg) % 3 <> 0 AND n_nationkey % 10 <> 9
)"""

ALIASES = """
aliases AS (
SELECT DISTINCT upper(replace(n_name, '_', ' ')) AS variant, upper(n_name) AS canonical FROM nation
)"""


def _t(c):
    return f"nullif(trim({c}), '')"


PREP = f"""
prep AS (
SELECT
  CAST(case_id AS bigint) AS case_id, CAST(event_code AS integer) AS event_code,
  {_t('event_name')} AS event_name, CAST(epi_year AS integer) AS epi_year,
  CAST(epi_week AS integer) AS epi_week,
  {_t('notified_text')} AS notified_text, {_t('onset_text')} AS onset_text,
  {_t('born_text')} AS born_text,
  CAST(age AS integer) AS age, CAST(age_unit AS integer) AS age_unit,
  {_t('sex')} AS sex, CAST(area_type AS integer) AS area_type,
  CAST(hospital_code AS integer) AS hospital_code,
  {_t('region_code')} AS region_code, {_t('local_code')} AS local_code,
  coalesce(a.canonical, upper({_t('region_name')})) AS region_name,
  {_t('local_name')} AS local_name,
  CAST(gp_psychiatric AS integer) AS gp_psychiatric, CAST(gp_migrant AS integer) AS gp_migrant,
  CAST(gp_pregnant AS integer) AS gp_pregnant,
  {_t('group_name')} AS group_name, {_t('stratum')} AS stratum
FROM raw r LEFT JOIN aliases a ON upper({_t('r.region_name')}) = a.variant
)"""

MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
MONTHS_SHORT = "['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic']"


def _bins(x, edges, labels):
    parts = [f"WHEN {x} > {lo} AND {x} <= {hi} THEN {lab}"
             for lo, hi, lab in zip(edges[:-1], edges[1:], labels)]
    return "CASE " + " ".join(parts) + " END"


AGE_E = (0, 11, 17, 25, 35, 45, 59, 150)
AGE_L = ["'0–11'", "'12–17'", "'18–25'", "'26–35'", "'36–45'", "'46–59'", "'60+'"]
WK_E = (0, 13, 26, 39, 52)
WK_L = ["'T1 (Sem 1–13)'", "'T2 (Sem 14–26)'", "'T3 (Sem 27–39)'", "'T4 (Sem 40–52)'"]


def _zfill(c, n):
    return f"CASE WHEN length({c}) < {n} THEN lpad({c}, {n}, '0') ELSE {c} END"


DERIVE = f"""
typed AS (
SELECT * EXCLUDE (notified_text, onset_text, born_text),
  CAST(try_strptime(notified_text, '%Y-%m-%d') AS date) AS notified_on,
  CAST(try_strptime(onset_text, '%Y-%m-%d') AS date) AS onset0,
  CAST(try_strptime(born_text, '%Y-%m-%d') AS date) AS born_on,
  CASE WHEN region_name = 'BOGOTÁ D.C.' THEN '11001'
       ELSE {_zfill('region_code', 2)} || {_zfill('local_code', 3)} END AS area_code
FROM scoped
),
clean AS (
SELECT * EXCLUDE (onset0, group_name, stratum),
  onset0 IS NOT NULL AND coalesce(onset0 > notified_on
      OR date_diff('day', onset0, notified_on) > 365, false) AS onset_corrected,
  CASE WHEN NOT (onset0 IS NOT NULL AND coalesce(onset0 > notified_on
      OR date_diff('day', onset0, notified_on) > 365, false)) THEN onset0 END AS onset_on,
  CAST(month(notified_on) AS integer) AS month,
  {MONTHS}[month(notified_on)] AS month_name,
  strftime(notified_on, '%Y-%m') AS year_month,
  {_bins('epi_week', WK_E, WK_L)} AS quarter,
  CASE WHEN coalesce(epi_week <= 26, false) THEN 'H1 (Sem 1–26)' ELSE 'H2 (Sem 27–52)' END AS semester,
  {_bins('age', AGE_E, AGE_L)} AS age_group,
  CAST({_bins('age', AGE_E, [str(i) for i in range(1, 8)])} AS integer) AS age_group_ord,
  CASE sex WHEN 'F' THEN 'Femenino' WHEN 'M' THEN 'Masculino' ELSE 'Otro/Ind.' END AS sex_label,
  CASE area_type WHEN 1 THEN 'Cabecera municipal' WHEN 2 THEN 'Centro poblado'
       WHEN 3 THEN 'Rural disperso' ELSE 'Desconocida' END AS area_label,
  CASE hospital_code WHEN 1 THEN 'Hospitalizado' WHEN 2 THEN 'No hospitalizado'
       ELSE 'Desconocido' END AS hospital_label,
  coalesce(age < 18, false) AS is_minor,
  coalesce(age BETWEEN 12 AND 17, false) AS is_adolescent,
  coalesce(area_type = 3, false) AS is_rural,
  born_on IS NOT NULL AND coalesce(abs(date_diff('day', born_on, notified_on) / 365.25 - age) > 2, false)
      AS age_inconsistent,
  coalesce(group_name, 'Sin especificar') AS group_name,
  CASE WHEN try_cast(stratum AS double) = floor(try_cast(stratum AS double))
       THEN CAST(try_cast(stratum AS double) AS integer) END AS stratum
FROM typed
)"""


def scoped_cte(year=YEAR):
    yr = f" AND coalesce(epi_year = {year}, false)" if year is not None else ""
    return f"""
dedup AS (SELECT DISTINCT * FROM prep),
scoped AS (SELECT * FROM dedup WHERE NOT coalesce(region_name IN ('EXTERIOR'), false){yr})"""


def _pct(cond):
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS double) / CAST(count(*) AS double)"


AREAS = f"""
areas0 AS (
SELECT area_code, region_name, local_name,
  CAST(count(case_id) AS bigint) AS cases,
  CAST(sum(CASE WHEN coalesce(epi_week > 26, false) THEN 0 ELSE 1 END) AS bigint) AS cases_h1,
  CAST(sum(CASE WHEN epi_week > 26 THEN 1 ELSE 0 END) AS bigint) AS cases_h2,
  {_pct('age BETWEEN 12 AND 17')} AS pct_adolescent,
  {_pct('age BETWEEN 18 AND 25')} AS pct_young_adult,
  {_pct('hospital_code = 1')} AS pct_hospitalised,
  {_pct('gp_psychiatric = 1')} AS pct_psychiatric,
  {_pct('is_minor')} AS pct_minor,
  {_pct("sex = 'F'")} AS pct_female,
  {_pct('is_rural')} AS pct_rural
FROM clean
WHERE area_code IS NOT NULL AND region_name IS NOT NULL AND local_name IS NOT NULL
GROUP BY area_code, region_name, local_name
),
areas1 AS (
SELECT *, greatest(least(CASE WHEN cases_h1 = 0 THEN CAST(1.0 AS double)
    ELSE (CAST(cases_h2 AS double) - CAST(cases_h1 AS double)) / CAST(cases_h1 AS double) END,
    CAST(1.0 AS double)), CAST(-1.0 AS double)) AS trend
FROM areas0
),
areas2 AS (SELECT a.*, p.population FROM areas1 a LEFT JOIN pop p USING (area_code)),
regmean AS (
SELECT region_name, round_even(avg(population), 0) AS rp FROM areas2
WHERE population IS NOT NULL GROUP BY region_name
),
areas AS (
SELECT a.* EXCLUDE (population),
  coalesce(a.population, r.rp, CAST(50000.0 AS double)) AS population,
  CAST(a.cases AS double) / coalesce(a.population, r.rp, CAST(50000.0 AS double)) * CAST(100000.0 AS double) AS rate_100k
FROM areas2 a LEFT JOIN regmean r USING (region_name)
)"""

MEAN2 = ("CAST(sum(CAST(round_even(score * CAST(100.0 AS double), 0) AS bigint)) AS double)"
         " / CAST(count(score) AS double) / CAST(100.0 AS double)")
COMPS = ("rate_100k", "pct_adolescent", "trend", "pct_hospitalised", "pct_psychiatric")
WEIGHTS = ("0.35", "0.25", "0.2", "0.1", "0.1")


def _norm(c):
    return (f"CASE WHEN mm.{c}_mx = mm.{c}_mn THEN CAST(0.0 AS double) "
            f"ELSE (a.{c} - mm.{c}_mn) / (mm.{c}_mx - mm.{c}_mn) END")


def _rnd(x, d):
    scale = "CAST(%s AS double)" % float(10 ** d)
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


_SUM = None
for _c, _w in zip(COMPS, WEIGHTS):
    _term = f"CAST({_w} AS double) * {_c}_norm"
    _SUM = _term if _SUM is None else f"({_SUM} + {_term})"

IDX = f"""
mm AS (SELECT {', '.join(f'min({c}) AS {c}_mn, max({c}) AS {c}_mx' for c in COMPS)} FROM areas),
normed AS (SELECT a.*, {', '.join(f'{_norm(c)} AS {c}_norm' for c in COMPS)} FROM areas a, mm),
scored AS (SELECT *, {_rnd(f'{_SUM} * CAST(100.0 AS double)', 2)} AS score FROM normed),
idx AS (
SELECT *,
  CASE WHEN score >= 80 THEN 'Crítica' WHEN score >= 60 THEN 'Alta'
       WHEN score >= 40 THEN 'Media' ELSE 'Baja' END AS priority,
  CAST(rank() OVER (ORDER BY score DESC) AS integer) AS rank
FROM scored
)"""


def with_ctes(select: str, stages=("raw", "clean"), year=YEAR) -> str:
    """Prefix ``select`` with the CTE chain up to the last named stage."""
    order = ["raw", "clean", "areas", "idx"]
    last = max(order.index(s) for s in stages)
    parts = [RAW]
    if last >= 1:
        parts += [ALIASES, PREP, scoped_cte(year), DERIVE]
    if last >= 2:
        parts += [POP, AREAS]
    if last >= 3:
        parts += [IDX]
    body = select.lstrip()
    if body.upper().startswith("WITH "):     # the query brings its own CTEs
        return "WITH " + ",".join(parts) + ",\n" + body[5:]
    return "WITH " + ",".join(parts) + "\n" + select


def rnd(x, d):
    return _rnd(x, d)


QUERIES: dict[str, str] = {}


def q(name, select, stages=("clean",), year=None):
    QUERIES[name] = with_ctes(select, stages, year)


# --------------------------------------------------------------------------
# 2.13 priority index
# --------------------------------------------------------------------------
IDX_COLS = ("area_code, region_name, local_name, cases, cases_h1, cases_h2, pct_adolescent, "
            "pct_young_adult, pct_hospitalised, pct_psychiatric, pct_minor, pct_female, "
            "pct_rural, trend, population, rate_100k, rate_100k_norm, pct_adolescent_norm, "
            "trend_norm, pct_hospitalised_norm, pct_psychiatric_norm, score, priority, rank")
q("idx_priority", f"SELECT {IDX_COLS} FROM idx", ("idx",))

# --------------------------------------------------------------------------
# shared helpers for the remaining keys
# --------------------------------------------------------------------------
RAW_COLS = ("case_id", "event_code", "event_name", "epi_year", "epi_week", "notified_text",
            "onset_text", "born_text", "age", "age_unit", "sex", "area_type", "hospital_code",
            "region_code", "local_code", "region_name", "local_name", "gp_psychiatric",
            "gp_migrant", "gp_pregnant", "group_name", "stratum")
INT_COLS = {"event_code", "epi_year", "epi_week", "age", "age_unit", "area_type",
            "hospital_code", "gp_psychiatric", "gp_migrant", "gp_pregnant"}


def _typed_col(c):
    if c == "case_id":
        return "CAST(case_id AS bigint) AS case_id"
    if c in INT_COLS:
        return f"CAST({c} AS integer) AS {c}"
    return c


TYPED = "typed_raw AS (SELECT " + ", ".join(_typed_col(c) for c in RAW_COLS) + " FROM raw)"


def q_raw(name, select, extra=""):
    """Query over the raw file (adapter + typed view [+ extra CTEs])."""
    QUERIES[name] = "WITH " + RAW + ",\n" + TYPED + extra + "\n" + select


def pct1(num, den):
    return rnd(f"CAST({num} AS double) / CAST({den} AS double) * 100", 1)


def pct1_safe(num, den):
    return f"CASE WHEN {den} <> 0 THEN {pct1(num, den)} END"


def cnt_if(cond):
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS bigint)"


AREA_KEYS = "area_code, region_name, local_name"

# --------------------------------------------------------------------------
# 2.1 sources / sinks
# --------------------------------------------------------------------------
q_raw("src_cases", "SELECT * FROM typed_raw")
QUERIES["src_population"] = "WITH " + POP + "\nSELECT area_code, population FROM pop"
q("src_clean", """SELECT * REPLACE (strftime(notified_on, '%Y-%m-%d') AS notified_on,
  strftime(onset_on, '%Y-%m-%d') AS onset_on, strftime(born_on, '%Y-%m-%d') AS born_on) FROM clean""")
q("snk_ranking_export", f"""SELECT rank, region_name, local_name, cases,
  {rnd('rate_100k', 1)} AS rate_100k, {rnd('score', 1)} AS score, priority
FROM idx WHERE cases >= 5""", ("idx",))

q("snk_clean", "SELECT epi_year, CAST(count(*) AS bigint) AS cases FROM clean GROUP BY epi_year")
q("snk_area", "SELECT rank, region_name, local_name, cases, rate_100k, pct_adolescent, trend, score, priority FROM idx WHERE cases >= 5",
  ("idx",))
q("snk_public", f"SELECT {AREA_KEYS}, cases, score, priority, rank FROM idx WHERE cases >= 5", ("idx",))
q("snk_snapshot", "SELECT case_id, area_code, epi_year FROM clean")
q_raw("src_resolve_base", "SELECT case_id, event_code, epi_year, age FROM typed_raw")
q_raw("cln_trim_names", "SELECT case_id, sex, age FROM typed_raw")
q_raw("cln_drop_columns", "SELECT case_id, region_name FROM typed_raw")

# --------------------------------------------------------------------------
# 2.2 profiling
# --------------------------------------------------------------------------
QUERIES["prof_dtypes"] = f"""SELECT column_name AS "column", CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
  ELSE lower(column_type) END AS type FROM (DESCRIBE WITH {RAW},\n{TYPED} SELECT * FROM typed_raw)"""
_ROLES = {"id": "case_id event_code", "temporal": "notified_text onset_text born_text epi_week epi_year",
          "demographic": "age age_unit sex stratum", "geographic": "region_code local_code area_type region_name local_name",
          "clinical": "hospital_code", "risk": "gp_psychiatric gp_migrant gp_pregnant"}
_NULL_SHARE = f"""(SELECT "column", {rnd('CAST(n_null AS double) / CAST(t AS double) * 100', 1)} AS pct_null
  FROM (UNPIVOT (SELECT count(*) AS t, {', '.join(f'count(*) - count({c}) AS {c}' for c in RAW_COLS)} FROM typed_raw)
        ON {', '.join(RAW_COLS)} INTO NAME "column" VALUE n_null))"""
q_raw("prof_column_roles", f"""SELECT role, "column", pct_null FROM (VALUES {', '.join(
    f"('{r}', '{c}')" for r, cs in _ROLES.items() for c in cs.split())}) AS r(role, "column") JOIN {_NULL_SHARE} AS n USING ("column")
UNION ALL SELECT 'high_null', "column", pct_null FROM {_NULL_SHARE} AS n WHERE pct_null > 10""")
_CONTRACT = [("required", c) for c in ("case_id event_code event_name epi_year epi_week notified_text age age_unit sex area_type hospital_code "
                                       "region_code local_code region_name local_name").split()] + [
    ("optional", c) for c in ("gp_psychiatric gp_migrant gp_prison gp_pregnant gp_indigenous gp_icbf gp_disabled gp_displaced gp_violence gp_other "
                              "onset_text consulted_text admitted_text ethnicity group_name").split()]
q_raw("val_contract_doc", f"""SELECT CAST(place AS integer) AS place, kind, "column", n_filled IS NOT NULL AS present, coalesce(n_filled, 0) AS n_filled
FROM (VALUES {', '.join(f"({i + 1}, '{k}', '{c}')" for i, (k, c) in enumerate(_CONTRACT))}) AS c(place, kind, "column")
LEFT JOIN (UNPIVOT (SELECT {', '.join(f'count({c}) AS {c}' for c in RAW_COLS)} FROM typed_raw) ON {', '.join(RAW_COLS)}
           INTO NAME "column" VALUE n_filled) AS f USING ("column")""")
q_raw("prof_shape", f"""SELECT CAST(count(*) AS bigint) AS n_rows,
  arg_min(event_name, case_id) AS event_name, arg_min(epi_year, case_id) AS epi_year,
  CAST({len(RAW_COLS)} AS integer) AS n_columns FROM typed_raw""")

_head_cols = ", ".join(f"CAST({c} AS varchar) AS {c}" for c in RAW_COLS)
q_raw("prof_head", f"""SELECT CAST(row_no AS integer) AS row_no, "column", value FROM h
  UNPIVOT INCLUDE NULLS (value FOR "column" IN ({', '.join(RAW_COLS)}))""",
      f""",
h AS (SELECT row_number() OVER (ORDER BY case_id) AS row_no, {_head_cols}
      FROM (SELECT * FROM typed_raw ORDER BY case_id NULLS LAST LIMIT 3))""")


def _describe(c):
    x = f"CAST({c} AS double)"
    return f"""SELECT '{c}' AS variable, CAST(count({x}) AS bigint) AS count,
  {rnd(f'avg({x})', 2)} AS mean, {rnd(f'stddev_samp({x})', 2)} AS std,
  {rnd(f'min({x})', 2)} AS min, {rnd(f'quantile_cont({x}, 0.25)', 2)} AS p25,
  {rnd(f'quantile_cont({x}, 0.5)', 2)} AS p50, {rnd(f'quantile_cont({x}, 0.75)', 2)} AS p75,
  {rnd(f'max({x})', 2)} AS max FROM typed_raw"""


q_raw("prof_describe", _describe("age") + "\nUNION ALL\n" + _describe("epi_week"))
q_raw("prof_dup_rows", """SELECT CAST((SELECT count(*) FROM typed_raw)
  - (SELECT count(*) FROM (SELECT DISTINCT * FROM typed_raw)) AS bigint) AS duplicate_rows""")
q_raw("prof_dup_ids", """SELECT CAST(coalesce(sum(n - 1), 0) AS bigint) AS duplicate_ids
FROM (SELECT case_id, count(*) AS n FROM typed_raw GROUP BY case_id)""")
_nulls = ", ".join(f"count(*) - count({c}) AS {c}" for c in RAW_COLS)
q_raw("prof_null_pct", f"""SELECT "column", CAST(n_null AS bigint) AS n_null, pct_null FROM (
  SELECT "column", n_null, {rnd('CAST(n_null AS double) / CAST(t AS double) * 100', 1)} AS pct_null
  FROM (UNPIVOT (SELECT count(*) AS t, {_nulls} FROM typed_raw)
        ON {', '.join(RAW_COLS)} INTO NAME "column" VALUE n_null))
WHERE pct_null > 0""")
q_raw("prof_value_counts", """SELECT "column", value, count(*) AS n FROM vc
  UNPIVOT INCLUDE NULLS (value FOR "column" IN (sex, area_type, hospital_code))
GROUP BY "column", value""", """,
vc AS (SELECT CAST(sex AS varchar) AS sex, CAST(area_type AS varchar) AS area_type,
              CAST(hospital_code AS varchar) AS hospital_code FROM typed_raw)""")
q_raw("prof_top_regions", """SELECT region_name, count(*) AS n FROM typed_raw
WHERE region_name IS NOT NULL GROUP BY region_name ORDER BY n DESC, region_name LIMIT 5""")
_cnts = ", ".join(f"count({c}) AS {c}" for c in RAW_COLS)
q_raw("prof_empty_columns", f"""SELECT "column" FROM (
  UNPIVOT (SELECT {_cnts}, count(died_on) AS died_on FROM (SELECT *, CAST(NULL AS varchar) AS died_on FROM typed_raw))
  ON {', '.join(RAW_COLS)}, died_on INTO NAME "column" VALUE n_values) WHERE n_values = 0""")
q("prof_code_uniqueness", """SELECT CAST(count(DISTINCT local_code) AS bigint) AS local_codes,
  CAST(count(DISTINCT area_code) AS bigint) AS area_codes FROM clean""")
q_raw("prof_code_names", """SELECT area_code, CAST(count(DISTINCT (region_name, local_name)) AS bigint) AS n_names,
  min(region_name || ' / ' || local_name) AS first_name, max(region_name || ' / ' || local_name) AS last_name
FROM coded WHERE area_code IS NOT NULL AND region_name IS NOT NULL AND local_name IS NOT NULL
GROUP BY area_code HAVING count(DISTINCT (region_name, local_name)) > 1""", f""",
coded AS (SELECT *, {_zfill('region_code', 2)} || {_zfill('local_code', 3)} AS area_code FROM typed_raw)""")
q("prof_code_sample", f"""SELECT DISTINCT region_code, region_name, area_code, local_name
FROM clean WHERE {_zfill('local_code', 3)} = '001'
ORDER BY area_code NULLS LAST, region_name NULLS LAST, local_name NULLS LAST LIMIT 8""")

# --------------------------------------------------------------------------
# 2.3 validation findings (one CTE, one row per rule)
# --------------------------------------------------------------------------
from epispark import config as _C  # noqa: E402  (contract constants and message texts)
from epispark.operators.validate import message as _msg  # noqa: E402
from epispark.config import Config as _Config  # noqa: E402

_VCFG = _Config(year=YEAR)


def _m(rule, **kw):
    return "'" + _msg(rule, _VCFG, **kw).replace("'", "''") + "'"


def _label(x):
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS bigint) AS varchar) ELSE CAST({x} AS varchar) END"


def _num(c):
    return f"TRY_CAST(CAST({c} AS varchar) AS double)"


VALUES = f"""
offending AS (
SELECT rule_id, value, CAST(count(*) AS bigint) AS value_rows FROM (
  SELECT 'year' AS rule_id, {_label(_num('epi_year'))} AS value FROM raw WHERE {_num('epi_year')} <> {YEAR}
  UNION ALL SELECT 'sex_domain', upper(trim(sex)) FROM raw WHERE upper(trim(sex)) NOT IN ('F', 'M')
  UNION ALL SELECT 'area_domain', {_label(_num('area_type'))} FROM raw WHERE {_num('area_type')} NOT IN (1, 2, 3)
  UNION ALL SELECT 'hospital_domain', {_label(_num('hospital_code'))} FROM raw WHERE {_num('hospital_code')} NOT IN (1, 2)
  UNION ALL SELECT 'event_code', {_label(f"floor({_num('event_code')})")} FROM raw WHERE {_num('event_code')} IS NOT NULL)
GROUP BY rule_id, value)"""


_opt_found = [c for c in _C.OPTIONAL_COLUMNS if c in RAW_COLS]
_req = ", ".join(f"'{c}'" for c in _C.REQUIRED_COLUMNS)
_empty_list = "[" + ", ".join(f"CASE WHEN count({c}) = 0 THEN '{c}' END" for c in RAW_COLS) + "]"
FINDINGS = f"""
agg AS (
SELECT count(*) AS n,
  list_filter({_empty_list}, lambda x: x IS NOT NULL) AS empty_cols,
  {cnt_if(f'TRY_CAST(epi_year AS double) IS NOT NULL AND TRY_CAST(epi_year AS double) <> {YEAR}')} AS n_years,
  {cnt_if("notified_text IS NOT NULL AND try_strptime(notified_text, '%Y-%m-%d') IS NULL")} AS bad_dates,
  {cnt_if(f"try_strptime(notified_text, '%Y-%m-%d') IS NOT NULL AND year(try_strptime(notified_text, '%Y-%m-%d')) <> {YEAR}")} AS out_year,
  {cnt_if("sex IS NOT NULL AND upper(trim(sex)) NOT IN ('F', 'M')")} AS sex_rows,
  {cnt_if("TRY_CAST(CAST(area_type AS varchar) AS double) NOT IN (1, 2, 3)")} AS area_rows,
  {cnt_if("TRY_CAST(CAST(hospital_code AS varchar) AS double) NOT IN (1, 2)")} AS hosp_rows,
  {cnt_if("length(trim(CAST(region_code AS varchar))) < 2")} AS short_region,
  {cnt_if("length(trim(CAST(local_code AS varchar))) < 3")} AS short_local,
  {cnt_if("age IS NOT NULL AND TRY_CAST(CAST(age AS varchar) AS double) IS NULL")} AS age_text,
  {cnt_if(f"TRY_CAST(CAST(age AS varchar) AS double) < {_VCFG.age_min} OR TRY_CAST(CAST(age AS varchar) AS double) > {_VCFG.age_max}")} AS age_range,
  {cnt_if("floor(TRY_CAST(CAST(event_code AS varchar) AS double)) <> 356")} AS ev_other,
  count(TRY_CAST(CAST(event_code AS varchar) AS double)) AS ev_rows
FROM raw
),
agg2 AS (
SELECT *, list_filter(empty_cols, lambda x: x IN ({_req})) AS empty_req,
  list_filter(empty_cols, lambda x: x NOT IN ({_req})) AS empty_other
FROM agg
),
findings AS (
SELECT 'not_empty' AS rule_id, 'error' AS severity, n = 0 AS triggered, CAST(n AS bigint) AS n_rows, CAST([] AS varchar[]) AS vals, {_m('not_empty')} AS message FROM agg2
UNION ALL SELECT 'max_rows', 'warning', n > {_VCFG.max_rows}, n, CAST([] AS varchar[]), {_m('max_rows')} FROM agg2
UNION ALL SELECT 'required_columns', 'error', false, 0, CAST([] AS varchar[]), {_m('required_columns')} FROM agg2
UNION ALL SELECT 'empty_required', 'error', len(empty_req) > 0, len(empty_req), empty_req, {_m('empty_required')} FROM agg2
UNION ALL SELECT 'empty_other', 'warning', len(empty_other) > 0, len(empty_other), empty_other, {_m('empty_other')} FROM agg2
UNION ALL SELECT 'year', 'warning', n_years > 0, n_years, CAST([] AS varchar[]), {_m('year')} FROM agg2
UNION ALL SELECT 'date_format', 'warning', bad_dates > 0, bad_dates, CAST([] AS varchar[]), {_m('date_format')} FROM agg2
UNION ALL SELECT 'date_year', 'warning', out_year > 0, out_year, CAST([] AS varchar[]), {_m('date_year')} FROM agg2
UNION ALL SELECT 'sex_domain', 'error', sex_rows > 0, sex_rows, CAST([] AS varchar[]), {_m('sex_domain')} FROM agg2
UNION ALL SELECT 'area_domain', 'error', area_rows > 0, area_rows, CAST([] AS varchar[]), {_m('area_domain')} FROM agg2
UNION ALL SELECT 'hospital_domain', 'error', hosp_rows > 0, hosp_rows, CAST([] AS varchar[]), {_m('hospital_domain')} FROM agg2
UNION ALL SELECT 'short_region_code', 'warning', short_region > 0, short_region, CAST([] AS varchar[]), {_m('short_region_code')} FROM agg2
UNION ALL SELECT 'short_local_code', 'warning', short_local > 0, short_local, CAST([] AS varchar[]), {_m('short_local_code')} FROM agg2
UNION ALL SELECT 'age_not_numeric', 'warning', age_text > 0, age_text, CAST([] AS varchar[]), {_m('age_not_numeric')} FROM agg2
UNION ALL SELECT 'age_range', 'warning', age_range > 0, age_range, CAST([] AS varchar[]), {_m('age_range')} FROM agg2
UNION ALL SELECT 'event_code', 'warning', ev_other > 0 OR ev_rows = 0, ev_other, CAST([] AS varchar[]), {_m('event_code')} FROM agg2
UNION ALL SELECT 'psychiatric_flag_missing', 'warning', false, 0, CAST([] AS varchar[]), {_m('psychiatric_flag_missing')} FROM agg2
UNION ALL SELECT 'optional_columns', 'info', true, {len(_opt_found)}, [{', '.join(repr(c) for c in _opt_found)}],
  {_m('optional_columns', found=len(_opt_found), total=len(_C.OPTIONAL_COLUMNS))} FROM agg2
)"""


def q_find(name, select):
    QUERIES[name] = "WITH " + RAW + ",\n" + FINDINGS + "\n" + select


q_find("val_findings", "SELECT * REPLACE (array_to_string(vals, ', ') AS vals) FROM findings")
_VAL_KEYS = {"not_empty": "val_not_empty", "max_rows": "val_max_rows",
             "required_columns": "val_required_columns", "empty_required": "val_empty_required",
             "empty_other": "val_empty_other", "year": "val_year",
             "date_format": "val_date_format", "date_year": "val_date_year",
             "sex_domain": "val_sex_domain", "area_domain": "val_area_domain",
             "hospital_domain": "val_hospital_domain", "short_region_code": "val_short_codes",
             "short_local_code": "val_short_local_codes", "age_not_numeric": "val_age_text",
             "age_range": "val_age_range", "event_code": "val_event_code",
             "optional_columns": "val_optional_columns"}
QUERIES["val_offending_values"] = "WITH " + RAW + "," + VALUES + "\nSELECT * FROM offending"
for _r, _k in _VAL_KEYS.items():
    q_find(_k, f"SELECT * REPLACE (array_to_string(vals, ', ') AS vals) FROM findings "
               f"WHERE rule_id = '{_r}'")
for _r in ("year", "sex_domain", "area_domain", "hospital_domain", "event_code"):
    QUERIES[_VAL_KEYS[_r]] = ("WITH " + RAW + ",\n" + FINDINGS + "," + VALUES + f"""
SELECT f.* REPLACE (array_to_string(vals, ', ') AS vals), o.value, o.value_rows
FROM findings f LEFT JOIN offending o USING (rule_id) WHERE f.rule_id = '{_r}'""")
q_find("val_summary", f"""SELECT
  sum(CASE WHEN severity = 'error' AND triggered THEN 1 ELSE 0 END) = 0 AS is_valid,
  max(CASE WHEN rule_id = 'not_empty' THEN n_rows END) AS rows,
  CAST({len(RAW_COLS)} AS integer) AS columns,
  CAST(max(CASE WHEN rule_id = 'not_empty' THEN n_rows END)
       - coalesce(max(CASE WHEN rule_id = 'date_year' THEN n_rows END), 0) AS bigint) AS valid_rows_estimate,
  CAST(sum(CASE WHEN triggered AND severity = 'error' THEN 1 ELSE 0 END) AS bigint) AS n_errors,
  CAST(sum(CASE WHEN triggered AND severity = 'warning' THEN 1 ELSE 0 END) AS bigint) AS n_warnings
FROM findings""")
QUERIES["val_preview"] = "WITH " + RAW + """
SELECT case_id, CAST(epi_year AS integer) AS epi_year, CAST(epi_week AS integer) AS epi_week,
  notified_text, age, sex, region_name, local_name
FROM raw ORDER BY case_id NULLS LAST LIMIT 10"""

# --------------------------------------------------------------------------
# 2.4 cleaning steps
# --------------------------------------------------------------------------
q_raw("cln_trim_text", f"""SELECT case_id, {_t('sex')} AS sex, {_t('region_name')} AS region_name,
  {_t('local_name')} AS local_name, {_t('group_name')} AS group_name, {_t('stratum')} AS stratum,
  {_t('onset_text')} AS onset_text FROM typed_raw""")
q("cln_region_alias", "SELECT case_id, region_name FROM prep")
QUERIES["cln_dedup_rows"] = "WITH " + RAW + ",\n" + TYPED + f""",
feed AS (SELECT * FROM typed_raw UNION ALL SELECT * FROM typed_raw)
SELECT epi_year, CAST(count(*) AS bigint) AS rows FROM (SELECT DISTINCT * FROM feed) GROUP BY epi_year"""
q("flt_scope", "SELECT case_id, epi_year, region_name FROM scoped", year=YEAR)
q("flt_scope_report", f"""SELECT
  {cnt_if("coalesce(region_name IN ('EXTERIOR'), false)")} AS excluded_non_territorial,
  {cnt_if(f"NOT coalesce(epi_year = {YEAR}, false)")} AS excluded_year,
  {cnt_if(f"coalesce(region_name IN ('EXTERIOR'), false) OR NOT coalesce(epi_year = {YEAR}, false)")} AS excluded_total,
  {cnt_if(f"NOT coalesce(region_name IN ('EXTERIOR'), false) AND coalesce(epi_year = {YEAR}, false)")} AS rows_out
FROM dedup""", year=YEAR)
q("cln_area_code", "SELECT case_id, region_code, local_code, area_code FROM clean")
q("cln_parse_dates", """SELECT case_id, strftime(notified_on, '%Y-%m-%d') AS notified_on,
  strftime(born_on, '%Y-%m-%d') AS born_on FROM clean""")
q("cln_onset_check", """SELECT case_id, strftime(onset_on, '%Y-%m-%d') AS onset_on, onset_corrected
FROM clean""")
q("cln_age_check", "SELECT case_id, age, age_inconsistent FROM clean")
q("cln_group_default", "SELECT case_id, group_name FROM clean")
q("cln_to_int", "SELECT case_id, stratum FROM clean")
q("cln_area_override", """SELECT case_id, region_name,
  CASE WHEN region_name = 'NATION_3' THEN '99999' ELSE area_code END AS area_code FROM clean""")
q("cln_report", f"""SELECT
  CAST((SELECT count(*) FROM prep) AS bigint) AS rows_in,
  CAST((SELECT count(*) FROM dedup) AS bigint) AS rows_dedup,
  r.*,
  CAST((SELECT count(DISTINCT region_name) FROM clean) AS bigint) AS regions,
  CAST((SELECT count(DISTINCT area_code) FROM clean) AS bigint) AS areas,
  {cnt_if('onset_corrected')} AS onset_corrected,
  {cnt_if('age_inconsistent')} AS age_inconsistent,
  CAST((SELECT count(*) FROM prep) - (SELECT count(*) FROM dedup) AS bigint) AS duplicates_removed,
  {rnd('CAST(r.excluded_total AS double) / CAST((SELECT count(*) FROM dedup) AS double) * 100', 2)} AS pct_excluded
FROM clean, (SELECT
  {cnt_if("coalesce(region_name IN ('EXTERIOR'), false)")} AS excluded_non_territorial,
  {cnt_if(f"NOT coalesce(epi_year = {YEAR}, false)")} AS excluded_year,
  {cnt_if(f"coalesce(region_name IN ('EXTERIOR'), false) OR NOT coalesce(epi_year = {YEAR}, false)")} AS excluded_total,
  {cnt_if(f"NOT coalesce(region_name IN ('EXTERIOR'), false) AND coalesce(epi_year = {YEAR}, false)")} AS rows_out
  FROM dedup) r
GROUP BY ALL""", year=YEAR)
q("cln_outliers_iqr", f"""WITH qq AS (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.75) AS q3 FROM clean)
SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence,
  {cnt_if('age < q1 - 1.5 * (q3 - q1) OR age > q3 + 1.5 * (q3 - q1)')} AS n_outliers,
  {rnd(f"CAST({cnt_if('age < q1 - 1.5 * (q3 - q1) OR age > q3 + 1.5 * (q3 - q1)')} AS double) / CAST(count(*) AS double) * 100", 2)} AS pct_outliers
FROM clean, qq GROUP BY q1, q3""")

# --------------------------------------------------------------------------
# 2.5 derived columns
# --------------------------------------------------------------------------
q("drv_month", "SELECT case_id, month, month_name, year_month FROM clean")
q("drv_quarter", "SELECT case_id, epi_week, quarter FROM clean")
q("drv_semester", "SELECT case_id, epi_week, semester FROM clean")
q("drv_age_group", "SELECT case_id, age, age_group, age_group_ord FROM clean")
q("drv_labels", "SELECT case_id, sex_label, area_label, hospital_label FROM clean")
q("drv_flags", "SELECT case_id, is_minor, is_adolescent, is_rural FROM clean")
q("drv_index_flags", """SELECT case_id,
  CASE WHEN age BETWEEN 12 AND 17 THEN 1 ELSE 0 END AS f_adolescent,
  CASE WHEN age BETWEEN 18 AND 25 THEN 1 ELSE 0 END AS f_young_adult,
  CASE WHEN hospital_code = 1 THEN 1 ELSE 0 END AS f_hospitalised,
  CASE WHEN gp_psychiatric = 1 THEN 1 ELSE 0 END AS f_psychiatric,
  CASE WHEN epi_week > 26 THEN 1 ELSE 0 END AS f_second_half FROM clean""")
q("drv_classify", f"SELECT {AREA_KEYS}, score, priority FROM idx", ("idx",))
q("drv_accent_key", """SELECT case_id, upper(trim(strip_accents(region_name))) AS region_key,
  upper(trim(strip_accents(local_name))) AS local_key FROM clean""")
_GP = {k: v for k, v in _C.GP_LABELS.items()}
_gp_present = ("gp_psychiatric", "gp_migrant", "gp_pregnant")
q("drv_gp_labels", "SELECT * FROM (VALUES " + ", ".join(
    f"('{g}', '{_GP.get(g, g)}')" for g in _gp_present) + ") t(\"group\", label)")
q("drv_trend_text", f"""SELECT {AREA_KEYS}, printf('%.1f', {rnd('trend * 100', 1)}) || '%' AS trend_text
FROM idx""", ("idx",))

# --------------------------------------------------------------------------
# 2.6 interactive filter
# --------------------------------------------------------------------------
FILTER = "region_name = 'NATION_1' AND sex_label = 'Femenino' AND month IN (1, 2, 3, 4, 5, 6)"
q("flt_cases", f"""SELECT case_id, region_name, sex_label, month, area_label, age, area_code
FROM clean WHERE {FILTER}""")
QUERIES["flt_cases_clustered"] = QUERIES["flt_cases"]
q("lst_regions", "SELECT DISTINCT region_name FROM clean WHERE region_name IS NOT NULL")

# --------------------------------------------------------------------------
# 2.7 aggregations
# --------------------------------------------------------------------------


def _mode_sql(col, src="clean"):
    return (f"(SELECT {col} FROM (SELECT {col}, count(*) AS n FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY {col}) ORDER BY n DESC, {col} LIMIT 1)")


q("agg_kpis", f"""SELECT CAST(count(*) AS bigint) AS total_cases,
  {rnd('avg(age)', 1)} AS mean_age, median(CAST(age AS double)) AS median_age,
  {pct1(cnt_if("sex = 'F'"), 'count(*)')} AS pct_female,
  {pct1(cnt_if("sex = 'M'"), 'count(*)')} AS pct_male,
  {pct1(cnt_if('is_minor'), 'count(*)')} AS pct_minor,
  {pct1(cnt_if('is_adolescent'), 'count(*)')} AS pct_adolescent,
  {pct1(cnt_if('hospital_code = 1'), 'count(*)')} AS pct_hospitalised,
  {pct1(cnt_if('is_rural'), 'count(*)')} AS pct_rural,
  CAST(count(DISTINCT region_name) AS bigint) AS regions,
  CAST(count(DISTINCT area_code) AS bigint) AS areas,
  {_mode_sql('region_name')} AS top_region, {_mode_sql('month')} AS top_month,
  {_mode_sql('age_group')} AS top_age_group
FROM clean""")


def _kpis_filtered(where):
    src = f"(SELECT * FROM clean WHERE {where})"
    return f"""SELECT CAST(count(*) AS bigint) AS total_cases,
  coalesce({pct1_safe(cnt_if('is_adolescent'), 'count(*)')}, 0.0) AS pct_adolescent,
  coalesce({pct1_safe(cnt_if('hospital_code = 1'), 'count(*)')}, 0.0) AS pct_hospitalised,
  CAST(count(DISTINCT region_name) AS bigint) AS regions,
  CAST(count(DISTINCT area_code) AS bigint) AS areas,
  coalesce({_mode_sql('region_name', src)}, '–') AS top_region
FROM {src}"""


q("agg_kpis_filtered", _kpis_filtered(FILTER))
q("agg_kpis_filtered_empty", _kpis_filtered("region_name = 'NO SUCH REGION'"))
_BY_REGION = f"""SELECT region_name, CAST(count(case_id) AS bigint) AS cases,
  {pct1(cnt_if('is_minor'), 'count(*)')} AS pct_minor,
  {pct1(cnt_if('hospital_code = 1'), 'count(*)')} AS pct_hospitalised
FROM clean WHERE region_name IS NOT NULL GROUP BY region_name"""
q("agg_by_region", _BY_REGION)
q("agg_by_region_top", _BY_REGION + " ORDER BY cases DESC, region_name LIMIT 10")
q("agg_by_area", f"""SELECT {AREA_KEYS}, CAST(count(case_id) AS bigint) AS cases FROM clean
WHERE area_code IS NOT NULL AND region_name IS NOT NULL AND local_name IS NOT NULL
GROUP BY {AREA_KEYS} ORDER BY cases DESC, {AREA_KEYS} LIMIT 20""")


def _by_label(col, extra=""):
    cols = col + (", " + extra if extra else "")
    return f"""SELECT {cols}, cases, {pct1('cases', 'sum(cases) OVER ()')} AS pct FROM (
  SELECT {cols}, CAST(count(*) AS bigint) AS cases FROM clean WHERE {col} IS NOT NULL GROUP BY {cols})"""


q("agg_by_sex", _by_label("sex_label"))
q("agg_by_age_group", _by_label("age_group", "age_group_ord"))
q("agg_by_month", f"""SELECT month, CAST(count(*) AS bigint) AS cases, {MONTHS_SHORT}[month] AS month_name
FROM clean WHERE month IS NOT NULL GROUP BY month""")
q("agg_by_area_type", _by_label("area_label"))
q("agg_by_quarter", """SELECT quarter, CAST(count(*) AS bigint) AS cases FROM clean
WHERE quarter IS NOT NULL GROUP BY quarter""")
q("agg_semester_change", f"""SELECT cases_h1, cases_h2,
  CASE WHEN cases_h1 <> 0 THEN {rnd('CAST(cases_h2 - cases_h1 AS double) / CAST(cases_h1 AS double) * 100', 1)} END AS pct_change
FROM (SELECT {cnt_if("semester = 'H1 (Sem 1–26)'")} AS cases_h1,
             {cnt_if("semester = 'H2 (Sem 27–52)'")} AS cases_h2 FROM clean)""")
q("agg_cumulative_age", f"""SELECT *, {pct1('cum_cases', 'sum(cases) OVER ()')} AS cum_pct FROM (
  SELECT *, CAST(sum(cases) OVER (ORDER BY age_group_ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS cum_cases
  FROM ({_by_label('age_group', 'age_group_ord')}))""")
_rg = " UNION ALL ".join(
    f"SELECT '{g}' AS \"group\", '{_GP.get(g, g)}' AS label, {cnt_if(f'{g} = 1')} AS cases, "
    f"{rnd(f'CAST(' + cnt_if(f'{g} = 1') + ' AS double) / CAST(count(*) AS double) * 100', 2)} AS pct FROM clean"
    for g in _gp_present)
q("agg_risk_groups", _rg)
q("agg_top_group", f"""SELECT (SELECT age_group FROM g ORDER BY cases DESC, age_group_ord LIMIT 1) AS age_group,
  (SELECT max(cases) FROM g) AS cases""".replace(
    "FROM g", "FROM (SELECT age_group, age_group_ord, CAST(count(*) AS bigint) AS cases FROM clean "
              "WHERE age_group IS NOT NULL GROUP BY ALL) g"))
q("agg_exec_summary", f"""SELECT CAST(count(*) AS bigint) AS total_cases,
  {pct1(cnt_if('is_adolescent'), 'count(*)')} AS pct_adolescent,
  {pct1(cnt_if('hospital_code = 1'), 'count(*)')} AS pct_hospitalised,
  CAST(count(DISTINCT region_name) AS bigint) AS regions,
  CAST(count(DISTINCT area_code) AS bigint) AS areas,
  (SELECT {cnt_if("priority IN ('Alta', 'Crítica')")} FROM idx) AS areas_high_or_critical,
  (SELECT local_name FROM idx ORDER BY rank, area_code LIMIT 1) AS top_local,
  (SELECT max(score) FROM idx) AS max_score
FROM clean""", ("idx",))
_DIMS = "area_code, region_name, local_name, month, sex_label, age_group, area_label"
_DIMS_NN = " AND ".join(f"{d.strip()} IS NOT NULL" for d in _DIMS.split(","))
q("agg_public_cells", f"""SELECT {_DIMS}, CAST(count(*) AS bigint) AS cases FROM clean
WHERE {_DIMS_NN} GROUP BY {_DIMS}""")

# --------------------------------------------------------------------------
# 2.8 cross tabulations
# --------------------------------------------------------------------------


def _cube(row, col, src):
    return f"""SELECT
  CASE WHEN GROUPING({row}) = 1 THEN 'Total' ELSE CAST({row} AS varchar) END AS {row},
  CASE WHEN GROUPING({col}) = 1 THEN 'Total' ELSE CAST({col} AS varchar) END AS {col},
  CAST(count(*) AS bigint) AS cases, CAST(GROUPING({row}, {col}) AS integer) AS grouping_id
FROM {src} GROUP BY CUBE ({row}, {col})"""


q("xtab_age_sex", _cube("age_group", "sex_label",
                        "(SELECT * FROM clean WHERE age_group IS NOT NULL AND sex_label IS NOT NULL)"))
_TOP10 = """(SELECT region_name FROM (SELECT region_name, count(*) AS n FROM clean
  WHERE region_name IS NOT NULL GROUP BY region_name) ORDER BY n DESC, region_name LIMIT 10)"""
_XR = _cube("region_name", "sex_label",
            f"(SELECT * FROM clean WHERE region_name IN {_TOP10} AND sex_label IS NOT NULL)")
q("xtab_region_sex", _XR)
_XM = f"""SELECT month, {MONTHS_SHORT}[month] AS month_name,
  {cnt_if("sex_label = 'Femenino'")} AS n_female, {cnt_if("sex_label = 'Masculino'")} AS n_male,
  {cnt_if("sex_label = 'Otro/Ind.'")} AS n_other
FROM clean WHERE month IS NOT NULL AND sex_label IS NOT NULL GROUP BY month"""
q("xtab_month_sex", _XM)

# --------------------------------------------------------------------------
# 2.9 windows
# --------------------------------------------------------------------------
_WEEKS = "(SELECT epi_week, CAST(count(*) AS bigint) AS cases FROM clean WHERE epi_week IS NOT NULL GROUP BY epi_week)"
q("win_weekly_trend", f"""SELECT epi_week, cases,
  {rnd('avg(cases) OVER (ORDER BY epi_week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)', 1)} AS moving_avg
FROM {_WEEKS}""")
q("win_peak_week", f"""SELECT epi_week, cases FROM {_WEEKS} ORDER BY cases DESC, epi_week LIMIT 1""")
q("win_national_rank", f"SELECT {AREA_KEYS}, score, rank FROM idx", ("idx",))
q("win_region_mean_pop", f"""SELECT {AREA_KEYS}, population,
  {rnd('avg(population) OVER (PARTITION BY region_name)', 6)} AS region_mean_pop FROM areas2""", ("areas",))
q("win_top_area_per_region", """SELECT region_name, area_code, local_name, score, priority FROM idx
QUALIFY row_number() OVER (PARTITION BY region_name ORDER BY score DESC, area_code, local_name) = 1""", ("idx",))

# --------------------------------------------------------------------------
# 2.10 joins
# --------------------------------------------------------------------------
q("join_population", f"SELECT {AREA_KEYS}, cases, population FROM areas2", ("areas",))
q("join_impute_population", f"SELECT {AREA_KEYS}, population FROM areas", ("areas",))
CENTROIDS = """cen AS (SELECT upper(n_name) AS region_key,
  CAST(-80.0 AS double) + n_nationkey * CAST(0.5 AS double) AS lon,
  CAST(-4.0 AS double) + n_regionkey * CAST(3.0 AS double) AS lat FROM nation WHERE n_nationkey % 8 <> 5)"""
_REGTAB = f"""regtab AS (
SELECT r.*, coalesce(t.is_top, false) AS is_top,
  CASE WHEN r.max_score >= 80 THEN 'Crítica' WHEN r.max_score >= 60 THEN 'Alta'
       WHEN r.max_score >= 40 THEN 'Media' ELSE 'Baja' END AS max_priority FROM (
  SELECT region_name, {rnd(MEAN2, 2)} AS mean_score, {rnd('max(score)', 2)} AS max_score,
    CAST(sum(cases) AS bigint) AS cases, CAST(count(DISTINCT local_name) AS bigint) AS areas
  FROM idx GROUP BY region_name) r
LEFT JOIN (SELECT region_name, true AS is_top FROM (
  SELECT region_name, {rnd('max(score)', 2)} AS mx FROM idx GROUP BY region_name)
  ORDER BY mx DESC, region_name LIMIT 5) t USING (region_name)
)"""
q("join_centroids", f"""WITH {CENTROIDS}, {_REGTAB}
SELECT region_name, lon, lat FROM regtab JOIN cen
  ON upper(trim(strip_accents(region_name))) = upper(trim(strip_accents(region_key)))""", ("idx",))
q("join_top_filter", f"SELECT case_id, region_name FROM clean WHERE region_name IN {_TOP10}")
_UPD = f""",
base AS (SELECT * FROM typed_raw WHERE case_id % 10 >= 3),
new AS (SELECT * FROM typed_raw WHERE case_id % 10 <= 4)"""
q_raw("join_anti_new", """SELECT case_id, epi_year, region_name FROM new
WHERE case_id NOT IN (SELECT case_id FROM base WHERE case_id IS NOT NULL)""", _UPD)

# --------------------------------------------------------------------------
# 2.11 sort / limit / set operations / update
# --------------------------------------------------------------------------
q("top_ranking", f"""SELECT rank, region_name, local_name, cases, {rnd('rate_100k', 1)} AS rate_100k,
  {rnd('score', 2)} AS score, priority FROM idx ORDER BY rank, {AREA_KEYS} LIMIT 20""", ("idx",))
q("top_regions", """SELECT region_name, CAST(count(case_id) AS bigint) AS cases FROM clean
WHERE region_name IS NOT NULL GROUP BY region_name ORDER BY cases DESC, region_name LIMIT 15""")
q("flt_emerging", f"""SELECT {AREA_KEYS}, cases, trend, score, priority FROM idx
WHERE trend > 0.5 AND priority <> 'Crítica' AND cases >= 5
ORDER BY trend DESC, score DESC, {AREA_KEYS} LIMIT 10""", ("idx",))
QUERIES["flt_emerging"] = QUERIES["flt_emerging"].replace("weekofyear(o_orderdate) AS epi_week", """weekofyear(o_orderdate) + CASE
  WHEN m.seg = 3 AND weekofyear(o_orderdate) <= 26 AND o_orderkey % 2 = 0 THEN 26 ELSE 0 END AS epi_week""")
q("flt_emerging_level", f"""SELECT {AREA_KEYS}, cases, trend, score, priority FROM idx
WHERE trend > 0.05 AND priority <> 'Crítica' AND cases >= 5
ORDER BY trend DESC, score DESC, {AREA_KEYS} LIMIT 10""", ("idx",))
q_raw("set_union_update", f"""SELECT _source, epi_year, CAST(count(*) AS bigint) AS rows FROM (
  SELECT 0 AS _source, epi_year FROM base UNION ALL SELECT 1 AS _source, epi_year FROM new)
GROUP BY _source, epi_year""", _UPD)
q_raw("set_dedup_first", f"""SELECT case_id, epi_year, region_name, age, sex FROM (
  SELECT 0 AS s, * FROM base UNION ALL SELECT 1 AS s, * FROM new)
QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY s) = 1""", _UPD)
QUERIES["stm_incremental_merge"] = None  # filled below (same result as set_dedup_first)
q_raw("set_dedup_first_files", "SELECT case_id, epi_year, CAST(age + 60 AS integer) AS age FROM typed_raw WHERE case_id IS NOT NULL")
QUERIES["join_anti_new_indexed"] = QUERIES["join_anti_new"]
q_raw("upd_report", f"""SELECT e AS existing, i AS incoming, e + i - m AS duplicates, m - e AS added FROM (
  SELECT CAST((SELECT count(*) FROM base) AS bigint) AS e, CAST((SELECT count(*) FROM new) AS bigint) AS i,
  CAST((SELECT count(*) FROM (SELECT DISTINCT case_id FROM (SELECT case_id FROM base UNION ALL SELECT case_id FROM new))) AS bigint) AS m)""", _UPD)


def _valid(sql):
    """The line list with the few codes that validation refuses set to valid ones."""
    return sql.replace("'X'", "'M'").replace(
        "CAST(substr(o_orderpriority, 1, 1) AS int) AS area_type", "1 + CAST(substr(o_orderpriority, 1, 1) AS int) % 3 AS area_type")


QUERIES["upd_pipeline"] = _valid(with_ctes(
    f"SELECT {AREA_KEYS}, cases, cases_h1, cases_h2, score, priority, rank FROM idx", ("idx",), None))
_CUBE_DIMS = "area_code, region_name, local_name, month, epi_week, sex, age, area_type, hospital_code"
QUERIES["upd_cube"] = _valid(with_ctes(f"""SELECT {_CUBE_DIMS}, CAST(count(*) AS bigint) AS n,
  CAST(count(case_id) AS bigint) AS n_ids FROM clean GROUP BY {_CUBE_DIMS}""", ("clean",), None))
QUERIES["upd_kpis"] = _valid(QUERIES["agg_kpis"])
QUERIES["upd_public_cells"] = _valid(with_ctes(f"""SELECT {_DIMS}, CAST(count(*) AS bigint) AS cases FROM clean
WHERE {_DIMS_NN} GROUP BY {_DIMS} HAVING count(*) >= 5""", ("clean",), None))
q("set_distinct_rows", "SELECT DISTINCT region_code, region_name FROM clean")

# --------------------------------------------------------------------------
# 2.12 privacy
# --------------------------------------------------------------------------
q("prv_suppress", f"""SELECT {AREA_KEYS}, CAST(count(case_id) AS bigint) AS cases FROM clean
WHERE area_code IS NOT NULL AND region_name IS NOT NULL AND local_name IS NOT NULL
GROUP BY {AREA_KEYS} HAVING count(case_id) >= 5""")
q("prv_public_top_areas", f"""SELECT {AREA_KEYS}, CAST(count(case_id) AS bigint) AS cases FROM clean
WHERE area_code IS NOT NULL AND region_name IS NOT NULL AND local_name IS NOT NULL
GROUP BY {AREA_KEYS} HAVING count(case_id) >= 5 ORDER BY cases DESC, {AREA_KEYS} LIMIT 20""")
q("prv_public_areas", f"SELECT {AREA_KEYS}, cases, score, priority, rank FROM idx WHERE cases >= 5",
  ("idx",))
q("prv_public_areas_report", f"""SELECT CAST(count(*) AS bigint) AS areas_before,
  {cnt_if('cases >= 5')} AS areas_published, {cnt_if('cases < 5')} AS areas_suppressed FROM idx""",
  ("idx",))
_CELLS = f"""(SELECT {_DIMS}, CAST(count(*) AS bigint) AS cases FROM clean WHERE {_DIMS_NN}
  GROUP BY {_DIMS} HAVING count(*) >= 5)"""
q("prv_public_cells", f"SELECT * FROM {_CELLS}")


def _protect(src, keys, parent, parents=None):
    """Rows of ``src`` with what is hidden; ``parents``: rows that a hidden parent is among."""
    gone = f"LEFT JOIN {parents} AS p ON " + " AND ".join(f"r.{c} IS NOT DISTINCT FROM p.{c}" for c in parent) if parents else ""
    mark = "CASE WHEN p.hidden IS NOT NULL THEN 'parent' WHEN r.cases < 5 THEN 'small' END" if parents else "CASE WHEN r.cases < 5 THEN 'small' END"
    over = f"PARTITION BY {', '.join(parent)}" if parent else ""
    by = ", ".join(f"{c} NULLS FIRST" for c in keys)
    return f"""(SELECT {', '.join(keys)}, cases, CASE WHEN h0 IS NULL AND nth = 1 AND h >= 1 AND (h = 1 OR s < 5) THEN 'second' ELSE h0 END AS hidden
  FROM (SELECT *, count(*) FILTER (WHERE h0 = 'small') OVER ({over}) AS h, coalesce(sum(cases) FILTER (WHERE h0 = 'small') OVER ({over}), 0) AS s,
               row_number() OVER (PARTITION BY {', '.join([*parent, 'h0 IS NULL'])} ORDER BY cases, {by}) AS nth
        FROM (SELECT r.*, {mark} AS h0 FROM {src} AS r {gone}) AS marked) AS counted)"""


def _audit(src, parent, level):
    return f"""SELECT '{level}' AS level, CAST(coalesce(sum(a), 0) AS bigint) AS hidden_rows, CAST(count(*) FILTER (WHERE h >= 1) AS bigint) AS totals_with_hidden,
  CAST(coalesce(sum(h) FILTER (WHERE h >= 1 AND p = 0 AND total >= 5 AND (h = 1 OR s < 5)), 0) AS bigint) AS solved
FROM (SELECT count(*) FILTER (WHERE hidden IN ('small', 'second')) AS h, coalesce(sum(cases) FILTER (WHERE hidden IN ('small', 'second')), 0) AS s,
             count(*) FILTER (WHERE hidden IS NOT NULL) AS a, count(*) FILTER (WHERE hidden = 'parent') AS p, sum(cases) AS total
      FROM {src} AS x GROUP BY {', '.join(parent)}) AS lines"""


_AK = [c.strip() for c in AREA_KEYS.split(",")]
_REGIONS = "(SELECT region_name, CAST(sum(cases) AS bigint) AS cases FROM idx GROUP BY region_name)"
_SAFE_REGIONS = f"(SELECT * FROM {_protect(_REGIONS, ['region_name'], [])} AS q WHERE hidden IS NOT NULL)"
_SAFE_AREAS = _protect(f"(SELECT {AREA_KEYS}, cases FROM idx)", _AK, ["region_name"], _SAFE_REGIONS)
_ALL_CELLS = f"(SELECT {_DIMS}, CAST(count(*) AS bigint) AS cases FROM clean WHERE {_DIMS_NN} GROUP BY {_DIMS})"
_SAFE_CELLS = _protect(_ALL_CELLS, [c.strip() for c in _DIMS.split(",")], _AK, f"(SELECT * FROM {_SAFE_AREAS} AS q WHERE hidden IS NOT NULL)")
_SMALL = "CASE WHEN cases < 5 THEN 'small' END AS hidden"
q("prv_protected_areas", f"SELECT {AREA_KEYS}, cases, hidden FROM {_SAFE_AREAS} AS z", ("idx",))
q("prv_protected_cells", f"SELECT {_DIMS}, cases FROM {_SAFE_CELLS} AS z WHERE hidden IS NULL", ("idx",))
q("prv_disclosure_audit", " UNION ALL ".join((
    _audit(f"(SELECT *, {_SMALL} FROM (SELECT {AREA_KEYS}, cases FROM idx) AS i)", ["region_name"], "areas, small hidden"),
    _audit(_SAFE_AREAS, ["region_name"], "areas, protected"),
    _audit(f"(SELECT *, {_SMALL} FROM {_ALL_CELLS} AS c)", _AK, "cells, small hidden"),
    _audit(_SAFE_CELLS, _AK, "cells, protected"))), ("idx",))
q("prv_k_anonymity_check", f"""SELECT CAST(min(cases) AS bigint) AS min_cell,
  CAST(count(*) AS bigint) AS n_cells, CAST(0 AS integer) AS n_case_level_columns,
  coalesce(min(cases) >= 5, true) AS is_safe FROM {_CELLS}""")

# --------------------------------------------------------------------------
# 2.13 index stages
# --------------------------------------------------------------------------
q("idx_area_table", f"""SELECT {AREA_KEYS}, cases, cases_h1, cases_h2, pct_adolescent,
  pct_young_adult, pct_hospitalised, pct_psychiatric, pct_minor, pct_female, pct_rural FROM areas0""",
  ("areas",))
q("idx_trend", f"SELECT {AREA_KEYS}, cases_h1, cases_h2, trend FROM areas1", ("areas",))
q("idx_rate", f"SELECT {AREA_KEYS}, cases, population, rate_100k FROM areas", ("areas",))
q("idx_minmax", f"""SELECT {AREA_KEYS}, rate_100k_norm, pct_adolescent_norm, trend_norm,
  pct_hospitalised_norm, pct_psychiatric_norm FROM normed""", ("idx",))
q("idx_score", f"SELECT {AREA_KEYS}, score FROM idx", ("idx",))
q("idx_priority_class", f"SELECT {AREA_KEYS}, score, priority, rank FROM idx", ("idx",))
q("idx_distribution", f"""SELECT c.priority, c.priority_ord, CAST(coalesce(n.areas, 0) AS bigint) AS areas,
  CASE WHEN t.t > 0 THEN {rnd('CAST(coalesce(n.areas, 0) AS double) / CAST(t.t AS double) * 100', 1)} END AS pct
FROM (VALUES ('Crítica', 1), ('Alta', 2), ('Media', 3), ('Baja', 4)) c(priority, priority_ord)
LEFT JOIN (SELECT priority, count(*) AS areas FROM idx GROUP BY priority) n USING (priority)
CROSS JOIN (SELECT count(*) AS t FROM idx) t""", ("idx",))
q("idx_region_mean", f"SELECT region_name, {rnd(MEAN2, 2)} AS mean_score FROM idx GROUP BY region_name",
  ("idx",))
q("idx_region_table", f"WITH {_REGTAB} SELECT * FROM regtab", ("idx",))
q("idx_map_points", f"""WITH {CENTROIDS}, {_REGTAB}
SELECT region_name, lon, lat, mean_score, max_score, cases,
  greatest(mean_score, 10.0) * 0.9 + 8 AS bubble_size, is_top AS border
FROM regtab JOIN cen ON upper(trim(strip_accents(region_name))) = upper(trim(strip_accents(region_key)))""",
  ("idx",))
q("idx_counts", f"""SELECT {cnt_if("priority = 'Crítica'")} AS n_critical, {cnt_if("priority = 'Alta'")} AS n_high,
  (SELECT local_name FROM idx ORDER BY rank, area_code LIMIT 1) AS top_local,
  (SELECT region_name FROM idx ORDER BY rank, area_code LIMIT 1) AS top_region,
  max(score) AS max_score,
  (SELECT region_name FROM (SELECT region_name, {MEAN2} AS m FROM idx GROUP BY region_name)
   ORDER BY m DESC, region_name LIMIT 1) AS top_region_by_mean FROM idx""", ("idx",))
q("idx_scatter", f"""SELECT {AREA_KEYS}, rate_100k, pct_adolescent, priority, cases, score FROM idx
WHERE cases >= 5""", ("idx",))
q("idx_pipeline", f"SELECT {AREA_KEYS}, cases, score, priority, rank FROM idx", ("idx",))
q("idx_full_run", f"SELECT {AREA_KEYS}, cases, score, priority, rank FROM idx", ("idx",))

# --------------------------------------------------------------------------
# 2.14 chart tables
# --------------------------------------------------------------------------
q("cht_histogram", """WITH st AS (SELECT min(CAST(age AS double)) AS mn, max(CAST(age AS double)) AS mx FROM clean),
b0 AS (SELECT CAST(age AS double) AS x, CASE WHEN mx = mn THEN 0
         ELSE least(CAST(floor((CAST(age AS double) - mn) / (mx - mn) * 30) AS integer), 29) END AS i, mn, mx
       FROM clean, st WHERE age IS NOT NULL),
b1 AS (SELECT x, mn, mx, CASE WHEN x < (CASE WHEN i >= 30 THEN mx ELSE i * ((mx - mn) / 30.0) + mn END)
         THEN i - 1 ELSE i END AS i FROM b0),
b2 AS (SELECT CASE WHEN x >= (CASE WHEN i + 1 >= 30 THEN mx ELSE (i + 1) * ((mx - mn) / 30.0) + mn END) AND i <> 29
         THEN i + 1 ELSE i END AS i FROM b1),
cnt AS (SELECT i, count(*) AS n FROM b2 GROUP BY i)
SELECT CAST(g.i + 1 AS integer) AS bin,
  CASE WHEN mx = mn THEN mn ELSE g.i * ((mx - mn) / 30.0) + mn END AS lo,
  CASE WHEN g.i + 1 >= 30 THEN mx ELSE (g.i + 1) * ((mx - mn) / 30.0) + mn END AS hi,
  CAST(coalesce(cnt.n, 0) AS bigint) AS cases
FROM (SELECT CAST(range AS integer) AS i FROM range(30)) g CROSS JOIN st LEFT JOIN cnt USING (i)""")
q("cht_center_lines", "SELECT avg(CAST(age AS double)) AS mean, median(CAST(age AS double)) AS median FROM clean")
q("cht_boxplot", """WITH f AS (SELECT sex, CAST(age AS double) AS x FROM clean WHERE sex IN ('F', 'M') AND age IS NOT NULL),
qq AS (SELECT sex, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
       FROM f GROUP BY sex)
SELECT sex, q1, median, q3,
  min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END) AS whisker_lo,
  max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_hi,
  CAST(sum(CASE WHEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS bigint) AS outliers,
  CAST(count(*) AS bigint) AS n
FROM f JOIN qq USING (sex) GROUP BY sex, q1, median, q3""")
q("cht_heatmap_month_sex", _XM)
q("cht_region_by_sex", f"SELECT * FROM ({_XR}) WHERE grouping_id = 0")
q("cht_share_sex", _by_label("sex_label"))
q("cht_area_share", _by_label("area_label"))

# --------------------------------------------------------------------------
# 2.16 recommendations
# --------------------------------------------------------------------------
from epispark.operators.recommend import DEFAULT_RULE as _DEF, RULES as _RULES, default_text as _say  # noqa: E402



def _rule_sql(col, op, value):
    v = f"'{value}'" if isinstance(value, str) else repr(value)
    return f"{col} {'=' if op == '==' else op} {v}"


_ids = "list_filter([" + ", ".join(
    f"CASE WHEN {_rule_sql(c, op, v)} THEN '{rid}' END" for rid, c, op, v in _RULES) \
    + "], lambda x: x IS NOT NULL)"
_txt = "list_filter([" + ", ".join(
    f"CASE WHEN {_rule_sql(c, op, v)} THEN '{_say(rid).replace(chr(39), chr(39) * 2)}' END" for rid, c, op, v in _RULES) \
    + "], lambda x: x IS NOT NULL)"
q("rec_rules", f"""SELECT {AREA_KEYS}, priority,
  CASE WHEN len(ids) = 0 THEN '{_DEF}' ELSE array_to_string(ids, ',') END AS rule_ids,
  CAST(CASE WHEN len(ids) = 0 THEN 1 ELSE len(ids) END AS integer) AS n_rules,
  CASE WHEN len(txt) = 0 THEN '{_say(_DEF)}' ELSE array_to_string(txt, chr(10) || chr(10)) END AS text
FROM (SELECT *, {_ids} AS ids, {_txt} AS txt FROM idx)""", ("idx",))
q("rec_top_area", f"""SELECT {AREA_KEYS}, cases, {rnd('rate_100k', 1)} AS rate_100k,
  {rnd('pct_adolescent * 100', 1)} AS pct_adolescent, {rnd('trend * 100', 1)} AS trend_pct,
  {rnd('pct_hospitalised * 100', 1)} AS pct_hospitalised, {rnd('pct_psychiatric * 100', 1)} AS pct_psychiatric,
  {rnd('score', 1)} AS score, priority, rank
FROM idx ORDER BY rank, {AREA_KEYS} LIMIT 1""", ("idx",))
q("rec_findings", f"""SELECT {pct1(cnt_if('is_adolescent'), 'count(*)')} AS pct_adolescent,
  {pct1(cnt_if('is_rural'), 'count(*)')} AS pct_rural,
  (SELECT {cnt_if("priority = 'Crítica'")} FROM idx) AS n_critical,
  {_mode_sql('region_name')} AS top_region
FROM clean""", ("idx",))

# --------------------------------------------------------------------------
# 2.15 deterministic parts of the model stage
# --------------------------------------------------------------------------
_FEATS = list(_C.MODEL_FEATURES)
_FEAT_SEL = ", ".join(f"coalesce(CAST({c} AS double), 0.0) AS {c}" for c in _FEATS)
_PREP = f"""(SELECT {AREA_KEYS}, {_FEAT_SEL}, priority,
  CAST(dense_rank() OVER (ORDER BY priority) - 1 AS double) AS label FROM idx WHERE cases >= 5)"""
q("ml_prepare", f"SELECT * FROM {_PREP}", ("idx",))
q("ml_class_weight", f"""SELECT priority, label, CAST(n AS bigint) AS n,
  CAST(sum(n) OVER () AS double) / (count(*) OVER () * n) AS weight
FROM (SELECT priority, label, count(*) AS n FROM {_PREP} GROUP BY priority, label)""", ("idx",))
_HASH = "CAST('0x' || substr(md5(coalesce(area_code, '') || ':42'), 1, 15) AS bigint)"
_SPLIT = f"""(SELECT *, nth <= ceil(0.2 * n) AS is_test FROM (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY h, {AREA_KEYS}) AS nth, count(*) OVER (PARTITION BY g) AS n
  FROM (SELECT *, CASE WHEN min(c) OVER () >= 2 THEN label ELSE 0 END AS g, {_HASH} AS h
        FROM (SELECT *, count(*) OVER (PARTITION BY label) AS c FROM {_PREP} AS p) AS q) AS r) AS s)"""
q("ml_split", f"SELECT area_code, priority, is_test FROM {_SPLIT}", ("idx",))
q("ml_folds", f"""SELECT area_code, priority,
  CAST((row_number() OVER (PARTITION BY label ORDER BY h, {AREA_KEYS}) - 1)
       % CASE WHEN k >= 2 THEN least(5, k) ELSE 1 END AS integer) AS fold
FROM (SELECT *, min(c2) OVER () AS k FROM (SELECT *, count(*) OVER (PARTITION BY label) AS c2 FROM {_SPLIT} WHERE NOT is_test))""", ("idx",))
_GUESS = f"""split AS (SELECT * FROM {_SPLIT}),
seen AS (SELECT region_name, priority, label, count(*) AS n FROM split WHERE NOT is_test GROUP BY ALL),
own AS (SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY region_name ORDER BY n DESC, priority) = 1),
overall AS (SELECT priority, label FROM (SELECT priority, label, sum(n) AS n FROM seen GROUP BY ALL) ORDER BY n DESC, priority LIMIT 1),
guessed AS (SELECT t.area_code, t.region_name, t.local_name, t.priority, t.label,
  coalesce(o.priority, (SELECT priority FROM overall)) AS predicted_priority, coalesce(o.label, (SELECT label FROM overall)) AS prediction
  FROM split t LEFT JOIN own o ON t.region_name IS NOT DISTINCT FROM o.region_name WHERE t.is_test)"""
_CLASSES = "(VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(_C.PRIORITY_ORDER, 1)) + ") AS c(cls, ord)"
q("ml_baseline", f"WITH {_GUESS} SELECT * FROM guessed", ("idx",))
q("ml_baseline_metrics", f"""WITH {_GUESS}, counts AS (SELECT cls, ord,
  (SELECT count(*) FROM guessed WHERE priority = cls) AS support,
  (SELECT count(*) FROM guessed WHERE predicted_priority = cls) AS n_pred,
  (SELECT count(*) FROM guessed WHERE priority = cls AND predicted_priority = cls) AS tp FROM {_CLASSES}),
rates AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM counts)
SELECT cls AS priority, CAST(ord AS integer) AS cls_ord, CAST(p AS double) AS precision, CAST(r AS double) AS recall,
  CAST(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS double) AS f1, CAST(support AS bigint) AS support,
  coalesce((SELECT sum(CASE WHEN priority = predicted_priority THEN 1 ELSE 0 END) / count(*) FROM guessed), 0.0) AS accuracy
FROM rates""", ("idx",))
q("ml_baseline_confusion", f"""WITH {_GUESS} SELECT cls AS priority, CAST(ord AS integer) AS cls_ord, {", ".join(
    f"(SELECT CAST(count(*) AS bigint) FROM guessed WHERE priority = cls AND predicted_priority = '{c}') AS pred_{i}"
    for i, c in enumerate(_C.PRIORITY_ORDER, 1))} FROM {_CLASSES}""", ("idx",))
_Z = ", ".join(
    f"{rnd(f'({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1.0 ELSE stddev_pop({c}) OVER () END', 6)} AS {c}_z"
    for c in _FEATS)
q("ml_standardize", f"SELECT {AREA_KEYS}, {_Z} FROM (SELECT {AREA_KEYS}, {_FEAT_SEL} FROM idx)",
  ("idx",))


QUERIES["stm_incremental_merge"] = QUERIES["set_dedup_first"]
# cube-answered views must equal the direct ones
for _k in ("agg_kpis", "agg_by_sex", "agg_by_age_group", "agg_by_region", "win_weekly_trend",
           "agg_kpis_filtered", "agg_by_month", "agg_by_area_type", "agg_by_quarter",
           "agg_semester_change", "xtab_age_sex", "agg_cumulative_age", "xtab_month_sex"):
    QUERIES[f"{_k}_cube"] = QUERIES[_k]


def load_all() -> dict[str, str]:
    return QUERIES

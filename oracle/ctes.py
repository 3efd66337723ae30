"""DuckDB SQL for the stand-in sources and the 40 models, as named CTEs.

Written independently of the Spark code, directly in the dialect of the
oracle engine (regexp_replace needs 'g' for every match, regexp_full_match
for whole-string tests, list indexes start at 1).  ``with_ctes(final, deps)``
emits ``WITH`` clauses for a final SELECT and everything it depends on.
"""

from __future__ import annotations

import csv
import os
import re

SENT = "'_dbt_utils_surrogate_key_null_'"


def sk(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), {SENT})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def month_key(c: str) -> str:
    return f"CAST(strftime(date_trunc('month', {c}), '%Y%m%d') AS INTEGER)"


GENDER_SHORT = ("CASE WHEN lower(trim({c})) IN ('k','kvinna','kvinnor') THEN 'F' "
                "WHEN lower(trim({c})) IN ('m','man','män') THEN 'M' ELSE 'ALL' END")
MONTHS = "['januari','februari','mars','april','maj','juni','juli','augusti','september','oktober','november','december']"


def _taxonomy_values() -> str:
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "indicatormart", "seeds",
                        "standin_taxonomy.csv")
    with open(path, newline="", encoding="utf-8") as fh:
        rows = list(csv.reader(fh))[1:]
    def q(v):
        return "'" + v.replace("'", "''") + "'"
    vals = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows if r)
    return f"SELECT * FROM (VALUES {vals}) t(source_system, source_indicator_code, topic, polarity)"


CTE: dict[str, str] = {}

CTE["onat"] = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       c.c_nationkey AS k, c.c_mktsegment, n.n_name AS nm, n.n_regionkey,
       CAST(year(o.o_orderdate) AS INTEGER) AS yr, CAST(month(o.o_orderdate) AS INTEGER) AS mo
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""

CTE["lnat"] = """
SELECT l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_returnflag, l.l_linestatus,
       s.s_nationkey AS k, n.n_name AS nm, CAST(year(l.l_shipdate) AS INTEGER) AS yr
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey"""

CTE["taxonomy"] = _taxonomy_values()

# ---------------------------------------------------------------- staging
CTE["kol_raw"] = r"""
SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'Alla regioner, ovägt' WHEN k % 4 = 0 THEN 'Region ' || nm
            WHEN k % 4 = 1 THEN nm || 's' WHEN k % 4 = 2 THEN 'Regionen ' || nm ELSE nm END AS area,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Kvinnor'
            WHEN o_orderstatus = 'O' THEN 'M' ELSE 'Totalt' END AS gender_raw,
       'N7924' || CAST(o_custkey % 6 AS VARCHAR) AS code, 'Väntetid ' || CAST(o_custkey % 6 AS VARCHAR) AS name,
       yr, CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS v
FROM onat"""

CTE["stg_kolada"] = r"""
SELECT * FROM (
  SELECT area AS region_name_raw,
         CASE WHEN area ILIKE 'Alla regioner%' THEN NULL
              ELSE regexp_replace(regexp_replace(trim(area), '^region(en)?\s+', '', 'i'), 's$', '') END AS region_name,
         yr AS year, 'KOLADA' AS source_system, lower(trim(code)) AS source_indicator_code,
         trim(name) AS indicator_name, v AS value, """ + GENDER_SHORT.format(c="gender_raw") + r""" AS gender
  FROM kol_raw WHERE v IS NOT NULL) x
WHERE region_name IS NOT NULL"""

CTE["de_raw"] = r"""
SELECT ' ' || nm || ' ' AS unit_name, CASE WHEN o_orderkey % 10 = 0 THEN 'Sjukhus' ELSE 'Region' END AS unit_type,
       CAST(k AS VARCHAR) AS region_code_raw, CAST(o_custkey AS VARCHAR) AS unit_code,
       CASE WHEN o_orderkey % 11 = 0 THEN 'K' WHEN o_orderstatus = 'F' THEN 'Kvinnor'
            WHEN o_orderstatus = 'O' THEN 'män' ELSE 'Totalt' END AS gender_raw,
       ' ' || o_orderpriority AS indicator_code,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Responstid för ambulans vid prio 1-larm'
            WHEN o_orderpriority = '2-HIGH' THEN 'Ambulanslarm per invånare – prio1-larm'
            ELSE 'Väntetid ' || o_orderpriority END AS indicator_name_raw,
       CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'dagar' ELSE 'procent' END AS unit_raw,
       (CASE WHEN o_orderkey % 89 = 3 THEN CAST(yr AS VARCHAR) || '-13'
                 WHEN o_orderkey % 97 = 1 THEN CAST(yr AS VARCHAR) || '-Q1'
                 WHEN (k + yr) % 3 = 0 THEN ' ' || CAST(yr AS VARCHAR)
                 WHEN (k + yr) % 3 = 1 AND o_orderkey % 4 = 0 THEN CAST(yr AS VARCHAR)
                 ELSE CAST(yr AS VARCHAR) || '-' || lpad(CAST(mo AS VARCHAR), 2, '0') END) AS period_raw,
       CASE WHEN o_orderkey % 23 = 0 THEN '--'
            ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') || ' %' END AS value_raw,
       replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS numerator_raw,
       CAST(o_custkey AS VARCHAR) AS denominator_raw
FROM onat"""

CTE["de_parsed"] = r"""
SELECT * REPLACE (trim(period_raw) AS period_raw),
  CASE WHEN regexp_full_match(trim(period_raw), '[0-9]{4}-[0-9]{2}') THEN 'MONTH'
       WHEN regexp_full_match(trim(period_raw), '[0-9]{4}') THEN 'YEAR' ELSE 'UNKNOWN' END AS period_granularity,
  TRY_CAST(NULLIF(regexp_extract(trim(period_raw), '^[0-9]{4}'), '') AS INTEGER) AS year,
  CASE WHEN regexp_full_match(trim(period_raw), '[0-9]{4}-[0-9]{2}')
       THEN CAST(try_strptime(trim(period_raw), '%Y-%m') AS DATE) END AS period_month,
  TRY_CAST(replace(regexp_replace(value_raw, '[^0-9.,-]', '', 'g'), ',', '.') AS DOUBLE) AS value,
  TRY_CAST(regexp_replace(numerator_raw, '[^0-9.-]', '', 'g') AS DOUBLE) AS numerator,
  TRY_CAST(regexp_replace(denominator_raw, '[^0-9.-]', '', 'g') AS DOUBLE) AS denominator
FROM de_raw WHERE unit_type = 'Region'"""

CTE["de_aug"] = r"""
SELECT *, max(CASE WHEN period_granularity = 'MONTH' THEN 1 ELSE 0 END)
          OVER (PARTITION BY region_code_raw, lower(trim(indicator_code)), year, upper(trim(gender_raw))) AS has_monthly
FROM de_parsed"""

CTE["stg_dataexport"] = r"""
SELECT trim(unit_name) AS region_name, CAST(region_code_raw AS INTEGER) AS region_code, unit_code, year,
       period_month, period_granularity,
       CASE WHEN period_granularity = 'MONTH' THEN period_month ELSE make_date(year, 1, 1) END AS period_filter_date,
       CASE WHEN period_granularity = 'MONTH' THEN strftime(period_month, '%Y-%m')
            ELSE CAST(year AS VARCHAR) END AS period_filter_label,
       'DATAEXPORT' AS source_system, lower(trim(indicator_code)) AS source_indicator_code,
       trim(indicator_name_raw) AS indicator_name, value, """ + GENDER_SHORT.format(c="gender_raw") + r""" AS gender,
       NULLIF(trim(unit_raw), '') AS unit, numerator, denominator
FROM de_aug WHERE NOT (period_granularity = 'YEAR' AND has_monthly = 1) AND year IS NOT NULL"""

CTE["pop_rows"] = """
SELECT k, n_regionkey, yr, count(*) AS cnt FROM onat GROUP BY k, n_regionkey, yr"""

CTE["stg_population"] = """
SELECT CAST(k AS INTEGER) AS region_code, lpad(CAST(k AS VARCHAR), 2, '0') AS region_code_str, yr AS year,
       CASE WHEN (k + yr) % 11 = 0 THEN NULL ELSE cnt END AS population, 'ALL' AS gender,
       CAST(NULL AS VARCHAR) AS age_group
FROM pop_rows"""

CTE["stg_dim_region"] = r"""
SELECT CAST(n_nationkey AS INTEGER) AS region_code_int, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS region_code_2,
       nm_off AS region_name_raw, regexp_replace(nm_off, 's$', '') AS region_name,
       CASE n_nationkey % 3 WHEN 0 THEN format('{{"type":"Point","coordinates":[{}.5,{}]}}', n_nationkey, n_regionkey)
       WHEN 1 THEN format('{{"type":"Polygon","coordinates":[[[{0},{1}],[{0}.25,{1}],[{0},{1}.25],[{0},{1}]]]}}', n_nationkey, n_regionkey)
       ELSE format('{{"type":"MultiPolygon","coordinates":[[[[{0},{1}],[{0}.5,{1}],[{0},{1}.5],[{0},{1}]]]]}}', n_nationkey, n_regionkey) END AS geom
FROM (SELECT *, CASE WHEN n_nationkey % 2 = 0 THEN n_name || 's' ELSE n_name END AS nm_off FROM nation) x"""

CTE["oc_rows"] = """
SELECT yr, mo, CASE WHEN k = 9 THEN nm || 'regionen' WHEN k % 3 = 0 THEN 'Region ' || nm
                    WHEN k % 3 = 1 THEN nm || ' län' ELSE nm END AS region_col, count(*) AS cnt
FROM onat GROUP BY ALL"""

CTE["stg_overcrowding"] = r"""
SELECT yr AS year, mo AS month_no, make_date(yr, mo, 1) AS period_month,
       CASE WHEN trim(region_col) = 'NATION_9regionen' THEN 'NATION_9'
            ELSE regexp_replace(regexp_replace(trim(region_col), '^Region\s+', ''), '\s+län$', '') END AS region_name,
       CAST(cnt AS DOUBLE) AS value, 'OVERCROWDING' AS source_system, 'displaced_patients' AS source_indicator_code,
       'Overcrowding & displaced patients' AS indicator_name, 'MONTH' AS period_granularity, 'ALL' AS gender
FROM oc_rows"""

CTE["stg_beds_region"] = """
SELECT trim(nm) AS region_name, CAST(k AS INTEGER) AS region_code, yr AS year, l_quantity AS value,
       'beds_' || lower(l_returnflag) AS indicator_code, 'Vårdplatser ' || l_returnflag AS indicator_name,
       'Vårdplatser per 1000 invånare' AS indicator_desc
FROM lnat WHERE l_orderkey % 101 <> 0"""

CTE["stg_beds_intl"] = """
SELECT trim(p_brand) AS country_code, trim(' ' || p_brand) AS country_name, CAST(1995 + p_size % 7 AS INTEGER) AS year,
       'OECD_HEALTH' AS source_system, 'beds_per_1000_population' AS source_indicator_code,
       'Hospital beds per 1,000 inhabitants' AS indicator_name,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'Per 1 000 inhabitants' END AS unit, p_retailprice AS value
FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 11 <> 0"""

CTE["mp_raw"] = """
SELECT yr AS year,
       CASE l_returnflag WHEN 'A' THEN 'Läkare' WHEN 'N' THEN 'Sjuksköterska' ELSE 'Specialist läkare' END AS grp,
       CASE WHEN l_linenumber = 7 THEN 'Riket' WHEN l_linenumber = 6 THEN 'Sjukvårdsregion Norr'
            WHEN k % 2 = 0 THEN nm || ' län' ELSE nm || 's' END AS area,
       CASE WHEN l_linestatus = 'O' THEN 'Män' ELSE 'Kvinnor' END AS gender_raw, l_quantity AS value
FROM lnat"""

CTE["stg_medical_personnel"] = r"""
SELECT trim(regexp_replace(regexp_replace(area, '\s+län\s*$', '', 'i'), 's$', '', 'i')) AS region_name, year, value,
       CAST(NULL AS DATE) AS period_month, 'YEAR' AS period_granularity, 'MEDICAL_PERSONNEL' AS source_system,
       lower(regexp_replace(grp, '[^A-Za-z0-9]+', '_', 'g')) AS source_indicator_code, grp AS indicator_name,
       CASE WHEN lower(gender_raw) IN ('män','man') THEN 'M' WHEN lower(gender_raw) IN ('kvinnor','kvinna') THEN 'F'
            ELSE 'ALL' END AS gender
FROM mp_raw WHERE area <> 'Riket' AND lower(area) NOT LIKE '%sjukvårdsregion%'"""

CTE["nc_raw"] = """
SELECT nm AS region_name_raw, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE CAST(k AS VARCHAR) END AS code_raw,
       CASE WHEN o_orderkey % 10 = 1 THEN 'Kommun' ELSE ' Region ' END AS unit_type,
       CASE WHEN o_orderstatus = 'F' THEN 'K' WHEN o_orderstatus = 'O' THEN 'M' ELSE 'Totalt' END AS gender_raw,
       CASE WHEN o_custkey % 4 = 0 THEN ' ' ELSE c_mktsegment END AS age_raw, yr,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS value_raw,
       CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'Nettokostnad hälso- och sjukvård' END AS titel,
       'Nettokostnad för hälso- och sjukvård' AS rubrik
FROM onat"""

CTE["stg_net_cost"] = r"""
SELECT region_code, region_name, year, value, CAST(NULL AS DATE) AS period_month, 'YEAR' AS period_granularity,
       'NET_COST' AS source_system, lower(regexp_replace(indicator_name, '[^A-Za-z0-9]+', '_', 'g')) AS source_indicator_code,
       indicator_name, gender, age_group, unit
FROM (SELECT CAST(TRY_CAST(code_raw AS DECIMAL(38,0)) AS INTEGER) AS region_code, trim(region_name_raw) AS region_name,
             yr AS year, CAST(value_raw AS DOUBLE) AS value,
             coalesce(NULLIF(trim(titel), ''), trim(rubrik)) AS indicator_name,
             """ + GENDER_SHORT.format(c="gender_raw") + r""" AS gender,
             NULLIF(trim(age_raw), '') AS age_group, 'kr per invånare' AS unit
      FROM nc_raw WHERE trim(unit_type) = 'Region') x
WHERE year IS NOT NULL AND region_code IS NOT NULL AND region_name IS NOT NULL AND value IS NOT NULL"""

CTE["exp_rows"] = """
SELECT yr, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) AS h,
       CAST(count(*) * 1000 AS DOUBLE) AS g, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS s
FROM onat GROUP BY yr"""

CTE["stg_expenditure_gdp"] = """
SELECT 'Sverige' AS region_name, yr AS year, make_date(yr, 1, 1) AS period_date, 'YEAR' AS period_granularity,
       'SCB_NATIONAL' AS source_system, code AS source_indicator_code, name AS indicator_name, unit, value
FROM (SELECT yr, 'health_exp_mnkr' AS code, 'Totala hälso- och sjukvårdsutgifter' AS name, 'mnkr' AS unit, h AS value FROM exp_rows
      UNION ALL SELECT yr, 'gdp_mnkr', 'BNP till marknadspris', 'mnkr', g FROM exp_rows
      UNION ALL SELECT yr, 'health_exp_share_pct', 'Hälso-/sjukvård som andel av BNP', 'percent',
                       CASE WHEN yr % 2 = 1 THEN s END FROM exp_rows) u
WHERE value IS NOT NULL"""

CTE["hi_raw"] = """
SELECT CASE WHEN s_suppkey % 13 <> 0 THEN ' ' || r_name END AS area,
       CASE WHEN s_suppkey % 17 = 0 THEN 'n/a' ELSE CAST(1995 + s_suppkey % 7 AS VARCHAR) END AS tp,
       CAST(s_suppkey % 100 AS VARCHAR) || ',' || lpad(CAST((s_suppkey * 7) % 1000 AS VARCHAR), 3, '0') AS obs
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTE["stg_health_exp_gdp_intl"] = """
SELECT trim(area) AS country_name, CAST(TRY_CAST(tp AS DECIMAL(38,0)) AS INTEGER) AS year,
       CAST(CAST(TRY_CAST(replace(obs, ',', '.') AS DECIMAL(10,2)) AS VARCHAR) AS DOUBLE) AS value,
       'OECD_HEALTH' AS source_system, 'HEALTH_EXPENDITURE_PCT_GDP' AS source_indicator_code,
       'Health expenditure (% of GDP)' AS indicator_name, '% of GDP' AS unit
FROM hi_raw WHERE trim(area) IS NOT NULL AND TRY_CAST(tp AS DECIMAL(38,0)) IS NOT NULL"""

CTE["stg_physicians_per1000"] = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS region_name,
       CAST(1995 + c_custkey % 7 AS INTEGER) AS year, c_acctbal AS value, 'OECD_HEALTH' AS source_system,
       'Doctors per 1000 inhabitants' AS indicator_name, 'Per 1000 inhabitants' AS unit
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

CTE["ka_raw"] = """
SELECT yr, mo, """ + MONTHS + """[mo] AS month_raw,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Antal besök' ELSE 'Median tid till läkare i minuter' END AS metric,
       CASE WHEN o_orderkey % 31 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ' st' END AS value_raw,
       CASE WHEN k % 3 = 0 THEN 'REGION ' || nm WHEN k % 3 = 1 THEN nm || ' LÄN' ELSE nm END AS region_raw,
       CASE WHEN o_orderstatus = 'F' THEN 'Kvinnor' WHEN o_orderstatus = 'O' THEN 'Män' ELSE 'Totalt' END AS gender_raw,
       CASE o_custkey % 5 WHEN 0 THEN '0-17' WHEN 1 THEN '18-29' WHEN 2 THEN '30-64' WHEN 3 THEN '80+'
            ELSE 'Totalt' END AS age_raw
FROM onat"""

CTE["stg_tid_konalder"] = r"""
SELECT yr AS year, mo AS month_number, upper(substr(trim(month_raw), 1, 1)) || lower(substr(trim(month_raw), 2)) AS month_name,
       make_date(yr, mo, 1) AS period_date, 'STAT_KON_ALDER' AS source_system, trim(metric) AS indicator_name,
       lower(regexp_replace(trim(metric), '\s+', '_', 'g')) AS source_indicator_code, trim(region_raw) AS region_name,
       """ + GENDER_SHORT.format(c="gender_raw") + r""" AS gender, NULLIF(trim(age_raw), '') AS age_group,
       TRY_CAST(replace(regexp_replace(value_raw, '[^0-9.,-]', '', 'g'), ',', '.') AS DOUBLE) AS value
FROM ka_raw WHERE value_raw IS NOT NULL"""

CTE["di_raw"] = """
SELECT yr, mo, CASE WHEN o_orderkey % 3 = 0 THEN 'Antal besök' ELSE 'Median tid till läkare i minuter' END AS metric,
       CASE WHEN o_orderkey % 37 = 0 THEN '--' WHEN o_orderkey % 41 = 0 THEN '-'
            ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR) || ',5' END AS value_raw,
       CASE WHEN o_orderkey % 19 = 0 THEN 'Riket' ELSE nm END AS region_raw,
       CASE WHEN o_orderkey % 43 <> 0 THEN c_mktsegment END AS diag
FROM onat"""

CTE["stg_tid_diagnos"] = r"""
SELECT trim(region_raw) AS region_name, yr AS year, make_date(yr, mo, 1) AS period_month, 'MONTH' AS period_granularity,
       'STAT_DIAGNOS' AS source_system, lower(regexp_replace(trim(metric), 's+', '_', 'g')) AS source_indicator_code,
       trim(metric) AS indicator_name, trim(diag) AS diagnosgrupp,
       CASE WHEN trim(value_raw) IN ('--', '-', '') THEN NULL
            ELSE TRY_CAST(replace(regexp_replace(value_raw, '[^0-9.,-]', '', 'g'), ',', '.') AS DOUBLE) END AS value,
       'ALL' AS gender, CAST(NULL AS VARCHAR) AS age_group,
       CASE WHEN lower(trim(metric)) LIKE '%minut%' THEN 'minuter' WHEN lower(trim(metric)) LIKE '%antal%' THEN 'antal' END AS unit
FROM di_raw WHERE coalesce(lower(trim(region_raw)), '') NOT IN ('riket', 'sverige')"""

# ---------------------------------------------------------------- dimensions
CTE["dim_region"] = f"""
SELECT {sk('region_code_int')} AS region_key, region_code_int, region_code_2, region_name, geom FROM stg_dim_region"""

CTE["dim_gender"] = f"""
SELECT {sk('gender_code')} AS gender_key, gender_code, gender_name
FROM (VALUES ('F', 'Kvinna'), ('M', 'Man'), ('ALL', 'Alla')) t(gender_code, gender_name)"""

CTE["dim_age_group"] = f"""
SELECT {sk('trim(age_group)')} AS age_key, trim(age_group) AS age_group_label,
       coalesce(TRY_CAST(NULLIF(regexp_extract(age_group, '^[0-9]+'), '') AS INTEGER), 999) AS sort_key
FROM (SELECT DISTINCT age_group FROM stg_tid_konalder WHERE age_group IS NOT NULL) x"""

CTE["date_bounds"] = """
SELECT min(m) AS lo, max(m) AS hi FROM (
  SELECT CAST(date_trunc('month', period_month) AS DATE) AS m FROM stg_dataexport
  UNION ALL SELECT CAST(date_trunc('month', period_month) AS DATE) FROM stg_overcrowding
  UNION ALL SELECT CAST(date_trunc('month', period_date) AS DATE) FROM stg_tid_konalder
  UNION ALL SELECT CAST(date_trunc('month', period_month) AS DATE) FROM stg_tid_diagnos) u"""

CTE["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS month_date, CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month_no, strftime(d, '%Y-%m') AS year_month_label
FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS d
      FROM date_bounds WHERE lo IS NOT NULL AND hi IS NOT NULL) s"""

CTE["ind_base"] = """
SELECT DISTINCT * FROM (
  SELECT source_system, source_indicator_code, indicator_name, unit, 'MONTH' AS default_granularity
    FROM stg_dataexport WHERE period_granularity = 'MONTH'
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, CAST(NULL AS VARCHAR), 'MONTH' FROM stg_overcrowding
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, CAST(NULL AS VARCHAR), 'MONTH' FROM stg_tid_konalder
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, unit, 'MONTH' FROM stg_tid_diagnos
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, unit, 'YEAR'
    FROM stg_dataexport WHERE period_granularity = 'YEAR'
  UNION ALL SELECT 'BEDS_REGION', indicator_code, indicator_name, CAST(NULL AS VARCHAR), 'YEAR' FROM stg_beds_region
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, unit, 'YEAR' FROM stg_beds_intl
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, CAST(NULL AS VARCHAR), 'YEAR' FROM stg_medical_personnel
  UNION ALL (SELECT 'SCB', 'POPULATION', 'Population', CAST(NULL AS VARCHAR), 'YEAR' FROM stg_population LIMIT 1)
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, unit, 'YEAR' FROM stg_net_cost
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, CAST(NULL AS VARCHAR), 'YEAR' FROM stg_kolada
  UNION ALL (SELECT 'OECD_HEALTH', 'PHYSICIANS_PER_1000', 'Doctors per 1000 inhabitants', 'Per 1000 inhabitants', 'YEAR'
             FROM stg_physicians_per1000 LIMIT 1)
  UNION ALL (SELECT 'OECD_HEALTH', 'HEALTH_EXPENDITURE_PCT_GDP', 'Health expenditure (% of GDP)', '% of GDP', 'YEAR'
             FROM stg_health_exp_gdp_intl LIMIT 1)
  UNION ALL SELECT source_system, source_indicator_code, indicator_name, unit, 'YEAR' FROM stg_expenditure_gdp) u"""

CTE["ind_dedup"] = """
SELECT source_system, source_indicator_code, indicator_name, unit, default_granularity FROM (
  SELECT *, row_number() OVER (PARTITION BY source_system, source_indicator_code
                               ORDER BY indicator_name ASC NULLS LAST, unit ASC NULLS LAST,
                                        default_granularity ASC NULLS LAST) AS rn
  FROM ind_base) x WHERE rn = 1"""

CTE["dim_indicator"] = f"""
SELECT {sk('d.source_system', 'd.source_indicator_code')} AS indicator_key, d.source_system, d.source_indicator_code,
       d.indicator_name, d.unit, d.default_granularity, m.topic, m.polarity
FROM ind_dedup d
LEFT JOIN (SELECT upper(trim(source_system)) AS ss, upper(trim(source_indicator_code)) AS sc, topic, polarity
           FROM taxonomy) m
  ON m.ss = upper(trim(d.source_system)) AND m.sc = upper(trim(d.source_indicator_code))"""

CTE["dim_region_geojson"] = """
SELECT region_key, lpad(CAST(region_code_int AS VARCHAR), 2, '0') AS region_code, region_name, geom AS geojson
FROM dim_region"""

# ---------------------------------------------------------------- facts
CTE["fct_beds_intl_y"] = """
SELECT s.country_name, s.year, i.indicator_key, s.value, s.unit
FROM stg_beds_intl s LEFT JOIN dim_indicator i
  ON i.source_system = s.source_system AND i.source_indicator_code = s.source_indicator_code"""

CTE["cap_union"] = """
SELECT r.region_key, s.year, 'BEDS_PER_1000' AS metric_type, 'BEDS_REGION' AS src_system, s.indicator_code AS src_code,
       s.value, CAST(NULL AS VARCHAR) AS unit
FROM stg_beds_region s LEFT JOIN dim_region r ON r.region_code_int = s.region_code
UNION ALL
SELECT r.region_key, s.year, 'STAFF_HEADCOUNT', s.source_system, s.source_indicator_code, CAST(sum(s.value) AS DOUBLE),
       CAST(NULL AS VARCHAR)
FROM stg_medical_personnel s LEFT JOIN dim_region r ON r.region_name = s.region_name
WHERE s.value IS NOT NULL GROUP BY r.region_key, s.year, s.source_system, s.source_indicator_code
UNION ALL
SELECT r.region_key, s.year, 'POPULATION', 'SCB', 'POPULATION', CAST(s.population AS DOUBLE), CAST(NULL AS VARCHAR)
FROM stg_population s LEFT JOIN dim_region r ON r.region_code_int = s.region_code
UNION ALL
SELECT r.region_key, s.year, 'NET_COST_SEK', s.source_system, s.source_indicator_code, s.value, s.unit
FROM stg_net_cost s LEFT JOIN dim_region r ON r.region_code_int = s.region_code"""

CTE["fct_capacity_yearly"] = """
SELECT u.region_key, u.year, u.metric_type, i.indicator_key, u.value, u.unit
FROM cap_union u LEFT JOIN dim_indicator i ON i.source_system = u.src_system AND i.source_indicator_code = u.src_code"""

CTE["dim_diag"] = f"""
SELECT DISTINCT diagnosgrupp, {sk('diagnosgrupp')} AS diagnosis_key FROM stg_tid_diagnos WHERE diagnosgrupp IS NOT NULL"""

CTE["fct_ed_time_by_diagnosis_m"] = f"""
SELECT r.region_key, {month_key('s.period_month')} AS date_key, d.diagnosis_key, s.diagnosgrupp, i.indicator_key,
       s.value, s.unit
FROM stg_tid_diagnos s
LEFT JOIN dim_region r ON r.region_name = s.region_name
LEFT JOIN dim_diag d ON d.diagnosgrupp = s.diagnosgrupp
LEFT JOIN dim_indicator i ON i.source_system = s.source_system AND i.source_indicator_code = s.source_indicator_code"""

CTE["fct_health_exp_gdp_intl_y"] = """
SELECT * FROM (
  SELECT s.country_name, CAST(CAST(s.year AS VARCHAR) || '0101' AS INTEGER) AS date_key, i.indicator_key, s.value
  FROM stg_health_exp_gdp_intl s LEFT JOIN dim_indicator i
    ON i.source_system = s.source_system AND i.source_indicator_code = s.source_indicator_code) x
WHERE date_key IS NOT NULL"""

UPPER_NORM = r"upper(regexp_replace(regexp_replace(trim({c}), '^\s*REGION\s+', ''), '\s+LÄN\s*$', ''))"

# Region spellings as the facts look them up, one row per spelling and region.
CTE["region_spelling"] = f"SELECT {UPPER_NORM.format(c='region_name')} AS spelling, region_key FROM dim_region " \
                         "WHERE region_key IS NOT NULL"

# Indicator keys under upper-case, trimmed codes.
CTE["indicator_by_code"] = "SELECT upper(trim(source_system)) AS sys, upper(trim(source_indicator_code)) AS code, " \
                        "indicator_key FROM dim_indicator"


def spelled(column: str, alias: dict[str, str]) -> str:
    """The looked-up spelling of a raw region name, with the aliases of one source applied."""
    norm = UPPER_NORM.format(c=column)
    return f"CASE {norm} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in alias.items()) + f" ELSE {norm} END"


# The largest value of a grain is the row that one-row-per-grain keeps (NULL values are out before).
CTE["fct_kolada_y"] = f"""
SELECT region_key, s.year, gender_key, indicator_key, max(s.value) AS value
FROM stg_kolada s
JOIN region_spelling ON spelling = {spelled("s.region_name", {"NATION_23": "NATION_3"})}
LEFT JOIN indicator_by_code ON sys = upper(trim(s.source_system)) AND code = upper(trim(s.source_indicator_code))
LEFT JOIN dim_gender ON gender_code = upper(trim(s.gender))
WHERE s.value IS NOT NULL
GROUP BY ALL"""

NAME_NORM = r"upper(regexp_replace(regexp_replace(regexp_replace(trim({c}), '^Region\s+', ''), '\s+län$', ''), '\s+', ' ', 'g'))"

# Region names as the crowding source spells them, cleaned like its rows.
CTE["cleaned_spelling"] = f"SELECT {NAME_NORM.format(c='region_name')} AS cleaned, region_key FROM dim_region"


def tag_key(system: str, code: str) -> str:
    """The key of the one indicator that a source's rows all carry."""
    return f"(SELECT max(indicator_key) FROM dim_indicator WHERE source_system = '{system}' AND source_indicator_code = '{code}')"


CTE["fct_overcrowding_monthly"] = f"""
SELECT region_key, {month_key('period_month')} AS date_key, indicator_key, value
FROM stg_overcrowding
LEFT JOIN cleaned_spelling
  ON cleaned = CASE lower(region_name) WHEN 'nation_22' THEN 'NATION_2' ELSE {NAME_NORM.format(c="region_name")} END
LEFT JOIN (SELECT source_system, source_indicator_code, indicator_key FROM dim_indicator)
  USING (source_system, source_indicator_code)"""

# The exported rows with the keys that both grains share.
CTE["keyed_export"] = """
SELECT period_granularity AS grain, region_key, gender_key, e.year, period_month, source_system, source_indicator_code,
       value, numerator, denominator, unit
FROM stg_dataexport e
LEFT JOIN (SELECT gender_code AS gender, gender_key FROM dim_gender) USING (gender)
LEFT JOIN (SELECT region_code_int AS region_code, region_key FROM dim_region) USING (region_code)"""

CTE["fct_performance_monthly"] = f"""
SELECT indicator_key, gender_key, region_key, {month_key('period_month')} AS date_key, value, numerator, denominator, unit
FROM keyed_export
LEFT JOIN (SELECT source_system, source_indicator_code, indicator_key FROM dim_indicator)
  USING (source_system, source_indicator_code)
WHERE grain = 'MONTH' AND value IS NOT NULL"""

CTE["fct_performance_yearly"] = """
SELECT indicator_key, gender_key, region_key, year, value, numerator, denominator, unit
FROM keyed_export
LEFT JOIN indicator_by_code ON code = upper(trim(source_indicator_code)) AND sys = upper(trim(source_system))
WHERE grain = 'YEAR'"""

CTE["ref_physicians_per_1000_y"] = f"""
SELECT region_key, year, year * 10000 + 101 AS date_key, value, {tag_key('OECD_HEALTH', 'PHYSICIANS_PER_1000')} AS indicator_key,
       'PHYSICIANS_PER_1000' AS source_indicator_code, 'OECD_HEALTH' AS source_system,
       'Per 1000 inhabitants' AS unit, 'Doctors per 1000 inhabitants' AS indicator_name
FROM (SELECT upper(region_name) AS spelling, year, value FROM stg_physicians_per1000)
JOIN (SELECT upper(region_name) AS spelling, region_key FROM dim_region WHERE region_key IS NOT NULL) USING (spelling)"""

CTE["fct_physicians_per_1000_y"] = """
SELECT region_key, date_key, indicator_key, year, value FROM ref_physicians_per_1000_y
WHERE region_key IS NOT NULL AND date_key IS NOT NULL AND indicator_key IS NOT NULL"""

CTE["fct_visits_by_gender_age_m"] = f"""
SELECT region_key, {month_key('s.period_date')} AS date_key, gender_key, age_key, indicator_key, s.value,
       CAST(NULL AS VARCHAR) AS unit
FROM stg_tid_konalder s
JOIN region_spelling ON spelling = {spelled("s.region_name", {"NATION_24": "NATION_4"})}
LEFT JOIN indicator_by_code ON sys = upper(trim(s.source_system)) AND code = upper(trim(s.source_indicator_code))
LEFT JOIN dim_age_group ON age_group_label = trim(s.age_group)
LEFT JOIN dim_gender ON gender_code = upper(trim(s.gender))
WHERE s.value IS NOT NULL"""

# ---------------------------------------------------------------- marts
CTE["mart_access_monthly"] = """
SELECT f.region_key, f.date_key, f.gender_key, f.indicator_key, d.source_system, d.source_indicator_code,
       d.indicator_name, d.unit, f.value, f.numerator, f.denominator
FROM fct_performance_monthly f JOIN dim_indicator d ON d.indicator_key = f.indicator_key
WHERE coalesce(d.topic, '') = 'WAITING_TIME'"""

CTE["mart_access_yearly"] = """
SELECT f.region_key, f.year, CAST(f.year * 10000 + 101 AS INTEGER) AS date_key, f.gender_key, f.indicator_key,
       d.source_system, d.source_indicator_code, d.indicator_name, d.unit, f.value
FROM fct_kolada_y f JOIN dim_indicator d ON d.indicator_key = f.indicator_key
WHERE coalesce(d.topic, '') = 'WAITING_TIME' AND d.source_indicator_code IN ('n79241', 'n79240', 'n79242', 'n79243')"""

# What the international marts show where the registry does not know an indicator.
SHOWN = {
    "mart_beds_intl_y": ("Hospital beds per 1,000 inhabitants", "CAPACITY", "Per 1 000 inhabitants"),
    "mart_health_exp_gdp_intl_y": ("Health expenditure (% of GDP)", "COST", "% of GDP"),
    "mart_physicians_per_1000_y": ("Doctors per 1000 inhabitants", "CAPACITY", "Per 1000 inhabitants"),
}


def shown(mart: str, rows: str, columns: str) -> str:
    """``columns`` of ``rows`` with the indicator's description, from the registry or from ``SHOWN``."""
    name, topic, unit = SHOWN[mart]
    return f"""
SELECT {columns}, indicator_key, value, '{unit}' AS unit, ifnull(registry.name, '{name}') AS indicator_name,
       ifnull(registry.topic, '{topic}') AS topic, ifnull(registry.system, 'OECD_HEALTH') AS source_system
FROM ({rows})
LEFT JOIN (SELECT indicator_key, indicator_name AS name, topic, source_system AS system FROM dim_indicator) registry
  USING (indicator_key)"""


CTE["mart_beds_intl_y"] = shown(
    "mart_beds_intl_y", "SELECT country_name, year, year * 10000 + 101 AS date_key, indicator_key, value FROM fct_beds_intl_y",
    "country_name, year, date_key")


CTE["mart_emergency_yearly"] = """
SELECT f.region_key, f.year, d.source_system, d.source_indicator_code, d.indicator_name,
       coalesce(d.unit, 'minuter') AS unit, 'MINUTES' AS metric_kind, f.value
FROM fct_performance_yearly f JOIN dim_indicator d ON d.indicator_key = f.indicator_key
WHERE lower(d.indicator_name) LIKE '%responstid för ambulans%' OR lower(d.source_indicator_code) LIKE '%ambulans%'"""

# The year comes from the calendar: none where the calendar lacks the date.
CTE["mart_health_exp_gdp_intl_y"] = shown(
    "mart_health_exp_gdp_intl_y", """SELECT country_name, date_key, calendar.year, indicator_key, value
    FROM fct_health_exp_gdp_intl_y LEFT JOIN (SELECT date_key, year FROM dim_date) calendar USING (date_key)""",
    "country_name, year, date_key")

CTE["mart_physicians_per_1000_y"] = shown(
    "mart_physicians_per_1000_y", """SELECT region_key, region.name AS region_name, year, date_key, indicator_key, value
    FROM fct_physicians_per_1000_y LEFT JOIN (SELECT region_key, region_name AS name FROM dim_region) region USING (region_key)""",
    "region_key, region_name, year, date_key")

# Patterns, units and kinds of the pressure mart.  `marks` lists what an indicator counts as.
CTE["pressure_marks"] = """
SELECT indicator_key, source_system, source_indicator_code, indicator_name, marks,
       coalesce(unit, CASE WHEN marks[1] = 'doctor' THEN 'minuter' WHEN marks[1] IN ('displaced', 'visit_code') THEN 'antal' END)
         AS unit
FROM (SELECT *, list_filter([
               CASE WHEN lower(source_indicator_code) LIKE '%median_tid_till_läkare%' THEN 'doctor' END,
               CASE WHEN lower(source_indicator_code) LIKE '%displaced%' THEN 'displaced' END,
               CASE WHEN lower(source_indicator_code) LIKE '%besök%' THEN 'visit_code' END,
               CASE WHEN regexp_full_match(lower(source_indicator_code || ' ' || indicator_name),
                                           'antal.*bes(ö|o)k|bes_k') THEN 'visits' END,
               'any'], lambda m: m IS NOT NULL) AS marks
      FROM dim_indicator) m
WHERE upper(topic) = 'PRESSURE'
   OR (list_contains(marks, 'visits') AND upper(source_system) IN ('STAT_KON_ALDER', 'STAT_DIAGNOS'))"""

# The monthly pressure facts in one shape, by the feed they come from.
CTE["pressure_feed"] = """
SELECT 'beds' AS feed, region_key, date_key, indicator_key, value FROM fct_overcrowding_monthly
UNION ALL BY NAME
SELECT 'visits' AS feed, region_key, date_key, indicator_key, value, gender_key, age_key FROM fct_visits_by_gender_age_m
UNION ALL BY NAME
SELECT 'diagnosis' AS feed, region_key, date_key, indicator_key, value, CAST(diagnosgrupp AS VARCHAR) AS diagnosis_group
FROM fct_ed_time_by_diagnosis_m"""

# One rule per published kind: which mark of which feed it takes, and the unit where none is known.
CTE["pressure_rule"] = """
SELECT * FROM (VALUES ('beds', 'displaced', 'COUNT', NULL), ('visits', 'doctor', 'MINUTES', NULL),
                      ('visits', 'visits', 'VISITS', 'antal'), ('diagnosis', 'any', 'MINUTES', 'minuter'))
  r(feed, mark, metric_kind, default_unit)"""

CTE["mart_pressure_monthly"] = """
SELECT region_key, date_key, source_system, source_indicator_code, indicator_name, coalesce(unit, default_unit) AS unit,
       metric_kind, 'MONTHLY' AS grain, gender_key, age_key, diagnosis_group, value
FROM pressure_feed JOIN pressure_rule USING (feed) JOIN pressure_marks USING (indicator_key)
WHERE list_contains(marks, mark)"""

CTE["dim_i"] = """
SELECT indicator_key, upper(trim(topic)) AS topic, upper(trim(polarity)) AS polarity, source_system,
       source_indicator_code, indicator_name
FROM dim_indicator"""

# Facts that the explorer passes through row by row, with the topics it takes from each.
CTE["explorer_feed"] = """
SELECT 'MONTH' AS time_grain, ['WAITING_TIME'] AS topics, region_key, date_key, indicator_key, value
FROM fct_performance_monthly
UNION ALL BY NAME
SELECT 'MONTH' AS time_grain, ['PRESSURE'] AS topics, region_key, date_key, indicator_key, value
FROM fct_overcrowding_monthly
UNION ALL BY NAME
SELECT 'YEAR' AS time_grain, ['CAPACITY', 'COST', 'WAITING_TIME', 'DEMAND'] AS topics, region_key, year, indicator_key, value
FROM (SELECT region_key, year, indicator_key, value FROM fct_capacity_yearly
      UNION ALL SELECT region_key, year, indicator_key, value FROM fct_performance_yearly
      UNION ALL SELECT region_key, year, indicator_key, value FROM fct_kolada_y) yearly"""

# Visits per region-month and metric: every row counts towards demand, PRESSURE rows also towards the medians.
CTE["explorer_visits"] = """
WITH named AS (
  SELECT f.region_key, f.date_key, f.value, d.topic, d.source_indicator_code AS code, d.indicator_name AS label
  FROM fct_visits_by_gender_age_m f LEFT JOIN dim_i d USING (indicator_key))
SELECT region_key, date_key, 'DEMAND' AS theme, 'NEUTRAL' AS polarity, sum(value) AS value,
       coalesce(if(topic = 'DEMAND', code, NULL), 'VISITS_TOTAL') AS metric_code,
       coalesce(if(topic = 'DEMAND', label, NULL), 'ED visits (total)') AS indicator_name
FROM named GROUP BY ALL
UNION ALL BY NAME
SELECT region_key, date_key, 'PRESSURE' AS theme, 'NEG' AS polarity, avg(value) AS value, code AS metric_code,
       label AS indicator_name
FROM named WHERE topic = 'PRESSURE' GROUP BY ALL"""

CTE["mart_regional_explorer_monthly_long"] = """
SELECT region_key, date_key, CAST(year AS INTEGER) AS year, time_grain, topic AS theme, polarity,
       source_indicator_code AS metric_code, indicator_name, value
FROM explorer_feed JOIN dim_i USING (indicator_key) WHERE list_contains(topics, topic)
UNION ALL BY NAME
SELECT *, 'MONTH' AS time_grain FROM explorer_visits"""

# Role rules of the resources mart, first match wins; NULL matches anything.
ROLE_RULES = [  # role, system, code, topic, whole-name pattern
    ("POPULATION", "SCB", "POPULATION", None, None),
    ("BEDS_PER_1000", "BEDS_REGION", None, None, None),
    ("BEDS_PER_1000", "OECD_HEALTH", None, None, None),
    ("BEDS_PER_1000", None, None, "CAPACITY", "(vårdplatser|beds)"),
    ("STAFF_DOCTORS", "MEDICAL_PERSONNEL", None, None, "(läkare)"),
    ("STAFF_NURSES", "MEDICAL_PERSONNEL", None, None,
     "(sjuksköterska|sjukskoterska|röntgensjuksköterska|rontgensjukskoterska)"),
    ("STAFF_DOCTORS", None, None, "CAPACITY", "(läkare)"),
    ("STAFF_NURSES", None, None, "CAPACITY",
     "(sjuksköterska|sjukskoterska|röntgensjuksköterska|rontgensjukskoterska)"),
    ("STAFF_OTHER", "MEDICAL_PERSONNEL", None, None, None),
    ("STAFF_OTHER", None, None, "CAPACITY", None),
    ("COST_PER_CAPITA", "NET_COST", None, "COST", None),
    ("COST_OTHER", None, None, "COST", None),
    ("AMBULANCE_TIME_MIN", None, None, None, "responstid för ambulans vid prio 1-larm"),
    ("AMBULANCE_COUNT", None, None, None,
     "ambulanslarm per invånare – prio1-larm|ambulanslarm per invånare - prio1-larm"),
]


def _literal(v) -> str:
    return "CAST(NULL AS VARCHAR)" if v is None else str(v) if isinstance(v, int) else f"'{v}'"


CTE["role_rule"] = "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join(map(_literal, (n, *rule))) + ")" for n, rule in enumerate(ROLE_RULES)) \
    + ") t(rank, role, sys, code, topic, pattern)"

CTE["indicator_role"] = """
SELECT i.indicator_key, arg_min(t.role, t.rank) AS role
FROM dim_indicator i JOIN role_rule t
  ON coalesce(t.sys = upper(trim(i.source_system)), t.sys IS NULL)
 AND coalesce(t.code = upper(trim(i.source_indicator_code)), t.code IS NULL)
 AND coalesce(t.topic = upper(i.topic), t.topic IS NULL)
 AND coalesce(regexp_full_match(lower(i.indicator_name), t.pattern), t.pattern IS NULL)
GROUP BY i.indicator_key"""

# Roles that each yearly fact feeds; overcrowding is summed over the months of a year.
CTE["resource_feed"] = """
SELECT region_key, year, role, value FROM fct_capacity_yearly JOIN indicator_role USING (indicator_key)
UNION ALL
SELECT region_key, year, role, value FROM fct_performance_yearly JOIN indicator_role USING (indicator_key)
WHERE starts_with(role, 'AMBULANCE_')
UNION ALL
SELECT region_key, year, 'OVERCROWDING_Y', CAST(sum(value) AS DOUBLE)
FROM fct_overcrowding_monthly JOIN dim_date USING (date_key) GROUP BY ALL"""

# Output column -> aggregate and the roles it takes.
RESOURCE_COLUMNS = {
    "beds_per_1000": ("max", ["BEDS_PER_1000"]), "staff_doctors": ("sum", ["STAFF_DOCTORS"]),
    "staff_nurses": ("sum", ["STAFF_NURSES"]), "staff_headcount_total": ("sum", ["STAFF_DOCTORS", "STAFF_NURSES"]),
    "population": ("max", ["POPULATION"]), "cost_per_capita": ("max", ["COST_PER_CAPITA"]),
    "cost_other": ("max", ["COST_OTHER"]), "ambulance_count": ("max", ["AMBULANCE_COUNT"]),
    "ambulance_time_min": ("max", ["AMBULANCE_TIME_MIN"]), "displaced_patients_year": ("max", ["OVERCROWDING_Y"]),
}
PER_1000 = {"staff_per_1000": "staff_headcount_total", "doctors_per_1000": "staff_doctors",
            "nurses_per_1000": "staff_nurses"}

CTE["resource_columns"] = "SELECT region_key, year, " + ", ".join(
    f"{fn}(value) FILTER (WHERE role IN ({', '.join(map(_literal, roles))})) AS {name}"
    for name, (fn, roles) in RESOURCE_COLUMNS.items()) + " FROM resource_feed GROUP BY region_key, year"

CTE["mart_resources_yearly"] = "SELECT *, CAST(year * 10000 + 101 AS INTEGER) AS date_key, " + ", ".join(
    f"if(population > 0, {top} / population * 1000, NULL) AS {name}" for name, top in PER_1000.items()) \
    + " FROM resource_columns"


_IDENT = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def deps_of(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(_IDENT.findall(sql)) if w in CTE]


def with_ctes(final: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` every CTE the final query needs (transitively, in dependency order)."""
    table = dict(CTE)
    table.update(extra or {})
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in [w for w in dict.fromkeys(_IDENT.findall(table[name])) if w in table and w != name]:
            visit(d)
        order.append(name)

    for w in dict.fromkeys(_IDENT.findall(final)):
        if w in table:
            visit(w)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({table[n]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def model_sql(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}")

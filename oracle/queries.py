"""Oracle SQL per query key (DuckDB dialect, tables pre-registered as views)."""

from __future__ import annotations

from oracle.ctes import GENDER_SHORT, MONTHS, NAME_NORM, SENT, UPPER_NORM, model_sql, with_ctes

MODEL_NAMES = (
    "stg_beds_intl", "stg_beds_region", "stg_dataexport", "stg_dim_region", "stg_expenditure_gdp",
    "stg_health_exp_gdp_intl", "stg_kolada", "stg_medical_personnel", "stg_net_cost", "stg_overcrowding",
    "stg_physicians_per1000", "stg_population", "stg_tid_diagnos", "stg_tid_konalder",
    "dim_age_group", "dim_date", "dim_gender", "dim_indicator", "dim_region", "dim_region_geojson",
    "fct_beds_intl_y", "fct_capacity_yearly", "fct_ed_time_by_diagnosis_m", "fct_health_exp_gdp_intl_y",
    "fct_kolada_y", "fct_overcrowding_monthly", "fct_performance_monthly", "fct_performance_yearly",
    "fct_physicians_per_1000_y", "fct_visits_by_gender_age_m", "ref_physicians_per_1000_y",
    "mart_access_monthly", "mart_access_yearly", "mart_beds_intl_y", "mart_emergency_yearly",
    "mart_health_exp_gdp_intl_y", "mart_physicians_per_1000_y", "mart_pressure_monthly",
    "mart_regional_explorer_monthly_long", "mart_resources_yearly",
)

PXWEB_ROWS = """
SELECT lpad(CAST(k AS VARCHAR), 2, '0') AS region_code_raw, CAST(yr AS VARCHAR) AS year_raw,
       CASE WHEN (k + yr) % 11 = 0 THEN '..' ELSE CAST(cnt AS VARCHAR) END AS obs_raw
FROM pop_rows"""

OC_COLS = """
SELECT n_nationkey AS k, CASE WHEN n_nationkey = 9 THEN n_name || 'regionen' WHEN n_nationkey % 3 = 0 THEN 'Region ' || n_name
                              WHEN n_nationkey % 3 = 1 THEN n_name || ' län' ELSE n_name END AS region_col
FROM nation"""


def _dollar_sum(expr: str) -> str:
    return f"CAST(CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE)"


def _status(n: str, sev: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 'pass' WHEN {sev} = 'warn' THEN 'warn' ELSE 'fail' END"


def _check(table: str, check: str, column: str, failures_sql: str, severity: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
            f"CAST(n AS BIGINT) AS failures, '{severity}' AS severity, {_status('n', repr(severity))} AS status "
            f"FROM ({failures_sql}) c")


def _best_match_sql(where: str = "true") -> str:
    from indicatormart.plans.entries import BEST_MATCH_FAMILIES
    cases = []
    for fam, terms in BEST_MATCH_FAMILIES.items():
        words = sorted({w for t in terms for w in t.lower().split()})
        hits = " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in words)
        cases.append(f"WHEN '{fam}' THEN {hits}")
    hits_sql = "CASE lang " + " ".join(cases) + " END"
    return f"""
SELECT lang, doc_id, hits FROM (
  SELECT lang, doc_id, hits,
         row_number() OVER (PARTITION BY lang ORDER BY hits DESC, length(text) ASC, doc_id ASC) AS rn
  FROM (SELECT doc_id, lang, text, {hits_sql} AS hits FROM documents WHERE {where}) d) x
WHERE rn = 1"""


def operator_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    # sources / sinks
    q["read_documents"] = with_ctes("SELECT * FROM pxweb_rows", {"pxweb_rows": PXWEB_ROWS})
    q["load_table"] = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
                         FROM orders WHERE o_orderstatus = 'F'"""
    q["load_seed"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
    q["rename_columns"] = with_ctes("""
        SELECT unit_name, unit_type, region_code_raw, unit_code, gender_raw, indicator_code, indicator_name_raw,
               unit_raw, period_raw, value_raw, numerator_raw, denominator_raw FROM de_raw""")
    q["inline_table"] = """
        SELECT l.gender_label, count(*) AS n_orders
        FROM orders o LEFT JOIN (VALUES ('F', 'Kvinnor'), ('O', 'Män'), ('P', 'Totalt')) l(status, gender_label)
          ON o.o_orderstatus = l.status
        GROUP BY l.gender_label"""
    q["publish_view"] = f"""SELECT o_orderstatus, count(*) AS n_orders, {_dollar_sum('o_totalprice')} AS total_price
                            FROM orders GROUP BY o_orderstatus"""
    q["publish_table"] = f"""SELECT c_nationkey, count(*) AS n_customers, {_dollar_sum('c_acctbal')} AS acctbal_total
                             FROM customer GROUP BY c_nationkey"""
    q["csv_roundtrip"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem"
    q["export_region_geojson"] = model_sql("dim_region_geojson")
    q["load_audit"] = with_ctes("""
        SELECT count(*) AS row_count, count(DISTINCT source_indicator_code) AS series_count,
               count(DISTINCT region_name) AS region_count, max(year) AS loaded_at
        FROM stg_kolada""")
    # predicates
    q["tag_source"] = """SELECT o_orderkey, 'TPCH' AS source_system, 'orders' AS source_indicator_code,
                                'Orders' AS indicator_name, 'MONTH' AS period_granularity FROM orders"""
    q["drop_aggregate_rows"] = with_ctes("""
        SELECT year, area, value FROM mp_raw
        WHERE area IS NOT NULL AND area <> 'Riket' AND lower(area) NOT LIKE '%sjukvårdsregion%'
          AND NOT (area ILIKE 'alla regioner%')""")
    q["required_fields"] = """
        SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority,
                              CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price FROM orders) x
        WHERE priority IS NOT NULL AND price IS NOT NULL"""
    q["code_filter"] = """SELECT o_orderkey, o_orderpriority FROM orders
                          WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderpriority LIKE '_-LOW'"""
    q["full_match"] = """
        SELECT p_partkey, regexp_full_match(lower(p_type), '(medium|small)') AS is_full,
               regexp_matches(lower(p_type), '(medium|small)') AS is_substring,
               regexp_full_match(lower(p_brand), 'brand#[0-9]+') AS brand_full
        FROM part"""
    q["filter_topic"] = with_ctes("SELECT * FROM dim_indicator WHERE coalesce(topic, '') = 'WAITING_TIME'")
    q["classify_roles"] = with_ctes("SELECT indicator_key, role FROM dim_indicator LEFT JOIN indicator_role USING (indicator_key)")
    q["normalize_gender"] = with_ctes(f"""
        SELECT gender_raw, {GENDER_SHORT.format(c='gender_raw')} AS gender, count(*) AS n
        FROM kol_raw GROUP BY 1, 2""")
    # joins
    q["resolve_key_code"] = with_ctes("""
        SELECT o.o_orderkey, r.region_key, g.gender_key, a.age_key
        FROM (SELECT o_orderkey, c_nationkey,
                     CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M' ELSE 'ALL' END AS gender_code,
                     CASE o_custkey % 5 WHEN 0 THEN '0-17' WHEN 1 THEN '18-29' WHEN 2 THEN '30-64' WHEN 3 THEN '80+'
                          ELSE '65-79' END AS age_label
              FROM orders JOIN customer ON o_custkey = c_custkey) o
        LEFT JOIN dim_region r ON r.region_code_int = o.c_nationkey
        LEFT JOIN dim_gender g ON g.gender_code = o.gender_code
        LEFT JOIN dim_age_group a ON a.age_group_label = o.age_label""")
    q["resolve_key_name"] = with_ctes(f"""
        SELECT c.c_custkey, c.name, r1.region_key AS key_exact, r2.region_key AS key_upper, r3.region_key AS key_norm
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name WHEN c_custkey % 3 = 1 THEN lower(n_name)
                                     ELSE 'Region ' || n_name || ' län' END AS name
              FROM customer JOIN nation ON c_nationkey = n_nationkey) c
        LEFT JOIN dim_region r1 ON r1.region_name = c.name
        LEFT JOIN dim_region r2 ON upper(r2.region_name) = upper(c.name)
        LEFT JOIN dim_region r3 ON {NAME_NORM.format(c='r3.region_name')} = {NAME_NORM.format(c='c.name')}""")
    q["alias_map"] = with_ctes(f"""
        SELECT s.region_name, s.name_norm, coalesce(m.good, s.name_norm) AS region_name_norm
        FROM (SELECT region_name, {UPPER_NORM.format(c='region_name')} AS name_norm
              FROM (SELECT DISTINCT trim(region_name) AS region_name FROM stg_kolada) d) s
        LEFT JOIN (VALUES ('NATION_23', 'NATION_3'), ('NATION_2', 'NATION_20')) m(bad, good) ON m.bad = s.name_norm""")
    q["resolve_indicator"] = with_ctes("""
        SELECT f.region_code, f.unit_code, f.year, f.period_month, f.source_system, f.source_indicator_code,
               i1.indicator_key AS key_exact, i2.indicator_key AS key_normalized
        FROM (SELECT region_code, unit_code, year, period_month, source_system,
                     upper(source_indicator_code) AS source_indicator_code FROM stg_dataexport) f
        LEFT JOIN dim_indicator i1 ON i1.source_system = f.source_system
                                  AND i1.source_indicator_code = f.source_indicator_code
        LEFT JOIN dim_indicator i2 ON upper(trim(i2.source_system)) = upper(trim(f.source_system))
                                  AND upper(trim(i2.source_indicator_code)) = upper(trim(f.source_indicator_code))""")
    q["derive_dim"] = with_ctes("""
        SELECT s.diagnosgrupp, d.diagnosis_key, s.period_month, s.value
        FROM stg_tid_diagnos s LEFT JOIN dim_diag d ON d.diagnosgrupp = s.diagnosgrupp""")
    q["inner_indicator"] = with_ctes("""
        SELECT f.region_key, f.year, f.indicator_key, d.source_indicator_code, d.topic, f.value
        FROM fct_performance_yearly f JOIN dim_indicator d ON d.indicator_key = f.indicator_key""")
    q["dims_with_defaults"] = with_ctes("""
        SELECT s.region_name, s.year, s.value, coalesce(r.region_key, 'UNKNOWN') AS region_key,
               coalesce(r.region_code_2, '00') AS region_code_2
        FROM stg_physicians_per1000 s LEFT JOIN dim_region r ON r.region_name = s.region_name""")
    q["left_on_predicate"] = with_ctes("""
        SELECT f.region_key, f.date_key, f.indicator_key, coalesce(d.source_indicator_code, 'VISITS_TOTAL') AS metric_code,
               f.value
        FROM fct_visits_by_gender_age_m f LEFT JOIN dim_i d ON d.indicator_key = f.indicator_key AND d.topic = 'DEMAND'""")
    q["calendar_rollup"] = with_ctes("""
        SELECT m.region_key, d.year, CAST(sum(m.value) AS DOUBLE) AS value
        FROM fct_overcrowding_monthly m JOIN dim_date d ON d.date_key = m.date_key GROUP BY 1, 2""")
    # reshape
    q["unpivot_drop_nulls"] = with_ctes("""
        SELECT area AS "Område", gender_raw AS "Kön", code AS "NYCKELTALSID", yr AS year, v AS value
        FROM kol_raw WHERE v IS NOT NULL""")
    q["unpivot_keep_nulls"] = with_ctes(f"""
        SELECT {MONTHS}[m.mo] || ' ' || CAST(m.yr AS VARCHAR) AS "CATEGORY", m.region_col,
               CAST(r.cnt AS VARCHAR) AS value
        FROM (SELECT yr, mo, unnest((SELECT list(region_col) FROM oc_cols)) AS region_col
              FROM (SELECT DISTINCT yr, mo FROM onat) d) m
        LEFT JOIN oc_rows r ON r.yr = m.yr AND r.mo = m.mo AND r.region_col = m.region_col""",
                                        {"oc_cols": OC_COLS})
    q["melt_measures"] = with_ctes("""
        SELECT yr AS year, code AS source_indicator_code, name AS indicator_name, unit, value
        FROM (SELECT yr, 'health_exp_mnkr' AS code, 'Totala hälso- och sjukvårdsutgifter' AS name, 'mnkr' AS unit,
                     h AS value FROM exp_rows
              UNION ALL SELECT yr, 'gdp_mnkr', 'BNP till marknadspris', 'mnkr', g FROM exp_rows
              UNION ALL SELECT yr, 'health_exp_share_pct', 'Hälso-/sjukvård som andel av BNP', 'percent',
                               CASE WHEN yr % 2 = 1 THEN s END FROM exp_rows) u""")
    q["explode_features"] = q["read_large_documents"] = """
        SELECT CAST(n_nationkey AS VARCHAR) AS code,
               CASE WHEN n_nationkey % 2 = 0 THEN n_name || 's' ELSE n_name END AS name,
               CASE n_nationkey % 3 WHEN 0 THEN format('{{"type":"Point","coordinates":[{}.5,{}]}}', n_nationkey, n_regionkey)
       WHEN 1 THEN format('{{"type":"Polygon","coordinates":[[[{0},{1}],[{0}.25,{1}],[{0},{1}.25],[{0},{1}]]]}}', n_nationkey, n_regionkey)
       ELSE format('{{"type":"MultiPolygon","coordinates":[[[[{0},{1}],[{0}.5,{1}],[{0},{1}.5],[{0},{1}]]]]}}', n_nationkey, n_regionkey) END AS geom
        FROM nation"""
    q["flatten_pxweb"] = q["read_whole_documents"] = q["read_variant_documents"] = q["read_documents"]
    q["explorer_strict"] = with_ctes("""
        SELECT * FROM mart_regional_explorer_monthly_long
        WHERE NOT (theme = 'DEMAND' AND time_grain = 'MONTH' AND metric_code = 'VISITS_TOTAL')""")
    q["pressure_strict"] = with_ctes("""
        SELECT region_key, date_key, source_system, source_indicator_code, indicator_name,
               coalesce(unit, default_unit) AS unit, metric_kind, 'MONTHLY' AS grain, gender_key, age_key,
               diagnosis_group, value
        FROM pressure_feed JOIN pressure_rule USING (feed) JOIN pressure_marks USING (indicator_key)
        WHERE list_contains(marks, mark) AND NOT (feed = 'diagnosis' AND list_contains(marks, 'visits'))""")
    q["stack_headers"] = with_ctes(f"""
        SELECT nm AS "Region", c_mktsegment AS "Segment", CAST(yr AS VARCHAR) AS "Year",
               substr({MONTHS}[mo], 1, 3) || '.' AS "Month", metric AS "Metric", value AS "Value",
               make_date(yr, mo, 1) AS "Period"
        FROM (SELECT nm, c_mktsegment, yr, mo, 'Antal' AS metric, {_dollar_sum('1.0')} AS value
              FROM onat GROUP BY nm, c_mktsegment, yr, mo
              UNION ALL
              SELECT nm, c_mktsegment, yr, mo, 'Summa', {_dollar_sum('o_totalprice')}
              FROM onat GROUP BY nm, c_mktsegment, yr, mo) x""")
    q["tidy_sheet"] = with_ctes(f"""
        SELECT nm AS "Region", c_mktsegment AS "Diagnosgrupp", make_date(yr, mo, 1) AS "Period",
               {_dollar_sum('1.0')} AS "Antal", {_dollar_sum('o_totalprice')} AS "Summa"
        FROM onat GROUP BY nm, c_mktsegment, yr, mo""")
    q["pivot_metrics"] = with_ctes("""
        SELECT region_name, gender, age_group, period_date,
               min(CASE WHEN indicator_name = 'Antal besök' THEN value END) AS "Antal besök",
               min(CASE WHEN indicator_name = 'Median tid till läkare i minuter' THEN value END)
                 AS "Median tid till läkare i minuter"
        FROM stg_tid_konalder GROUP BY 1, 2, 3, 4""")
    q["pivot_roles"] = with_ctes("""
        SELECT k, yr, max(CASE WHEN l_returnflag IN ('A') THEN l_quantity END) AS max_a,
               sum(CASE WHEN l_returnflag IN ('N') THEN l_quantity END) AS sum_n,
               sum(CASE WHEN l_returnflag IN ('A', 'N') THEN l_quantity END) AS sum_a_n,
               max(CASE WHEN l_returnflag IN ('R') THEN l_quantity END) AS max_r
        FROM lnat GROUP BY k, yr""")
    q["json_path"] = """
        SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_json,
               TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_variant
        FROM events"""
    q["canonicalize_columns"] = "SELECT o_orderkey AS order_id, o_custkey AS customer, o_orderpriority AS priority FROM orders"
    regions = ", ".join(f"'{r}'" for r in ("01", "03", "04", "05", "06", "07", "08", "09", "10", "12", "13", "14",
                                           "17", "18", "19", "20", "21", "22", "23", "24", "25"))
    years = ", ".join(f"'{y}'" for y in ("2020", "2021", "2022", "2023", "2024", "2025"))
    q["select_codes"] = with_ctes(f"""
        SELECT code, year, obs FROM p1 WHERE year IN (SELECT year FROM chosen)""", {
        "pxweb_rows": PXWEB_ROWS,
        "p0": "SELECT region_code_raw AS code, year_raw AS year, obs_raw AS obs FROM pxweb_rows",
        "p1": f"""SELECT * FROM p0 WHERE code IN ({regions})
                   OR NOT EXISTS (SELECT 1 FROM p0 WHERE code IN ({regions}))""",
        "yrs": "SELECT DISTINCT year FROM p1",
        "chosen": f"""SELECT year FROM yrs WHERE year IN ({years})
                      UNION ALL
                      SELECT year FROM (SELECT year FROM yrs ORDER BY year DESC LIMIT 6) t
                      WHERE NOT EXISTS (SELECT 1 FROM yrs WHERE year IN ({years}))"""})
    q["explode_series"] = with_ctes("""
        SELECT source_indicator_code AS kpi_id, region_name AS region_id, year AS period, gender, max(value) AS value
        FROM stg_kolada GROUP BY 1, 2, 3, 4""")
    # aggregates
    q["sum_by_grain"] = with_ctes("""
        SELECT region_name, year, source_system, source_indicator_code, CAST(sum(value) AS DOUBLE) AS value
        FROM stg_medical_personnel GROUP BY 1, 2, 3, 4""")
    q["demand_totals"] = with_ctes("""
        SELECT f.region_key, f.date_key, coalesce(d.source_indicator_code, 'VISITS_TOTAL') AS metric_code,
               coalesce(d.indicator_name, 'ED visits (total)') AS indicator_name, sum(f.value) AS value
        FROM fct_visits_by_gender_age_m f LEFT JOIN dim_i d ON d.indicator_key = f.indicator_key AND d.topic = 'DEMAND'
        GROUP BY 1, 2, 3, 4""")
    q["avg_of_medians"] = with_ctes("""
        SELECT f.region_key, f.date_key, d.source_indicator_code AS metric_code, d.indicator_name, avg(f.value) AS value
        FROM fct_visits_by_gender_age_m f JOIN dim_i d ON d.indicator_key = f.indicator_key
        WHERE d.topic = 'PRESSURE' GROUP BY 1, 2, 3, 4""")
    bounds = {f"b{i}": f"""SELECT CAST(min(date_trunc('month', {c})) AS DATE) AS lo,
                                  CAST(max(date_trunc('month', {c})) AS DATE) AS hi FROM {t}"""
              for i, (t, c) in enumerate([("stg_dataexport", "period_month"), ("stg_overcrowding", "period_month"),
                                          ("stg_tid_konalder", "period_date"), ("stg_tid_diagnos", "period_month")])}
    los = ", ".join(f"(SELECT lo FROM b{i})" for i in range(4))
    his = ", ".join(f"(SELECT hi FROM b{i})" for i in range(4))
    lo_null = " OR ".join(f"(SELECT lo FROM b{i}) IS NULL" for i in range(4))
    hi_null = " OR ".join(f"(SELECT hi FROM b{i}) IS NULL" for i in range(4))
    q["min_max_dates"] = with_ctes(f"""
        SELECT least({los}) AS start_month, greatest({his}) AS end_month,
               CASE WHEN {lo_null} THEN NULL ELSE least({los}) END AS start_month_strict,
               CASE WHEN {hi_null} THEN NULL ELSE greatest({his}) END AS end_month_strict""", bounds)
    q["check_min_distinct"] = with_ctes(
        _check("dim_region", "min_distinct_21", "region_code_2",
               "SELECT CASE WHEN count(DISTINCT region_code_2) < 21 THEN 1 ELSE 0 END AS n FROM dim_region", "warn")
        + "\nUNION ALL\n" +
        _check("stg_population", "min_distinct_30", "region_code_str",
               "SELECT CASE WHEN count(DISTINCT region_code_str) < 30 THEN 1 ELSE 0 END AS n FROM stg_population",
               "warn"))
    q["per_1000_ratio"] = with_ctes("""
        SELECT s.region_name, s.year, s.staff, p.population,
               CASE WHEN p.population > 0 THEN s.staff / p.population * 1000 END AS staff_per_1000
        FROM (SELECT region_name, year, CAST(sum(value) AS DOUBLE) AS staff FROM stg_medical_personnel GROUP BY 1, 2) s
        LEFT JOIN (SELECT 'NATION_' || CAST(region_code AS VARCHAR) AS region_name, year, population
                   FROM stg_population) p ON p.region_name = s.region_name AND p.year = s.year""")
    # windows / order
    q["prefer_finer_grain"] = with_ctes("""
        SELECT region_code_raw, unit_code, indicator_code, gender_raw, period_raw, period_granularity, year, value
        FROM de_aug WHERE NOT (period_granularity = 'YEAR' AND has_monthly = 1)""")
    q["dedupe_registry"] = with_ctes("SELECT * FROM ind_dedup")
    q["dedupe_grain"] = """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                    ORDER BY l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST, l_quantity DESC NULLS LAST,
                             l_extendedprice ASC NULLS LAST, l_discount ASC NULLS LAST, l_tax ASC NULLS LAST,
                             l_returnflag ASC NULLS LAST, l_linestatus ASC NULLS LAST, l_shipdate ASC NULLS LAST) AS rn
          FROM lineitem) x
        WHERE rn = 1"""
    q["month_spine"] = with_ctes("""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS month_date, CAST(year(d) AS INTEGER) AS year,
               CAST(month(d) AS INTEGER) AS month_no, strftime(d, '%Y-%m') AS year_month_label
        FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS d
              FROM spine_bounds) s""", {"spine_bounds": """
        SELECT min(m) AS lo, max(m) AS hi FROM (
          SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders
          UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem) u"""})
    q["ordered_output"] = with_ctes("SELECT * FROM stg_beds_intl ORDER BY country_name, year")
    q["best_match"] = _best_match_sql()
    q["best_match_percent"] = _best_match_sql("contains(coalesce(text, ''), '%') OR contains(lower(coalesce(text, '')), 'andel')")
    q["label_sort_key"] = """
        SELECT c_custkey, label, coalesce(TRY_CAST(NULLIF(regexp_extract(label, '^[0-9]+'), '') AS INTEGER), 999) AS sort_key
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'Totalt' WHEN c_custkey % 4 = 1 THEN '80+'
                                     ELSE CAST(c_custkey % 90 AS VARCHAR) || '-' || CAST(c_custkey % 90 + 9 AS VARCHAR)
                                END AS label FROM customer) c"""
    # set operations
    q["indicator_registry"] = model_sql("dim_indicator")
    q["union_facts"] = with_ctes("""
        SELECT source_system, source_indicator_code, year, value FROM stg_net_cost
        UNION ALL SELECT source_system, source_indicator_code, year, value FROM stg_kolada
        UNION ALL SELECT source_system, source_indicator_code, year, value FROM stg_beds_intl
        UNION ALL SELECT source_system, source_indicator_code, year, value FROM stg_expenditure_gdp""")
    # scalar functions
    q["text_basics"] = with_ctes("""
        SELECT trim(unit_type) AS unit_type, lower(trim(region_name_raw)) AS name_lower, upper(trim(titel)) AS title_upper,
               upper(substr(trim(age_raw), 1, 1)) || lower(substr(trim(age_raw), 2)) AS age_initcap,
               NULLIF(trim(age_raw), '') AS age_group,
               coalesce(NULLIF(trim(titel), ''), trim(rubrik)) AS indicator_name,
               region_name_raw || '-' || CAST(yr AS VARCHAR) AS label,
               region_name_raw || '-' || NULLIF(trim(age_raw), '') AS label_null
        FROM nc_raw""")
    q["slug_codes"] = with_ctes(r"""
        SELECT name, lower(regexp_replace(name, '[^A-Za-z0-9]+', '_', 'g')) AS slug,
               lower(regexp_replace(name, '\s+', '_', 'g')) AS snake, lower(regexp_replace(name, 's+', '_', 'g')) AS s_runs
        FROM (SELECT metric AS name FROM di_raw
              UNION SELECT coalesce(NULLIF(trim(titel), ''), trim(rubrik)) FROM nc_raw
              UNION SELECT grp FROM mp_raw) n""")
    q["entity_name_clean"] = with_ctes(r"""
        SELECT name,
               regexp_replace(regexp_replace(trim(name), '^region(en)?\s+', '', 'i'), 's$', '') AS kpi_name,
               trim(regexp_replace(regexp_replace(name, '\s+län\s*$', '', 'i'), 's$', '', 'i')) AS area_name,
               CASE WHEN name = 'NATION_9regionen' THEN 'NATION_9'
                    ELSE regexp_replace(regexp_replace(name, '^Region\s+', ''), '\s+län$', '') END AS column_name,
               """ + NAME_NORM.format(c="name") + r""" AS norm_name,
               regexp_replace(upper(trim(name)), '\s+', ' ', 'g') AS collapsed
        FROM (SELECT area AS name FROM kol_raw UNION SELECT area FROM mp_raw UNION SELECT region_raw FROM ka_raw
              UNION SELECT region_col FROM oc_cols) n""", {"oc_cols": OC_COLS})
    q["parse_decimal"] = with_ctes("""
        SELECT unit_code, value_raw, numerator_raw,
               TRY_CAST(replace(regexp_replace(value_raw, '[^0-9.,-]', '', 'g'), ',', '.') AS DOUBLE) AS value,
               TRY_CAST(regexp_replace(numerator_raw, '[^0-9.-]', '', 'g') AS DOUBLE) AS numerator,
               CAST(CAST(TRY_CAST(replace(numerator_raw, ',', '.') AS DECIMAL(10,2)) AS VARCHAR) AS DOUBLE) AS numerator_2dp
        FROM de_raw""")
    q["parse_int_round"] = with_ctes("""
        SELECT obs AS "OBS_VALUE", tp AS "TIME_PERIOD",
               CAST(TRY_CAST(replace(obs, ',', '.') AS DECIMAL(38,0)) AS INTEGER) AS obs_int,
               CAST(TRY_CAST(tp AS DECIMAL(38,0)) AS INTEGER) AS year
        FROM hi_raw""")
    q["parse_period"] = with_ctes("""
        SELECT unit_code, period_raw, period_granularity, year, period_month,
               CASE WHEN period_granularity = 'MONTH' THEN period_month ELSE make_date(year, 1, 1) END AS period_filter_date,
               CASE WHEN period_granularity = 'MONTH' THEN strftime(period_month, '%Y-%m')
                    ELSE CAST(year AS VARCHAR) END AS period_filter_label
        FROM (SELECT unit_code, period_raw,
                     CASE WHEN regexp_full_match(trim(period_raw), '[0-9]{4}-[0-9]{2}') THEN 'MONTH'
                          WHEN regexp_full_match(trim(period_raw), '[0-9]{4}') THEN 'YEAR' ELSE 'UNKNOWN' END
                       AS period_granularity,
                     TRY_CAST(NULLIF(regexp_extract(trim(period_raw), '^[0-9]{4}'), '') AS INTEGER) AS year,
                     CASE WHEN regexp_full_match(trim(period_raw), '[0-9]{4}-[0-9]{2}')
                          THEN CAST(try_strptime(trim(period_raw), '%Y-%m') AS DATE) END AS period_month
              FROM de_raw) p""")
    q["parse_named_month"] = with_ctes(f"""
        SELECT {MONTHS}[mo] || ' ' || CAST(yr AS VARCHAR) AS category, mo AS month_no, yr AS year,
               make_date(yr, mo, 1) AS period_month, mo AS short_month_no
        FROM (SELECT DISTINCT yr, mo FROM onat) d""")
    q["date_parts"] = """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(month(o_orderdate) AS INTEGER) AS month_no,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(year(o_orderdate) AS INTEGER) AS year,
               strftime(o_orderdate, '%Y-%m') AS year_month_label,
               make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS year_start
        FROM orders"""
    q["period_keys"] = """
        SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') || '01' AS INTEGER) AS date_key,
               CAST(year(o_orderdate) * 10000 + 101 AS INTEGER) AS year_key
        FROM orders"""
    q["surrogate_key"] = f"""
        SELECT c_custkey, md5(coalesce(CAST(c_custkey AS VARCHAR), {SENT})) AS key_one,
               md5(coalesce(CAST(c_nationkey AS VARCHAR), {SENT}) || '-' ||
                   coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END, {SENT})) AS key_two
        FROM customer"""
    # quality
    nn_cols = [("region_key", "error"), ("year", "error"), ("metric_type", "error"), ("indicator_key", "error"),
               ("value", "warn")]
    q["check_not_null"] = with_ctes("\nUNION ALL\n".join(
        _check("fct_capacity_yearly", "not_null", c,
               f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS n FROM fct_capacity_yearly", sev)
        for c, sev in nn_cols))
    q["check_unique"] = with_ctes(
        _check("dim_region", "unique", "region_key",
               "SELECT count(*) AS n FROM (SELECT region_key FROM dim_region WHERE region_key IS NOT NULL "
               "GROUP BY region_key HAVING count(*) > 1) d", "error")
        + "\nUNION ALL\n" +
        _check("stg_dataexport", "unique", "unit_code",
               "SELECT count(*) AS n FROM (SELECT unit_code FROM stg_dataexport WHERE unit_code IS NOT NULL "
               "GROUP BY unit_code HAVING count(*) > 1) d", "error"))
    q["check_accepted"] = with_ctes(
        _check("stg_dataexport", "accepted_values", "gender",
               "SELECT count(DISTINCT gender) AS n FROM stg_dataexport WHERE gender NOT IN ('F', 'M', 'ALL')", "error")
        + "\nUNION ALL\n" +
        _check("stg_dataexport", "accepted_values", "period_granularity",
               "SELECT count(DISTINCT period_granularity) AS n FROM stg_dataexport "
               "WHERE period_granularity NOT IN ('MONTH', 'YEAR')", "warn"))
    q["check_relationship"] = with_ctes(
        _check("fct_capacity_yearly", "relationships", "region_key",
               "SELECT count(*) AS n FROM fct_capacity_yearly c WHERE c.region_key IS NOT NULL AND NOT EXISTS "
               "(SELECT 1 FROM dim_region r WHERE r.region_key = c.region_key)", "error")
        + "\nUNION ALL\n" +
        _check("orders", "relationships", "o_custkey",
               "SELECT count(*) AS n FROM orders o WHERE o.o_custkey IS NOT NULL AND NOT EXISTS "
               "(SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)", "error"))
    q["check_unique_combination"] = with_ctes(
        _check("fct_kolada_y", "unique_combination_of_columns", "region_key,year,gender_key,indicator_key",
               "SELECT count(*) AS n FROM (SELECT 1 FROM fct_kolada_y GROUP BY region_key, year, gender_key, "
               "indicator_key HAVING count(*) > 1) d", "error")
        + "\nUNION ALL\n" +
        _check("fct_performance_monthly", "unique_combination_of_columns",
               "region_key,date_key,gender_key,indicator_key",
               "SELECT count(*) AS n FROM (SELECT 1 FROM fct_performance_monthly GROUP BY region_key, date_key, "
               "gender_key, indicator_key HAVING count(*) > 1) d", "error"))
    return q


def _declared_sql(tests: dict) -> str:
    parts = []
    for model, spec in tests.items():
        for c in spec.get("not_null", ()):
            parts.append(_check(model, "not_null", c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS n FROM {model}",
                                "error"))
        for c in spec.get("warn", ()):
            parts.append(_check(model, "not_null", c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS n FROM {model}",
                                "warn"))
        for c, values in (spec.get("accepted") or {}).items():
            vals = ", ".join(f"'{v}'" for v in values)
            parts.append(_check(model, "accepted_values", c,
                                f"SELECT count(DISTINCT {c}) AS n FROM {model} WHERE {c} NOT IN ({vals})", "error"))
        for c, (parent, pcol) in (spec.get("relationships") or {}).items():
            parts.append(_check(model, "relationships", c,
                                f"SELECT count(*) AS n FROM {model} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                                f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = ch.{c})", "error"))
        for c in spec.get("unique", ()):
            parts.append(_check(model, "unique", c,
                                f"SELECT count(*) AS n FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL "
                                f"GROUP BY {c} HAVING count(*) > 1) d", "error"))
        for cols in spec.get("combinations", ()):
            cl = ", ".join(cols)
            parts.append(_check(model, "unique_combination_of_columns", ",".join(cols),
                                f"SELECT count(*) AS n FROM (SELECT 1 FROM {model} GROUP BY {cl} "
                                f"HAVING count(*) > 1) d", "error"))
    return with_ctes("\nUNION ALL\n".join(parts))


def oracle_queries() -> dict[str, str]:
    from indicatormart.plans.checks import REFERENCE_TESTS, STAGING_TESTS
    from indicatormart.plans.entries import SHAPE_ALIASES
    out = {name: model_sql(name) for name in MODEL_NAMES}
    out.update(operator_queries())
    out["declared_checks_staging"] = _declared_sql(STAGING_TESTS)
    out["declared_checks_reference"] = _declared_sql(REFERENCE_TESTS)
    out["fct_intl_y"] = with_ctes("""
        SELECT country_name, CAST(year * 10000 + 101 AS INTEGER) AS date_key, indicator_key, value FROM fct_beds_intl_y
        UNION ALL SELECT country_name, date_key, indicator_key, value FROM fct_health_exp_gdp_intl_y""")
    out["mart_intl_y"] = with_ctes("SELECT * FROM mart_beds_intl_y UNION ALL SELECT * FROM mart_health_exp_gdp_intl_y")
    for alias, model in SHAPE_ALIASES.items():
        out[alias] = out[model]
    out.pop("dim_gender")
    return out

"""Named queries over the test tables: every model of the graph plus one
query per operator family (keys follow SURVEY §7.3).  Each takes
``(spark, sf_dir)`` and returns a DataFrame over the whole input tables;
nothing is collected except bounded metadata (column lists).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatormart.functions import keys as K
from indicatormart.functions import numbers as N
from indicatormart.functions import periods as P
from indicatormart.functions import text as T
from indicatormart.operators import documents as D
from indicatormart.operators import grain as G
from indicatormart.operators import joins as J
from indicatormart.operators import predicates as PR
from indicatormart.operators import quality as Q
from indicatormart.operators import reshape as R
from indicatormart.operators import selection as SEL
from indicatormart.operators.aggregates import sum_by
from indicatormart.operators.setops import union_all
from indicatormart.functions.periods import SWEDISH_MONTHS
from indicatormart.plans import marts as M
from indicatormart.plans import reference as REF
from indicatormart.plans.checks import reference_checks, staging_checks
from indicatormart.plans.staging import EXPENDITURE_MEASURES
from indicatormart.plans.warehouse import MODELS
from indicatormart.sources import readers as RD
from indicatormart.sources.elements import read_elements
from indicatormart.sources import schemas as S
from indicatormart.sources import sinks as SK
from indicatormart.sources.standins import StandIns, landed_sources, landed_standins, month_name, standin_warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A landed raw extract (written once per session)."""
    return landed_sources(spark, sf_dir)[name]


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return standin_warehouse(spark, sf_dir).model(name)
    run.__name__ = name
    return run


def model_queries() -> dict[str, Query]:
    return {name: _model(name) for name in MODELS}


# ---------------------------------------------------------------- sources / sinks

@query
def read_documents(spark, sf_dir):
    """PXWeb documents written as JSON Lines next to decoy files, read back
    through a name pattern with a typed schema, then flattened."""
    docs = _raw(spark, sf_dir, "SCB_POPULATION_RAW")
    path = SK.scratch_path(spark, "pxweb")
    docs.select(F.col("payload.*")).write.mode("overwrite").json(path)
    docs.select(F.to_json("payload").alias("value")).write.mode("append").text(path)  # *.txt decoys
    back = RD.read_documents(spark, path, schema=S.PXWEB_SCHEMA, glob="*.json", multi_line=False)
    return D.flatten_pxweb(back, {"region_code_raw": "Region", "year_raw": "Tid"})


def _one_document_per_file(docs: DataFrame, path: str) -> None:
    docs.select(F.to_json("payload").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


@query
def read_whole_documents(spark, sf_dir):
    """One document per file, read whole with a typed schema."""
    path = SK.scratch_path(spark, "pxweb_files")
    _one_document_per_file(_raw(spark, sf_dir, "SCB_POPULATION_RAW"), path)
    back = RD.read_documents(spark, path, schema=S.PXWEB_SCHEMA)
    return D.flatten_pxweb(back, {"region_code_raw": "Region", "year_raw": "Tid"})


@query
def read_variant_documents(spark, sf_dir):
    """One document per file, read whole without a schema (VARIANT)."""
    path = SK.scratch_path(spark, "pxweb_variant")
    _one_document_per_file(_raw(spark, sf_dir, "SCB_POPULATION_RAW"), path)
    return D.flatten_pxweb(RD.read_documents(spark, path), {"region_code_raw": "Region", "year_raw": "Tid"})


@query
def load_table(spark, sf_dir):
    """S3 + P6: a named raw table scan with an equality filter pushed to the scan."""
    o = RD.load_table(spark, f"{sf_dir}/orders.parquet")
    return o.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))


@query
def load_seed(spark, sf_dir):
    """A CSV seed with a header and an explicit schema."""
    path = SK.scratch_path(spark, "seed")
    SK.write_csv(_t(spark, sf_dir, "nation"), path)
    return RD.load_seed(spark, path, "n_nationkey int, n_name string, n_regionkey int")


DATAEXPORT_RENAMES = {
    "ENHETSNAMN": "unit_name", "ENHETSTYP": "unit_type", "REGIONSKOD": "region_code_raw", "ENHETSKOD": "unit_code",
    "Kön/Totalt": "gender_raw", "Indikator-Id": "indicator_code", "TITEL": "indicator_name_raw",
    "Måttenhet": "unit_raw", "Mätperiod": "period_raw", "Värde": "value_raw", "Täljare": "numerator_raw",
    "Nämnare/antal fall": "denominator_raw",
}


@query
def rename_columns(spark, sf_dir):
    """S5 + P1: awkward raw column names (slashes, non-ASCII) to canonical names."""
    return RD.rename_columns(_raw(spark, sf_dir, "DATAEXPORT_RAW"), DATAEXPORT_RENAMES)


@query
def inline_table(spark, sf_dir):
    """A literal relation joined to the orders."""
    labels = RD.inline_table(spark, [("F", "Kvinnor"), ("O", "Män"), ("P", "Totalt")],
                             "status string, gender_label string")
    o = _t(spark, sf_dir, "orders")
    j = o.join(F.broadcast(labels), o.o_orderstatus == labels.status, "left")  # 3-row literal
    return j.groupBy("gender_label").agg(F.count(F.lit(1)).alias("n_orders"))


@query
def publish_view(spark, sf_dir):
    """A model published as a temp view and queried by name."""
    o = _t(spark, sf_dir, "orders")
    SK.publish(o, "im_orders", kind="view")
    return spark.sql("""SELECT o_orderstatus, count(*) AS n_orders,
                               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
                        FROM im_orders GROUP BY o_orderstatus""")


@query
def publish_table(spark, sf_dir):
    """S9 + S10: a table written to a shared path and registered in its own database."""
    c = _t(spark, sf_dir, "customer")
    per_nation = c.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("acctbal_total"))
    return SK.publish(per_nation, "customers_by_nation", kind="table", database="indicatormart_ref",
                      path=SK.scratch_path(spark, "customers_by_nation"))


@query
def csv_roundtrip(spark, sf_dir):
    """S12 + F21: CSV sink and all-string read back with strict casts."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                               "l_returnflag")
    path = SK.scratch_path(spark, "lineitem_csv")
    SK.write_csv(li, path)
    raw = spark.read.schema(S.string_schema(li.columns)).option("header", True).csv(path)
    return raw.select(N.strict_int("l_orderkey", "bigint").alias("l_orderkey"),
                      N.strict_int("l_linenumber").alias("l_linenumber"),
                      N.strict_double("l_quantity").alias("l_quantity"),
                      N.strict_double("l_extendedprice").alias("l_extendedprice"), "l_returnflag")


@query
def export_region_geojson(spark, sf_dir):
    """S11 + F37 + F5: region shapes as GeoJSON text with two-digit codes."""
    return standin_warehouse(spark, sf_dir).dim_region_geojson


@query
def load_audit(spark, sf_dir):
    """A one-row load record (rows, series, regions, as-of stamp)."""
    stg = standin_warehouse(spark, sf_dir).stg_kolada
    return RD.load_audit(stg, ["source_indicator_code"], "region_name", as_of=F.max("year"))


@query
def read_large_documents(spark, sf_dir):
    """S1 + C4: the features of each document as elements that many tasks read, each file in byte ranges."""
    path = SK.scratch_path(spark, "geojson_large")
    _one_document_per_file(_raw(spark, sf_dir, "GEO_LAN_REGIONS_RAW"), path)
    feature = S.GEOJSON_SCHEMA["features"].dataType.elementType
    feats = D.feature_rows(read_elements(spark, path, "features", feature))
    return feats.select(F.col("props.scb_lan_code_2").alias("code"),
                        F.col("props.region_name_official").alias("name"), "geom")


# ---------------------------------------------------------------- predicates

@query
def tag_source(spark, sf_dir):
    """Constant lineage columns."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    return PR.tag_source(o, system="TPCH", code="orders", name="Orders", grain="MONTH")


@query
def drop_aggregate_rows(spark, sf_dir):
    """P7 + P12: national and health-care-region rows dropped (exact, contains, ILIKE)."""
    raw = _raw(spark, sf_dir, "MEDICAL_PERSONNEL_RAW").select(
        F.col("År").alias("year"), F.col("Område").alias("area"), F.col(f"`{S.PERSONNEL_VALUE_COL}`").alias("value"))
    return PR.drop_aggregate_rows(raw, "area", names=["Riket"], contains_lower=["sjukvårdsregion"],
                                  ilike_prefixes=["alla regioner"], keep_nulls=False)


@query
def required_fields(spark, sf_dir):
    """Required-field filter (NULL-only, NaN kept)."""
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("price"))
    return PR.require(o, "priority", "price")


@query
def code_filter(spark, sf_dir):
    """P9 + P11: IN list and LIKE with a live '_' wildcard."""
    o = _t(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") | PR.like_any("o_orderpriority", ["_-LOW"])) \
            .select("o_orderkey", "o_orderpriority")


@query
def full_match(spark, sf_dir):
    """Whole-string regex match next to Spark's substring rlike."""
    p = _t(spark, sf_dir, "part")
    low = F.lower("p_type")
    return p.select("p_partkey", P.full_match(low, "(medium|small)").alias("is_full"),
                    low.rlike("(medium|small)").alias("is_substring"),
                    P.full_match(F.lower("p_brand"), "brand#[0-9]+").alias("brand_full"))


@query
def filter_topic(spark, sf_dir):
    """Topic filter with a NULL guard."""
    return PR.filter_topic(standin_warehouse(spark, sf_dir).dim_indicator, ["WAITING_TIME"])


@query
def classify_roles(spark, sf_dir):
    """P15 + F35: first-match CASE classification of indicators into resource roles."""
    return M.resource_roles(standin_warehouse(spark, sf_dir).dim_indicator)


@query
def normalize_gender(spark, sf_dir):
    """Gender spellings to F / M / ALL."""
    raw = _raw(spark, sf_dir, "KOLADA_RAW")
    return raw.groupBy(F.col("Kön").alias("gender_raw"), T.normalize_gender("Kön").alias("gender")) \
              .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- joins

@query
def resolve_key_code(spark, sf_dir):
    """J1 + J8 + J9: facts to region, gender and age keys by code or label (broadcast lookups)."""
    wh = standin_warehouse(spark, sf_dir)
    o = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select("o_orderkey", "c_nationkey",
                 F.when(F.col("o_orderstatus") == "F", "F").when(F.col("o_orderstatus") == "O", "M")
                  .otherwise("ALL").alias("gender_code"),
                 F.when(F.col("o_custkey") % 5 == 0, "0-17").when(F.col("o_custkey") % 5 == 1, "18-29")
                  .when(F.col("o_custkey") % 5 == 2, "30-64").when(F.col("o_custkey") % 5 == 3, "80+")
                  .otherwise("65-79").alias("age_label"))
    f = J.resolve_key(o, wh.dim_region, "c_nationkey", "region_code_int", "region_key")
    f = J.resolve_key(f, wh.dim_gender, "gender_code", "gender_code", "gender_key")
    f = J.resolve_key(f, wh.dim_age_group, "age_label", "age_group_label", "age_key")
    return f.select("o_orderkey", "region_key", "gender_key", "age_key")


@query
def resolve_key_name(spark, sf_dir):
    """J2 + J3 + J4 + F14: region keys by exact, upper-cased and normalized names, each spelling cleaned once."""
    wh = standin_warehouse(spark, sf_dir)
    c = _t(spark, sf_dir, "customer").join(J.checked_broadcast(_t(spark, sf_dir, "nation")),
                                           F.col("c_nationkey") == F.col("n_nationkey"))
    spelled = (F.when(F.col("c_custkey") % 3 == 0, F.col("n_name"))
                .when(F.col("c_custkey") % 3 == 1, F.lower("n_name"))
                .otherwise(F.concat(F.lit("Region "), "n_name", F.lit(" län"))))
    f = c.select("c_custkey", spelled.alias("name"))
    f = J.resolve_key(f, wh.dim_region, "name", "region_name", "region_key", out="key_exact")
    f = J.resolve_key(f, wh.dim_region, "name", "region_name", "region_key", normalize=F.upper, out="key_upper",
                      spellings_once=True)
    f = J.resolve_key(f, wh.dim_region, "name", "region_name", "region_key", normalize=T.region_name_norm,
                      out="key_norm", spellings_once=True)
    return f.select("c_custkey", "name", "key_exact", "key_upper", "key_norm")


@query
def alias_map(spark, sf_dir):
    """J5 + F15: upper-case-pattern normalizer and a literal alias map (no join)."""
    stg = standin_warehouse(spark, sf_dir).stg_kolada
    names = stg.select(F.trim("region_name").alias("region_name")).distinct()
    norm = names.withColumn("name_norm", T.upper_pattern_norm("region_name"))
    return J.apply_alias(norm, "name_norm", [("NATION_23", "NATION_3"), ("NATION_2", "NATION_20")],
                         out="region_name_norm")


@query
def resolve_indicator(spark, sf_dir):
    """J6 + J7: indicator keys by exact and by upper(trim()) matching."""
    wh = standin_warehouse(spark, sf_dir)
    f = wh.stg_dataexport.select("region_code", "unit_code", "year", "period_month", "source_system",
                                 F.upper("source_indicator_code").alias("source_indicator_code"))
    f = J.resolve_indicator(f, wh.dim_indicator, out="key_exact")
    f = J.resolve_indicator(f, wh.dim_indicator, normalize=True, out="key_normalized")
    return f


@query
def derive_dim(spark, sf_dir):
    """J10 + A8: a dimension derived with DISTINCT and a surrogate key, then looked up."""
    stg = standin_warehouse(spark, sf_dir).stg_tid_diagnos
    dim = J.derive_dim(stg, ["diagnosgrupp"], "diagnosis_key")
    f = J.lookup(stg, dim, [F.col("diagnosgrupp")], [F.col("diagnosgrupp")], ["diagnosis_key"])
    return f.select("diagnosgrupp", "diagnosis_key", "period_month", "value")


@query
def inner_indicator(spark, sf_dir):
    """Inner fact-indicator join (NULL keys dropped)."""
    wh = standin_warehouse(spark, sf_dir)
    f = J.lookup(wh.fct_performance_yearly, wh.dim_indicator, [F.col("indicator_key")], [F.col("indicator_key")],
                 ["source_indicator_code", "topic"], how="inner")
    return f.select("region_key", "year", "indicator_key", "source_indicator_code", "topic", "value")


@query
def dims_with_defaults(spark, sf_dir):
    """J12 + F36: left lookups with coalesce defaults."""
    wh = standin_warehouse(spark, sf_dir)
    f = J.lookup(wh.stg_physicians_per1000, wh.dim_region, [F.col("region_name")], [F.col("region_name")],
                 {"region_key": "region_key", "region_code_2": "region_code_2"})
    return J.with_defaults(f.select("region_name", "year", "value", "region_key", "region_code_2"),
                           {"region_key": "UNKNOWN", "region_code_2": "00"})


@query
def left_on_predicate(spark, sf_dir):
    """A topic predicate inside a LEFT join's ON clause."""
    wh = standin_warehouse(spark, sf_dir)
    di = M.explorer_indicators(wh.dim_indicator)
    f = J.lookup(wh.fct_visits_by_gender_age_m, di, [F.col("indicator_key")], [F.col("indicator_key")],
                 {"source_indicator_code": "d_code"}, how="left", extra_condition=F.col("topic") == "DEMAND")
    return f.select("region_key", "date_key", "indicator_key",
                    F.coalesce("d_code", F.lit("VISITS_TOTAL")).alias("metric_code"), "value")


@query
def calendar_rollup(spark, sf_dir):
    """J14 + A4: monthly facts rolled up to years through the calendar."""
    wh = standin_warehouse(spark, sf_dir)
    f = J.lookup(wh.fct_overcrowding_monthly, wh.dim_date, [F.col("date_key")], [F.col("date_key")],
                 ["year"], how="inner")
    return sum_by(f, ["region_key", "year"], "value")


# ---------------------------------------------------------------- reshape

@query
def unpivot_drop_nulls(spark, sf_dir):
    """C1 + F22: wide year columns to rows, NULL cells dropped, year from the name."""
    raw = _raw(spark, sf_dir, "KOLADA_RAW")
    years = [c for c in raw.columns if c.isdigit()]
    return R.unpivot_years(raw, ["Område", "Kön", "NYCKELTALSID"], years)


@query
def unpivot_keep_nulls(spark, sf_dir):
    """Wide region columns to rows, NULL cells kept."""
    raw = _raw(spark, sf_dir, "OVERCROWDING_RAW")
    cols = [c for c in raw.columns if c != S.OVERCROWDING_CATEGORY]
    return R.unpivot_columns(raw, [S.OVERCROWDING_CATEGORY], cols, "region_col", "value")


@query
def melt_measures(spark, sf_dir):
    """Three measure columns to rows with per-measure metadata, one scan."""
    raw = _raw(spark, sf_dir, "EXPENDITURE_GDP_RAW")
    return R.melt_measures(raw.withColumnRenamed("Year", "year"), ["year"], EXPENDITURE_MEASURES)


@query
def explode_features(spark, sf_dir):
    """C4 + J16: GeoJSON features to rows."""
    feats = D.explode_features(_raw(spark, sf_dir, "GEO_LAN_REGIONS_RAW"))
    return feats.select(F.col("props.scb_lan_code_2").alias("code"),
                        F.col("props.region_name_official").alias("name"), "geom")


@query
def flatten_pxweb(spark, sf_dir):
    """C5 + A7 + J15: PXWeb matrices to rows, key positions found per document."""
    return D.flatten_pxweb(_raw(spark, sf_dir, "SCB_POPULATION_RAW"),
                           {"region_code_raw": "Region", "year_raw": "Tid"})


def spreadsheet(spark, sf_dir) -> DataFrame:
    """A wide sheet: one row per (nation, segment), one column per
    'year/month/metric' header.  Header values are the calendar months of
    the data (bounded), listed for the pivot."""
    o = landed_standins(spark, sf_dir).orders_by_nation()
    monthly = SK.materialize(
        o.groupBy(F.col("nm").alias("Region"), F.col("c_mktsegment").alias("Segment"),
                  F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM").alias("m"))
         .agg(F.count(F.lit(1)).cast("decimal(28,2)").alias("n"),
              F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")), "sheet_months")
    months = [r.m for r in monthly.select("m").distinct().orderBy("m").collect()]
    headers = []
    for m in months:
        y, mo = m.split("-")
        for metric in ("Antal", "Summa"):
            headers.append(f"{y}/{SWEDISH_MONTHS[int(mo) - 1][:3]}./{metric}")
    head = F.concat(F.substring("m", 1, 4), F.lit("/"),
                    F.substring(month_name(F.substring("m", 6, 2).cast("int")), 1, 3), F.lit("./"))
    cells = F.inline(F.array(F.struct(F.concat(head, F.lit("Antal")).alias("header"), F.col("n").alias("v")),
                             F.struct(F.concat(head, F.lit("Summa")).alias("header"), F.col("total").alias("v"))))
    return monthly.select("Region", "Segment", cells).groupBy("Region", "Segment").pivot("header", headers).agg(
        F.sum("v").cast("double"))


@query
def stack_headers(spark, sf_dir):
    """C6 + J18: 'Year/Month/Metric' headers stacked to long rows with a period."""
    return R.stack_headers(spreadsheet(spark, sf_dir), ["Region", "Segment"])


@query
def tidy_sheet(spark, sf_dir):
    """The sheet stacked to long rows, its ids standardised, pivoted back per metric."""
    from indicatormart.plans.tidy import tidy_sheet as tidy
    sheet = spreadsheet(spark, sf_dir).withColumnsRenamed({"Region": "Region/landsting",
                                                            "Segment": "Diagnosgrupp"})
    _, wide = tidy(sheet, ["Antal", "Summa"])
    return wide


@query
def pivot_metrics(spark, sf_dir):
    """Long metrics pivoted to one column each."""
    stg = standin_warehouse(spark, sf_dir).stg_tid_konalder
    return R.pivot_metrics(stg, ["region_name", "gender", "age_group", "period_date"], "indicator_name", "value",
                           ["Antal besök", "Median tid till läkare i minuter"], agg="min")


@query
def pivot_roles(spark, sf_dir):
    """C8 + A5: conditional aggregates per role."""
    li = StandIns(spark, sf_dir).lines_by_nation()
    spec = {"max_a": ("max", ["A"]), "sum_n": ("sum", ["N"]), "sum_a_n": ("sum", ["A", "N"]),
            "max_r": ("max", ["R"])}
    return R.pivot_roles(li, ["k", "yr"], "l_returnflag", "l_quantity", spec)


@query
def json_path(spark, sf_dir):
    """JSON path access on a string column, also through VARIANT."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", D.json_path("props", "$.k", "int").alias("k_json"),
                    D.variant_path("props", "$.k", "int").alias("k_variant"))


@query
def canonicalize_columns(spark, sf_dir):
    """C10 + C11: columns found by candidate names (exact, then contains)."""
    o = _t(spark, sf_dir, "orders")
    out = SEL.canonicalize_columns(o, {"order_id": ["O_ORDERKEY"], "customer": ["custkey"],
                                       "priority": ["PRIORITY"]})
    return out.select("order_id", "customer", "priority")


# Region codes and years requested from the population service.
WANTED_REGIONS = ("01", "03", "04", "05", "06", "07", "08", "09", "10", "12", "13", "14",
                  "17", "18", "19", "20", "21", "22", "23", "24", "25")
WANTED_YEARS = ("2020", "2021", "2022", "2023", "2024", "2025")


@query
def select_codes(spark, sf_dir):
    """Wanted codes, else the last N codes."""
    rows = SK.materialize(landed_standins(spark, sf_dir).population_rows().select("code", "year", "obs"),
                          "population_codes")
    rows = SEL.select_codes(rows, "code", WANTED_REGIONS)
    return SEL.select_codes(rows, "year", WANTED_YEARS, fallback_last=6)


@query
def explode_series(spark, sf_dir):
    """Series documents to one row per value."""
    stg = standin_warehouse(spark, sf_dir).stg_kolada
    points = stg.groupBy(F.col("source_indicator_code").alias("kpi_id"), F.col("region_name").alias("region_id"),
                         F.col("year").alias("period"), "gender").agg(F.max("value").alias("value"))
    series = points.groupBy("kpi_id", "region_id").agg(
        F.collect_list(F.struct("period", "gender", "value")).alias("values"))
    docs = series.groupBy("kpi_id").agg(F.collect_list(F.struct("kpi_id", "region_id", "values")).alias("data")) \
                 .select(F.struct(F.lit("stand-in").alias("source"), "data").alias("payload"))
    return D.explode_series(docs)


# ---------------------------------------------------------------- aggregates

@query
def sum_by_grain(spark, sf_dir):
    """A1: sums by grain (NULL keys form a group)."""
    stg = standin_warehouse(spark, sf_dir).stg_medical_personnel
    return sum_by(stg, ["region_name", "year", "source_system", "source_indicator_code"], "value")


@query
def demand_totals(spark, sf_dir):
    """A2: visits summed per region-month, other topics under VISITS_TOTAL."""
    wh = standin_warehouse(spark, sf_dir)
    return M.demand_visits(wh.fct_visits_by_gender_age_m, M.explorer_indicators(wh.dim_indicator))


@query
def explorer_strict(spark, sf_dir):
    """The explorer mart counting only visits of DEMAND indicators as demand."""
    wh = standin_warehouse(spark, sf_dir)
    return M.mart_regional_explorer_monthly_long(
        wh.fct_performance_monthly, wh.fct_overcrowding_monthly, wh.fct_visits_by_gender_age_m,
        wh.fct_capacity_yearly, wh.fct_performance_yearly, wh.fct_kolada_y, wh.dim_indicator, strict=True)


@query
def pressure_strict(spark, sf_dir):
    """The pressure mart without visit counts in the minutes of the diagnosis branch."""
    wh = standin_warehouse(spark, sf_dir)
    return M.mart_pressure_monthly(wh.fct_overcrowding_monthly, wh.fct_visits_by_gender_age_m,
                                   wh.fct_ed_time_by_diagnosis_m, wh.dim_indicator, strict=True)


@query
def avg_of_medians(spark, sf_dir):
    """A3: unweighted average of medians."""
    wh = standin_warehouse(spark, sf_dir)
    return M.median_times(wh.fct_visits_by_gender_age_m, M.explorer_indicators(wh.dim_indicator))


@query
def min_max_dates(spark, sf_dir):
    """A6 + F33: month bounds over several sources, NULL-skipping and strict."""
    wh = standin_warehouse(spark, sf_dir)
    srcs = [(wh.stg_dataexport, "period_month"), (wh.stg_overcrowding, "period_month"),
            (wh.stg_tid_konalder, "period_date"), (wh.stg_tid_diagnos, "period_month")]
    parts = [G.date_bounds(df, c).select(F.lit(i).alias("src"), "lo", "hi") for i, (df, c) in enumerate(srcs)]
    b = union_all(parts).groupBy().agg(
        *[F.max(F.when(F.col("src") == i, F.col(x))).alias(f"{x}{i}") for i in range(len(srcs)) for x in ("lo", "hi")])
    los = [F.col(f"lo{i}") for i in range(len(srcs))]
    his = [F.col(f"hi{i}") for i in range(len(srcs))]
    return b.select(F.least(*los).alias("start_month"), F.greatest(*his).alias("end_month"),
                    P.least_strict(*los).alias("start_month_strict"),
                    P.greatest_strict(*his).alias("end_month_strict"))


@query
def check_min_distinct(spark, sf_dir):
    """A9 + Q6: cardinality warning checks."""
    wh = standin_warehouse(spark, sf_dir)
    return Q.run_checks([Q.check_min_distinct(wh.dim_region, "dim_region", "region_code_2", 21),
                         Q.check_min_distinct(wh.stg_population, "stg_population", "region_code_str", 30)])


@query
def per_1000_ratio(spark, sf_dir):
    """A10: guarded per-1,000 ratio (no division by zero)."""
    wh = standin_warehouse(spark, sf_dir)
    staff = sum_by(wh.stg_medical_personnel, ["region_name", "year"], "value", out="staff")
    pop = wh.stg_population.select(F.concat(F.lit("NATION_"), F.col("region_code").cast("string")).alias("region_name"),
                                   "year", "population")
    j = staff.join(pop, ["region_name", "year"], "left")
    return j.select("region_name", "year", "staff", "population",
                    N.safe_ratio("staff", "population").alias("staff_per_1000"))


# ---------------------------------------------------------------- windows / order

def _de_parsed(spark, sf_dir) -> DataFrame:
    raw = RD.rename_columns(_raw(spark, sf_dir, "DATAEXPORT_RAW"), DATAEXPORT_RENAMES)
    raw = raw.filter(F.col("unit_type") == "Region").withColumn("period_raw", F.trim("period_raw"))
    return raw.withColumns({"period_granularity": P.period_granularity("period_raw"),
                            "year": P.period_year("period_raw"),
                            "value": N.parse_decimal("value_raw")})


@query
def prefer_finer_grain(spark, sf_dir):
    """W1 + P10: YEAR rows dropped where MONTH rows exist for the same key."""
    d = _de_parsed(spark, sf_dir)
    kept = G.prefer_finer_grain(d, [F.col("region_code_raw"), T.trim_lower("indicator_code"), F.col("year"),
                                    T.trim_upper("gender_raw")], parsed_once=True)
    return kept.select("region_code_raw", "unit_code", "indicator_code", "gender_raw", "period_raw",
                       "period_granularity", "year", "value")


@query
def dedupe_registry(spark, sf_dir):
    """One registry row per (system, code), deterministic order."""
    wh = standin_warehouse(spark, sf_dir)
    base = REF.indicator_union(wh.staging())
    return G.first_by(base, ["source_system", "source_indicator_code"],
                      ["indicator_name", "unit", "default_granularity"])


@query
def dedupe_grain(spark, sf_dir):
    """One row per non-unique key, ordered by every other column."""
    li = _t(spark, sf_dir, "lineitem")
    order = ["l_partkey", "l_suppkey", K.desc("l_quantity"), "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_shipdate"]
    return G.first_by(li, ["l_orderkey", "l_linenumber"], order)


@query
def month_spine(spark, sf_dir):
    """W3 + S7 + J17 + F32: month calendar between the first and last month."""
    return G.month_spine([(_t(spark, sf_dir, "orders"), "o_orderdate"),
                          (_t(spark, sf_dir, "lineitem"), "l_shipdate")])


@query
def ordered_output(spark, sf_dir):
    """O1: ORDER BY at the sink only."""
    stg = standin_warehouse(spark, sf_dir).stg_beds_intl
    return stg.orderBy(F.col("country_name").asc_nulls_last(), F.col("year").asc_nulls_last())


# Search-term families used to pick one candidate each.
BEST_MATCH_FAMILIES = {
    "en": ["the and", "with"],
    "de": ["der die", "und"],
    "fr": ["le la", "des"],
    "es": ["el la", "que"],
}


@query
def best_match(spark, sf_dir):
    """O2: best keyword match per family over whole texts."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    best = SEL.best_match(d, "lang", "text", "doc_id", BEST_MATCH_FAMILIES)
    return best.select("lang", "doc_id", "hits")


@query
def best_match_percent(spark, sf_dir):
    """O2: best keyword match per family among percent-like candidates only."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    best = SEL.best_match(d, "lang", "text", "doc_id", BEST_MATCH_FAMILIES, keep=SEL.percent_like("text", "text"))
    return best.select("lang", "doc_id", "hits")


@query
def label_sort_key(spark, sf_dir):
    """O3 + F16: numeric sort key from a label's leading digits."""
    c = _t(spark, sf_dir, "customer")
    label = (F.when(F.col("c_custkey") % 4 == 0, F.lit("Totalt"))
              .when(F.col("c_custkey") % 4 == 1, F.lit("80+"))
              .otherwise(F.concat((F.col("c_custkey") % 90).cast("string"), F.lit("-"),
                                  (F.col("c_custkey") % 90 + 9).cast("string"))))
    return c.select("c_custkey", label.alias("label"), K.label_sort_key(label).alias("sort_key"))


# ---------------------------------------------------------------- set operations

@query
def union_facts(spark, sf_dir):
    """UNION ALL of fact families."""
    wh = standin_warehouse(spark, sf_dir)
    cols = ["source_system", "source_indicator_code", "year", "value"]
    return union_all([wh.stg_net_cost.select(*cols), wh.stg_kolada.select(*cols),
                      wh.stg_beds_intl.select(*cols), wh.stg_expenditure_gdp.select(*cols)])


# ---------------------------------------------------------------- scalar functions

@query
def text_basics(spark, sf_dir):
    """F1-F4 + F6: trim/case, initcap, blank to NULL, fallback title, NULL-propagating concat."""
    raw = _raw(spark, sf_dir, "NET_COST_RAW")
    return raw.select(
        F.trim("Enhetstyp").alias("unit_type"),
        T.trim_lower("Enhetsnamn").alias("name_lower"),
        T.trim_upper("Titel").alias("title_upper"),
        T.initcap_words("Ålder").alias("age_initcap"),
        T.blank_to_null("Ålder").alias("age_group"),
        T.first_non_blank("Titel", "Diagramrubrik").alias("indicator_name"),
        F.concat(F.col("Enhetsnamn"), F.lit("-"), F.col("Mätperiod")).alias("label"),
        F.concat(F.col("Enhetsnamn"), F.lit("-"), T.blank_to_null("Ålder")).alias("label_null"))


@query
def slug_codes(spark, sf_dir):
    """Slug, blank-run and letter-s-run codes."""
    names = _raw(spark, sf_dir, "STAT_DIAGNOS_RAW").select(F.col("Metric").alias("name")).unionByName(
        _raw(spark, sf_dir, "NET_COST_RAW").select(T.first_non_blank("Titel", "Diagramrubrik").alias("name"))
    ).unionByName(_raw(spark, sf_dir, "MEDICAL_PERSONNEL_RAW").select(F.col("Grupp").alias("name"))).distinct()
    return names.select("name", T.slug("name").alias("slug"), T.snake("name").alias("snake"),
                        T.letter_s_runs("name").alias("s_runs"))


@query
def entity_name_clean(spark, sf_dir):
    """F10-F13 + F38: the region-name cleaners over every spelling in the extracts."""
    oc_cols = [c for c in _raw(spark, sf_dir, "OVERCROWDING_RAW").columns if c != S.OVERCROWDING_CATEGORY]
    names = union_all([
        _raw(spark, sf_dir, "KOLADA_RAW").select(F.col("Område").alias("name")),
        _raw(spark, sf_dir, "MEDICAL_PERSONNEL_RAW").select(F.col("Område").alias("name")),
        _raw(spark, sf_dir, "STAT_KON_ALDER_RAW").select(F.col("Region/landsting/akutmottagning").alias("name")),
        spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in oc_cols])).alias("name")),
    ]).distinct()
    return names.select(
        "name",
        T.clean_kpi_region("name").alias("kpi_name"),
        T.clean_area_name("name").alias("area_name"),
        T.clean_column_region("name", {"NATION_9regionen": "NATION_9"}).alias("column_name"),
        T.region_name_norm("name").alias("norm_name"),
        T.collapse_upper("name").alias("collapsed"))


@query
def parse_decimal(spark, sf_dir):
    """Decimal comma, stripped comma and two-place decimals."""
    raw = RD.rename_columns(_raw(spark, sf_dir, "DATAEXPORT_RAW"), DATAEXPORT_RENAMES)
    return raw.select("unit_code", "value_raw", "numerator_raw",
                      N.parse_decimal("value_raw").alias("value"),
                      N.parse_decimal("numerator_raw", comma="strip").alias("numerator"),
                      N.parse_decimal_scale2("numerator_raw").alias("numerator_2dp"))


@query
def parse_int_round(spark, sf_dir):
    """safe integer parsing, half away from zero."""
    raw = _raw(spark, sf_dir, "HEALTH_EXPENDITURE_INTL_RAW")
    return raw.select("OBS_VALUE", "TIME_PERIOD",
                      N.parse_int_round(F.replace(F.col("OBS_VALUE"), F.lit(","), F.lit("."))).alias("obs_int"),
                      N.parse_int_round("TIME_PERIOD").alias("year"))


@query
def parse_period(spark, sf_dir):
    """F23 + F27: period grain, year, month and unified date/label."""
    raw = RD.rename_columns(_raw(spark, sf_dir, "DATAEXPORT_RAW"), DATAEXPORT_RENAMES)
    p = F.trim("period_raw")
    g, y, m = P.period_granularity(p), P.period_year(p), P.period_month(p)
    return raw.select("unit_code", "period_raw", g.alias("period_granularity"), y.alias("year"),
                      m.alias("period_month"), P.period_filter_date(g, m, y).alias("period_filter_date"),
                      P.period_filter_label(g, m, y).alias("period_filter_label"))


@query
def parse_named_month(spark, sf_dir):
    """Swedish month names (long and short) to dates."""
    raw = _raw(spark, sf_dir, "OVERCROWDING_RAW").select(S.OVERCROWDING_CATEGORY)
    cat = F.col(S.OVERCROWDING_CATEGORY)
    no, yr = P.named_month_number(cat), P.named_month_year(cat)
    short = F.concat(F.substring(cat, 1, 3), F.lit("."))
    return raw.select(cat.alias("category"), no.alias("month_no"), yr.alias("year"),
                      P.month_date(yr, no).alias("period_month"),
                      P.spelled_month_number(short).alias("short_month_no"))


@query
def date_parts(spark, sf_dir):
    """F25 + F26 + F28 + F31: date, month, month start, year and labels."""
    o = _t(spark, sf_dir, "orders")
    d = F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", d.alias("order_date"), F.month(d).alias("month_no"),
                    P.month_start(d).alias("month_start"), F.year(d).alias("year"),
                    P.year_month_label(d).alias("year_month_label"), P.year_start(F.year(d)).alias("year_start"))


@query
def period_keys(spark, sf_dir):
    """F29 + F30: YYYYMMDD month keys and YYYY0101 year keys."""
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", P.month_key("o_orderdate").alias("date_key"),
                    P.year_key(F.year("o_orderdate")).alias("year_key"))


@query
def surrogate_key(spark, sf_dir):
    """md5 surrogate keys with the NULL stand-in."""
    c = _t(spark, sf_dir, "customer")
    seg = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    return c.select("c_custkey", K.surrogate_key("c_custkey").alias("key_one"),
                    K.surrogate_key("c_nationkey", seg).alias("key_two"))


# ---------------------------------------------------------------- quality

@query
def check_not_null(spark, sf_dir):
    """Q1 + Q7: fused not-null checks with severities."""
    wh = standin_warehouse(spark, sf_dir)
    return Q.check_columns(wh.fct_capacity_yearly, "fct_capacity_yearly",
                           not_null=["region_key", "year", "metric_type", "indicator_key", "value"],
                           severity={"value": "warn"})


@query
def check_unique(spark, sf_dir):
    """Q2: uniqueness checks."""
    wh = standin_warehouse(spark, sf_dir)
    return Q.run_checks([Q.check_unique(wh.dim_region, "dim_region", "region_key"),
                         Q.check_unique(wh.stg_dataexport, "stg_dataexport", "unit_code")])


@query
def check_accepted(spark, sf_dir):
    """Q3: accepted-values checks."""
    wh = standin_warehouse(spark, sf_dir)
    return Q.check_columns(wh.stg_dataexport, "stg_dataexport",
                           accepted={"gender": ["F", "M", "ALL"], "period_granularity": ["MONTH", "YEAR"]},
                           severity={"period_granularity": "warn"})


@query
def check_relationship(spark, sf_dir):
    """Q4: relationship (anti-join) checks."""
    wh = standin_warehouse(spark, sf_dir)
    return Q.run_checks([
        Q.check_relationship(wh.fct_capacity_yearly, "fct_capacity_yearly", "region_key", wh.dim_region, "region_key"),
        Q.check_relationship(_t(spark, sf_dir, "orders"), "orders", "o_custkey", _t(spark, sf_dir, "customer"),
                             "c_custkey")])


@query
def check_unique_combination(spark, sf_dir):
    """Q5: grain (unique combination) checks of written facts, by the hash sketch and an exact count of the rest."""
    wh = standin_warehouse(spark, sf_dir)
    kolada, monthly = (SK.materialize(wh.model(m), m) for m in ("fct_kolada_y", "fct_performance_monthly"))
    return Q.run_checks([
        Q.check_unique_combination(kolada, "fct_kolada_y", ["region_key", "year", "gender_key", "indicator_key"],
                                   sketch=True),
        Q.check_unique_combination(monthly, "fct_performance_monthly",
                                   ["region_key", "date_key", "gender_key", "indicator_key"], sketch=True)])


@query
def declared_checks_staging(spark, sf_dir):
    """Q1-Q7: every declared test of the staging models."""
    return staging_checks(standin_warehouse(spark, sf_dir))


@query
def declared_checks_reference(spark, sf_dir):
    """Q1-Q7: every declared test of the dimension and fact models."""
    return reference_checks(standin_warehouse(spark, sf_dir))


@query
def fct_intl_y(spark, sf_dir):
    """Both international facts on one key shape (country, date key, indicator, value)."""
    wh = standin_warehouse(spark, sf_dir)
    beds = wh.fct_beds_intl_y.select("country_name", P.year_key("year").alias("date_key"), "indicator_key", "value")
    return union_all([beds, wh.fct_health_exp_gdp_intl_y.select("country_name", "date_key", "indicator_key", "value")])


@query
def mart_intl_y(spark, sf_dir):
    wh = standin_warehouse(spark, sf_dir)
    return union_all([wh.mart_beds_intl_y, wh.mart_health_exp_gdp_intl_y])


# SURVEY §7.3 names of the staging shapes -> the models that have them.
SHAPE_ALIASES = {
    "stg_mixed_grain": "stg_dataexport",
    "stg_wide_years": "stg_kolada",
    "stg_wide_regions": "stg_overcrowding",
    "stg_measures": "stg_expenditure_gdp",
    "stg_document": "stg_population",
    "indicator_registry": "dim_indicator",
}


def all_queries() -> dict[str, Query]:
    out = model_queries()
    out.update(QUERIES)
    for alias, model in SHAPE_ALIASES.items():
        out[alias] = out[model]
    out.pop("dim_gender")   # three literal rows: it reads no table, the facts use it as a dimension
    return out

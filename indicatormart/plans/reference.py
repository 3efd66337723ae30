"""Reference models: conformed dimensions and fact tables.

Facts are the large side.  Each fact is one pass over its staging rows with
map-side (broadcast) lookups into small dimensions; the only shuffles are
the aggregates and the per-grain de-duplication.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatormart.functions import keys as K
from indicatormart.functions import periods as P
from indicatormart.functions import text as T
from indicatormart.operators import joins as J
from indicatormart.operators.aggregates import exact_sum
from indicatormart.operators.grain import first_by, month_spine
from indicatormart.operators.setops import union_all, union_distinct
from indicatormart.plans.staging import (BEDS_INTL_TAG, DIAGNOS_CODE, HEALTH_EXP_TAG, KON_ALDER_CODE, NET_COST_CODE,
                                         OVERCROWDING_TAG, PERSONNEL_CODE, PHYSICIANS_TAG)
from indicatormart.sources.sinks import export_region_geojson

# Metric types of the capacity fact and the registry rows of sources without tags.
METRIC_BEDS = "BEDS_PER_1000"
METRIC_STAFF = "STAFF_HEADCOUNT"
METRIC_POPULATION = "POPULATION"
METRIC_NET_COST = "NET_COST_SEK"
BEDS_REGION_SYSTEM = "BEDS_REGION"
POPULATION_TAG = ("SCB", "POPULATION", "Population")

# The gender dimension (code, name).
GENDERS = (("F", "Kvinna"), ("M", "Man"), ("ALL", "Alla"))

# KPI region spellings (upper case) -> dimension name (upper case).
KPI_REGION_ALIASES = (
    ("JÄMTLAND HÄRJEDALEN", "JÄMTLAND"),
    ("JÖNKÖPINGS LÄN", "JÖNKÖPING"),
    ("SÖRMLAND", "SÖDERMANLAND"),
    ("VÄSTRA GÖTALANDSREGIONEN", "VÄSTRA GÖTALAND"),
    ("STOCKHOLMS LÄN", "STOCKHOLM"),
    ("UPPSALA LÄN", "UPPSALA"),
    ("SÖDERMANLANDS LÄN", "SÖDERMANLAND"),
    ("ÖSTERGÖTLANDS LÄN", "ÖSTERGÖTLAND"),
    ("KRONOBERGS LÄN", "KRONOBERG"),
    ("KALMAR LÄN", "KALMAR"),
    ("GOTLANDS LÄN", "GOTLAND"),
    ("BLEKINGE LÄN", "BLEKINGE"),
    ("SKÅNE LÄN", "SKÅNE"),
    ("HALLANDS LÄN", "HALLAND"),
    ("VÄSTRA GÖTALANDS LÄN", "VÄSTRA GÖTALAND"),
    ("VÄRMLANDS LÄN", "VÄRMLAND"),
    ("ÖREBRO LÄN", "ÖREBRO"),
    ("VÄSTMANLANDS LÄN", "VÄSTMANLAND"),
    ("DALARNAS LÄN", "DALARNA"),
    ("GÄVLEBORGS LÄN", "GÄVLEBORG"),
    ("VÄSTERNORRLANDS LÄN", "VÄSTERNORRLAND"),
    ("JÄMTLANDS LÄN", "JÄMTLAND"),
    ("VÄSTERBOTTENS LÄN", "VÄSTERBOTTEN"),
    ("NORRBOTTENS LÄN", "NORRBOTTEN"),
)

# Overcrowding region spellings -> dimension name (matched case-insensitively).
OVERCROWDING_REGION_ALIASES = (
    ("Sörmland", "Södermanland"),
    ("Jönköpings", "Jönköping"),
    ("Jämtland Härjedalen", "Jämtland"),
)

# Visit-statistics region spelling (upper case) -> dimension name.
VISITS_REGION_ALIASES = (("JÄMTLAND HÄRJEDALEN", "JÄMTLAND"),)


# ---------------------------------------------------------------- dimensions

def dim_region(stg_dim_region: DataFrame) -> DataFrame:
    """Regions keyed by md5 of the integer code; geometry kept for export."""
    return stg_dim_region.select(
        K.surrogate_key("region_code_int").alias("region_key"),
        "region_code_int", "region_code_2", "region_name", "geom")


def dim_region_geojson(dim: DataFrame) -> DataFrame:
    return export_region_geojson(dim)


def dim_gender(spark: SparkSession) -> DataFrame:
    """Fixed three-row dimension, built as a JVM-side literal."""
    rows = F.array(*[F.struct(F.lit(c).alias("gender_code"), F.lit(n).alias("gender_name")) for c, n in GENDERS])
    base = spark.range(1).select(F.inline(rows))
    return base.select(K.surrogate_key("gender_code").alias("gender_key"), "gender_code", "gender_name")


def dim_age_group(stg_tid_konalder: DataFrame) -> DataFrame:
    """Distinct age labels with a numeric sort key (leading digits, else 999)."""
    src = stg_tid_konalder.select("age_group").filter(F.col("age_group").isNotNull()).distinct()
    return src.select(
        K.surrogate_key(F.trim("age_group")).alias("age_key"),
        F.trim("age_group").alias("age_group_label"),
        K.label_sort_key("age_group").alias("sort_key"))


def dim_date(stg_dataexport: DataFrame, stg_overcrowding: DataFrame, stg_tid_konalder: DataFrame,
             stg_tid_diagnos: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """Month calendar spanning every monthly source (exact, no row cap)."""
    return month_spine([(stg_dataexport, "period_month"), (stg_overcrowding, "period_month"),
                        (stg_tid_konalder, "period_date"), (stg_tid_diagnos, "period_month")],
                       strict_nulls=strict_nulls)


def _registry_rows(df: DataFrame, granularity, system=None, code=None, name=None,
                   unit: str | None = "unit") -> DataFrame:
    def col_or_lit(v, default):
        if v is None:
            return F.col(default)
        return v if not isinstance(v, str) else F.col(v)
    return df.select(
        col_or_lit(system, "source_system").cast("string").alias("source_system"),
        col_or_lit(code, "source_indicator_code").cast("string").alias("source_indicator_code"),
        col_or_lit(name, "indicator_name").cast("string").alias("indicator_name"),
        (F.col(unit) if unit else F.lit(None)).cast("string").alias("unit"),
        (granularity if not isinstance(granularity, str) else F.lit(granularity)).alias("default_granularity"))


def _registry_names(df: DataFrame, granularity: str, code, unit: str | None = "unit") -> DataFrame:
    """:func:`_registry_rows` of a source whose code is a function of its indicator name (``code`` maps the column).

    Rows are reduced to their distinct names first, so the code's regular
    expressions run once a name and task group, not once a row.
    """
    names = df.select("source_system", "indicator_name", *([unit] if unit else [])).distinct()
    return _registry_rows(names, granularity, code=code(F.col("indicator_name")), unit=unit)


def _constant_row(df: DataFrame, system: str, code: str, name: str, unit: str | None) -> DataFrame:
    """One registry row when ``df`` has any row (LIMIT 1 stops the scan early)."""
    return df.limit(1).select(
        F.lit(system).alias("source_system"), F.lit(code).alias("source_indicator_code"),
        F.lit(name).alias("indicator_name"), F.lit(unit).cast("string").alias("unit"),
        F.lit("YEAR").alias("default_granularity"))


def indicator_union(stg: dict[str, DataFrame]) -> DataFrame:
    """UNION (distinct) of every source's indicators with their default grain."""
    de = stg["stg_dataexport"].filter(F.col("period_granularity").isin("MONTH", "YEAR"))
    branches = [
        # MONTH rows register as MONTH, YEAR rows as YEAR: one scan for both branches
        _registry_rows(de, F.col("period_granularity")),
        _registry_rows(stg["stg_overcrowding"], "MONTH", unit=None),
        _registry_names(stg["stg_tid_konalder"], "MONTH", KON_ALDER_CODE, unit=None),
        _registry_names(stg["stg_tid_diagnos"], "MONTH", DIAGNOS_CODE),
        _registry_rows(stg["stg_beds_region"], "YEAR", system=F.lit(BEDS_REGION_SYSTEM), code="indicator_code",
                       unit=None),
        _registry_rows(stg["stg_beds_intl"], "YEAR"),
        _registry_names(stg["stg_medical_personnel"], "YEAR", PERSONNEL_CODE, unit=None),
        _constant_row(stg["stg_population"], *POPULATION_TAG, None),
        _registry_names(stg["stg_net_cost"], "YEAR", NET_COST_CODE),
        _registry_rows(stg["stg_kolada"], "YEAR", unit=None),
        _constant_row(stg["stg_physicians_per1000"], *PHYSICIANS_TAG, "Per 1000 inhabitants"),
        _constant_row(stg["stg_health_exp_gdp_intl"], *HEALTH_EXP_TAG, "% of GDP"),
        _registry_rows(stg["stg_expenditure_gdp"], "YEAR"),
    ]
    return union_distinct(branches)


def dim_indicator(stg: dict[str, DataFrame], taxonomy: DataFrame) -> DataFrame:
    """Indicator registry: one row per (system, code) with topic and polarity.

    The pick per code is ordered by name, unit, grain (NULLs last) so it is
    deterministic when a code has two units or both grains.  Topic and
    polarity come from the taxonomy seed, matched on upper(trim()) of both.
    """
    base = indicator_union(stg)
    one = first_by(base, ["source_system", "source_indicator_code"],
                   ["indicator_name", "unit", "default_granularity"])
    keyed = one.select(K.surrogate_key("source_system", "source_indicator_code").alias("indicator_key"),
                       "source_system", "source_indicator_code", "indicator_name", "unit",
                       "default_granularity")
    tax = taxonomy.select(T.trim_upper("source_system").alias("source_system"),
                          T.trim_upper("source_indicator_code").alias("source_indicator_code"),
                          "topic", "polarity")
    return J.lookup(keyed, tax,
                    [T.trim_upper("source_system"), T.trim_upper("source_indicator_code")],
                    [T.trim_upper("source_system"), T.trim_upper("source_indicator_code")],
                    ["topic", "polarity"])


# ---------------------------------------------------------------- facts

def tagged_indicator_key(dim_ind: DataFrame, tag: Sequence[str]):
    """Indicator key of a single-indicator source (its rows all carry ``tag``):
    one scalar lookup in the registry, which is unique on (system, code)."""
    return J.constant_lookup(dim_ind, {"source_system": tag[0], "source_indicator_code": tag[1]}, "indicator_key")


def fct_beds_intl_y(stg_beds_intl: DataFrame, dim_ind: DataFrame) -> DataFrame:
    return stg_beds_intl.select("country_name", F.col("year").cast("int").alias("year"),
                                tagged_indicator_key(dim_ind, BEDS_INTL_TAG).alias("indicator_key"),
                                F.col("value").cast("double").alias("value"), "unit")


def fct_capacity_yearly(stg_beds_region: DataFrame, stg_medical_personnel: DataFrame,
                        stg_population: DataFrame, stg_net_cost: DataFrame,
                        dim_reg: DataFrame, dim_ind: DataFrame) -> DataFrame:
    """Beds, staff headcount (summed over genders), population and net cost by region-year."""
    def by_code(df, code_col):
        return J.resolve_key(df, dim_reg, code_col, "region_code_int", "region_key")

    beds = by_code(stg_beds_region, "region_code").select(
        "region_key", F.col("year").cast("int").alias("year"), F.lit(METRIC_BEDS).alias("metric_type"),
        F.lit(BEDS_REGION_SYSTEM).alias("src_system"), F.col("indicator_code").alias("src_code"),
        F.col("value").cast("double").alias("value"), F.lit(None).cast("string").alias("unit"))
    staff_rows = J.resolve_key(stg_medical_personnel.filter(F.col("value").isNotNull()), dim_reg,
                               "region_name", "region_name", "region_key")
    staff = staff_rows.groupBy("region_key", "year", "source_system", "source_indicator_code").agg(
        exact_sum("value").alias("value")).select(
        "region_key", F.col("year").cast("int").alias("year"), F.lit(METRIC_STAFF).alias("metric_type"),
        F.col("source_system").alias("src_system"), F.col("source_indicator_code").alias("src_code"),
        "value", F.lit(None).cast("string").alias("unit"))
    pop = by_code(stg_population, "region_code").select(
        "region_key", F.col("year").cast("int").alias("year"), F.lit(METRIC_POPULATION).alias("metric_type"),
        F.lit(POPULATION_TAG[0]).alias("src_system"), F.lit(POPULATION_TAG[1]).alias("src_code"),
        F.col("population").cast("double").alias("value"), F.lit(None).cast("string").alias("unit"))
    cost = by_code(stg_net_cost, "region_code").select(
        "region_key", F.col("year").cast("int").alias("year"), F.lit(METRIC_NET_COST).alias("metric_type"),
        F.col("source_system").alias("src_system"), F.col("source_indicator_code").alias("src_code"),
        F.col("value").cast("double").alias("value"), "unit")
    unioned = union_all([beds, staff, pop, cost])
    f = J.resolve_indicator(unioned, dim_ind, "src_system", "src_code")
    return f.select("region_key", "year", "metric_type", "indicator_key", "value", "unit")


def fct_ed_time_by_diagnosis_m(stg_tid_diagnos: DataFrame, dim_reg: DataFrame, dim_ind: DataFrame) -> DataFrame:
    """ED times by diagnosis group and month.

    The diagnosis dimension is DISTINCT(diagnosgrupp) keyed by md5, so its
    lookup equals computing the key in the row; no join is needed.
    """
    f = J.resolve_key(stg_tid_diagnos, dim_reg, "region_name", "region_name", "region_key")
    f = J.resolve_indicator(f, dim_ind)
    diag_key = F.when(F.col("diagnosgrupp").isNotNull(), K.surrogate_key("diagnosgrupp"))
    return f.select("region_key", P.month_key("period_month").alias("date_key"),
                    diag_key.alias("diagnosis_key"), "diagnosgrupp", "indicator_key",
                    F.col("value").cast("double").alias("value"), "unit")


def fct_health_exp_gdp_intl_y(stg_health: DataFrame, dim_ind: DataFrame) -> DataFrame:
    return stg_health.select("country_name", P.year_key("year").alias("date_key"),
                             tagged_indicator_key(dim_ind, HEALTH_EXP_TAG).alias("indicator_key"), "value") \
                     .filter(F.col("date_key").isNotNull())


def _name_resolved(src: DataFrame, dim_reg: DataFrame, aliases: Sequence[tuple[str, str]],
                   spellings_once: bool = False) -> DataFrame:
    """Upper-case-pattern normalizer + alias map, matched to the region
    dimension normalized the same way; unmatched rows are dropped."""
    if spellings_once:
        return J.lookup_by_spelling(src, dim_reg, "region_name_raw",
                                    lambda c: J.alias_lookup(T.upper_pattern_norm(c), aliases),
                                    T.upper_pattern_norm(F.trim("region_name")), {"region_key": "region_key"}, how="inner")
    s = src.withColumn("__name_norm", J.alias_lookup(T.upper_pattern_norm("region_name_raw"), aliases))
    return J.lookup(s, dim_reg, [F.col("__name_norm")], [T.upper_pattern_norm(F.trim("region_name"))],
                    ["region_key"], how="inner").drop("__name_norm")


def fct_kolada_y(stg_kolada: DataFrame, dim_reg: DataFrame, dim_gen: DataFrame, dim_ind: DataFrame,
                 aliases: Sequence[tuple[str, str]] = KPI_REGION_ALIASES, spellings_once: bool = False) -> DataFrame:
    """Yearly KPI values, one row per region, year, gender and indicator."""
    src = stg_kolada.filter(F.col("value").isNotNull()).select(
        F.trim("region_name").alias("region_name_raw"),
        T.trim_upper("gender").alias("gender_code"),
        "source_system",
        F.col("source_indicator_code").alias("indicator_code"),
        F.col("year").cast("int").alias("year"),
        F.col("value").cast("double").alias("value"))
    joined = _name_resolved(src, dim_reg, aliases, spellings_once)
    joined = J.lookup(joined, dim_gen, [F.col("gender_code")], [F.col("gender_code")], ["gender_key"])
    joined = J.resolve_indicator(joined, dim_ind, "source_system", "indicator_code", normalize=True)
    # year is constant inside the grain and values are non-NULL, so the
    # original order leaves ties; the value (largest first) settles them.
    one = first_by(joined, ["region_key", "year", "gender_key", "indicator_key"],
                   [F.col("value").isNull(), K.desc("year"), K.desc("value")])
    return one.select("region_key", "year", "gender_key", "indicator_key", "value")


def fct_overcrowding_monthly(stg_overcrowding: DataFrame, dim_reg: DataFrame, dim_ind: DataFrame,
                             aliases: Sequence[tuple[str, str]] = OVERCROWDING_REGION_ALIASES,
                             spellings_once: bool = False) -> DataFrame:
    def clean(c):
        return T.region_name_norm(J.alias_lookup(c, aliases, case_insensitive=True))

    if spellings_once:
        f = J.lookup_by_spelling(stg_overcrowding, dim_reg, "region_name", clean, T.region_name_norm("region_name"),
                                 {"region_key": "region_key"})
    else:
        f = J.lookup(stg_overcrowding, dim_reg, [clean("region_name")], [T.region_name_norm("region_name")], ["region_key"])
    return f.select("region_key", P.month_key("period_month").alias("date_key"),
                    tagged_indicator_key(dim_ind, OVERCROWDING_TAG).alias("indicator_key"),
                    F.col("value").cast("double").alias("value"))


def fct_performance_monthly(stg_dataexport: DataFrame, dim_reg: DataFrame, dim_gen: DataFrame,
                            dim_ind: DataFrame) -> DataFrame:
    src = stg_dataexport.filter((F.col("period_granularity") == "MONTH") & F.col("value").isNotNull())
    f = J.resolve_key(src, dim_reg, "region_code", "region_code_int", "region_key")
    f = J.resolve_key(f, dim_gen, "gender", "gender_code", "gender_key")
    f = J.resolve_indicator(f, dim_ind)
    return f.select("region_key", P.month_key("period_month").alias("date_key"), "gender_key",
                    "indicator_key", F.col("value").cast("double").alias("value"),
                    F.col("numerator").cast("double").alias("numerator"),
                    F.col("denominator").cast("double").alias("denominator"), "unit")


def fct_performance_yearly(stg_dataexport: DataFrame, dim_reg: DataFrame, dim_gen: DataFrame,
                           dim_ind: DataFrame) -> DataFrame:
    """Yearly rows (NULL values kept)."""
    src = stg_dataexport.filter(F.col("period_granularity") == "YEAR")
    f = J.resolve_key(src, dim_reg, "region_code", "region_code_int", "region_key")
    f = J.resolve_key(f, dim_gen, "gender", "gender_code", "gender_key")
    f = J.resolve_indicator(f, dim_ind, normalize=True)
    return f.select("region_key", F.col("year").cast("int").alias("year"), "gender_key", "indicator_key",
                    F.col("value").cast("double").alias("value"),
                    F.col("numerator").cast("double").alias("numerator"),
                    F.col("denominator").cast("double").alias("denominator"), "unit")


def ref_physicians_per_1000_y(stg_physicians: DataFrame, dim_reg: DataFrame, dim_ind: DataFrame) -> DataFrame:
    s = stg_physicians.select(
        "region_name", "year", F.col("value").cast("double").alias("value"),
        F.lit(PHYSICIANS_TAG[0]).alias("source_system"),
        F.lit(PHYSICIANS_TAG[1]).alias("source_indicator_code"),
        F.lit(PHYSICIANS_TAG[2]).alias("indicator_name"),
        F.lit("Per 1000 inhabitants").alias("unit"))
    m = J.resolve_key(s, dim_reg, "region_name", "region_name", "region_key", normalize=F.upper,
                      keep_unmatched=False)
    m = m.withColumns({"date_key": P.year_key("year"),
                       "indicator_key": tagged_indicator_key(dim_ind, PHYSICIANS_TAG)})
    return m.select("region_key", "date_key", "year", "indicator_key", "value", "source_system",
                    "source_indicator_code", "indicator_name", "unit")


def fct_physicians_per_1000_y(ref_phys: DataFrame) -> DataFrame:
    return ref_phys.filter(F.col("region_key").isNotNull() & F.col("date_key").isNotNull()
                           & F.col("indicator_key").isNotNull()) \
                   .select("region_key", "date_key", "indicator_key", "year", "value")


def fct_visits_by_gender_age_m(stg_tid_konalder: DataFrame, dim_reg: DataFrame, dim_gen: DataFrame,
                               dim_age: DataFrame, dim_ind: DataFrame,
                               aliases: Sequence[tuple[str, str]] = VISITS_REGION_ALIASES,
                               spellings_once: bool = False) -> DataFrame:
    src = stg_tid_konalder.filter(F.col("value").isNotNull()).select(
        F.trim("region_name").alias("region_name_raw"),
        T.trim_upper("gender").alias("gender_code"),
        F.trim("age_group").alias("age_group_label"),
        "source_system",
        F.col("source_indicator_code").alias("indicator_code"),
        "period_date",
        F.col("value").cast("double").alias("value"))
    f = _name_resolved(src, dim_reg, aliases, spellings_once)
    f = J.lookup(f, dim_gen, [F.col("gender_code")], [F.col("gender_code")], ["gender_key"])
    f = J.lookup(f, dim_age, [F.col("age_group_label")], [F.col("age_group_label")], ["age_key"])
    f = J.resolve_indicator(f, dim_ind, "source_system", "indicator_code", normalize=True)
    return f.select("region_key", P.month_key("period_date").alias("date_key"), "gender_key", "age_key",
                    "indicator_key", "value", F.lit(None).cast("string").alias("unit"))

"""Staging models: raw extract -> conformed long observations.

Every function takes the raw DataFrame with the extract's own column names
and returns the staged columns in a fixed order.  All row-level: no shuffle
except ``stg_dataexport`` (the finer-grain rule).
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.functions import numbers as N
from indicatormart.functions import periods as P
from indicatormart.functions import text as T
from indicatormart.operators import documents as D
from indicatormart.operators import predicates as PR
from indicatormart.operators import reshape as R
from indicatormart.operators.grain import prefer_finer_grain
from indicatormart.sources import schemas as S


def _c(name: str):
    return F.col(f"`{name}`")


def NULL_DATE():
    return F.lit(None).cast("date")


def NULL_STR():
    return F.lit(None).cast("string")


# The three national expenditure measures (column, code, name, unit).
EXPENDITURE_MEASURES = (
    ("Totala hälso- och sjukvårdsutgifter, mnkr", "health_exp_mnkr",
     "Totala hälso- och sjukvårdsutgifter", "mnkr"),
    ("BNP till marknadspris, mnkr", "gdp_mnkr", "BNP till marknadspris", "mnkr"),
    ("BNP relationstal, procent", "health_exp_share_pct", "Hälso-/sjukvård som andel av BNP", "percent"),
)

# Source system tags of the multi-indicator sources.
SYS_KOLADA = "KOLADA"
SYS_DATAEXPORT = "DATAEXPORT"
SYS_PERSONNEL = "MEDICAL_PERSONNEL"
SYS_NET_COST = "NET_COST"
SYS_NATIONAL = "SCB_NATIONAL"
SYS_DIAGNOS = "STAT_DIAGNOS"
SYS_KON_ALDER = "STAT_KON_ALDER"

# How the multi-indicator sources without codes of their own make one from the indicator's name.
PERSONNEL_CODE = T.slug
NET_COST_CODE = T.slug
DIAGNOS_CODE = T.letter_s_runs
KON_ALDER_CODE = T.snake

# Rows that name an aggregate rather than a region, and the national region name.
ALL_REGIONS_PREFIX = "Alla regioner"
NATIONAL_AREA = "Riket"
HEALTHCARE_REGION_WORD = "sjukvårdsregion"
NATIONAL_NAMES = ("riket", "sverige")
NATIONAL_REGION_NAME = "Sverige"
REGION_UNIT_TYPE = "Region"

# Unit of a diagnosis metric from its lower-cased name (first LIKE wins).
DIAGNOS_UNIT_RULES = (("%minut%", "minuter"), ("%antal%", "antal"))

# Lineage tags (system, code, name) of the single-indicator sources.
BEDS_INTL_TAG = ("OECD_HEALTH", "beds_per_1000_population", "Hospital beds per 1,000 inhabitants")
HEALTH_EXP_TAG = ("OECD_HEALTH", "HEALTH_EXPENDITURE_PCT_GDP", "Health expenditure (% of GDP)")
OVERCROWDING_TAG = ("OVERCROWDING", "displaced_patients", "Overcrowding & displaced patients")
PHYSICIANS_TAG = ("OECD_HEALTH", "PHYSICIANS_PER_1000", "Doctors per 1000 inhabitants")

# Wide-by-region column needing a special name.
OVERCROWDING_SPECIAL_NAMES = {"Västra Götalandsregionen": "Västra Götaland"}


def stg_beds_intl(raw: DataFrame) -> DataFrame:
    """International beds per 1,000 inhabitants (one row per country-year)."""
    return (raw
            .filter(_c("OBS_VALUE").isNotNull())
            .select(
                F.trim(_c("REF_AREA")).alias("country_code"),
                F.trim(_c("Reference area")).alias("country_name"),
                N.strict_int(_c("TIME_PERIOD")).alias("year"),
                F.lit(BEDS_INTL_TAG[0]).alias("source_system"),
                F.lit(BEDS_INTL_TAG[1]).alias("source_indicator_code"),
                F.lit(BEDS_INTL_TAG[2]).alias("indicator_name"),
                T.blank_to_null(_c("Unit of measure")).alias("unit"),
                N.strict_double(_c("OBS_VALUE")).alias("value"))
            .filter(F.col("year").isNotNull()))


def stg_beds_region(raw: DataFrame) -> DataFrame:
    """Regional beds: renamed columns, rows with a year."""
    return (raw.select(
                F.trim(_c("Enhetsnamn")).alias("region_name"),
                N.strict_int(_c("Regionskod")).alias("region_code"),
                N.strict_int(_c("Mätperiod")).alias("year"),
                N.strict_double(_c("Värde")).alias("value"),
                _c("Indikator-Id").alias("indicator_code"),
                _c("Titel").alias("indicator_name"),
                _c("Diagramrubrik").alias("indicator_desc"))
            .filter(F.col("year").isNotNull()))


def stg_dataexport(raw: DataFrame) -> DataFrame:
    """Mixed-grain regional indicators; a YEAR row is dropped when the same
    region, indicator, year and raw gender spelling has MONTH rows."""
    base = raw.filter(_c("ENHETSTYP") == F.lit(REGION_UNIT_TYPE)).select(
        _c("ENHETSNAMN").alias("unit_name"),
        _c("REGIONSKOD").alias("region_code_raw"),
        _c("ENHETSKOD").alias("unit_code"),
        _c("Kön/Totalt").alias("gender_raw"),
        _c("Indikator-Id").alias("indicator_code"),
        _c("TITEL").alias("indicator_name_raw"),
        _c("Måttenhet").alias("unit_raw"),
        F.trim(_c("Mätperiod")).alias("period_raw"),
        N.parse_decimal(_c("Värde")).alias("value"),
        N.parse_decimal(_c("Täljare"), comma="strip").alias("numerator"),
        N.parse_decimal(_c("Nämnare/antal fall"), comma="strip").alias("denominator"),
    )
    parsed = base.withColumns({
        "period_granularity": P.period_granularity("period_raw"),
        "year": P.period_year("period_raw"),
        "period_month": P.period_month("period_raw"),
    })
    kept = prefer_finer_grain(parsed, [F.col("region_code_raw"), T.trim_lower("indicator_code"),
                                       F.col("year"), T.trim_upper("gender_raw")], parsed_once=True)
    return kept.filter(F.col("year").isNotNull()).select(
        F.trim("unit_name").alias("region_name"),
        N.strict_int("region_code_raw").alias("region_code"),
        "unit_code",
        "year",
        "period_month",
        "period_granularity",
        P.period_filter_date("period_granularity", "period_month", "year").alias("period_filter_date"),
        P.period_filter_label("period_granularity", "period_month", "year").alias("period_filter_label"),
        F.lit(SYS_DATAEXPORT).alias("source_system"),
        T.trim_lower("indicator_code").alias("source_indicator_code"),
        F.trim("indicator_name_raw").alias("indicator_name"),
        "value",
        T.normalize_gender("gender_raw").alias("gender"),
        T.blank_to_null("unit_raw").alias("unit"),
        "numerator",
        "denominator",
    )


def stg_dim_region(docs: DataFrame, payload: str = "payload") -> DataFrame:
    """GeoJSON region features -> code, two-digit code, names, geometry text."""
    feats = D.explode_features(docs, payload).filter(F.col("props").isNotNull())
    code = D.prop(feats, "props", "scb_lan_code_2")
    name = F.trim(D.prop(feats, "props", "region_name_official"))
    return feats.select(
        N.parse_int_round(code).alias("region_code_int"),
        F.lpad(code, 2, "0").alias("region_code_2"),
        name.alias("region_name_raw"),
        T.drop_trailing_s(name).alias("region_name"),
        F.col("geom"),
    )


def stg_expenditure_gdp(raw: DataFrame) -> DataFrame:
    """National expenditure and GDP: three measure columns -> rows (one scan)."""
    src = raw.filter(_c("Year").isNotNull()).select(N.strict_int(_c("Year")).alias("year"),
                                                     *[_c(m[0]) for m in EXPENDITURE_MEASURES])
    long = R.melt_measures(src, ["year"], EXPENDITURE_MEASURES)
    return long.filter(F.col("value").isNotNull()).select(
        F.lit(NATIONAL_REGION_NAME).alias("region_name"),
        "year",
        P.year_start("year").alias("period_date"),
        F.lit("YEAR").alias("period_granularity"),
        F.lit(SYS_NATIONAL).alias("source_system"),
        "source_indicator_code", "indicator_name", "unit", "value",
    )


def stg_health_exp_gdp_intl(raw: DataFrame) -> DataFrame:
    """International health expenditure as % of GDP (decimal comma, 2 places)."""
    src = raw.select(
        F.trim(_c("REFERENCE_AREA")).alias("country_name"),
        N.parse_int_round(_c("TIME_PERIOD")).alias("year"),
        N.parse_decimal_scale2(_c("OBS_VALUE")).alias("value"),
        _c("UNIT_OF_MEASURE").alias("unit"),
    )
    return PR.require(src, "country_name", "year").select(
        "country_name", "year", "value",
        F.lit(HEALTH_EXP_TAG[0]).alias("source_system"),
        F.lit(HEALTH_EXP_TAG[1]).alias("source_indicator_code"),
        F.lit(HEALTH_EXP_TAG[2]).alias("indicator_name"),
        "unit",
    )


def year_columns(df: DataFrame) -> list[str]:
    """Columns named by a year (digits only, optionally prefixed)."""
    return [c for c in df.columns if re.fullmatch(r"[A-Za-z]?[0-9]{4}", c)]


def stg_kolada(raw: DataFrame, year_cols: Sequence[str] | None = None) -> DataFrame:
    """Wide KPI table: one column per year -> rows, NULL cells dropped.

    Aggregate rows ('Alla regioner…') and NULL areas are dropped on the raw
    column (the cleaned name is NULL exactly for those), so the region-name
    regexes run only where the name is used, and once per wide row rather
    than once per year column.
    """
    years = list(year_cols) if year_cols is not None else year_columns(raw)
    area = _c("Område")
    prepared = raw.filter(area.isNotNull() & ~area.ilike(ALL_REGIONS_PREFIX + "%")).select(
        area.alias("region_name_raw"),
        T.clean_kpi_region(area).alias("region_name"),
        _c("Kön").alias("gender_raw"),
        _c("NYCKELTALSID").alias("indicator_code"),
        _c("NYCKELTAL").alias("indicator_name"),
        *[N.strict_double(_c(y)).alias(y) for y in years],
    )
    long = R.unpivot_years(prepared, ["region_name_raw", "region_name", "gender_raw", "indicator_code",
                                      "indicator_name"], years)
    return long.select(
        "region_name_raw", "region_name", "year",
        F.lit(SYS_KOLADA).alias("source_system"),
        T.trim_lower("indicator_code").alias("source_indicator_code"),
        F.trim("indicator_name").alias("indicator_name"),
        "value",
        T.normalize_gender("gender_raw").alias("gender"),
    )


def stg_medical_personnel(raw: DataFrame) -> DataFrame:
    """Staff headcount by county; national and health-care-region rows dropped."""
    src = raw.select(
        N.strict_int(_c("År")).alias("year"),
        F.trim(_c("Grupp")).alias("profession_group"),
        F.trim(_c("Område")).alias("area_raw"),
        F.trim(_c("Kön")).alias("gender_raw"),
        N.strict_double(_c(S.PERSONNEL_VALUE_COL)).alias("value"),
    )
    kept = PR.drop_aggregate_rows(src, "area_raw", names=[NATIONAL_AREA], contains_lower=[HEALTHCARE_REGION_WORD],
                                  keep_nulls=False)
    typed = kept.select(
        "year",
        T.clean_area_name("area_raw").alias("region_name"),
        T.normalize_gender("gender_raw", short_codes=False, trim=False).alias("gender"),
        F.col("profession_group").alias("indicator_name"),
        PERSONNEL_CODE("profession_group").alias("source_indicator_code"),
        "value",
    )
    # region_name is never NULL here (the raw area is), so only year and value are tested:
    # the name regexes then run only where the name is used.
    return PR.require(typed, "year", "value").select(
        "region_name", "year", "value",
        NULL_DATE().alias("period_month"),
        F.lit("YEAR").alias("period_granularity"),
        F.lit(SYS_PERSONNEL).alias("source_system"),
        "source_indicator_code", "indicator_name", "gender",
    )


def stg_net_cost(raw: DataFrame) -> DataFrame:
    """Regional net cost per inhabitant (yearly)."""
    src = raw.filter(F.trim(_c("Enhetstyp")) == F.lit(REGION_UNIT_TYPE)).select(
        F.trim(_c("Enhetsnamn")).alias("region_name"),
        N.parse_int_round(_c("Regionskod")).alias("region_code"),
        F.trim(_c("Kön/Totalt")).alias("gender_raw"),
        F.trim(_c("Ålder")).alias("age_raw"),
        N.strict_int(_c("Mätperiod")).alias("year"),
        F.trim(_c("Måttenhet")).alias("unit_raw"),
        N.strict_double(_c("Värde")).alias("value"),
        T.first_non_blank(_c("Titel"), _c("Diagramrubrik")).alias("indicator_name"),
    )
    typed = src.select(
        "region_code", "region_name", "year", "value",
        NULL_DATE().alias("period_month"),
        F.lit("YEAR").alias("period_granularity"),
        F.lit(SYS_NET_COST).alias("source_system"),
        NET_COST_CODE("indicator_name").alias("source_indicator_code"),
        "indicator_name",
        T.normalize_gender("gender_raw", trim=False).alias("gender"),
        T.blank_to_null("age_raw").alias("age_group"),
        T.blank_to_null("unit_raw").alias("unit"),
    )
    return PR.require(typed, "year", "region_code", "region_name", "value")


def stg_overcrowding(raw: DataFrame, region_cols: Sequence[str] | None = None,
                     special_names: dict[str, str] | None = None) -> DataFrame:
    """Wide monthly table (one column per region) -> rows; month from a
    Swedish 'månad YYYY' category.  NULL cells survive the unpivot and are
    removed with the other required fields."""
    cols = list(region_cols) if region_cols is not None else \
        [c for c in raw.columns if c != S.OVERCROWDING_CATEGORY]
    special = OVERCROWDING_SPECIAL_NAMES if special_names is None else special_names
    cat = _c(S.OVERCROWDING_CATEGORY)
    dated = raw.select(
        P.named_month_year(cat).alias("year"),
        P.named_month_number(cat).alias("month_no"),
        *[N.strict_double(_c(c)).alias(c) for c in cols],
    ).withColumn("period_month", P.month_date("year", "month_no"))
    long = R.unpivot_columns(dated, ["period_month", "year", "month_no"], cols, "region_col", "value")
    cleaned = long.select(
        "year", "month_no", "period_month",
        T.clean_column_region(F.trim("region_col"), special).alias("region_name"),
        "value",
    )
    # region_name comes from a column name and is never NULL: not tested, so the name
    # regexes run only where the name is used
    return PR.require(cleaned, "year", "month_no", "period_month", "value").select(
        "year", "month_no", "period_month", "region_name", "value",
        F.lit(OVERCROWDING_TAG[0]).alias("source_system"),
        F.lit(OVERCROWDING_TAG[1]).alias("source_indicator_code"),
        F.lit(OVERCROWDING_TAG[2]).alias("indicator_name"),
        F.lit("MONTH").alias("period_granularity"),
        F.lit("ALL").alias("gender"),
    )


def stg_physicians_per1000(raw: DataFrame) -> DataFrame:
    return raw.select(
        _c("REGION_NAME").alias("region_name"),
        N.strict_int(_c("YEAR")).alias("year"),
        N.strict_double(_c("VALUE")).alias("value"),
        F.lit("OECD_HEALTH").alias("source_system"),
        F.lit("Doctors per 1000 inhabitants").alias("indicator_name"),
        F.lit("Per 1000 inhabitants").alias("unit"),
    )


def stg_population(docs: DataFrame, payload: str = "payload") -> DataFrame:
    """PXWeb population documents -> region, year, population."""
    rows = D.flatten_pxweb(docs, {"region_code_raw": "Region", "year_raw": "Tid"}, payload)
    out = rows.filter(F.col("obs_raw").isNotNull()).select(
        N.parse_int_round("region_code_raw").alias("region_code"),
        F.lpad("region_code_raw", 2, "0").alias("region_code_str"),
        N.strict_int("year_raw").alias("year"),
        N.parse_int_round("obs_raw", "bigint").alias("population"),
        F.lit("ALL").alias("gender"),
        NULL_STR().alias("age_group"),
    )
    return out.filter(F.col("year").isNotNull())


def stg_tid_diagnos(raw: DataFrame) -> DataFrame:
    """Emergency-department times by diagnosis group (monthly)."""
    typed = raw.select(
        N.parse_int_round(_c("Year")).alias("year"),
        F.to_date(_c("PERIOD")).alias("period_date"),
        F.trim(_c("Region")).alias("region_name"),
        F.trim(_c("Diagnosgrupp")).alias("diagnosgrupp"),
        F.trim(_c("Metric")).alias("indicator_name"),
        N.parse_decimal_or_dash(_c("Value")).alias("value"),
    )
    low = F.lower("indicator_name")
    labeled = typed.select(
        "region_name", "year",
        P.month_date("year", F.month("period_date")).alias("period_month"),
        F.lit("MONTH").alias("period_granularity"),
        F.lit(SYS_DIAGNOS).alias("source_system"),
        DIAGNOS_CODE("indicator_name").alias("source_indicator_code"),
        "indicator_name", "diagnosgrupp", "value",
        F.lit("ALL").alias("gender"),
        NULL_STR().alias("age_group"),
        PR.classify([(low.like(p), unit) for p, unit in DIAGNOS_UNIT_RULES]).alias("unit"),
    )
    # NULL region names are kept: the national rows are dropped through coalesce(lower(name), '')
    return labeled.filter(F.col("year").isNotNull()
                          & ~F.coalesce(F.lower("region_name"), F.lit("")).isin(*NATIONAL_NAMES))


def stg_tid_konalder(raw: DataFrame) -> DataFrame:
    """Emergency-department visits and times by gender and age (monthly)."""
    cleaned = raw.filter(_c("Value").isNotNull()).select(
        N.parse_int_round(_c("Year")).alias("year"),
        T.initcap_words(_c("Month")).alias("month_name"),
        F.trim(_c("Metric")).alias("metric_name"),
        N.parse_decimal(_c("Value")).alias("value"),
        F.trim(_c("Region/landsting/akutmottagning")).alias("region_name"),
        T.normalize_gender(_c("Kön")).alias("gender"),
        T.blank_to_null(_c("Ålder")).alias("age_group"),
        F.to_date(_c("PERIOD")).alias("period_date"),
    )
    return cleaned.filter(F.col("year").isNotNull()).select(
        "year",
        F.month("period_date").alias("month_number"),
        "month_name", "period_date",
        F.lit(SYS_KON_ALDER).alias("source_system"),
        F.col("metric_name").alias("indicator_name"),
        KON_ALDER_CODE("metric_name").alias("source_indicator_code"),
        "region_name", "gender", "age_group", "value",
    )

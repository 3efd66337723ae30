"""The 40 models wired together.

``Warehouse`` holds the raw sources and the taxonomy seed and exposes every
model as a lazily built attribute; nothing runs until an action.  The
dimensions (REF tables) are small and reused by many facts, so they are
materialized once as parquet under the shared checkpoint folder: that runs
their upstream plan once, cuts lineage, and lets the size-checked broadcast
read the row count from file metadata.  ``stg_dataexport`` (the one staging
model with a shuffle, read by four models) is written once too; facts are
written when ``materialize_facts`` (a full REF-layer build).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from indicatormart.plans import marts as M
from indicatormart.plans import reference as R
from indicatormart.plans import staging as S
from indicatormart.sources.sinks import materialize


@dataclass(frozen=True)
class Options:
    """Source-specific spellings; defaults are the fixed values of the modelled warehouse."""
    kpi_aliases: Sequence[tuple[str, str]] = R.KPI_REGION_ALIASES
    overcrowding_aliases: Sequence[tuple[str, str]] = R.OVERCROWDING_REGION_ALIASES
    visits_aliases: Sequence[tuple[str, str]] = R.VISITS_REGION_ALIASES
    overcrowding_special_names: Mapping[str, str] = field(
        default_factory=lambda: dict(S.OVERCROWDING_SPECIAL_NAMES))
    access_codes: Sequence[str] = M.ACCESS_KPI_CODES
    strict_null_calendar: bool = False
    #: Clean each distinct region spelling of a source once instead of each row's (one more narrow pass per source).
    spellings_once: bool = False


STAGING = ("stg_beds_intl", "stg_beds_region", "stg_dataexport", "stg_dim_region", "stg_expenditure_gdp",
           "stg_health_exp_gdp_intl", "stg_kolada", "stg_medical_personnel", "stg_net_cost",
           "stg_overcrowding", "stg_physicians_per1000", "stg_population", "stg_tid_diagnos",
           "stg_tid_konalder")
REFERENCE = ("dim_age_group", "dim_date", "dim_gender", "dim_indicator", "dim_region", "dim_region_geojson",
             "fct_beds_intl_y", "fct_capacity_yearly", "fct_ed_time_by_diagnosis_m",
             "fct_health_exp_gdp_intl_y", "fct_kolada_y", "fct_overcrowding_monthly",
             "fct_performance_monthly", "fct_performance_yearly", "fct_physicians_per_1000_y",
             "fct_visits_by_gender_age_m", "ref_physicians_per_1000_y")
MARTS = ("mart_access_monthly", "mart_access_yearly", "mart_beds_intl_y", "mart_emergency_yearly",
         "mart_health_exp_gdp_intl_y", "mart_physicians_per_1000_y", "mart_pressure_monthly",
         "mart_regional_explorer_monthly_long", "mart_resources_yearly")
MODELS = STAGING + REFERENCE + MARTS


class Warehouse:
    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], taxonomy: DataFrame,
                 options: Options | None = None, materialize_dims: bool = True,
                 materialize_facts: bool = False,
                 materialize_staging: Sequence[str] = ("stg_dataexport",)):
        self.spark = spark
        self.raw = dict(raw)
        self.taxonomy = taxonomy
        self.options = options or Options()
        self.materialize_dims = materialize_dims
        self.materialize_facts = materialize_facts
        self.materialize_staging = tuple(materialize_staging)

    def model(self, name: str) -> DataFrame:
        if name not in MODELS:
            raise KeyError(name)
        return getattr(self, name)

    def use(self, name: str, df: DataFrame) -> None:
        """Serve model ``name`` from ``df`` (e.g. its published table) for every
        model built after this call."""
        if name not in MODELS:
            raise KeyError(name)
        self.__dict__[name] = df

    def _stg(self, df: DataFrame, name: str) -> DataFrame:
        """Staging models are views; the ones listed in ``materialize_staging``
        (shuffle-heavy and read by several models) are written once instead."""
        return materialize(df, name) if name in self.materialize_staging else df

    def _dim(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.materialize_dims else df

    def _fact(self, df: DataFrame, name: str) -> DataFrame:
        """Facts are REF tables too; written once when the whole layer is built."""
        return materialize(df, name) if self.materialize_facts else df

    # staging
    @cached_property
    def stg_beds_intl(self): return S.stg_beds_intl(self.raw["BEDS_INTL_RAW"])
    @cached_property
    def stg_beds_region(self): return S.stg_beds_region(self.raw["BEDS_REGION_RAW"])
    @cached_property
    def stg_dataexport(self): return self._stg(S.stg_dataexport(self.raw["DATAEXPORT_RAW"]), "stg_dataexport")
    @cached_property
    def stg_dim_region(self): return S.stg_dim_region(self.raw["GEO_LAN_REGIONS_RAW"])
    @cached_property
    def stg_expenditure_gdp(self): return S.stg_expenditure_gdp(self.raw["EXPENDITURE_GDP_RAW"])
    @cached_property
    def stg_health_exp_gdp_intl(self): return S.stg_health_exp_gdp_intl(self.raw["HEALTH_EXPENDITURE_INTL_RAW"])
    @cached_property
    def stg_kolada(self): return S.stg_kolada(self.raw["KOLADA_RAW"])
    @cached_property
    def stg_medical_personnel(self): return S.stg_medical_personnel(self.raw["MEDICAL_PERSONNEL_RAW"])
    @cached_property
    def stg_net_cost(self): return S.stg_net_cost(self.raw["NET_COST_RAW"])
    @cached_property
    def stg_overcrowding(self):
        return S.stg_overcrowding(self.raw["OVERCROWDING_RAW"],
                                  special_names=dict(self.options.overcrowding_special_names))
    @cached_property
    def stg_physicians_per1000(self): return S.stg_physicians_per1000(self.raw["PHYSICIANSPER1000_RAW"])
    @cached_property
    def stg_population(self): return S.stg_population(self.raw["SCB_POPULATION_RAW"])
    @cached_property
    def stg_tid_diagnos(self): return S.stg_tid_diagnos(self.raw["STAT_DIAGNOS_RAW"])
    @cached_property
    def stg_tid_konalder(self): return S.stg_tid_konalder(self.raw["STAT_KON_ALDER_RAW"])

    def staging(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in STAGING}

    # dimensions
    @cached_property
    def dim_region(self): return self._dim(R.dim_region(self.stg_dim_region), "dim_region")
    @cached_property
    def dim_region_geojson(self): return R.dim_region_geojson(self.dim_region)
    @cached_property
    def dim_gender(self): return R.dim_gender(self.spark)
    @cached_property
    def dim_age_group(self): return self._dim(R.dim_age_group(self.stg_tid_konalder), "dim_age_group")
    @cached_property
    def dim_date(self):
        return self._dim(R.dim_date(self.stg_dataexport, self.stg_overcrowding, self.stg_tid_konalder,
                                    self.stg_tid_diagnos, self.options.strict_null_calendar), "dim_date")
    @cached_property
    def dim_indicator(self): return self._dim(R.dim_indicator(self.staging(), self.taxonomy), "dim_indicator")

    # facts
    @cached_property
    def fct_beds_intl_y(self):
        return self._fact(R.fct_beds_intl_y(self.stg_beds_intl, self.dim_indicator), "fct_beds_intl_y")

    @cached_property
    def fct_capacity_yearly(self):
        f = R.fct_capacity_yearly(self.stg_beds_region, self.stg_medical_personnel, self.stg_population,
                                  self.stg_net_cost, self.dim_region, self.dim_indicator)
        return self._fact(f, "fct_capacity_yearly")

    @cached_property
    def fct_ed_time_by_diagnosis_m(self):
        f = R.fct_ed_time_by_diagnosis_m(self.stg_tid_diagnos, self.dim_region, self.dim_indicator)
        return self._fact(f, "fct_ed_time_by_diagnosis_m")

    @cached_property
    def fct_health_exp_gdp_intl_y(self):
        f = R.fct_health_exp_gdp_intl_y(self.stg_health_exp_gdp_intl, self.dim_indicator)
        return self._fact(f, "fct_health_exp_gdp_intl_y")

    @cached_property
    def fct_kolada_y(self):
        f = R.fct_kolada_y(self.stg_kolada, self.dim_region, self.dim_gender, self.dim_indicator,
                           self.options.kpi_aliases, self.options.spellings_once)
        return self._fact(f, "fct_kolada_y")

    @cached_property
    def fct_overcrowding_monthly(self):
        f = R.fct_overcrowding_monthly(self.stg_overcrowding, self.dim_region, self.dim_indicator,
                                       self.options.overcrowding_aliases, self.options.spellings_once)
        return self._fact(f, "fct_overcrowding_monthly")

    @cached_property
    def fct_performance_monthly(self):
        f = R.fct_performance_monthly(self.stg_dataexport, self.dim_region, self.dim_gender, self.dim_indicator)
        return self._fact(f, "fct_performance_monthly")

    @cached_property
    def fct_performance_yearly(self):
        f = R.fct_performance_yearly(self.stg_dataexport, self.dim_region, self.dim_gender, self.dim_indicator)
        return self._fact(f, "fct_performance_yearly")

    @cached_property
    def ref_physicians_per_1000_y(self):
        f = R.ref_physicians_per_1000_y(self.stg_physicians_per1000, self.dim_region, self.dim_indicator)
        return self._fact(f, "ref_physicians_per_1000_y")

    @cached_property
    def fct_physicians_per_1000_y(self):
        return R.fct_physicians_per_1000_y(self.ref_physicians_per_1000_y)

    @cached_property
    def fct_visits_by_gender_age_m(self):
        f = R.fct_visits_by_gender_age_m(self.stg_tid_konalder, self.dim_region, self.dim_gender,
                                         self.dim_age_group, self.dim_indicator, self.options.visits_aliases,
                                         self.options.spellings_once)
        return self._fact(f, "fct_visits_by_gender_age_m")

    # marts
    @cached_property
    def mart_access_monthly(self): return M.mart_access_monthly(self.fct_performance_monthly, self.dim_indicator)
    @cached_property
    def mart_access_yearly(self):
        return M.mart_access_yearly(self.fct_kolada_y, self.dim_indicator, self.options.access_codes)
    @cached_property
    def mart_beds_intl_y(self): return M.mart_beds_intl_y(self.fct_beds_intl_y, self.dim_indicator)
    @cached_property
    def mart_emergency_yearly(self): return M.mart_emergency_yearly(self.fct_performance_yearly, self.dim_indicator)
    @cached_property
    def mart_health_exp_gdp_intl_y(self):
        return M.mart_health_exp_gdp_intl_y(self.fct_health_exp_gdp_intl_y, self.dim_date, self.dim_indicator)
    @cached_property
    def mart_physicians_per_1000_y(self):
        return M.mart_physicians_per_1000_y(self.fct_physicians_per_1000_y, self.dim_region, self.dim_indicator)
    @cached_property
    def mart_pressure_monthly(self):
        return M.mart_pressure_monthly(self.fct_overcrowding_monthly, self.fct_visits_by_gender_age_m,
                                       self.fct_ed_time_by_diagnosis_m, self.dim_indicator)
    @cached_property
    def mart_regional_explorer_monthly_long(self):
        return M.mart_regional_explorer_monthly_long(
            self.fct_performance_monthly, self.fct_overcrowding_monthly, self.fct_visits_by_gender_age_m,
            self.fct_capacity_yearly, self.fct_performance_yearly, self.fct_kolada_y, self.dim_indicator)
    @cached_property
    def mart_resources_yearly(self):
        return M.mart_resources_yearly(self.fct_capacity_yearly, self.fct_performance_yearly,
                                       self.fct_overcrowding_monthly, self.dim_date, self.dim_indicator)

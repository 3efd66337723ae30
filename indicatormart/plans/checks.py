"""The data tests declared for the models, run as Spark jobs over a built
warehouse (the test step that follows a build)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from indicatormart.operators.quality import check_model, run_checks
from indicatormart.sources.sinks import materialize

GENDER_CODES = ["F", "M", "ALL"]

# Declared tests of the staging models.
STAGING_TESTS = {
    "stg_kolada": {"not_null": ["region_name", "year", "source_indicator_code"], "warn": ["value"],
                   "accepted": {"gender": GENDER_CODES}},
    "stg_dataexport": {"not_null": ["region_name", "year", "source_indicator_code"], "warn": ["value"],
                       "accepted": {"gender": GENDER_CODES}},
    "stg_population": {"not_null": ["region_code", "year", "population"], "accepted": {"gender": ["ALL"]}},
    "stg_overcrowding": {"not_null": ["year"], "warn": ["value"],
                         "accepted": {"period_granularity": ["YEAR", "MONTH"], "gender": GENDER_CODES}},
    "stg_beds_region": {"not_null": ["year"], "warn": ["value"]},
    "stg_beds_intl": {"not_null": ["year"], "warn": ["value"]},
    "stg_expenditure_gdp": {"not_null": ["year"], "warn": ["value"]},
    "stg_tid_diagnos": {"not_null": ["region_name", "year"], "warn": ["value"]},
    "stg_tid_konalder": {"not_null": ["region_name", "year"], "warn": ["value"]},
    "stg_medical_personnel": {"not_null": ["year"], "warn": ["value"]},
    "stg_net_cost": {"not_null": ["year"], "warn": ["value"]},
}

# Declared tests of the dimension and fact models.
REFERENCE_TESTS = {
    "dim_region": {"not_null": ["region_key", "region_code_int", "region_name"],
                   "unique": ["region_key", "region_code_int"]},
    "dim_date": {"not_null": ["date_key", "month_date"], "unique": ["date_key"]},
    "dim_gender": {"not_null": ["gender_key"], "unique": ["gender_key"], "accepted": {"gender_code": GENDER_CODES}},
    "dim_age_group": {"not_null": ["age_key", "age_group_label"], "unique": ["age_key"]},
    "dim_indicator": {"not_null": ["indicator_key", "source_system", "source_indicator_code"],
                      "unique": ["indicator_key"], "accepted": {"default_granularity": ["MONTH", "YEAR"]}},
    "fct_performance_monthly": {
        "combinations": [["region_key", "date_key", "indicator_key", "gender_key"]],
        "not_null": ["region_key", "date_key", "indicator_key", "value"],
        "relationships": {"region_key": ("dim_region", "region_key"), "date_key": ("dim_date", "date_key"),
                          "indicator_key": ("dim_indicator", "indicator_key")}},
    "fct_performance_yearly": {
        "combinations": [["region_key", "year", "indicator_key", "gender_key"]],
        "not_null": ["region_key", "year", "indicator_key", "value"],
        "relationships": {"region_key": ("dim_region", "region_key"),
                          "indicator_key": ("dim_indicator", "indicator_key")}},
    "fct_overcrowding_monthly": {
        "combinations": [["region_key", "date_key", "indicator_key"]],
        "not_null": ["region_key", "date_key", "indicator_key", "value"],
        "relationships": {"region_key": ("dim_region", "region_key"), "date_key": ("dim_date", "date_key"),
                          "indicator_key": ("dim_indicator", "indicator_key")}},
    "fct_visits_by_gender_age_m": {
        "combinations": [["region_key", "date_key", "gender_key", "age_key", "indicator_key"]],
        "not_null": ["region_key", "date_key", "gender_key", "age_key", "indicator_key", "value"],
        "relationships": {"region_key": ("dim_region", "region_key"), "date_key": ("dim_date", "date_key"),
                          "gender_key": ("dim_gender", "gender_key"), "age_key": ("dim_age_group", "age_key"),
                          "indicator_key": ("dim_indicator", "indicator_key")}},
    "fct_capacity_yearly": {
        "combinations": [["region_key", "year", "metric_type", "indicator_key"]],
        "not_null": ["region_key", "year", "indicator_key", "value"],
        "accepted": {"metric_type": ["BEDS_PER_1000", "STAFF_HEADCOUNT", "POPULATION", "NET_COST_SEK"]},
        "relationships": {"region_key": ("dim_region", "region_key"),
                          "indicator_key": ("dim_indicator", "indicator_key")}},
    "fct_kolada_y": {
        "combinations": [["region_key", "year", "gender_key", "indicator_key"]],
        "not_null": ["region_key", "year", "indicator_key", "value"],
        "relationships": {"region_key": ("dim_region", "region_key"),
                          "indicator_key": ("dim_indicator", "indicator_key")}},
    "fct_beds_intl_y": {"not_null": ["country_name", "year", "indicator_key"],
                        "relationships": {"indicator_key": ("dim_indicator", "indicator_key")}},
    "ref_physicians_per_1000_y": {"combinations": [["region_key", "date_key"]],
                                  "not_null": ["region_key", "date_key", "value"]},
    "fct_physicians_per_1000_y": {"combinations": [["region_key", "date_key"]],
                                  "not_null": ["region_key", "date_key", "value"]},
}


def run_declared(wh, tests: dict) -> DataFrame:
    """One report row per declared test of the listed models.

    A model with grain or unique tests is read several times; facts that the
    warehouse has not written are written first.  Large written tables get the
    uniqueness sketch (their row count is in the footers).
    """
    parts = []
    for model, spec in tests.items():
        table = wh.model(model)
        if spec.get("combinations") and not wh.materialize_facts:
            table = materialize(table, f"checked_{model}")
        written = bool(spec.get("combinations")) or model.startswith("dim_")
        rel = {c: (wh.model(parent), pcol) for c, (parent, pcol) in spec.get("relationships", {}).items()}
        parts.append(check_model(table, model, not_null=spec.get("not_null", ()),
                                 warn_not_null=spec.get("warn", ()), accepted=spec.get("accepted"),
                                 relationships=rel, unique=spec.get("unique", ()),
                                 combinations=spec.get("combinations", ()), sketch=None if written else False))
    return run_checks(parts)


def staging_checks(wh) -> DataFrame:
    return run_declared(wh, STAGING_TESTS)


def reference_checks(wh) -> DataFrame:
    return run_declared(wh, REFERENCE_TESTS)

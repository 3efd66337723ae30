"""End to end on a tiny warehouse with the modelled warehouse's own spellings
and default options (alias maps, special names, taxonomy seed)."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from indicatormart.plans.checks import reference_checks, staging_checks
from indicatormart.plans.warehouse import MODELS, Warehouse
from indicatormart.sources import schemas as S
from indicatormart.sources.readers import load_seed

SEED = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                    "indicatormart", "seeds", "dim_indicator_taxonomy.csv")


def _strings(spark, cols, data):
    return spark.createDataFrame(data, S.string_schema(cols))


def _doc(spark, schema, doc):
    return spark.createDataFrame([(doc,)], StructType([StructField("payload", schema)]))


@pytest.fixture(scope="module")
def wh(spark):
    geo = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"scb_lan_code_2": c, "region_name_official": n},
         "geometry": {"type": "Point", "coordinates": [int(c), 0]}}
        for c, n in [("1", "Stockholms"), ("6", "Jönköpings"), ("14", "Västra Götalands"), ("4", "Södermanlands")]]}
    pop = {"columns": [{"code": "Region", "text": "region", "type": "d"}, {"code": "Tid", "text": "år", "type": "t"}],
           "data": [{"key": ["01", "2024"], "values": ["2400000"]}, {"key": ["06", "2024"], "values": ["370000"]},
                    {"key": ["14", "2024"], "values": ["1700000"]}]}
    kolada = _strings(spark, list(S.KOLADA_COLS) + ["2023", "2024"], [
        ("Region Stockholm", "Totalt", "N79240", "Väntetid", "d", "10", "12"),
        ("Region Jönköpings län", "K", "N79241", "Väntetid", "d", "5", None),
        ("Västra Götalandsregionen", "M", "N79242", "Väntetid", "d", None, "7"),
        ("Region Sörmland", "Totalt", "N79243", "Väntetid", "d", "1", "1"),
        ("Alla regioner, ovägt", "Totalt", "N79243", "Väntetid", "d", "99", "99"),
    ])
    dataexport = _strings(spark, S.DATAEXPORT_COLS, [
        ("Region Stockholm", "Region", "1", "u", "Totalt", "467cfcf1-208b-486c-baf5-a4a358040b98", "Väntetid",
         "dagar", "2024-03", "12,5", "10", "80"),
        ("Region Stockholm", "Region", "1", "u", "Totalt", "467cfcf1-208b-486c-baf5-a4a358040b98", "Väntetid",
         "dagar", "2024", "99", "1", "1"),
        ("Region Jönköping", "Region", "6", "u", "Totalt", "amb-1", "Responstid för ambulans vid prio 1-larm",
         "", "2024", "14,5", "", ""),
    ])
    overcrowding = spark.createDataFrame([("mars 2024", "5", "3", "9", "2")],
                                         "CATEGORY string, `Region Stockholm` string, `Region Jönköpings län` string, "
                                         "`Västra Götalandsregionen` string, `Region Sörmland` string")
    beds_region = spark.createDataFrame(
        [("Region Stockholm", "Region", "1", "ab0dd634-b383-4233-8c79-16d968488e53", "Vårdplatser", "d", "2024", 2.1,
          "k")], "Enhetsnamn string, Enhetstyp string, Regionskod string, `Indikator-Id` string, Titel string, "
                 "Diagramrubrik string, `Mätperiod` string, `Värde` double, `Register/källa` string")
    beds_intl = spark.createDataFrame([("SWE", "Sweden", 2.0, "Beds", "Per 1 000", 2024)],
                                      "REF_AREA string, `Reference area` string, OBS_VALUE double, STRUCTURE_NAME string, "
                                      "`Unit of measure` string, TIME_PERIOD int")
    personnel = spark.createDataFrame([(2024, "Läkare", "Stockholms län", "Män", 100.0),
                                       (2024, "Sjuksköterska", "Stockholms län", "Kvinnor", 300.0),
                                       (2024, "Läkare", "Riket", "Män", 9999.0)],
                                      f"`År` int, Grupp string, `Område` string, `Kön` string, "
                                      f"`{S.PERSONNEL_VALUE_COL}` double")
    net_cost = _strings(spark, S.NET_COST_COLS, [
        ("Region Stockholm", "01", "Region", "Totalt", "", "2024", "kr", "30000",
         "Nettokostnad för hälso- och sjukvård", "", "k")])
    expenditure = spark.createDataFrame([(2024, 600000.0, 6000000.0, 10.0)],
                                        "Year int, `Totala hälso- och sjukvårdsutgifter, mnkr` double, "
                                        "`BNP till marknadspris, mnkr` double, `BNP relationstal, procent` double")
    kon_alder = _strings(spark, S.KON_ALDER_COLS, [
        ("2024", "mars", "Antal besök", "120", "Stockholm", "Kvinnor", "18-29", "2024-03-01"),
        ("2024", "mars", "Median tid till läkare i minuter", "45", "Jönköping", "Män", "80+", "2024-03-01")])
    diagnos = _strings(spark, S.DIAGNOS_COLS, [
        ("2024", "mars", "Median tid till läkare i minuter", "50,5", "Stockholm", "Buksmärta", "2024-03-01"),
        ("2024", "mars", "Antal besök", "7", "Riket", "Buksmärta", "2024-03-01")])
    physicians = _strings(spark, S.PHYSICIANS_COLS, [("STOCKHOLM", "2024", "4.5")])
    health = _strings(spark, S.HEALTH_INTL_COLS, [("Sweden", "2024", "10,725", "% of GDP")])
    raw = {"KOLADA_RAW": kolada, "DATAEXPORT_RAW": dataexport, "SCB_POPULATION_RAW": _doc(spark, S.PXWEB_SCHEMA, pop),
           "GEO_LAN_REGIONS_RAW": _doc(spark, S.GEOJSON_SCHEMA, geo), "OVERCROWDING_RAW": overcrowding,
           "BEDS_REGION_RAW": beds_region, "BEDS_INTL_RAW": beds_intl, "MEDICAL_PERSONNEL_RAW": personnel,
           "NET_COST_RAW": net_cost, "EXPENDITURE_GDP_RAW": expenditure, "STAT_KON_ALDER_RAW": kon_alder,
           "STAT_DIAGNOS_RAW": diagnos, "PHYSICIANSPER1000_RAW": physicians, "HEALTH_EXPENDITURE_INTL_RAW": health}
    return Warehouse(spark, raw, load_seed(spark, SEED, S.TAXONOMY_SCHEMA))


def test_every_model_builds(wh):
    for name in MODELS:
        assert wh.model(name).count() >= 0, name


def test_name_resolution_with_default_aliases(wh):
    names = {r.region_key: r.region_name for r in wh.dim_region.collect()}
    kpi = [(names[r.region_key], r.year, r.value) for r in wh.fct_kolada_y.collect()]
    assert sorted(kpi) == sorted([("Stockholm", 2023, 10.0), ("Stockholm", 2024, 12.0), ("Jönköping", 2023, 5.0),
                                  ("Södermanland", 2023, 1.0), ("Södermanland", 2024, 1.0),
                                  ("Västra Götaland", 2024, 7.0)])
    overc = sorted((names.get(r.region_key), r.value) for r in wh.fct_overcrowding_monthly.collect())
    assert overc == [("Jönköping", 3.0), ("Stockholm", 5.0), ("Södermanland", 2.0), ("Västra Götaland", 9.0)]
    assert wh.mart_access_yearly.count() == 6   # all four guarantee codes are WAITING_TIME in the seed


def test_resources_mart(wh):
    names = {r.region_key: r.region_name for r in wh.dim_region.collect()}
    res = {(names.get(r.region_key), r.year): r for r in wh.mart_resources_yearly.collect()}
    sth = res[("Stockholm", 2024)]
    assert (sth.population, sth.staff_doctors, sth.staff_nurses, sth.beds_per_1000, sth.cost_per_capita) == \
        (2400000.0, 100.0, 300.0, 2.1, 30000.0)
    assert sth.doctors_per_1000 == pytest.approx(100.0 / 2400000.0 * 1000)
    assert sth.displaced_patients_year == 5.0
    assert res[("Jönköping", 2024)].ambulance_time_min == 14.5


def test_marts_and_quirks(wh):
    emergency = wh.mart_emergency_yearly.collect()
    assert [(r.metric_kind, r.unit, r.value) for r in emergency] == [("MINUTES", "minuter", 14.5)]
    pressure = {(r.metric_kind, r.source_system) for r in wh.mart_pressure_monthly.collect()}
    assert ("MINUTES", "STAT_DIAGNOS") in pressure and ("COUNT", "OVERCROWDING") in pressure
    explorer = {r.metric_code for r in wh.mart_regional_explorer_monthly_long.filter(F.col("theme") == "DEMAND")
                .collect()}
    assert {"antal_besök", "VISITS_TOTAL"} <= explorer          # the median row lands under VISITS_TOTAL
    phys = wh.mart_physicians_per_1000_y.collect()
    assert [(r.region_name, r.topic, r.value) for r in phys] == [("Stockholm", "CAPACITY", 4.5)]
    health = wh.mart_health_exp_gdp_intl_y.collect()
    # year comes from the calendar, which spans only the monthly sources (March 2024): NULL here
    assert [(r.value, r.date_key, r.year) for r in health] == [(10.73, 20240101, None)]


def test_declared_checks(wh):
    stg = {(r.table_name, r.check_name, r.column_name): r.status for r in staging_checks(wh).collect()}
    assert stg[("stg_kolada", "not_null", "region_name")] == "pass"
    ref = {(r.table_name, r.check_name, r.column_name): r.status for r in reference_checks(wh).collect()}
    assert ref[("dim_region", "unique", "region_key")] == "pass"
    assert ref[("fct_kolada_y", "unique_combination_of_columns", "region_key,year,gender_key,indicator_key")] == "pass"
    assert len(stg) == 34 and len(ref) == 81


def test_build_publishes_every_model(spark, wh, tmp_path):
    from indicatormart.plans.build import build_warehouse
    out = build_warehouse(wh, str(tmp_path / "lake"), ref_database="im_fixture_ref",
                          partitions={"fct_kolada_y": ["year"]})
    assert len(out) == len(MODELS)
    kpi = spark.table("im_fixture_ref.fct_kolada_y")
    assert kpi.count() == 6
    pruned = kpi.filter("year = 2024")
    assert pruned.count() == 3
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()
    assert spark.sql("SELECT count(*) AS n FROM mart_resources_yearly").first().n > 0


def test_registry_makes_codes_of_distinct_names(wh):
    """The regular expressions that make codes from names stand above a reduction to distinct names."""
    from indicatormart.functions.text import SLUG_RE
    from indicatormart.plans import reference as R
    union = R.indicator_union(wh.staging())
    lines = union._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [i for i, line in enumerate(lines) if SLUG_RE in line]
    assert len(made) == 2
    for line in (lines[i].lstrip(" :+-") for i in made):      # Aggregate [what it groups by], [what it gives]
        by, gives = line.split("], [", 1)
        assert line.startswith("Aggregate [") and SLUG_RE not in by and SLUG_RE in gives
    for name in ("stg_tid_konalder", "stg_tid_diagnos", "stg_medical_personnel", "stg_net_cost"):
        staged = wh.model(name).select("source_system", "source_indicator_code", "indicator_name").distinct()
        assert staged.count() and staged.subtract(union.select(*staged.columns)).count() == 0

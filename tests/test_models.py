"""Staging, reference and mart models on small raw extracts (FIXTURES.md traps)."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from indicatormart.plans import marts as M
from indicatormart.plans import reference as R
from indicatormart.plans import staging as STG
from indicatormart.sources import schemas as S


def _raw(spark, cols, data):
    return spark.createDataFrame(data, S.string_schema(cols))


def test_stg_kolada_regions_and_genders(spark):
    cols = list(S.KOLADA_COLS) + ["2023", "2024"]
    raw = _raw(spark, cols, [
        ("Region Skåne", "kvinnor", " N79240 ", "Väntetid ", "d", "1.5", None),
        ("Regionen X", "MÄN", "N79240", "Väntetid", "d", None, "2"),
        ("Alla regioner, ovägt", "Totalt", "N79240", "Väntetid", "d", "9", "9"),
        ("Region Jönköpings län", None, "N79240", "Väntetid", "d", "3", None),
    ])
    out = STG.stg_kolada(raw)
    got = rows(out, "region_name", "year", "source_indicator_code", "value", "gender")
    assert got == [("Jönköpings län", 2023, "n79240", 3.0, "ALL"), ("Skåne", 2023, "n79240", 1.5, "F"),
                   ("X", 2024, "n79240", 2.0, "M")]


def test_stg_medical_personnel_drops_aggregates(spark):
    raw = spark.createDataFrame([
        (2024, "Läkare", "Stockholms län", "Kvinnor", 10.0),
        (2024, "Läkare", "KALMAR LÄN", "män", 5.0),
        (2024, "Läkare", "Riket", "Män", 99.0),
        (2024, "Läkare", "Sjukvårdsregion Norr", "Män", 99.0),
        (2024, "Specialist läkare", None, "Män", 99.0),
    ], f"`År` int, Grupp string, `Område` string, `Kön` string, `{S.PERSONNEL_VALUE_COL}` double")
    got = rows(STG.stg_medical_personnel(raw), "region_name", "source_indicator_code", "gender", "value")
    assert got == [("KALMAR", "l_kare", "M", 5.0), ("Stockholm", "l_kare", "F", 10.0)]


def test_stg_overcrowding_category_and_columns(spark):
    raw = spark.createDataFrame([("mars 2024", "4", None, "7"), ("foo 2024", "1", "1", "1")],
                                "CATEGORY string, `Region Jönköpings län` string, `Region Gotland` string, "
                                "`Västra Götalandsregionen` string")
    got = rows(STG.stg_overcrowding(raw), "period_month", "region_name", "value")
    assert got == [(dt.date(2024, 3, 1), "Jönköpings", 4.0), (dt.date(2024, 3, 1), "Västra Götaland", 7.0)]


def test_stg_dataexport_grain_and_numbers(spark):
    cols = list(S.DATAEXPORT_COLS)
    base = (" Region A ", "Region", "1", "u1")
    raw = _raw(spark, cols, [
        base + ("Kvinnor", "X1", "T", "dagar", "2024", "10", "1,5", "3"),        # YEAR dropped (monthly exists)
        base + ("Kvinnor", "X1", "T", "dagar", "2024-03", "1 234,5 %", "1,5", "3"),
        base + ("K", "X1", "T", "", "2024", "1.234,5", "2", "4"),                # kept: raw gender differs
        base + ("Kvinnor", "X1", "T", "", "2024-Q1", "--", None, None),            # UNKNOWN kept
        (" B ", "Sjukhus", "2", "u2", "Män", "X1", "T", "", "2024", "1", "1", "1"),  # not a region row
    ])
    out = STG.stg_dataexport(raw)
    got = rows(out, "period_granularity", "period_month", "value", "numerator", "gender", "unit", "period_filter_label")
    assert got == [("MONTH", dt.date(2024, 3, 1), 1234.5, 15.0, "F", "dagar", "2024-03"),
                   ("UNKNOWN", None, None, None, "F", None, "2024"),
                   ("YEAR", None, None, 2.0, "F", None, "2024")]


def test_stg_tid_diagnos_codes_and_units(spark):
    raw = _raw(spark, S.DIAGNOS_COLS, [
        ("2024", "mars", "Antal besök", "12", "Region A", "Infektion", "2024-03-01"),
        ("2024", "mars", "Median tid till läkare i minuter", "--", "Region A", "Infektion", "2024-03-01"),
        ("2024", "mars", "Antal besök", "5", "Riket", "Infektion", "2024-03-01"),
    ])
    got = rows(STG.stg_tid_diagnos(raw), "source_indicator_code", "unit", "value", "period_month")
    assert got == [("antal be_ök", "antal", 12.0, dt.date(2024, 3, 1)),
                   ("median tid till läkare i minuter", "minuter", None, dt.date(2024, 3, 1))]


def test_registry_one_row_per_code_month_first(spark):
    """One code with both grains (and a NULL unit) -> exactly one registry row, MONTH by the tiebreak."""
    base = spark.createDataFrame(
        [("DATAEXPORT", "x1", "Name", "dagar", "MONTH"), ("DATAEXPORT", "x1", "Name", "dagar", "YEAR"),
         ("DATAEXPORT", "x1", "Name", None, "MONTH")],
        "source_system string, source_indicator_code string, indicator_name string, unit string, "
        "period_granularity string")
    one = R.first_by(R._registry_rows(base, F.col("period_granularity")), ["source_system", "source_indicator_code"],
                     ["indicator_name", "unit", "default_granularity"])
    assert rows(one, "unit", "default_granularity") == [("dagar", "MONTH")]


def test_resource_roles_whole_string(spark):
    dim = spark.createDataFrame([
        ("k1", "MEDICAL_PERSONNEL", "l_kare", "läkare", "CAPACITY"),
        ("k2", "MEDICAL_PERSONNEL", "x", "specialist läkare", "CAPACITY"),
        ("k3", "SCB", "population", "Population", None),
        ("k4", "DATAEXPORT", "a", "Responstid för ambulans vid prio 1-larm", None),
        ("k5", "NET_COST", "n", "Nettokostnad", "COST"),
    ], "indicator_key string, source_system string, source_indicator_code string, indicator_name string, topic string")
    got = dict(rows(M.resource_roles(dim)))
    assert got == {"k1": "STAFF_DOCTORS", "k2": "STAFF_OTHER", "k3": "POPULATION", "k4": "AMBULANCE_TIME_MIN",
                   "k5": "COST_PER_CAPITA"}


def test_resources_ratio_guard(spark):
    cap = spark.createDataFrame([("r", 2024, "i_doc", 5.0), ("r", 2024, "i_pop", 0.0), ("s", 2024, "i_doc", 2.0)],
                                "region_key string, year int, indicator_key string, value double")
    dim = spark.createDataFrame([("i_doc", "MEDICAL_PERSONNEL", "l_kare", "Läkare", "CAPACITY"),
                                 ("i_pop", "SCB", "POPULATION", "Population", "CAPACITY")],
                                "indicator_key string, source_system string, source_indicator_code string, "
                                "indicator_name string, topic string")
    empty_y = spark.createDataFrame([], "region_key string, year int, indicator_key string, value double")
    empty_m = spark.createDataFrame([], "region_key string, date_key int, indicator_key string, value double")
    cal = spark.createDataFrame([], "date_key int, year int")
    out = {r.region_key: r for r in M.mart_resources_yearly(cap, empty_y, empty_m, cal, dim).collect()}
    assert out["r"].staff_doctors == 5.0 and out["r"].population == 0.0 and out["r"].doctors_per_1000 is None
    assert out["s"].population is None and out["s"].doctors_per_1000 is None


def test_demand_left_join_keeps_other_topics(spark):
    visits = spark.createDataFrame([("r", 20240301, "k_dem", 2.0), ("r", 20240301, "k_med", 30.0)],
                                   "region_key string, date_key int, indicator_key string, value double")
    di = spark.createDataFrame([("k_dem", "DEMAND", "NEUTRAL", "antal_besök", "Antal besök"),
                                ("k_med", "PRESSURE", "NEG", "median", "Median")],
                               "indicator_key string, topic string, polarity string, source_indicator_code string, "
                               "indicator_name string")
    got = rows(M.demand_visits(visits, di), "metric_code", "value")
    assert got == [("VISITS_TOTAL", 30.0), ("antal_besök", 2.0)]

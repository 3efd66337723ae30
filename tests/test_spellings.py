"""Names resolved through a dictionary of their distinct spellings."""
import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from indicatormart.functions import text as T
from indicatormart.operators import joins as J

SF = "/root/testdata/sf0.001"
NAMES = ["Region Kalmar län", "kalmar", "Kalmar", "  Kalmar  län", "Region  Kalmar", None, "", "Okänd", "Region Örebro län"]


def _frames(spark):
    facts = spark.createDataFrame([(i, NAMES[i % len(NAMES)]) for i in range(90)], "id int, name string").repartition(4)
    dim = spark.createDataFrame([("k1", "Kalmar"), ("k2", "Örebro"), ("k3", "KALMAR"), ("k4", None)],
                                "region_key string, region_name string")
    return facts, dim


@pytest.mark.parametrize("keep", [True, False])
def test_same_keys_as_row_by_row(spark, keep):
    facts, dim = _frames(spark)        # two dimension rows have one cleaned name: facts fan out both ways
    args = (facts, dim, "name", "region_name", "region_key", T.region_name_norm, keep)
    once, each = J.resolve_key(*args, spellings_once=True), J.resolve_key(*args)
    assert once.columns == each.columns and rows(once) == rows(each) and once.count() > 0
    none = J.resolve_key(facts.limit(0), *args[1:], spellings_once=True)
    assert none.count() == 0


def test_no_cleaning_runs_per_row(spark):
    facts, dim = _frames(spark)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def clean(name):
        seen.add(1)
        return (name or "").strip().lower() or None

    def calls(**how):
        seen.value = 0
        J.resolve_key(facts, dim, "name", "region_name", "region_key", clean, **how).collect()
        return seen.value

    each, once = calls(), calls(spellings_once=True)
    assert each >= 80 and once < 30
    plan = J.resolve_key(facts, dim, "name", "region_name", "region_key", T.region_name_norm, spellings_once=True) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "BroadcastHashJoin" in plan


def test_too_many_spellings_are_cleaned_row_by_row(spark, monkeypatch):
    facts, dim = _frames(spark)
    want = rows(J.resolve_key(facts, dim, "name", "region_name", "region_key", T.region_name_norm))
    monkeypatch.setattr(J, "is_small", lambda *_: False)
    got = J.resolve_key(facts, dim, "name", "region_name", "region_key", T.region_name_norm, spellings_once=True)
    assert rows(got) == want


@pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="test tables not present")
def test_facts_are_the_same_either_way(spark):
    from indicatormart.plans.warehouse import Warehouse
    from indicatormart.sources.standins import standin_warehouse
    wh = standin_warehouse(spark, SF)
    other = Warehouse(spark, wh.raw, wh.taxonomy, dataclasses.replace(wh.options, spellings_once=True))
    for name in ("dim_region", "dim_indicator", "dim_age_group"):
        other.use(name, wh.model(name))
    for fact in ("fct_kolada_y", "fct_overcrowding_monthly", "fct_visits_by_gender_age_m"):
        assert rows(other.model(fact)) == rows(wh.model(fact)), fact

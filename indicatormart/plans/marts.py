"""Marts: fact x indicator views for dashboards.

Quirks of the modelled marts are kept as they are (documented per function):
a topic predicate inside a LEFT join's ON clause, visit counts labelled
MINUTES in the diagnosis branch, medians summed into VISITS_TOTAL.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.functions import numbers as N
from indicatormart.functions import periods as P
from indicatormart.functions import text as T
from indicatormart.operators import joins as J
from indicatormart.operators.aggregates import exact_avg, exact_sum
from indicatormart.operators.predicates import classify, filter_topic
from indicatormart.operators.reshape import pivot_roles
from indicatormart.operators.setops import union_all

# Waiting-time guarantee KPI codes (median days) shown in the yearly access mart.
ACCESS_KPI_CODES = ("n79241", "n79240", "n79242", "n79243")

# Whole-string patterns used to classify indicators.
VISITS_PATTERN = "antal.*bes(ö|o)k|bes_k"
BEDS_PATTERN = "(vårdplatser|beds)"
DOCTORS_PATTERN = "(läkare)"
NURSES_PATTERN = "(sjuksköterska|sjukskoterska|röntgensjuksköterska|rontgensjukskoterska)"
AMBULANCE_TIME_PATTERN = "responstid för ambulans vid prio 1-larm"
AMBULANCE_COUNT_PATTERN = "ambulanslarm per invånare – prio1-larm|ambulanslarm per invånare - prio1-larm"

# LIKE patterns on lower-cased indicator names / codes.
AMBULANCE_NAME_LIKE = "%responstid för ambulans%"
AMBULANCE_CODE_LIKE = "%ambulans%"
DOCTOR_TIME_CODE_LIKE = "%median_tid_till_läkare%"
DISPLACED_CODE_LIKE = "%displaced%"
VISITS_CODE_LIKE = "%besök%"

# Defaults and labels of the marts.
BEDS_INTL_DEFAULTS = ("Hospital beds per 1,000 inhabitants", "CAPACITY", "Per 1 000 inhabitants")
HEALTH_EXP_DEFAULTS = ("Health expenditure (% of GDP)", "COST", "% of GDP")
PHYSICIANS_DEFAULTS = ("Doctors per 1000 inhabitants", "CAPACITY", "Per 1000 inhabitants")
DEFAULT_SOURCE_SYSTEM = "OECD_HEALTH"
VISITS_TOTAL = ("VISITS_TOTAL", "ED visits (total)")
EXPLORER_YEARLY_TOPICS = ("CAPACITY", "COST", "WAITING_TIME", "DEMAND")


def NULL_STR():
    return F.lit(None).cast("string")


def _with_indicator(fact: DataFrame, dim_ind: DataFrame, cols: Sequence[str], how: str = "inner",
                    size_base: DataFrame | None = None) -> DataFrame:
    """Fact joined to indicator columns by key (inner drops NULL keys).
    ``size_base``: the registry a derived indicator frame was filtered from."""
    return J.lookup(fact, dim_ind, [F.col("indicator_key")], [F.col("indicator_key")],
                    {c: f"d_{c}" for c in cols}, how=how, size_base=size_base)


def mart_access_monthly(fct_perf_m: DataFrame, dim_ind: DataFrame) -> DataFrame:
    cols = ["source_system", "source_indicator_code", "indicator_name", "unit", "topic"]
    f = _with_indicator(fct_perf_m.drop("unit"), dim_ind, cols)
    f = filter_topic(f, ["WAITING_TIME"], "d_topic")
    return f.select("region_key", "date_key", "gender_key", "indicator_key",
                    F.col("d_source_system").alias("source_system"),
                    F.col("d_source_indicator_code").alias("source_indicator_code"),
                    F.col("d_indicator_name").alias("indicator_name"),
                    F.col("d_unit").alias("unit"), "value", "numerator", "denominator")


def mart_access_yearly(fct_kolada: DataFrame, dim_ind: DataFrame,
                       codes: Sequence[str] = ACCESS_KPI_CODES) -> DataFrame:
    cols = ["source_system", "source_indicator_code", "indicator_name", "unit", "topic"]
    f = _with_indicator(fct_kolada, dim_ind, cols)
    f = filter_topic(f, ["WAITING_TIME"], "d_topic").filter(F.col("d_source_indicator_code").isin(*codes))
    return f.select("region_key", "year", P.year_key("year").alias("date_key"), "gender_key", "indicator_key",
                    F.col("d_source_system").alias("source_system"),
                    F.col("d_source_indicator_code").alias("source_indicator_code"),
                    F.col("d_indicator_name").alias("indicator_name"),
                    F.col("d_unit").alias("unit"), "value")


def _intl(fact: DataFrame, dim_ind: DataFrame, name: str, topic: str, unit: str) -> DataFrame:
    f = _with_indicator(fact, dim_ind, ["indicator_name", "topic", "source_system"], how="left")
    return f.withColumns({
        "indicator_name": F.coalesce("d_indicator_name", F.lit(name)),
        "topic": F.coalesce("d_topic", F.lit(topic)),
        "source_system": F.coalesce("d_source_system", F.lit(DEFAULT_SOURCE_SYSTEM)),
        "unit": F.lit(unit),
    })


def mart_beds_intl_y(fct_beds_intl: DataFrame, dim_ind: DataFrame) -> DataFrame:
    """International beds with defaults.  The calendar join of the modelled
    view contributes no column and cannot fan out (date_key is unique), so it
    is left out."""
    f = fct_beds_intl.withColumn("date_key", P.year_key("year"))
    f = _intl(f, dim_ind, *BEDS_INTL_DEFAULTS)
    return f.select("country_name", "date_key", "year", "indicator_key", "indicator_name", "topic",
                    "source_system", "value", "unit")


def mart_health_exp_gdp_intl_y(fct_health: DataFrame, dim_dt: DataFrame, dim_ind: DataFrame) -> DataFrame:
    """Health expenditure with defaults; ``year`` comes from the calendar, so
    it is NULL for years outside the monthly sources' span."""
    f = J.lookup(fct_health, dim_dt, [F.col("date_key")], [F.col("date_key")], ["year"])
    f = _intl(f, dim_ind, *HEALTH_EXP_DEFAULTS)
    return f.select("country_name", "date_key", "year", "indicator_key", "indicator_name", "topic",
                    "source_system", "value", "unit")


def mart_physicians_per_1000_y(fct_phys: DataFrame, dim_reg: DataFrame, dim_ind: DataFrame) -> DataFrame:
    f = J.lookup(fct_phys, dim_reg, [F.col("region_key")], [F.col("region_key")], ["region_name"])
    f = _intl(f, dim_ind, *PHYSICIANS_DEFAULTS)
    return f.select("region_key", "region_name", "date_key", "year", "indicator_key", "indicator_name",
                    "topic", "source_system", "value", "unit")


def mart_emergency_yearly(fct_perf_y: DataFrame, dim_ind: DataFrame) -> DataFrame:
    """Ambulance indicators; every match is labelled MINUTES."""
    cols = ["source_system", "source_indicator_code", "indicator_name", "unit"]
    f = _with_indicator(fct_perf_y.drop("unit"), dim_ind, cols)
    f = f.filter(F.lower("d_indicator_name").like(AMBULANCE_NAME_LIKE)
                 | F.lower("d_source_indicator_code").like(AMBULANCE_CODE_LIKE))
    return f.select("region_key", "year",
                    F.col("d_source_system").alias("source_system"),
                    F.col("d_source_indicator_code").alias("source_indicator_code"),
                    F.col("d_indicator_name").alias("indicator_name"),
                    F.coalesce("d_unit", F.lit("minuter")).alias("unit"),
                    F.lit("MINUTES").alias("metric_kind"), "value")


def pressure_indicators(dim_ind: DataFrame) -> DataFrame:
    """PRESSURE topic, or visit-count indicators of the ED statistics, with a unit guess."""
    code = F.lower("source_indicator_code")
    label = F.lower(F.concat(F.col("source_indicator_code"), F.lit(" "), F.col("indicator_name")))
    unit = F.coalesce(F.col("unit"), classify([
        (code.like(DOCTOR_TIME_CODE_LIKE), "minuter"),
        (code.like(DISPLACED_CODE_LIKE), "antal"),
        (code.like(VISITS_CODE_LIKE), "antal")]))
    keep = (F.upper(F.coalesce("topic", F.lit(""))) == "PRESSURE") | (
        F.upper("source_system").isin("STAT_KON_ALDER", "STAT_DIAGNOS")
        & F.coalesce(P.full_match(label, VISITS_PATTERN), F.lit(False)))
    return dim_ind.filter(keep).select("indicator_key", "source_system", "source_indicator_code",
                                       "indicator_name", unit.alias("unit"))


def mart_pressure_monthly(fct_overc: DataFrame, fct_visits: DataFrame, fct_diag: DataFrame,
                          dim_ind: DataFrame, strict: bool = False) -> DataFrame:
    """Monthly pressure: displaced patients, median time to doctor and visit
    counts by gender/age, and times by diagnosis.

    The two branches over the visits fact share one scan and one join: each
    joined row is emitted once per branch it qualifies for (UNION ALL
    multiplicity).  The diagnosis branch has no indicator filter, so visit
    counts there are labelled MINUTES too; ``strict`` leaves them out.
    """
    press = pressure_indicators(dim_ind)
    cols = ["source_system", "source_indicator_code", "indicator_name", "unit"]

    def out(df, unit, kind, gender, age, diag):
        return df.select("region_key", "date_key",
                         F.col("d_source_system").alias("source_system"),
                         F.col("d_source_indicator_code").alias("source_indicator_code"),
                         F.col("d_indicator_name").alias("indicator_name"),
                         unit.alias("unit"), F.lit(kind).alias("metric_kind"), F.lit("MONTHLY").alias("grain"),
                         gender.alias("gender_key"), age.alias("age_key"), diag.alias("diagnosis_group"),
                         F.col("value").cast("double").alias("value"))

    overc = _with_indicator(fct_overc, press, cols, size_base=dim_ind) \
        .filter(F.lower("d_source_indicator_code").like(DISPLACED_CODE_LIKE))
    overc = out(overc, F.col("d_unit"), "COUNT", NULL_STR(), NULL_STR(), NULL_STR())

    v = _with_indicator(fct_visits.drop("unit"), press, cols, size_base=dim_ind)
    code = F.lower("d_source_indicator_code")
    label = F.lower(F.concat(F.col("d_source_indicator_code"), F.lit(" "), F.col("d_indicator_name")))
    branches = F.filter(F.array(
        F.struct(F.lit("MINUTES").alias("kind"), F.col("d_unit").alias("unit"),
                 F.coalesce(code.like(DOCTOR_TIME_CODE_LIKE), F.lit(False)).alias("hit")),
        F.struct(F.lit("VISITS").alias("kind"), F.coalesce("d_unit", F.lit("antal")).alias("unit"),
                 F.coalesce(P.full_match(label, VISITS_PATTERN), F.lit(False)).alias("hit"))),
        lambda b: b["hit"])
    v = v.select("*", F.explode(branches).alias("b"))
    visits = v.select("region_key", "date_key",
                      F.col("d_source_system").alias("source_system"),
                      F.col("d_source_indicator_code").alias("source_indicator_code"),
                      F.col("d_indicator_name").alias("indicator_name"),
                      F.col("b.unit").alias("unit"), F.col("b.kind").alias("metric_kind"),
                      F.lit("MONTHLY").alias("grain"), "gender_key", "age_key",
                      NULL_STR().alias("diagnosis_group"), F.col("value").cast("double").alias("value"))

    diag = _with_indicator(fct_diag.drop("unit"), press, cols, size_base=dim_ind)
    if strict:
        diag = diag.filter(~F.coalesce(P.full_match(label, VISITS_PATTERN), F.lit(False)))
    diag = out(diag, F.coalesce("d_unit", F.lit("minuter")), "MINUTES", NULL_STR(), NULL_STR(),
               F.col("diagnosgrupp").cast("string"))
    return union_all([overc, visits, diag])


def explorer_indicators(dim_ind: DataFrame) -> DataFrame:
    return dim_ind.select("indicator_key", T.trim_upper("topic").alias("topic"),
                          T.trim_upper("polarity").alias("polarity"), "source_system",
                          "source_indicator_code", "indicator_name")



def demand_visits(fct_visits: DataFrame, di: DataFrame, size_base: DataFrame | None = None) -> DataFrame:
    """Visits summed per region-month.  The DEMAND test sits in the LEFT
    join's ON clause: rows of other topics are kept and summed under
    VISITS_TOTAL."""
    cols = ["topic", "polarity", "source_indicator_code", "indicator_name"]
    dv = J.lookup(fct_visits, di, [F.col("indicator_key")], [F.col("indicator_key")],
                  {c: f"d_{c}" for c in cols}, how="left", extra_condition=F.col("topic") == "DEMAND",
                  size_base=size_base)
    return dv.groupBy("region_key", "date_key",
                      F.coalesce("d_source_indicator_code", F.lit(VISITS_TOTAL[0])).alias("metric_code"),
                      F.coalesce("d_indicator_name", F.lit(VISITS_TOTAL[1])).alias("indicator_name")) \
             .agg(exact_sum("value").alias("value"))


def median_times(fct_visits: DataFrame, di: DataFrame, size_base: DataFrame | None = None) -> DataFrame:
    """Unweighted average of the PRESSURE medians per region-month."""
    cols = ["topic", "source_indicator_code", "indicator_name"]
    pv = _with_indicator(fct_visits, di, cols, size_base=size_base).filter(F.col("d_topic") == "PRESSURE")
    return pv.groupBy("region_key", "date_key", F.col("d_source_indicator_code").alias("metric_code"),
                      F.col("d_indicator_name").alias("indicator_name")).agg(exact_avg("value").alias("value"))


def visit_metrics(fct_visits: DataFrame, di: DataFrame, size_base: DataFrame | None = None,
                  strict: bool = False) -> DataFrame:
    """Demand sums and PRESSURE averages of the visits in one join and one aggregate.

    Every row counts towards DEMAND: under its own indicator if that has the
    topic, else under VISITS_TOTAL (``strict`` leaves the latter out).  PRESSURE
    rows also count towards the averages.
    """
    cols = ["topic", "source_indicator_code", "indicator_name"]
    v = J.lookup(fct_visits, di, [F.col("indicator_key")], [F.col("indicator_key")], {c: f"d_{c}" for c in cols},
                 how="left", size_base=size_base)
    of_topic = F.coalesce(F.col("d_topic") == "DEMAND", F.lit(False))
    code, name = F.col("d_source_indicator_code"), F.col("d_indicator_name")

    def metric(theme, polarity, keep, code, name):
        return F.when(keep, F.struct(F.lit(theme).alias("theme"), F.lit(polarity).alias("polarity"),
                                     code.alias("metric_code"), name.alias("indicator_name")))

    metrics = F.array_compact(F.array(
        metric("DEMAND", "NEUTRAL", of_topic if strict else F.lit(True),
               F.coalesce(F.when(of_topic, code), F.lit(VISITS_TOTAL[0])),
               F.coalesce(F.when(of_topic, name), F.lit(VISITS_TOTAL[1]))),
        metric("PRESSURE", "NEG", F.col("d_topic") == "PRESSURE", code, name)))
    v = v.select("region_key", "date_key", "value", F.explode(metrics).alias("m")) \
         .select("region_key", "date_key", "value", "m.*")
    total, mean = exact_sum("value"), exact_avg("value")
    return v.groupBy("region_key", "date_key", "theme", "polarity", "metric_code", "indicator_name") \
            .agg(F.when(F.col("theme") == "DEMAND", total).otherwise(mean).alias("value"))


def mart_regional_explorer_monthly_long(fct_perf_m: DataFrame, fct_overc: DataFrame, fct_visits: DataFrame,
                                        fct_cap: DataFrame, fct_perf_y: DataFrame, fct_kolada: DataFrame,
                                        dim_ind: DataFrame, strict: bool = False) -> DataFrame:
    """Long explorer: monthly waiting time, pressure and demand, yearly
    capacity/cost.  Visits of other topics are summed under VISITS_TOTAL;
    ``strict`` counts visits of DEMAND indicators only."""
    di = explorer_indicators(dim_ind)
    cols = ["topic", "polarity", "source_indicator_code", "indicator_name"]
    null_int = F.lit(None).cast("int")

    def shape(df, date_key, year, grain, theme, polarity, code, name, value):
        return df.select("region_key", date_key.alias("date_key"), year.alias("year"),
                         F.lit(grain).alias("time_grain"), theme.alias("theme"), polarity.alias("polarity"),
                         code.alias("metric_code"), name.alias("indicator_name"),
                         value.cast("double").alias("value"))

    def monthly(fact, topic):
        f = _with_indicator(fact, di, cols, size_base=dim_ind).filter(F.col("d_topic") == topic)
        return shape(f, F.col("date_key"), null_int, "MONTH", F.col("d_topic"), F.col("d_polarity"),
                     F.col("d_source_indicator_code"), F.col("d_indicator_name"), F.col("value"))

    m_wait = monthly(fct_perf_m, "WAITING_TIME")
    m_overc = monthly(fct_overc, "PRESSURE")

    m_visits = shape(visit_metrics(fct_visits, di, dim_ind, strict), F.col("date_key"), null_int, "MONTH",
                     F.col("theme"), F.col("polarity"), F.col("metric_code"), F.col("indicator_name"), F.col("value"))

    yearly_topics = list(EXPLORER_YEARLY_TOPICS)

    def yearly(fact):
        f = _with_indicator(fact, di, cols, size_base=dim_ind).filter(F.col("d_topic").isin(*yearly_topics))
        return shape(f, null_int, F.col("year").cast("int"), "YEAR", F.col("d_topic"), F.col("d_polarity"),
                     F.col("d_source_indicator_code"), F.col("d_indicator_name"), F.col("value"))

    return union_all([m_wait, m_overc, m_visits, yearly(fct_cap), yearly(fct_perf_y),
                      yearly(fct_kolada)])


def resource_roles(dim_ind: DataFrame) -> DataFrame:
    """Indicator -> resource role (first matching rule wins, else NULL)."""
    src = T.trim_upper("source_system")
    code = T.trim_upper("source_indicator_code")
    topic = F.upper("topic")
    name = F.lower("indicator_name")

    def fm(p):
        return F.coalesce(P.full_match(name, p), F.lit(False))

    role = classify([
        ((src == "SCB") & (code == "POPULATION"), "POPULATION"),
        (src.isin("BEDS_REGION", "OECD_HEALTH"), "BEDS_PER_1000"),
        ((topic == "CAPACITY") & fm(BEDS_PATTERN), "BEDS_PER_1000"),
        ((src == "MEDICAL_PERSONNEL") & fm(DOCTORS_PATTERN), "STAFF_DOCTORS"),
        ((src == "MEDICAL_PERSONNEL") & fm(NURSES_PATTERN), "STAFF_NURSES"),
        ((topic == "CAPACITY") & fm(DOCTORS_PATTERN), "STAFF_DOCTORS"),
        ((topic == "CAPACITY") & fm(NURSES_PATTERN), "STAFF_NURSES"),
        ((src == "MEDICAL_PERSONNEL") | (topic == "CAPACITY"), "STAFF_OTHER"),
        ((topic == "COST") & (src == "NET_COST"), "COST_PER_CAPITA"),
        (topic == "COST", "COST_OTHER"),
        (fm(AMBULANCE_TIME_PATTERN), "AMBULANCE_TIME_MIN"),
        (fm(AMBULANCE_COUNT_PATTERN), "AMBULANCE_COUNT"),
    ])
    return dim_ind.select("indicator_key", role.alias("role"))


# Role pivot of the resources mart (output column -> aggregate, roles).
RESOURCE_PIVOT = {
    "beds_per_1000": ("max", ["BEDS_PER_1000"]),
    "staff_doctors": ("sum", ["STAFF_DOCTORS"]),
    "staff_nurses": ("sum", ["STAFF_NURSES"]),
    "staff_headcount_total": ("sum", ["STAFF_DOCTORS", "STAFF_NURSES"]),
    "population": ("max", ["POPULATION"]),
    "cost_per_capita": ("max", ["COST_PER_CAPITA"]),
    "cost_other": ("max", ["COST_OTHER"]),
    "ambulance_count": ("max", ["AMBULANCE_COUNT"]),
    "ambulance_time_min": ("max", ["AMBULANCE_TIME_MIN"]),
    "displaced_patients_year": ("max", ["OVERCROWDING_Y"]),
}


def mart_resources_yearly(fct_cap: DataFrame, fct_perf_y: DataFrame, fct_overc: DataFrame,
                          dim_dt: DataFrame, dim_ind: DataFrame) -> DataFrame:
    """Resources by region and year with per-1,000-inhabitant ratios."""
    roles = resource_roles(dim_ind)
    cap = J.lookup(fct_cap, roles, [F.col("indicator_key")], [F.col("indicator_key")], ["role"], how="inner",
                   size_base=dim_ind) \
           .filter(F.col("role").isNotNull()) \
           .select("region_key", "year", "role", F.col("value").cast("double").alias("value"))
    amb = J.lookup(fct_perf_y, roles, [F.col("indicator_key")], [F.col("indicator_key")], ["role"], how="inner",
                   size_base=dim_ind) \
           .filter(F.col("role").isin("AMBULANCE_COUNT", "AMBULANCE_TIME_MIN")) \
           .select("region_key", "year", "role", F.col("value").cast("double").alias("value"))
    ov = J.lookup(fct_overc, dim_dt, [F.col("date_key")], [F.col("date_key")], {"year": "cal_year"},
                  how="inner")
    ov = ov.groupBy("region_key", F.col("cal_year").alias("year")).agg(
        exact_sum("value").alias("value")) \
           .select("region_key", "year", F.lit("OVERCROWDING_Y").alias("role"), "value")
    agg = pivot_roles(union_all([cap, amb, ov]), ["region_key", "year"], "role", "value", RESOURCE_PIVOT)
    return agg.select(
        "region_key", "year", P.year_key("year").alias("date_key"),
        *RESOURCE_PIVOT.keys(),
        N.safe_ratio("staff_headcount_total", "population").alias("staff_per_1000"),
        N.safe_ratio("staff_doctors", "population").alias("doctors_per_1000"),
        N.safe_ratio("staff_nurses", "population").alias("nurses_per_1000"),
    )

"""Sums and averages that do not depend on the order of the rows."""
import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from indicatormart.operators import aggregates as A
from indicatormart.plans import marts as M

ODD = {100: [1e16, 1.0, -1e16], 101: [-2.0**-30], 102: [2.0**77, -2.0**77, 2.0**-78, -2.0**-77], 103: [0.0, -0.0],
       104: [-1.0, 2.0**-52], 105: [None, 0.1, None], 106: [-5.0, 5.0]}


def _groups():
    rng = random.Random(3)
    draw = (lambda: rng.uniform(-1, 1), lambda: rng.uniform(-1e15, 1e15), lambda: rng.choice([1e16, -1e16, 1.0, 0.1]),
            lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20), lambda: round(rng.uniform(0, 1000), 2))
    return {g: [draw[g % 5]() for _ in range(rng.randint(1, 200))] for g in range(30)} | ODD


def test_exact_sum_is_the_same_in_any_order_and_near_the_true_sum(spark):
    groups = _groups()
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, v double")
    seen = set()
    for n in range(10):
        shuffled = df.orderBy(F.rand(n)).repartition(1 + 2 * n)
        got = A.sum_by(shuffled, ["g"], "v").join(shuffled.groupBy("g").agg(A.exact_avg("v").alias("avg")), "g").collect()
        seen.add(tuple(sorted((r.g, r.value, r.avg) for r in got)))
    assert len(seen) == 1
    for g, value, avg in seen.pop():
        vs = [v for v in groups[g] if v is not None]
        want = math.fsum(vs)
        assert abs(Fraction(value) - Fraction(want)) <= Fraction(math.ulp(want)), (g, value, want)
        assert avg == value / len(vs)


def test_exact_sum_outside_its_range(spark):
    groups = {0: [float("inf"), 1.0], 1: [float("inf"), float("-inf")], 2: [float("nan"), 1.0], 3: [1e300, 1.0], 4: [None]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, v double")
    got = {r.g: r.value for r in A.sum_by(df, ["g"], "v").collect()}
    assert got[0] == float("inf") and got[3] == 1e300 and got[4] is None and all(math.isnan(got[g]) for g in (1, 2))
    assert A.sum_by(df.limit(0), ["g"], "v").count() == 0


def test_exact_sum_is_a_hash_aggregate(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"))
    plan = A.sum_by(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Sort" not in plan


def test_visit_marts_are_the_same_in_any_order(spark):
    rng = random.Random(8)
    visits = spark.createDataFrame([(f"r{rng.randint(1, 3)}", 20240101, f"i{rng.randint(1, 4)}", rng.uniform(0, 1e6) * 10 ** rng.randint(-6, 6))
                                    for _ in range(4000)], "region_key string, date_key int, indicator_key string, value double")
    di = spark.createDataFrame([("i1", "DEMAND", "NEUTRAL", "S", "c1", "n1"), ("i2", "PRESSURE", "NEG", "S", "c2", "n2"),
                                ("i3", "PRESSURE", "NEG", "S", "c3", "n3")],
                               "indicator_key string, topic string, polarity string, source_system string, "
                               "source_indicator_code string, indicator_name string")
    seen = [set(), set(), set()]
    for n in range(10):
        some = visits.orderBy(F.rand(n)).repartition(2 + n)
        for i, f in enumerate((M.demand_visits, M.median_times, M.visit_metrics)):
            seen[i].add(tuple(sorted((tuple(r) for r in f(some, di).collect()), key=repr)))
    assert [len(s) for s in seen] == [1, 1, 1] and all(len(s.pop()) > 5 for s in seen)

"""The uniqueness sketch against plain grouping, and what it shuffles."""
from pyspark.sql import functions as F

from conftest import rows
from indicatormart.operators import quality as Q
from indicatormart.operators import uniqueness as U
from indicatormart.sources.sinks import materialize
from plan_metrics import exchanges


def _wide(spark, n, **more):
    key = lambda c, m: F.md5((F.col("id") % m + c).cast("string"))
    return spark.range(n).select(key(0, 21).alias("region"), key(7, 3).alias("gender"), key(9, 10**12).alias("indicator"),
                                 (F.col("id") % 6).cast("int").alias("year"), "id", *[v.alias(k) for k, v in more.items()])


GRAIN = ["region", "year", "gender", "indicator"]


def test_sketch_equals_grouping(spark):
    nulls = _wide(spark, 4000, a=F.when(F.col("id") % 5 > 0, F.col("id") % 800), b=F.when(F.col("id") % 7 > 0, F.lit(1)))
    hot = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), F.lit(None).cast("int").alias("b"))
    swapped = spark.createDataFrame([(None, 1), (1, None), (None, None), (None, None)], "a int, b int")
    for df in (nulls, hot, swapped, nulls.limit(0)):
        t = materialize(df.repartition(5), "unique_test")
        for unique, combos in ((["a", "b"], [["a", "b"], ["b"]]), ([], [["a"]])):
            got, want = (Q.run_checks(Q.check_grains(t, "t", unique, combos, sketch=s)) for s in (True, False))
            assert rows(got) == rows(want)


def test_colliding_hashes_are_counted_exactly(spark, monkeypatch):
    # a weak hash: every key collides with many others, so all parts are suspect and all groups are still exact
    monkeypatch.setattr(U, "key_hash", lambda cols: F.xxhash64(F.pmod(F.xxhash64(*cols), F.lit(50))))
    t = materialize(_wide(spark, 3000), "unique_test")
    got = Q.run_checks(Q.check_grains(t, "t", ["id"], [["region", "year"], GRAIN], sketch=True))
    assert [r[0] for r in rows(got, "failures")] == sorted(
        [0, t.groupBy("region", "year").count().filter("count > 1").count(), 0])


def test_clean_keys_shuffle_less_than_a_tenth(spark):
    t = materialize(_wide(spark, 400_000).repartition(4), "unique_test")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        [exact] = exchanges(t.groupBy(*GRAIN).count(), "shuffleBytesWritten")
        parts = U.parts_for(400_000)
        packed = U.sketch(t, [GRAIN], [False], parts).groupBy("grain", "part").applyInArrow(U._merge, "grain int, part int")
        [sketch] = exchanges(packed, "shuffleBytesWritten")
        assert U.suspects(t, [GRAIN], [False], parts).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    print(f"bytes shuffled: exact {exact}, sketch {sketch}")
    assert sketch < 0.1 * exact


def test_several_grains_are_one_scan(spark):
    t = materialize(_wide(spark, 1000), "unique_test")
    plan = U.sketch(t, [GRAIN, ["id"], ["indicator"]], [False, True, True], 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1

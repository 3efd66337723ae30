"""One key holding a third of all rows: results stay whole and exact, and the
one-row-per-key pick forwards at most one row per map task for the hot key."""
from pyspark.sql import functions as F

from indicatormart.functions import keys as K
from indicatormart.operators import grain as G
from indicatormart.operators import quality as Q
from plan_metrics import exchanges


def _skewed(spark, n=30000):
    # a third of the rows share key 0; the rest spread over 2,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.when(F.col("id") % 5 == 0, F.lit("YEAR")).otherwise(F.lit("MONTH")).alias("g"),
        F.col("id").alias("v")).repartition(16)


def test_dedupe_on_hot_key(spark):
    df = _skewed(spark)
    out = G.dedupe(df, ["k"], [F.col("v").desc()])
    got = {r.k: r.v for r in out.collect()}
    expect = {r.k: r.m for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    assert got == expect and len(got) == 2001
    qe = out._jdf.queryExecution()
    qe.executedPlan().execute().count()
    plan = qe.executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_by_on_hot_key_sends_one_row_a_task(spark):
    df = _skewed(spark)
    out = G.first_by(df, ["k"], [K.desc("v")])
    got = {r.k: r.v for r in out.collect()}
    assert got == {r.k: r.m for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    # what leaves the map side: at most one row per key and task, for the hot key too
    spread = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("k").alias("n")).agg(F.sum("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert 0 < exchanges(G.first_by(df, ["k"], [K.desc("v")]), "shuffleRecordsWritten")[0] <= spread.first()[0] < df.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_finer_grain_on_hot_key_matches_the_window_definition(spark):
    from pyspark.sql import Window
    df = _skewed(spark)
    out = G.prefer_finer_grain(df, ["k"], grain_col="g")
    has_month = F.max(F.when(F.col("g") == "MONTH", 1).otherwise(0)).over(Window.partitionBy("k"))
    expect = df.withColumn("hm", has_month).filter(~((F.col("g") == "YEAR") & (F.col("hm") == 1))).drop("hm")
    assert sorted(r.v for r in out.select("v").collect()) == sorted(r.v for r in expect.select("v").collect())
    assert out.filter((F.col("k") == 0) & (F.col("g") == "YEAR")).count() == 0   # hot key has months


def test_grain_check_counts_hot_groups(spark):
    df = _skewed(spark)
    rep = Q.check_unique_combination(df, "t", ["k", "g"]).first()
    assert rep.failures == df.groupBy("k", "g").count().filter("count > 1").count()


def test_session_splits_skewed_joins(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"

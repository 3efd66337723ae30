"""Property checks (hypothesis): reshaping round trips, grain idempotence, key stability."""
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from indicatormart.functions.keys import surrogate_key
from indicatormart.operators import grain as G
from indicatormart.operators import reshape as R

cells = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["m1", "m2"]),
                           st.integers(-1000, 1000)), min_size=1, max_size=12, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=5, deadline=None)
@given(cells)
def test_pivot_then_unpivot_is_identity_on_cells(spark, data):
    df = spark.createDataFrame([(k, m, float(v)) for k, m, v in data], "k string, m string, v double")
    wide = R.pivot_metrics(df, ["k"], "m", "v", ["m1", "m2"])
    back = R.unpivot_columns(wide, ["k"], ["m1", "m2"], "m", "v", drop_nulls=True)
    assert sorted(tuple(r) for r in back.collect()) == sorted((k, m, float(v)) for k, m, v in data)


grains = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["YEAR", "MONTH", "UNKNOWN", None]),
                            st.integers(0, 9)), min_size=1, max_size=15)


@settings(max_examples=5, deadline=None)
@given(grains)
def test_prefer_finer_grain_matches_window_definition(spark, data):
    df = spark.createDataFrame(data, "k int, g string, v int")
    got = sorted((tuple(r) for r in G.prefer_finer_grain(df, ["k"], grain_col="g").collect()), key=repr)
    has_month = {k for k, g, _ in data if g == "MONTH"}
    # NOT (grain = 'YEAR' AND has_month) with three-valued logic: a NULL grain is dropped when the
    # group has months (NOT NULL), kept otherwise (NOT FALSE)
    expect = sorted((t for t in data if not ((t[1] == "YEAR" or t[1] is None) and t[0] in has_month)), key=repr)
    assert got == expect


def test_surrogate_keys_stable_across_partitionings(spark):
    df = spark.range(200).select((F.col("id") % 17).alias("a"), F.col("id").cast("string").alias("b"))
    one = sorted(r.k for r in df.coalesce(1).select(surrogate_key("a", "b").alias("k")).collect())
    many = sorted(r.k for r in df.repartition(7).select(surrogate_key("a", "b").alias("k")).collect())
    assert one == many

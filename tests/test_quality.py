"""Data-quality checks find planted violations."""
from indicatormart.operators import quality as Q


def _by_check(df):
    return {(r.check_name, r.column_name): (r.failures, r.status) for r in df.collect()}


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "F", None), (2, "X", 1.0), (2, None, 2.0), (3, "Y", None)],
                               "id int, g string, v double")
    out = _by_check(Q.check_columns(df, "t", not_null=["id", "v"], accepted={"g": ["F", "M", "ALL"]},
                                    severity={"v": "warn"}))
    assert out[("not_null", "id")] == (0, "pass")
    assert out[("not_null", "v")] == (2, "warn")
    assert out[("accepted_values", "g")] == (2, "fail")      # X and Y; NULL passes
    uniq = _by_check(Q.check_unique(df, "t", "id"))
    assert uniq[("unique", "id")] == (1, "fail")
    combo = _by_check(Q.check_unique_combination(df, "t", ["id", "v"]))
    assert combo[("unique_combination_of_columns", "id,v")] == (0, "pass")


def test_relationship_and_cardinality(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    rel = _by_check(Q.check_relationship(child, "c", "k", parent, "k"))
    assert rel[("relationships", "k")] == (1, "fail")          # 9 has no parent; NULL passes
    card = _by_check(Q.check_min_distinct(parent, "p", "k", 21))
    assert card[("min_distinct_21", "k")] == (1, "warn")

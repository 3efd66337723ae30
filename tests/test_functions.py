"""Column functions against the trap rows of FIXTURES.md."""
import datetime as dt
import hashlib

from pyspark.sql import functions as F

from indicatormart.functions import keys as K
from indicatormart.functions import numbers as N
from indicatormart.functions import periods as P
from indicatormart.functions import text as T


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first().out


def col_values(spark, fn, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r.out for r in df.select(fn(F.col("x")).alias("out")).collect()]


def test_parse_decimal_dot_and_strip(spark):
    assert col_values(spark, N.parse_decimal, ["1 234,5 %", "1.234,5", "12.", "-3,25"]) == [1234.5, None, 12.0, -3.25]
    assert col_values(spark, lambda c: N.parse_decimal(c, comma="strip"), ["1,5", "12 345"]) == [15.0, 12345.0]
    assert col_values(spark, N.parse_decimal_or_dash, ["--", "-", "", " 7,5 "]) == [None, None, None, 7.5]


def test_integer_parse_rounds_half_away_from_zero(spark):
    assert col_values(spark, N.parse_int_round, ["12.5", "-12.5", "2.5", "abc", None]) == [13, -13, 3, None, None]
    assert col_values(spark, N.parse_decimal_scale2, ["12,345", "-12,345", "x"]) == [12.35, -12.35, None]


def test_periods(spark):
    vals = ["2024-03", "2024", "2024-Q1", "2024-13"]
    assert col_values(spark, P.period_granularity, vals) == ["MONTH", "YEAR", "UNKNOWN", "MONTH"]
    assert col_values(spark, P.period_year, vals) == [2024, 2024, 2024, 2024]
    assert col_values(spark, P.period_month, vals) == [dt.date(2024, 3, 1), None, None, None]


def test_named_month(spark):
    assert col_values(spark, P.named_month_number, ["mars 2024", "Januari 2023", "foo 2024", "mars"]) == [3, 1, None, None]
    assert col_values(spark, P.spelled_month_number, ["jan.", "Sept", "okt", "07"]) == [1, 9, 10, 7]


def test_keys(spark):
    assert col_values(spark, P.month_key, [dt.date(2024, 3, 17)], "x date") == [20240301]
    assert col_values(spark, P.year_key, [2024], "x int") == [20240101]


def test_gender_codes(spark):
    vals = ["kvinnor", "MÄN", "Totalt", None, "x", " K "]
    assert col_values(spark, T.normalize_gender, vals) == ["F", "M", "ALL", "ALL", "ALL", "F"]
    words = col_values(spark, lambda c: T.normalize_gender(c, short_codes=False), ["k", "kvinna", "män"])
    assert words == ["ALL", "F", "M"]


def test_region_name_cleaning(spark):
    assert col_values(spark, T.clean_kpi_region, ["Region Skåne", "Regionen X", "Gotlands"]) == ["Skåne", "X", "Gotland"]
    assert col_values(spark, T.clean_area_name, ["Stockholms län", "KALMAR LÄN", "Uppsala"]) == \
        ["Stockholm", "KALMAR", "Uppsala"]
    special = {"Västra Götalandsregionen": "Västra Götaland"}
    assert col_values(spark, lambda c: T.clean_column_region(c, special),
                      ["Region Jönköpings län", "Västra Götalandsregionen"]) == ["Jönköpings", "Västra Götaland"]
    assert col_values(spark, T.region_name_norm, ["Region  Jönköping  län", "Jönköping"]) == ["JÖNKÖPING"] * 2
    # upper-case patterns do nothing on mixed case input
    assert col_values(spark, T.upper_pattern_norm, ["Region Jönköpings län", "REGION KALMAR LÄN"]) == \
        ["REGION JÖNKÖPINGS LÄN", "KALMAR"]


def test_metric_codes(spark):
    assert col_values(spark, T.slug, ["Antal besök"]) == ["antal_bes_k"]
    assert col_values(spark, T.snake, ["Antal besök"]) == ["antal_besök"]
    assert col_values(spark, T.letter_s_runs, ["Antal besök"]) == ["antal be_ök"]


def test_blank_helpers(spark):
    df = spark.createDataFrame([(" ", "Rubrik"), ("Titel ", "Rubrik"), (None, " R ")], "a string, b string")
    out = [r.o for r in df.select(T.first_non_blank("a", "b").alias("o")).collect()]
    assert out == ["Rubrik", "Titel", "R"]
    assert col_values(spark, T.blank_to_null, ["  ", " a "]) == [None, "a"]


def test_full_match_is_whole_string(spark):
    df = spark.createDataFrame([("läkare",), ("specialist läkare",)], "x string")
    out = [r.o for r in df.select(P.full_match("x", "(läkare)").alias("o")).collect()]
    assert out == [True, False]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    got = [r.k for r in df.select(K.surrogate_key("a", "b").alias("k")).collect()]
    expect = [hashlib.md5(b"1-a").hexdigest(),
              hashlib.md5(b"2-_dbt_utils_surrogate_key_null_").hexdigest()]
    assert got == expect
    assert col_values(spark, K.surrogate_key, ["F"]) == [hashlib.md5(b"F").hexdigest()]


def test_label_sort_key(spark):
    assert col_values(spark, K.label_sort_key, ["18-29", "80+", "Totalt"]) == [18, 80, 999]


def test_safe_ratio_and_strict_least(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (10.0, 4.0)], "n double, d double")
    assert [r.o for r in df.select(N.safe_ratio("n", "d").alias("o")).collect()] == [None, None, 2500.0]
    df2 = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    assert [r.o for r in df2.select(P.least_strict("a", "b").alias("o")).collect()] == [None, 1]


def test_strict_casts_fail_on_bad_input_under_ansi(spark):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    assert col_values(spark, N.strict_int, ["12.5", "7"]) == [13, 7]
    with pytest.raises((PySparkException, Py4JJavaError)):
        col_values(spark, N.strict_int, ["abc"])
    with pytest.raises((PySparkException, Py4JJavaError)):
        col_values(spark, N.strict_double, ["1,5"])

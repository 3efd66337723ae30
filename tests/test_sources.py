"""Readers and sinks: seeds, renames, inline relations, views, tables, CSV, materialize, audit."""
import pytest
from pyspark.sql import functions as F

from conftest import rows
from indicatormart.operators import joins as J
from indicatormart.operators import quality as Q
from indicatormart.sources import readers as RD
from indicatormart.sources import schemas as S
from indicatormart.sources import sinks as SK


def test_seed_csv_with_blank_tail_and_trailing_blanks(spark, tmp_path):
    p = tmp_path / "seed.csv"
    p.write_text("source_system,source_indicator_code,topic,polarity\nKOLADA,n1,WAITING_TIME,NEG \n\n\n")
    seed = RD.load_seed(spark, str(p), S.TAXONOMY_SCHEMA)
    assert rows(seed) == [("KOLADA", "n1", "WAITING_TIME", "NEG ")]   # trailing blank kept, blank lines skipped


def test_rename_and_inline(spark):
    raw = spark.createDataFrame([("a", "1")], "`Kön/Totalt` string, `Värde` string")
    assert RD.rename_columns(raw, {"Värde": "value_raw", "Kön/Totalt": "gender_raw"}).columns == \
        ["value_raw", "gender_raw"]
    lit = RD.inline_table(spark, [("F", "Kvinna")], "code string, name string")
    assert rows(lit) == [("F", "Kvinna")]


def test_publish_view_table_and_csv(spark, tmp_path):
    df = spark.range(3).withColumn("x", F.col("id") * 2)
    v = SK.publish(df, "im_test_view")
    assert spark.sql("SELECT sum(x) AS s FROM im_test_view").first().s == 6 and v.count() == 3
    t = SK.publish(df, "im_test_table", kind="table", database="im_test_db", path=str(tmp_path / "tbl"))
    assert rows(t) == rows(df) and spark.catalog.databaseExists("im_test_db")
    SK.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).schema("id long, x long").csv(str(tmp_path / "csv"))
    assert rows(back) == rows(df)
    m = SK.materialize(df, "im_test")
    assert rows(m) == rows(df) and "indicatormart/im_test-" in m.inputFiles()[0]


def _versions(folder):
    return sorted(p.name for p in folder.iterdir() if p.name.startswith("v-"))


def test_a_failing_rewrite_leaves_the_old_rows(spark, tmp_path):
    where = dict(kind="table", database="im_swap_db", path=str(tmp_path / "t"))
    first = spark.range(5).withColumn("x", F.col("id") * 2)
    SK.publish(first, "swap", **where)
    # fails in one task, after the others have written their files
    bad = spark.range(0, 100, 1, 4).select("id", F.when(F.col("id") == 99, F.raise_error(F.lit("broken row")).cast("long"))
                                           .otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception):  # noqa: B017 - a failed write, in whatever wrapping
        SK.publish(bad, "swap", **where)
    assert rows(spark.table("im_swap_db.swap")) == rows(first)
    assert len(_versions(tmp_path / "t")) == 1
    assert [t.name for t in spark.catalog.listTables("im_swap_db") if not t.isTemporary] == ["swap"]


def test_replace_swaps_versions_and_keeps_the_last(spark, tmp_path):
    where = dict(kind="table", database="im_swap_db", path=str(tmp_path / "t"))
    reader = SK.publish(spark.range(3), "versions", **where)
    second = SK.publish(spark.range(10), "versions", **where)
    assert second.count() == 10 and reader.count() in (3, 10)        # files of the version before are still there
    # reading the table while it is replaced by its own rows
    third = SK.publish(spark.table("im_swap_db.versions").filter("id > 6"), "versions", **where)
    assert rows(third) == [(7,), (8,), (9,)] and len(_versions(tmp_path / "t")) == 2
    # other columns and partitions
    wide = spark.range(6).select((F.col("id") % 2).cast("int").alias("year"), F.col("id").cast("string").alias("name"))
    fourth = SK.publish(wide.select("name", "year"), "versions", partition_by=["year"], **where)
    assert rows(fourth, "name", "year") == rows(wide, "name", "year")
    fifth = SK.publish(wide.filter("year = 1").select("name", "year"), "versions", partition_by=["year"], **where)
    assert fifth.count() == 3 and rows(SK.publish(spark.range(1), "versions", **where)) == [(0,)]
    assert [t.name for t in spark.catalog.listTables("im_swap_db")].count("versions") == 1
    managed = SK.publish(spark.range(4), "beside", kind="table", database="im_swap_db")
    assert managed.count() == 4 and SK.publish(spark.range(2), "beside", kind="table", database="im_swap_db").count() == 2


def test_load_audit(spark):
    df = spark.createDataFrame([("k1", "r1"), ("k1", "r2"), ("k2", "r1")], "kpi string, region string")
    a = RD.load_audit(df, ["kpi"], "region").first()
    assert (a.row_count, a.series_count, a.region_count) == (3, 2, 2) and a.loaded_at is not None


def test_constant_lookup_is_a_scalar_subquery(spark):
    dim = spark.createDataFrame([("OECD", "beds", "k1"), ("SCB", "pop", "k2")], "source_system string, "
                                "source_indicator_code string, indicator_key string")
    fact = spark.range(4)
    out = fact.select("id", J.constant_lookup(dim, {"source_system": "SCB", "source_indicator_code": "pop"},
                                              "indicator_key").alias("k"))
    assert {r.k for r in out.collect()} == {"k2"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan
    missing = fact.select(J.constant_lookup(dim, {"source_system": "X"}, "indicator_key").alias("k"))
    assert {r.k for r in missing.collect()} == {None}


def test_check_model_fuses_column_tests(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    child = spark.createDataFrame([("a", 1, "F"), ("z", None, "X"), (None, 3, "M"), ("a", 4, "F")],
                                  "k string, v int, g string")
    rep = {(r.check_name, r.column_name): (r.failures, r.status) for r in Q.check_model(
        child, "c", not_null=["k"], warn_not_null=["v"], accepted={"g": ["F", "M"]},
        relationships={"k": (parent, "k")}, unique=["k"], combinations=[["k", "g"]]).collect()}
    assert rep == {("not_null", "k"): (1, "fail"), ("not_null", "v"): (1, "warn"),
                   ("accepted_values", "g"): (1, "fail"), ("relationships", "k"): (1, "fail"),
                   ("unique", "k"): (1, "fail"), ("unique_combination_of_columns", "k,g"): (1, "fail")}


def test_variant_read_keeps_outer_array(spark, tmp_path):
    (tmp_path / "arr.json").write_text('[{"a": 1}, {"a": 2}]')
    v = RD.read_documents(spark, str(tmp_path))
    assert [r.j for r in v.select(F.to_json("payload").alias("j")).collect()] == ['[{"a":1},{"a":2}]']


def test_load_table_csv_with_string_schema(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("Område,Kön,2024\nRegion Skåne,K,\"1,5\"\n", encoding="utf-8")
    df = RD.load_table(spark, str(p), fmt="csv", schema=S.string_schema(["Område", "Kön", "2024"]),
                       options={"header": True})
    assert rows(df) == [("Region Skåne", "K", "1,5")]

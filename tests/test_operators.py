"""Operators on tiny literal rows (grain rules, reshaping, documents, joins, selection)."""
import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from indicatormart.functions import keys as K
from indicatormart.operators import documents as D
from indicatormart.operators import grain as G
from indicatormart.operators import joins as J
from indicatormart.operators import reshape as R
from indicatormart.operators import selection as SEL
from indicatormart.sources import readers as RD
from indicatormart.sources import schemas as S
from indicatormart.sources import sinks as SK


def test_prefer_finer_grain_rules(spark):
    data = [
        # region, code, year, gender_raw, grain, value
        ("1", "a", 2024, "Kvinnor", "YEAR", 1.0),    # monthly exists -> dropped
        ("1", "a", 2024, "Kvinnor", "MONTH", 2.0),
        ("2", "a", 2024, "Kvinnor", "YEAR", 3.0),    # monthly row has NULL value -> still dropped
        ("2", "a", 2024, "Kvinnor", "MONTH", None),
        ("3", "a", 2024, "Kvinnor", "YEAR", 5.0),    # raw spelling differs -> kept
        ("3", "a", 2024, "K", "MONTH", 6.0),
        ("4", "a", 2024, None, "YEAR", 7.0),         # NULL key matches NULL key (window semantics)
        ("4", "a", 2024, None, "MONTH", 8.0),
        ("5", "a", 2024, "K", "YEAR", 9.0),          # no monthly -> kept
        ("5", "a", 2024, "K", "UNKNOWN", 10.0),
        ("1", "a", 2024, "Kvinnor", None, 11.0),     # NULL grain, group has months -> NOT(NULL) drops it
        ("5", "a", 2024, "K", None, 12.0),           # NULL grain, no months -> kept
    ]
    df = spark.createDataFrame(data, "r string, c string, y int, g string, grain string, v double")
    out = G.prefer_finer_grain(df, ["r", "c", "y", F.upper(F.trim("g"))], grain_col="grain")
    kept = sorted(r.v for r in out.select("v").collect() if r.v is not None)
    assert kept == [2.0, 5.0, 6.0, 8.0, 9.0, 10.0, 12.0]
    assert out.filter(F.col("v").isNull()).count() == 1
    # idempotent
    again = G.prefer_finer_grain(out, ["r", "c", "y", F.upper(F.trim("g"))], grain_col="grain")
    assert rows(again) == rows(out)


def test_finer_grain_parsed_once_reads_the_extract_once(spark, tmp_path):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.randint(0, 400), rng.choice(["YEAR", "YEAR", "MONTH", "DAY", None]), i)
            for i in range(3000)]
    spark.createDataFrame(data, "k string, n int, g string, v int").write.parquet(str(tmp_path / "extract"))
    df = spark.read.parquet(str(tmp_path / "extract"))
    once = G.prefer_finer_grain(df, ["k", "n"], grain_col="g", parsed_once=True)
    assert once.columns == df.columns
    assert rows(once) == rows(G.prefer_finer_grain(df, ["k", "n"], grain_col="g"))
    assert all("/grain_rows-" in f or "/grain_bitmap-" in f for f in once.inputFiles())
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "__class" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "BroadcastHashJoin" in plan          # the coarse rows against the bitmap
    for keep in (F.lit(False), F.col("g") == "YEAR", F.col("g") == "MONTH", F.col("g") == "DAY"):
        some = df.filter(keep)
        assert rows(G.prefer_finer_grain(some, ["k", "n"], grain_col="g", parsed_once=True)) == \
            rows(G.prefer_finer_grain(some, ["k", "n"], grain_col="g"))


def test_bitmap_never_misses_a_key(spark):
    from indicatormart.operators import membership as B
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    for bits in (64, 1024, B.bits_for(5000)):
        seen = B.maybe_in(spark.range(20000).select("id", F.xxhash64("id").alias("h")), "h", B.bitmap(keys, "h", bits), bits, "hit")
        got = {r.hit: r.n for r in seen.filter("id < 5000").groupBy("hit").agg(F.count("id").alias("n")).collect()}
        assert got == {True: 5000}
    assert seen.filter("id >= 5000 AND hit").count() < 0.1 * 15000


def test_dedupe_picks_first_in_order(spark):
    df = spark.createDataFrame([("s", "c1", "B", "u"), ("s", "c1", "A", None), ("s", "c1", "A", "x"),
                                ("s", "c2", None, "u"), ("s", "c2", "Z", None)],
                               "sys string, code string, name string, unit string")
    out = G.dedupe(df, ["sys", "code"], [F.col("name").asc_nulls_last(), F.col("unit").asc_nulls_last()])
    assert rows(out) == [("s", "c1", "A", "x"), ("s", "c2", "Z", None)]


def test_first_by_orders_every_type_like_order_by(spark):
    rng = random.Random(4)
    pick = lambda *xs: None if rng.random() < 0.15 else rng.choice(xs)
    data = [(rng.randint(0, 4), pick("a", "ab", "abc", "", "ä", "z\0", "z"), pick(1.5, -0.0, 0.0, float("nan"), -2.5),
             pick(2**63 - 1, -2**63, 0), pick(Decimal("1.10"), Decimal("-99999.99")), pick(True, False),
             pick(dt.date(2020, 1, 1), dt.date(1950, 1, 2)), pick(dt.datetime(1960, 1, 1, 0, 0, 0, 7), dt.datetime(2020, 1, 1)),
             pick(b"", b"\x00", b"\xff"), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, s string, d double, l long, c decimal(7,2), b boolean, t date, ts timestamp, "
                                     "x binary, id int").withColumn("n", F.col("ts").cast("timestamp_ntz")).repartition(5)
    for c in ("s", "d", "l", "c", "b", "t", "ts", "x", "n"):
        for down, last in ((False, True), (False, False), (True, True), (True, False)):
            order = getattr(F.col(c), ("desc" if down else "asc") + ("_nulls_last" if last else "_nulls_first"))()
            want = rows(G.dedupe(df, ["k"], [order, F.col("id")]), "k", "id")
            assert rows(G.first_by(df, ["k"], [K.Ranked(c, down, last), "id"]), "k", "id") == want, (c, down, last)
    null_key = spark.createDataFrame([(None, 1), (None, 2)], "k int, v int")
    assert rows(G.first_by(null_key, ["k"], [K.desc("v")])) == [(None, 2)]
    maps = spark.range(4).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"), F.create_map("id", "id").alias("m"))
    got = G.first_by(maps, ["k"], ["v"])
    assert got.columns == maps.columns and rows(got, "k", "v") == [(0, 0), (1, 1)]
    assert G.first_by(df.limit(0), ["k"], ["id"]).count() == 0


def test_best_match_among_percent_like_candidates(spark):
    data = [("f", 1, "väntan 90 dagar besök", "antal"), ("f", 2, "väntan 90", "Andel %"), ("f", 3, "Andel besök 90", None),
            ("f", 4, "andel besök 90 dagar", "x"), ("g", 5, "väntan", None), ("g", 6, None, "%")]
    df = spark.createDataFrame(data, "fam string, id int, title string, unit string")
    best = SEL.best_match(df, "fam", "title", "id", {"f": ["besök 90"], "g": ["väntan"]}, keep=SEL.percent_like("unit", "title"))
    # most keywords, then the shorter title; 1 and 5 are not percent-like
    assert rows(best, "fam", "id", "hits") == [("f", 3, 2), ("g", 6, None)]


def test_month_spine_exact_span(spark):
    a = spark.createDataFrame([(dt.date(2023, 11, 15),), (None,)], "d date")
    b = spark.createDataFrame([(dt.date(2024, 2, 1),)], "d date")
    cal = G.month_spine([(a, "d"), (b, "d")])
    assert [r.date_key for r in cal.orderBy("date_key").collect()] == [20231101, 20231201, 20240101, 20240201]
    assert cal.filter("year_month_label = '2024-01' AND month_no = 1 AND year = 2024").count() == 1
    empty = spark.createDataFrame([], "d date")
    assert G.month_spine([(a, "d"), (empty, "d")]).count() == 1
    assert G.month_spine([(a, "d"), (empty, "d")], strict_nulls=True).count() == 0


def test_month_spine_of_written_tables_reads_footers_only(spark):
    days = [None if i % 11 == 0 else dt.date(2023, 1, 31) + dt.timedelta(days=i) for i in range(400)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d date, v int").repartition(3)
    written = SK.materialize(df, "dates")
    plan = RD.footer_query(spark, SK.folder_of(written), "d")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(d), MAX(d)]" in plan and "ReadSchema: struct<min(d):date,max(d):date>" in plan
    assert "FileScan" not in G.date_bounds(written, "d", footers=True)._jdf.queryExecution().executedPlan().toString()
    assert rows(G.month_spine([(written, "d")], footers=True)) == rows(G.month_spine([(df, "d")]))
    assert rows(G.date_bounds(written, "d", footers=True)) == rows(G.date_bounds(df, "d"))
    none = SK.materialize(df.filter("d IS NULL"), "dates")
    assert rows(G.date_bounds(none, "d", footers=True)) == [(None, None)] and G.month_spine([(none, "d")], footers=True).count() == 0
    assert rows(G.date_bounds(SK.materialize(df.limit(0), "dates"), "d", footers=True)) == [(None, None)]
    # other types and expressions are scanned
    stamps = SK.materialize(df.select(F.col("d").cast("timestamp").alias("t"), F.col("d").cast("string").alias("s")), "dates")
    for c in ("t", "s", F.col("t")):
        assert rows(G.date_bounds(stamps, c, footers=True)) == rows(G.date_bounds(df, "d"))


def test_unpivot_years_drops_nulls_and_reads_year(spark):
    df = spark.createDataFrame([("R1", 1.0, None), ("R2", None, float("nan"))], "r string, y2019 double, y2020 double")
    out = R.unpivot_years(df, ["r"], ["y2019", "y2020"])
    got = [(r.r, r.year, r.value) for r in out.collect()]
    assert ("R1", 2019, 1.0) in got and len(got) == 2
    assert any(r == "R2" and y == 2020 for r, y, _ in got)   # NaN is not NULL: kept


def test_unpivot_keep_nulls_and_pivot_roundtrip(spark):
    df = spark.createDataFrame([("jan 2024", 1.0, None)], "cat string, `Region A` double, `B län` double")
    long = R.unpivot_columns(df, ["cat"], ["Region A", "B län"], "region_col", "value")
    assert long.count() == 2
    wide = R.pivot_metrics(long.filter("value IS NOT NULL"), ["cat"], "region_col", "value", ["Region A", "B län"])
    assert rows(wide) == [("jan 2024", 1.0, None)]


def test_melt_measures_one_scan(spark):
    df = spark.createDataFrame([(2020, 1.0, None)], "year int, a double, b double")
    out = R.melt_measures(df, ["year"], [("a", "code_a", "A", "mnkr"), ("b", "code_b", "B", None)])
    assert rows(out) == [(2020, "code_a", "A", "mnkr", 1.0), (2020, "code_b", "B", None, None)]


def test_stack_headers(spark):
    df = spark.createDataFrame([("R", 1.0, None, 3.0)],
                               "Region string, `2024/jan./Antal` double, `2024/feb./Antal` double, `2024/xx/Antal` double")
    out = R.stack_headers(df, ["Region"])
    assert [(r.Year, r.Month, r.Metric, r.Value, r.Period) for r in out.collect()] == \
        [("2024", "jan.", "Antal", 1.0, dt.date(2024, 1, 1))]


def test_pivot_roles(spark):
    df = spark.createDataFrame([("k", 2024, "D", 2.0), ("k", 2024, "N", 3.0), ("k", 2024, "P", 100.0)],
                               "k string, y int, role string, v double")
    out = R.pivot_roles(df, ["k", "y"], "role", "v", {"doctors": ("sum", ["D"]), "staff": ("sum", ["D", "N"]),
                                                       "pop": ("max", ["P"])})
    assert rows(out) == [("k", 2024, 2.0, 5.0, 100.0)]


def _pxweb(spark, columns, data):
    doc = {"columns": [{"code": c, "text": c, "type": "d"} for c in columns],
           "data": [{"key": k, "values": v} for k, v in data]}
    return spark.createDataFrame([(doc,)], S.StructType([S.StructField("payload", S.PXWEB_SCHEMA)]))


def test_flatten_pxweb_column_order_is_per_document(spark):
    a = _pxweb(spark, ["Region", "Tid"], [(["01", "2024"], ["100"])])
    b = _pxweb(spark, ["Tid", "Region"], [(["2024", "01"], ["100"])])
    codes = {"region": "region", "year": "TID"}
    assert rows(D.flatten_pxweb(a, codes)) == rows(D.flatten_pxweb(b, codes)) == [("01", "2024", "100")]
    missing = D.flatten_pxweb(a, {"region": "Region", "sex": "Kon"})
    assert rows(missing) == [("01", None, "100")]


def test_explode_features(spark):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"scb_lan_code_2": "1", "region_name_official": "Stockholms"},
         "geometry": '{"type":"Point","coordinates":[1,2]}'}]}
    df = spark.createDataFrame([(doc,)], S.StructType([S.StructField("payload", S.GEOJSON_SCHEMA)]))
    out = D.explode_features(df).select("props.scb_lan_code_2", "geom")
    assert rows(out) == [("1", '{"type":"Point","coordinates":[1,2]}')]


def test_json_path_and_variant(spark):
    df = spark.createDataFrame([('{"k": 5, "a": {"b": "x"}}',), ("not json",)], "j string")
    out = df.select(D.json_path("j", "$.k", "int").alias("k"), D.json_path("j", "$.a.b").alias("b"),
                    D.variant_path("j", "$.k", "int").alias("kv"))
    assert [tuple(r) for r in out.collect()] == [(5, "x", 5), (None, None, None)]


def test_alias_lookup_and_left_join_predicate(spark):
    df = spark.createDataFrame([("Sörmland",), ("Uppsala",)], "n string")
    out = J.apply_alias(df, "n", [("sörmland", "Södermanland")], out="m", case_insensitive=True)
    assert rows(out) == [("Sörmland", "Södermanland"), ("Uppsala", "Uppsala")]
    fact = spark.createDataFrame([("k1", 1.0), ("k2", 2.0)], "indicator_key string, value double")
    dim = spark.createDataFrame([("k1", "DEMAND", "c1"), ("k2", "PRESSURE", "c2")], "indicator_key string, topic string, code string")
    j = J.lookup(fact, dim, [F.col("indicator_key")], [F.col("indicator_key")], ["code"],
                 extra_condition=F.col("topic") == "DEMAND")
    assert rows(j.select("indicator_key", F.coalesce("code", F.lit("VISITS_TOTAL")))) == \
        [("k1", "c1"), ("k2", "VISITS_TOTAL")]


def test_checked_broadcast_respects_bound(spark):
    small = spark.range(10)
    assert J.is_small(small, 100) and not J.is_small(small, 5)
    plan = J.lookup(spark.range(100).withColumnRenamed("id", "k"), small.withColumnRenamed("id", "k2"),
                    [F.col("k")], [F.col("k2")], ["k2"])._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_select_codes_and_best_match(spark):
    df = spark.createDataFrame([("01", "1999"), ("02", "2000"), ("03", "2001"), ("99", "2001")], "c string, y string")
    assert rows(SEL.select_codes(df, "c", ["01", "03"]).select("c")) == [("01",), ("03",)]
    assert rows(SEL.select_codes(df, "y", ["2024"], fallback_last=2).select("y")) == [("2000",), ("2001",), ("2001",)]
    cands = spark.createDataFrame([(1, "f", "andel besök 90 dagar"), (2, "f", "besök 90"), (3, "f", "andel x")],
                                  "id int, fam string, title string")
    best = SEL.best_match(cands, "fam", "title", "id", {"f": ["besök 90"]})
    assert [r.id for r in best.collect()] == [2]
    renamed = SEL.canonicalize_columns(df.withColumnRenamed("y", "the_year"), {"code": ["C"], "year": ["YEAR"]})
    assert renamed.columns == ["code", "year"]   # exact (any case) first, then containment


def test_read_documents_typed_and_variant(spark, tmp_path):
    import json
    from indicatormart.sources.readers import read_documents
    doc = {"columns": [{"code": "Tid"}, {"code": "Region"}], "data": [{"key": ["2024", "01"], "values": ["5"]}]}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "b.txt").write_text("not a document")
    typed = read_documents(spark, str(tmp_path), schema=S.PXWEB_SCHEMA, glob="*.json")
    assert rows(D.flatten_pxweb(typed, {"r": "Region", "y": "Tid"})) == [("01", "2024", "5")]
    var = read_documents(spark, str(tmp_path), glob="*.json")
    code = var.select(F.variant_get(F.col("payload"), "$.data[0].key[1]", "string").alias("c")).first().c
    assert code == "01"


def test_registry_calendar_strict_nulls(spark):
    from indicatormart.plans import reference as REF
    a = spark.createDataFrame([(dt.date(2024, 1, 5),)], "period_month date")
    b = spark.createDataFrame([(dt.date(2024, 3, 1),)], "period_date date")
    empty = spark.createDataFrame([], "period_month date")
    assert REF.dim_date(a, empty, b, a).count() == 3
    assert REF.dim_date(a, empty, b, a, strict_nulls=True).count() == 0   # one empty source empties it


def test_variant_documents_flatten_like_typed(spark, tmp_path):
    import json
    from indicatormart.plans import staging as STG
    from indicatormart.sources.readers import read_documents
    geo = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"scb_lan_code_2": "1", "region_name_official": "Stockholms", "extra": 1},
         "geometry": {"type": "Point", "coordinates": [18, 59]}}]}
    pop = {"columns": [{"code": "Tid"}, {"code": "Region"}], "data": [{"key": ["2024", "01"], "values": ["12.5"]}]}
    (tmp_path / "geo").mkdir()
    (tmp_path / "pop").mkdir()
    (tmp_path / "geo" / "g.json").write_text(json.dumps(geo, indent=1))
    (tmp_path / "pop" / "p.json").write_text(json.dumps(pop, indent=1))
    g_var = STG.stg_dim_region(read_documents(spark, str(tmp_path / "geo")))
    g_typ = STG.stg_dim_region(read_documents(spark, str(tmp_path / "geo"), schema=S.GEOJSON_SCHEMA))
    drop_geom = lambda df: rows(df.drop("geom"))
    assert drop_geom(g_var) == drop_geom(g_typ) == [(1, "01", "Stockholms", "Stockholm")]
    assert json.loads(g_var.first().geom) == json.loads(g_typ.first().geom) == geo["features"][0]["geometry"]
    p_var = STG.stg_population(read_documents(spark, str(tmp_path / "pop")))
    p_typ = STG.stg_population(read_documents(spark, str(tmp_path / "pop"), schema=S.PXWEB_SCHEMA))
    assert rows(p_var) == rows(p_typ) == [(1, "01", 2024, 13, "ALL", None)]


def test_tidy_sheet_long_and_wide(spark):
    from indicatormart.plans.tidy import tidy_sheet
    sheet = spark.createDataFrame(
        [("Region A", "Kvinnor", 5.0, 40.0, None), ("Region B", "Män", None, 30.0, 7.0)],
        "`Region/landsting/akutmottagning` string, `Kön` string, `2024/jan/Antal besök` double, "
        "`2024/jan/Median` double, `2024/feb./Antal besök` double")
    long, wide = tidy_sheet(sheet, ["Antal besök", "Median"])
    assert long.columns == ["Region", "Kon", "Year", "Month", "Metric", "Value", "Period"]
    assert long.count() == 4
    got = {(r.Region, r.Kon, r.Period.month): (r["Antal besök"], r.Median) for r in wide.collect()}
    assert got == {("Region A", "Kvinnor", 1): (5.0, 40.0), ("Region B", "Män", 1): (None, 30.0),
                   ("Region B", "Män", 2): (7.0, None)}

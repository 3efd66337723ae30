"""Large JSON documents read by many tasks, against the whole-document reader and Python's parser."""
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from indicatormart.operators import documents as D
from indicatormart.sources import elements as E
from indicatormart.sources import readers as RD
from indicatormart.sources import schemas as S

NASTY = ['plain', 'br{ace}', '[list], {"features": [1, 2]}', 'quo"te', 'back\\', 'b\\"', '\\\\', 'å }{ ][ ,', '"features":[', "", "\n\t"]


def _features(rng, n):
    def geometry(k):
        return {"type": "Polygon", "coordinates": [[[rng.random(), rng.random()] for _ in range(k)]], "features": [{"a": [1]}, 2]}
    return [{"type": "Feature", "properties": {"scb_lan_code_2": f"{i:02d}", "region_name_official": rng.choice(NASTY) + str(i),
                                               "features": [{"x": rng.choice(NASTY)}]},
             "geometry": geometry(rng.choice([1, 2, 40]))} for i in range(n)]


def _document(rng, n, **more):
    return {"crs": {"features": [1, {"b": "]"}]}, "note": rng.choice(NASTY), "bbox": [1, 2, [3]], "features": _features(rng, n),
            "after": [{"c": 1}, 2], "type": "FeatureCollection"} | more


@pytest.fixture
def small_splits(spark):
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield use
    for c, v in old.items():
        spark.conf.set(c, v)


@pytest.mark.parametrize("size", [61, 700, 5000, 10**6])
def test_features_of_documents_in_many_splits(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    docs = [_document(rng, n) for n in (17, 0, 1, 5)] + [{"type": "none"}, {"features": []}]
    for i, doc in enumerate(docs):
        text = json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"d{i}.json").write_text(text + rng.choice(["", "\n", " \n "]), encoding="utf-8")
    whole = D.explode_features(RD.read_documents(spark, str(tmp_path), S.GEOJSON_SCHEMA))
    plain = lambda df: [(*r[:2], json.loads(r[2])) for r in rows(df.select("props.*", "geom"))]
    want = plain(whole)             # the whole-document reader keeps the blanks of a geometry
    small_splits(size)
    feature = S.GEOJSON_SCHEMA["features"].dataType.elementType
    read = E.read_elements(spark, str(tmp_path), "features", feature, glob="*.json")
    if size <= 700:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 5
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(plain(D.feature_rows(read)), key=key) == sorted(want, key=key) and len(want) == 23
    # without a schema, against Python's parser
    got = E.read_elements(spark, str(tmp_path), "features").select(F.to_json("element").alias("j"))
    mine = sorted(json.dumps(f, sort_keys=True) for d in docs for f in d.get("features", []))
    assert sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in got.collect()) == mine


@pytest.mark.parametrize("size", [7, 40, 10**6])
def test_documents_that_are_arrays(spark, tmp_path, small_splits, size):
    values = [1, "a,b", [1, [2, 3]], {"k": "]"}, None, True, 'x"}', {"deep": [{"a": {}}, {}]}]
    (tmp_path / "a.json").write_text(" " + json.dumps(values))
    (tmp_path / "b.json").write_text(json.dumps([]))
    small_splits(size)
    got = [json.loads(r.j) for r in E.read_elements(spark, str(tmp_path), None).select(F.col("element").cast("string").alias("s"),
                                                                                       F.to_json("element").alias("j")).collect()
           if r.j is not None]
    key = lambda v: json.dumps(v, sort_keys=True)
    assert sorted(map(key, got)) == sorted(key(v) for v in values)


def test_documents_that_are_cut_off_fail(spark, tmp_path, small_splits):
    text = json.dumps(_document(random.Random(1), 6))
    small_splits(200)
    for i, end in enumerate((len(text) - 1, len(text) // 2, text.index('"properties"') + 30, text.rindex("}}") + 1)):
        folder = tmp_path / str(i)
        folder.mkdir()
        (folder / "d.json").write_text(text[:end])
        with pytest.raises(ValueError, match="not a whole JSON document"):
            E.read_elements(spark, str(folder), "features")
    assert E.read_elements(spark, str(_write(tmp_path / "ok", text)), "features").count() == 6


def _write(folder, text):
    folder.mkdir()
    (folder / "d.json").write_text(text)
    return folder

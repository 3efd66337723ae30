"""A stateless staging model over a file stream; a repeated micro-batch is published once."""
import os
import tempfile

from indicatormart.plans import staging as STG
from indicatormart.sources import schemas as S
from indicatormart.streaming import stage_stream


def test_stage_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="im-stream-")
    src, out, ckpt = (os.path.join(base, d) for d in ("in", "out", "ckpt"))
    rows = [("Region A", "1", "Region", "Kvinnor", "", "2024", "kr", "10.5", "Titel", "", "k"),
            ("Region B", "2", "Kommun", "Män", "0-17", "2024", "kr", "3", "", "Rubrik", "k")]
    raw = spark.createDataFrame(rows, S.string_schema(S.NET_COST_COLS))
    raw.write.parquet(src)
    stream = spark.readStream.schema(raw.schema).parquet(src)
    q = stage_stream(stream, STG.stg_net_cost, out, ckpt)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    expect = sorted(tuple(r) for r in STG.stg_net_cost(raw).collect())
    assert got == expect and len(got) == 1


def test_repeated_batch_is_published_once(spark):
    base = tempfile.mkdtemp(prefix="im-stream-")
    src, out = os.path.join(base, "in"), os.path.join(base, "out")
    spark.range(10).write.parquet(src)
    for attempt in ("first", "again"):           # the same batch ids once more, from a lost progress log
        stream = spark.readStream.schema("id long").parquet(src)
        stage_stream(stream, lambda d: d.selectExpr("id * 2 AS twice"), out, os.path.join(base, attempt)) \
            .awaitTermination(120)
    assert sorted(r.twice for r in spark.read.parquet(out).collect()) == list(range(0, 20, 2))

"""Written scratch tables, size-checked broadcasts and fixed-size Bloom filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatormart.sources.sinks import scratch_path

#: Most rows of a lookup side that may be broadcast (ids and a few numbers per row, so a few MB).
BROADCAST_ROWS = 200_000

#: Most bits of a Bloom filter: 16 MB, whatever the number of keys.
BLOOM_BITS = 1 << 27

_GOLDEN = 0x9E3779B97F4A7C15


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that goes when the session ends."""
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage (a lost executor reads the files again) and makes the
    counts of the table cheap.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """:func:`written` in buckets of ``key``: joins and groups by it read the files without a shuffle of this side."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    table = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    df.write.format("parquet").bucketBy(partitions(spark), key).option("path", path).saveAsTable(table)
    back = spark.table(table)
    spark.sql(f"DROP TABLE `{table}`")                  # the files stay, and so does the frame
    return back


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table as a join side: broadcast if its counted rows fit, else left to a shuffle join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def same_row(docs: DataFrame, id_col: str, text_col: str, keys: DataFrame) -> Column:
    """Join condition of ``docs`` and its keys ``(k_id, k_text)``; columns of ``docs`` may bear these names too."""
    return same(docs[id_col].cast("long"), keys["k_id"]) & (F.xxhash64(docs[text_col]) == keys["k_text"])


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# -- Bloom filters: fixed size, so they are broadcast whatever the corpus ----------------------

def _mix(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over uint64 keys."""
    return _mix(keys + np.uint64((seed * _GOLDEN + _GOLDEN) % 2**64))


def _slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    one, two = mix(keys, 7), mix(keys, 17)
    mask = np.uint64(bits - 1)
    return [((one + np.uint64(i) * two) & mask).astype(np.int64) for i in range(3)]


def bloom_of(keys: DataFrame, column: str, max_bits: int = BLOOM_BITS) -> np.ndarray:
    """Bits (packed in uint8) of a Bloom filter of every long in ``column`` of a written table.

    16 bits per key, but never more than ``max_bits``: a fuller filter lets
    more false keys pass, and no true key is ever missed.  Words of 64 bits are
    combined by ``bit_or``, so the driver gets at most ``max_bits / 64`` rows.
    """
    bits = 1 << 16
    n = keys.count()
    while bits < max_bits and bits < 16 * n:
        bits *= 2

    def positions(batches):
        import pyarrow as pa
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = np.unique(np.concatenate(_slots(keys, bits)))
            word, start = np.unique(at >> 6, return_index=True)
            value = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)), start) \
                if len(at) else np.zeros(0, np.uint64)
            yield pa.record_batch({"w": pa.array(word, pa.int64()), "b": pa.array(value.view(np.int64), pa.int64())})

    rows = (keys.select(F.col(column).cast("long").alias(column)).where(F.col(column).isNotNull())
            .mapInArrow(positions, "w long, b long").groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow())
    out = np.zeros(bits // 64, np.uint64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def in_bloom(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for at in _slots(keys, len(bits) * 8):
        found &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return found

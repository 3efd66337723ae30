"""Keys that are certainly unique, by a sketch of hashes; only the rest needs an exact count.

One scan serves several grains.  Each task sorts the 64-bit hashes of its keys
and sends, per part of the hash space, the number of rows and the distinct hashes
(their low five bytes, as sorted differences), so a hot key travels once a
task.  A part whose rows are as many as its distinct hashes has no key twice.
Other parts are suspect (a key that repeats, or two hashes that collide), and
their rows are grouped exactly.  On clean data nothing else is shuffled.

The sketch is numpy over Arrow batches: packing hashes needs no per-row Python,
and Spark has no built-in aggregate that packs them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.operators.joins import checked_broadcast
from indicatormart.sources.sinks import materialize

#: Rows of a part at about which a task that merges it works, and the most parts.
PART_ROWS, MAX_PARTS = 50_000, 1 << 20
#: Low bytes of a hash that travel; a part of 50,000 different keys has two alike in 1 case in 900.
BYTES = 5
#: Hashes a task sorts at a time (8 bytes each).
BLOCK = 4_000_000


def parts_for(n_rows: int) -> int:
    return int(min(MAX_PARTS, max(16, n_rows // PART_ROWS)))


def key_hash(cols: Sequence[str]) -> Column:
    """64-bit hash of a key; which columns are NULL is part of it."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(nulls, *[F.col(c) for c in cols])


def _part(hash_: Column, parts: int) -> Column:
    """The part of a hash: its high half, read as a number, scaled to ``parts``."""
    high = F.shiftrightunsigned(hash_, 32)
    return F.floor(high * F.lit(parts) / F.lit(float(2 ** 32))).cast("int")


def _packed(parts: int):
    schema = pa.schema([("grain", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("low", pa.binary())])

    def flush(grain: int, hashes: np.ndarray) -> pa.RecordBatch:
        keys, n = np.unique(hashes, return_counts=True)
        part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        end = np.append(start[1:], len(keys))
        low = np.sort(part << np.uint64(8 * BYTES) | keys & np.uint64((1 << 8 * BYTES) - 1))
        rows = np.add.reduceat(n, start)
        return pa.record_batch([pa.array(np.full(len(start), grain, np.int32)), pa.array(part[start].astype(np.int32)),
                                pa.array(rows.astype(np.int64)),
                                pa.array([_thin(low[a:b]) for a, b in zip(start, end)], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for g in range(batch.num_columns):
                column = batch.column(g).drop_null()
                if len(column):
                    held.setdefault(g, []).append(column.to_numpy().view(np.uint64))
                    size += len(column)
            if size >= BLOCK:
                for g in list(held):
                    yield flush(g, np.concatenate(held.pop(g)))
                size = 0
        for g in list(held):
            yield flush(g, np.concatenate(held.pop(g)))

    return run


def _thin(low: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte: the highest bytes are mostly zero and compress."""
    mask = np.uint64((1 << 8 * BYTES) - 1)
    steps = np.diff(low & mask, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8)[:, :BYTES].T.tobytes()


def _wide(data: bytes) -> np.ndarray:
    steps = np.zeros((len(data) // BYTES, 8), np.uint8)
    steps[:, :BYTES] = np.frombuffer(data, np.uint8).reshape(BYTES, -1).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _merge(table: pa.Table) -> pa.Table:
    """``(grain, part)`` if its rows are more than its distinct hashes."""
    low = np.concatenate([_wide(x) for x in table["low"].to_pylist()])
    suspect = sum(table["n"].to_pylist()) != len(np.unique(low))
    return table.select(["grain", "part"]).slice(0, 1 if suspect else 0)


def sketch(df: DataFrame, grains: Sequence[Sequence[str]], skip_nulls: Sequence[bool], parts: int) -> DataFrame:
    """``(grain, n, low, part)``: the packed hashes of every grain, in one scan."""
    hashes = []
    for cols, skip in zip(grains, skip_nulls, strict=True):
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        hashes.append(F.when(whole, key_hash(cols)) if skip else key_hash(cols))
    return df.select(*[h.alias(f"h{i}") for i, h in enumerate(hashes)]).mapInArrow(
        _packed(parts), "grain int, part int, n long, low binary")


def suspects(df: DataFrame, grains: Sequence[Sequence[str]], skip_nulls: Sequence[bool], parts: int) -> DataFrame:
    """Written ``(grain, part)`` that may hold a key twice."""
    packed = sketch(df, grains, skip_nulls, parts)
    return materialize(packed.groupBy("grain", "part").applyInArrow(_merge, "grain int, part int"), "suspect_keys")


def repeated_groups(df: DataFrame, grains: Sequence[Sequence[str]], skip_nulls: Sequence[bool],
                    n_rows: int) -> list[DataFrame]:
    """For each grain the groups that more than one row has, exactly (the columns and ``count``).

    ``df`` is read once for the sketch, and once more for a grain with suspect
    parts; give a written table.  ``n_rows`` only sets the number of parts.
    """
    parts = parts_for(n_rows)
    doubtful = suspects(df, grains, skip_nulls, parts)
    found = []
    for g, (cols, skip) in enumerate(zip(grains, skip_nulls, strict=True)):
        some = doubtful.filter(F.col("grain") == g).select(F.col("part").alias("__part"))
        d = df.select(*cols)
        if skip:
            d = d.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
        d = d.withColumn("__of", _part(key_hash(cols), parts))
        rest = d.join(checked_broadcast(some, base=doubtful), F.col("__of") == F.col("__part"), "left_semi")
        found.append(rest.groupBy(*cols).count().filter(F.col("count") > 1))
    return found

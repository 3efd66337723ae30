"""Packed vectors of integers: many rows in one, exact inner products, best rows per query.

A component x is floor(scale * x), x as double.  Rows without an id, without a
vector or with a null or non-finite component take no part.  Vectors of several
lengths may be mixed: the shorter one counts as filled up with zeros.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a pack, and the bytes of their vectors as doubles.
PACK_ROWS, PACK_BYTES = 8192, 16 << 20
#: Columns of a pack: one value per row, packed, and ``kind`` for the form of ``data``.
PACK = "dim int, kind string, ids binary, labels binary, flags binary, data binary"
_LONG = np.iinfo(np.int64)


class Pack(NamedTuple):
    """Rows whose vectors have one length."""
    ids: np.ndarray      # int64
    labels: np.ndarray   # int64
    flags: np.ndarray    # bool
    data: np.ndarray     # float64 holding integers, one row per vector

    def take(self, index: np.ndarray) -> Pack:
        return Pack(*(x[index] for x in self))

    @property
    def norms(self) -> np.ndarray:
        return np.einsum("ij,ij->i", self.data, self.data)


def pack_columns(pack: Pack) -> dict[str, list]:
    """The values of ``PACK`` for one row."""
    small = not pack.data.size or np.abs(pack.data).max() < 32768
    return {"dim": [pack.data.shape[1]], "kind": ["short" if small else "double"],
            "ids": [pack.ids.astype(np.int64).tobytes()], "labels": [pack.labels.astype(np.int64).tobytes()],
            "flags": [pack.flags.astype(np.uint8).tobytes()],
            "data": [pack.data.astype(np.int16 if small else np.float64).tobytes()]}


def unpack(row: dict) -> Pack:
    ids = np.frombuffer(row["ids"], np.int64)
    data = np.frombuffer(row["data"], np.int16 if row["kind"] == "short" else np.float64).astype(np.float64)
    return Pack(ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["flags"], np.uint8) > 0,
                data.reshape(len(ids), row["dim"]))


def rows_of(batch: pa.RecordBatch, scale: float) -> Iterator[Pack]:
    """The valid rows of a batch ``(id, label, flag, vector)``, one pack per length of vector."""
    vectors = batch.column(3)
    offset = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values
    good = values.is_valid().to_numpy(zero_copy_only=False)
    values = values.fill_null(0.0).to_numpy(zero_copy_only=False)
    low = offset[0]
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(values * scale)
    bad = np.concatenate([[0], np.cumsum(~(good & np.isfinite(values) & np.isfinite(whole)))])
    size = np.diff(offset)
    use = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[offset[1:]] == bad[offset[:-1]])
    use &= batch.column(0).is_valid().to_numpy(zero_copy_only=False)
    use &= batch.column(1).is_valid().to_numpy(zero_copy_only=False)
    ids, labels = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in (0, 1))
    flags = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False)
    for dim in np.unique(size[use]):
        at = np.flatnonzero(use & (size == dim))
        some = max(1, min(PACK_ROWS, PACK_BYTES // (8 * max(1, int(dim)))))
        for lo in range(0, len(at), some):
            part = at[lo:lo + some]
            data = whole[(offset[part] - low)[:, None] + low + np.arange(dim)[None, :]]
            yield Pack(ids[part], labels[part], flags[part], data)


def vector_rows(rows: DataFrame, id_col: str, vec_col: str, label: Column | None = None,
                flag: Column | None = None) -> DataFrame:
    """``(id, label, flag, vector)`` of all rows, as ``rows_of`` reads them."""
    return rows.select(
        F.col(id_col).cast("long").alias("id"),
        (F.lit(0).cast("long") if label is None else label.cast("long")).alias("label"),
        F.coalesce(flag, F.lit(False)).alias("flag") if flag is not None else F.lit(False).alias("flag"),
        F.col(vec_col).cast("array<double>").alias("vector"))


def table_packs(table: pa.Table) -> list[Pack]:
    """The packs of a table, joined where their vectors have one length."""
    by_dim: dict[int, list[Pack]] = {}
    for row in table.to_pylist():
        by_dim.setdefault(row["dim"], []).append(unpack(row))
    return [Pack(*(np.concatenate(x) for x in zip(*packs, strict=True))) for packs in by_dim.values()]


# -- inner products ----------------------------------------------------------------------------

def products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``one`` with all of ``two``, as exact integers.

    By doubles where no sum can leave their exact range, else by Python's
    integers; a product beyond a long becomes the greatest or smallest long.
    """
    dim = min(one.shape[1], two.shape[1])
    one, two = one[:, :dim], two[:, :dim]
    if not one.size or not two.size:
        return np.zeros((len(one), len(two)), np.int64)
    if float(np.abs(one).max()) * float(np.abs(two).max()) * dim < 2.0 ** 53:
        return (one @ two.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (one, two)]
    return np.array([[min(max(sum(x * y for x, y in zip(a, b, strict=True)), _LONG.min), _LONG.max) for b in whole[1]]
                     for a in whole[0]], np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best distinct (id, score) pairs: higher scores first, ties by smaller id."""
    if len(ids) > 8 * k:
        least = np.partition(scores, len(scores) - 4 * k)[len(scores) - 4 * k]
        some = scores >= least
        if len(set(zip(ids[some].tolist(), scores[some].tolist(), strict=True))) >= k:
            ids, scores = ids[some], scores[some]
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
    return ids[new][:k], scores[new][:k]

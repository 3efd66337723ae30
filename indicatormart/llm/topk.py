"""Exact top-k search by inner product, with multi-resolution segment statistics.

A vector is cut into segments; of each segment the mean and the deviation are
kept, at resolutions from one segment to a quarter of the components.  With m
and s the means and deviations of segments of l components,

    sum l * ((m_q - m_x)^2 + (s_q - s_x)^2)  <=  squared distance of q and x,

and as the squared lengths are exactly sum l * (m^2 + s^2), the inner product is
at most sum l * (m_q * m_x + s_q * s_x): the inner product of the two rows of
statistics, each times the root of l.  Rows whose bound is under the query's
k-th best score so far go, coarse to fine; survivors get exact scores.

1.  Rows are packed where they lie (no shuffle).  Within its own pack each query
    gets a first k-th best score.
2.  Pieces of queries meet groups of packs: both are dealt to all pairs
    (piece, group), so no task holds more than a piece and a group.
3.  The k best of each query over its groups are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatormart.llm._tables import partitions, written
from indicatormart.llm._vectors import PACK, Pack, best, pack_columns, products, rows_of, table_packs, unpack, vector_rows

SCALE = 256.0
#: Rows of a group of packs, and queries of a piece: what one task holds at a time.
GROUP_ROWS, PIECE_ROWS = 1 << 18, 1 << 16
#: Queries, and rows, whose bounds are looked at together.
BLOCK, SOME = 128, 8192
_NONE = np.iinfo(np.int64).min


# -- bounds ------------------------------------------------------------------------------------

def resolutions(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 4, 16, ... while a segment has four components."""
    out = [1]
    while 4 * out[-1] * 4 <= dim:
        out.append(4 * out[-1])
    return out


def statistics(data: np.ndarray, segments: int, dim: int) -> np.ndarray:
    """Means and deviations of ``segments`` segments of the first ``dim`` components, times the root of the length."""
    edge = np.linspace(0, dim, segments + 1).astype(int)
    out = np.empty((len(data), 2 * segments))
    for i, (lo, hi) in enumerate(zip(edge, edge[1:], strict=False)):
        part = data[:, lo:hi]
        mean = part.mean(1)
        out[:, i] = mean * np.sqrt(hi - lo)
        out[:, segments + i] = np.sqrt(np.square(part - mean[:, None]).sum(1))
    return out


def search(queries: np.ndarray, least: np.ndarray, own: np.ndarray, rows: Pack, k: int,
           found: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Merge the best rows for each query into ``found`` (ids, scores); ``least`` is a score to reach, raised here."""
    with np.errstate(over="ignore", invalid="ignore"):
        _search(queries, least, own, rows, k, found)


def _search(queries, least, own, rows, k, found) -> None:
    dim = min(queries.shape[1], rows.data.shape[1])
    levels = resolutions(dim) if dim else []
    mine = [statistics(queries, n, dim) for n in levels]
    slack = [1e-9 * np.sqrt(np.square(x).sum(1)).max(initial=0.0) for x in mine]
    for lo in range(0, len(rows.ids), SOME):
        part = rows.take(np.arange(lo, min(lo + SOME, len(rows.ids))))
        theirs = [statistics(part.data, n, dim) for n in levels]
        for a in range(0, len(queries), BLOCK):
            block = slice(a, a + BLOCK)
            bar = least[block].astype(np.float64)
            alive = np.ones((len(bar), len(part.ids)), bool)
            some = np.arange(len(part.ids))                    # rows that are alive for some query
            for q, x, wide in zip(mine, theirs, slack, strict=True):
                room = 1.0 + wide * np.sqrt(np.square(x).sum(1)).max(initial=0.0)
                alive[:, some] &= ~(q[block] @ x[some].T + room < bar[:, None])     # also alive: not a number
                some = some[alive[:, some].any(0)]
                if not len(some):
                    break
            if not len(some):
                continue
            score = products(queries[block], part.data[some])
            good = alive[:, some] & (score >= least[block, None]) & (own[block, None] != part.ids[some][None, :])
            for i in np.flatnonzero(good.any(1)):
                at = np.flatnonzero(good[i])
                old = found[a + i]
                ids, scores = best(np.concatenate([old[0], part.ids[some][at]]),
                                   np.concatenate([old[1], score[i, at]]), k)
                found[a + i] = ids, scores
                if len(ids) == k:
                    least[a + i] = max(least[a + i], scores[-1])


def _nothing(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    none = np.zeros(0, np.int64)
    return [(none, none)] * n


# -- Spark -------------------------------------------------------------------------------------

def _packs(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[int, list[Pack]] = {}
        schema = pa.schema([("rows", pa.int64()), ("queries", pa.int64()), ("dim", pa.int32()), ("kind", pa.string()),
                            *((c, pa.binary()) for c in ("ids", "labels", "flags", "data"))])

        def full(dim):
            pack = Pack(*(np.concatenate(x) for x in zip(*held.pop(dim), strict=True)))
            return pa.record_batch({"rows": [len(pack.ids)], "queries": [int(pack.flags.sum())], **pack_columns(pack)},
                                   schema)

        for batch in batches:
            for pack in rows_of(batch, SCALE):
                dim = pack.data.shape[1]
                held.setdefault(dim, []).append(pack)
                if sum(len(p.ids) for p in held[dim]) >= SOME:
                    yield full(dim)
        for dim in list(held):
            yield full(dim)

    return written(rows.mapInArrow(run, "rows long, queries long, " + PACK), "vectors")


def _queries(packs: DataFrame, k: int) -> DataFrame:
    """The queries of each pack, with the k-th best score in the pack in ``least``."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                pack = unpack(row)
                mine = pack.take(np.flatnonzero(pack.flags))
                least, found = np.full(len(mine.ids), _NONE), _nothing(len(mine.ids))
                search(mine.data, least, mine.ids, pack, k, found)
                yield pa.record_batch({"q_dim": pa.array([mine.data.shape[1]], pa.int32()),
                                       "least": pa.array([least.tobytes()], pa.binary()),
                                       **{c: pa.array(v, pa.int32() if c == "dim" else None)
                                          for c, v in pack_columns(mine).items()}})

    return packs.where("queries > 0").mapInArrow(run, "q_dim int, least binary, " + PACK)


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of highest score for each row where ``is_query`` holds.

    A component x counts as floor(256 * x), the score is the integer inner
    product; ties go to the smaller id.  Rows that bear the query's id are never
    its answers.  Rows without an id, a vector or with a null or non-finite
    component take no part; an empty vector scores zero, and of two lengths the
    shorter vector is filled up with zeros.  An id and score count once for a
    query id, so repeated rows are answered once; a query with fewer than ``k``
    other rows gets them all.  Very long vectors are packed in fewer rows.
    Other columns are ignored; an empty table gives no rows.

    The result is exact: a row is only left out when its bound is under ``k``
    scores that were found.  On vectors without structure few bounds are, and
    the work is that of all pairs of queries and rows.
    """
    packs = _packs(vector_rows(rows, id_col, vec_col, None, is_query))
    total = packs.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("queries"), F.lit(0)),
                      F.count(F.lit(1))).first()
    groups = max(1, min(total[2], max(2 * partitions(rows.sparkSession), total[0] // GROUP_ROWS)))
    pieces = max(1, -(-total[1] // PIECE_ROWS))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("ids", "data"), F.lit(n)).cast("int")
    right = written(_queries(packs, k).withColumn("piece", dealt(pieces)), "queries").withColumn("group", numbers(groups))
    left = packs.withColumn("group", dealt(groups)).withColumn("piece", numbers(pieces))

    def run(some: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        held = table_packs(some) if asked.num_rows else []
        for row in asked.to_pylist():
            mine, least = unpack(row), np.frombuffer(row["least"], np.int64).copy()
            found = _nothing(len(mine.ids))
            for pack in held:
                search(mine.data, least, mine.ids, pack, k, found)
            out["query_id"].append(np.repeat(mine.ids, [len(i) for i, _ in found]))
            out["vec_id"] += [i for i, _ in found]
            out["score"] += [s for _, s in found]
        return pa.table({c: pa.array(np.concatenate([np.zeros(0, np.int64), *v])) for c, v in out.items()})

    found = left.groupBy("piece", "group").cogroup(right.groupBy("piece", "group")).applyInArrow(
        run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.repartition("query_id").dropDuplicates()
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score")

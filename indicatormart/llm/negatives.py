"""Hard negatives by a GNAT-style multiway hyperplane tree.

1.  A bounded sample gives the tree: each node has split points far apart, and
    a row belongs to the child whose split point is nearest (all hyperplanes
    between split points at once).
2.  Every row goes down to its leaf.  For each split point of a node and each of
    its children the range of distances from that point to all rows below the
    child is kept, and the range of the rows' lengths.
3.  A search is a window of scores.  With the lengths it becomes an annulus of
    distances around the anchor.  A child is left out if, for some split point of
    its node, the annulus around the anchor can't meet the child's range, by the
    triangle inequality.  Leaves that remain are searched exactly.
4.  Positives: the anchor's own leaf gives a first k-th best score, then all
    leaves that may hold better ones are searched.  Negatives: one window per
    positive, all leaves that any window meets.

Leaves over ``SHARD_ROWS`` rows (copies can't be split) are dealt to several
shards, and anchors to pieces, so a task holds one shard and one piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from indicatormart.llm._tables import written
from indicatormart.llm._vectors import PACK, Pack, best, pack_columns, products, rows_of, table_packs, unpack, vector_rows

SCALE = 256.0
#: Rows of the sample that the tree is fitted on, and the most bytes of their vectors.
SAMPLE, SAMPLE_BYTES = 16384, 64 << 20
#: Split points of a node, the rows a leaf should hold, and the most leaves and levels.
FANOUT, LEAF_ROWS, LEAVES, DEPTH = 8, 4096, 1024, 4
#: Most rows of a shard and anchors of a piece (as dealt by hash).
SHARD_ROWS, PIECE_ROWS = 1 << 15, 1 << 14
#: Anchors whose scores are held together.
BLOCK = 128


class Tree(NamedTuple):
    """Nodes by number; the root is 0."""
    points: list[np.ndarray]     # of each node its split points, one per row
    children: list[np.ndarray]   # of each split point the child's node, or -1 - leaf
    leaves: int


class Ranges(NamedTuple):
    """Of each node: lowest and highest distance of split point i to the rows below child j, and these rows' lengths."""
    low: list[np.ndarray]
    high: list[np.ndarray]
    shortest: list[np.ndarray]
    longest: list[np.ndarray]


# -- the tree ----------------------------------------------------------------------------------

def distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``one`` to all of ``two``; the shorter vectors are filled up with zeros."""
    dim = min(one.shape[1], two.shape[1])
    square = np.einsum("ij,ij->i", one, one)[:, None] + np.einsum("ij,ij->i", two, two)[None, :]
    return np.sqrt(np.maximum(square - 2 * (one[:, :dim] @ two[:, :dim].T), 0))


def fit_tree(sample: np.ndarray, n_rows: int) -> Tree:
    """A tree whose leaves get about ``LEAF_ROWS`` of ``n_rows`` rows, as far as the sample tells rows apart."""
    points: list[np.ndarray] = []
    children: list[np.ndarray] = []
    leaves = 0

    def spread(rows):
        """Split points, each the farthest from those before it."""
        at, gap = [], np.full(len(rows), np.inf)
        far = distances(rows, rows.mean(0, keepdims=True))[:, 0]
        k = int(far.argmax())
        while len(at) < FANOUT:
            at.append(k)
            gap = np.minimum(gap, distances(rows, rows[k:k + 1])[:, 0])
            k = int(gap.argmax())
            if gap[k] <= 0:
                break
        return rows[at]

    todo = [(sample, 0, None)]
    while todo:
        rows, depth, above = todo.pop(0)
        split = None
        if len(rows) > 1 and depth < DEPTH and n_rows * len(rows) > LEAF_ROWS * len(sample) \
                and leaves + len(todo) + FANOUT <= LEAVES:
            split = spread(rows)
        if split is None or len(split) < 2:
            name, leaves = -1 - leaves, leaves + 1
        else:
            name = len(points)
            points.append(split)
            children.append(np.zeros(len(split), np.int64))
            nearest = distances(rows, split).argmin(1)
            todo += [(rows[nearest == i], depth + 1, (name, i)) for i in range(len(split))]
        if above:
            children[above[0]][above[1]] = name
    return Tree(points, children, leaves)


def route(tree: Tree, data: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The leaf of each row, and of each node the rows in it, their child there and distances to its split points."""
    leaf = np.zeros(len(data), np.int64)
    seen = {}
    todo = [(0, np.arange(len(data)))] if tree.points else []
    while todo:
        node, at = todo.pop()
        gap = distances(data[at], tree.points[node])
        child = gap.argmin(1)
        seen[node] = at, child, gap
        for i, below in enumerate(tree.children[node].tolist()):
            rows = at[child == i]
            if below < 0:
                leaf[rows] = -1 - below
            elif len(rows):
                todo.append((below, rows))
    return leaf, seen


def meeting(tree: Tree, ranges: Ranges, data: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """``(anchor, leaf)`` pairs whose rows may score within one of the anchor's windows.

    ``windows`` are pairs of arrays (lowest, highest score; lowest over highest: no window), one for each number of
    window.
    """
    n = len(data)
    if not tree.points:
        at = np.flatnonzero(np.any([lo <= hi for lo, hi in windows], axis=0))
        return np.stack([at, np.zeros_like(at)], 1)
    square = np.einsum("ij,ij->i", data, data)
    out = []
    todo = [(0, np.arange(n))]
    with np.errstate(over="ignore", invalid="ignore"):
        while todo:
            node, at = todo.pop()
            gap = distances(data[at], tree.points[node])[:, :, None]           # anchor, split point
            low, high = ranges.low[node][None], ranges.high[node][None]        # split point, child
            keep = np.zeros((len(at), low.shape[2]), bool)
            for least, most in windows:
                # squared distance = lengths squared - 2 * score
                inner = square[at, None] + ranges.shortest[node][None] ** 2 - 2 * most[at, None]
                outer = square[at, None] + ranges.longest[node][None] ** 2 - 2 * least[at, None]
                room = 1e-6 * (1 + square[at, None] + ranges.longest[node][None] ** 2)
                possible = ~(outer < -room) & (least[at] <= most[at])[:, None]
                inner = np.sqrt(np.maximum(inner - room, 0))[:, None, :]
                outer = np.sqrt(np.maximum(outer + room, 0))[:, None, :]
                near = 1e-6 * (1 + np.sqrt(square[at, None]) + ranges.longest[node][None])[:, None, :]
                apart = (gap + outer + near < low) | (gap - outer - near > high) | (gap + high + near < inner)
                keep |= possible & ~apart.any(1)
            keep &= ranges.low[node].min(0)[None] < np.inf                      # no rows below it
            for i, below in enumerate(tree.children[node].tolist()):
                rows = at[keep[:, i]]
                if below < 0:
                    out.append(np.stack([rows, np.full(len(rows), -1 - below)], 1))
                elif len(rows):
                    todo.append((below, rows))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


# -- rows in leaves ----------------------------------------------------------------------------

_LEAF_SCHEMA = pa.schema([("leaf", pa.int64()), ("rows", pa.int64()), ("n_flags", pa.int64()), ("dim", pa.int32()), ("kind", pa.string()),
                          *((c, pa.binary()) for c in ("ids", "labels", "flags", "data"))])


def _sample(rows: DataFrame) -> tuple[np.ndarray, int]:
    """A bounded sample of the valid vectors as rows of one width, and the number of rows."""
    n = rows.count()
    if not n:
        return np.zeros((0, 0)), 0
    some = rows.sample(min(1.0, 1.1 * SAMPLE / n), seed=7).limit(SAMPLE)

    def valid(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for pack in rows_of(batch, SCALE):
                yield pa.record_batch(pack_columns(pack), pa.schema(list(_LEAF_SCHEMA)[3:]))

    widest = some.select(F.max(F.size("vector"))).first()[0] or 0
    room = max(64, SAMPLE_BYTES // (8 * max(1, widest)))
    packs = table_packs(some.limit(room).mapInArrow(valid, PACK).toArrow())
    width = max((p.data.shape[1] for p in packs), default=0)
    filled = [np.pad(p.data, ((0, 0), (0, width - p.data.shape[1]))) for p in packs]
    return (np.concatenate(filled) if filled else np.zeros((0, width))), n


def _in_leaves(rows: DataFrame, tree: Tree) -> DataFrame:
    """Written packs of the rows of each leaf."""
    known = rows.sparkSession.sparkContext.broadcast(tree)        # LEAVES points at most

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for pack in rows_of(batch, SCALE):
                leaf, _ = route(known.value, pack.data)
                for i in np.unique(leaf):
                    part = pack.take(np.flatnonzero(leaf == i))
                    yield pa.record_batch({"leaf": [int(i)], "rows": [len(part.ids)], "n_flags": [int(part.flags.sum())],
                                           **pack_columns(part)}, _LEAF_SCHEMA)

    return written(rows.mapInArrow(run, "leaf long, rows long, n_flags long, " + PACK), "leaves")


def _ranges(packs: DataFrame, tree: Tree) -> Ranges:
    """Ranges over all rows: each task sends one row per (node, split point, child), added up by Spark."""
    known = packs.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                pack = unpack(row)
                length = np.sqrt(pack.norms)
                out = []
                for node, (at, child, gap) in route(known.value, pack.data)[1].items():
                    for j in np.unique(child):
                        some = child == j
                        size = length[at[some]]
                        lo, hi = gap[some].min(0), gap[some].max(0)
                        out += [(node, i, int(j), lo[i], hi[i], size.min(), size.max()) for i in range(len(lo))]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema)

    names = ("node", "point", "child", "low", "high", "shortest", "longest")
    schema = pa.schema([(c, pa.int32() if i < 3 else pa.float64()) for i, c in enumerate(names)])
    rows = packs.mapInArrow(run, "node int, point int, child int, low double, high double, shortest double, longest double")
    found = rows.groupBy("node", "point", "child").agg(F.min("low"), F.max("high"), F.min("shortest"), F.max("longest"))
    size = [len(p) for p in tree.points]
    out = Ranges([np.full((m, m), np.inf) for m in size], [np.full((m, m), -np.inf) for m in size],
                 [np.full(m, np.inf) for m in size], [np.zeros(m) for m in size])
    for node, i, j, low, high, shortest, longest in found.collect():        # at most LEAVES * FANOUT rows
        out.low[node][i, j], out.high[node][i, j] = low, high
        out.shortest[node][j], out.longest[node][j] = shortest, longest
    return out


# -- anchors -----------------------------------------------------------------------------------

_ANCHOR = "id long, label long, dim int, kind string, data binary"


def _anchors(packs: DataFrame) -> DataFrame:
    """One row per distinct anchor; ``key`` stands for its id, label and vector."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                pack = unpack(row)
                mine = pack.take(np.flatnonzero(pack.flags))
                some = [pack_columns(mine.take(np.array([i]))) for i in range(len(mine.ids))]
                yield pa.record_batch({"id": pa.array(mine.ids, pa.int64()), "label": pa.array(mine.labels, pa.int64()),
                                       "dim": pa.array([mine.data.shape[1]] * len(some), pa.int32()),
                                       "kind": pa.array([x["kind"][0] for x in some], pa.string()),
                                       "data": pa.array([x["data"][0] for x in some], pa.binary())})

    return packs.mapInArrow(run, _ANCHOR).dropDuplicates().withColumn("key", F.xxhash64("id", "label", "data"))


def _anchor_packs(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[np.ndarray, Pack]]:
    """Rows of the table and their vectors, by form and length."""
    dim = table.column("dim").to_numpy()
    kinds = np.array(table.column("kind").to_pylist(), dtype=object)
    for d, kind in sorted(set(zip(dim.tolist(), kinds.tolist(), strict=True))):
        at = np.flatnonzero((dim == d) & (kinds == kind))
        some = table.take(pa.array(at))
        data = b"".join(some.column("data").to_pylist())
        pack = unpack({"dim": d, "kind": kind, "data": data, "flags": bytes(len(at)),
                       **{c: some.column(n).to_numpy().astype(np.int64).tobytes() for c, n in (("ids", "id"), ("labels", "label"))}})
        yield at, pack


def visits(anchors: DataFrame, known, pairs: Callable[[pa.RecordBatch, np.ndarray, Pack], np.ndarray]) -> DataFrame:
    """Each anchor at every shard of the leaves that ``pairs`` (rows of the pack, leaf) names, with ``leaf`` and ``salt``."""
    def run(batches: Iterator[pa.RecordBatch]):
        salts = known.value[2]
        for batch in batches:
            for at, pack in _anchor_packs(batch):
                found = pairs(batch, at, pack)
                times = salts[found[:, 1]]
                row, leaf = np.repeat(at[found[:, 0]], times), np.repeat(found[:, 1], times)
                salt = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                some = batch.take(pa.array(row))
                yield pa.record_batch([*some.columns, pa.array(leaf, pa.int64()), pa.array(salt, pa.int32())],
                                      names=[*batch.schema.names, "leaf", "salt"])

    schema = StructType([*anchors.schema.fields, StructField("leaf", LongType()), StructField("salt", IntegerType())])
    return anchors.mapInArrow(run, schema)


def windows(scores: list[list[int]], ratio: tuple[int, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each place among the positives the lowest and highest score of its negatives (lowest over highest: none)."""
    out = []
    for j in range(max(map(len, scores), default=0)):
        score = np.array([s[j] if j < len(s) else -1 for s in scores], np.float64)      # below zero no score fits
        out.append((np.where(score < 0, np.inf, score * ratio[0] / ratio[1]), np.where(score < 0, -np.inf, score)))
    return out


def _search(packs: DataFrame, asked: DataFrame, columns: str,
            answer: Callable[[dict, np.ndarray, np.ndarray], Iterator[tuple]], same: bool) -> DataFrame:
    """``answer(anchor, ids, scores)`` on the rows of each shard that bear the anchor's label (or another) but not its id."""
    names = [c.split()[0] for c in columns.split(", ")]
    keep = [c for c in asked.columns if c not in ("data", "kind", "dim", "leaf", "salt", "piece")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        held = table_packs(left) if right.num_rows else []
        for at, mine in _anchor_packs(right) if held else ():
            facts = right.select(keep).take(pa.array(at)).to_pylist()
            for lo in range(0, len(at), BLOCK):
                for pack in held:
                    score = products(mine.data[lo:lo + BLOCK], pack.data)
                    for i, row in enumerate(score, lo):
                        use = np.flatnonzero(((pack.labels == mine.labels[i]) == same) & (pack.ids != mine.ids[i]))
                        out += answer(facts[i], pack.ids[use], row[use])
        columns_ = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.table({n: pa.array(c, pa.int32() if n == "place" else pa.int64())
                         for n, c in zip(names, columns_, strict=True)})

    return packs.groupBy("leaf", "salt", "piece").cogroup(asked.groupBy("leaf", "salt", "piece")).applyInArrow(run, columns)


def _first(found: DataFrame, keys: list[str], other: str, k: int) -> DataFrame:
    """The ``k`` best distinct (``other``, score) of each key, with ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), other)
    once = found.repartition(*keys).dropDuplicates([*keys, other, "score"])
    return once.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5,
                   ratio: tuple[int, int] = (80, 100), id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    An anchor is a row where ``is_anchor`` holds; its positives are the
    ``n_positives`` other rows of its label with the highest scores.  For each
    positive: the ``n_negatives`` rows of other labels with the highest scores
    from ``ratio`` of the positive's score up to that score; a positive with a
    negative score, or without such rows, has none.  A component x counts as
    floor(256 * x); the score is the integer inner product; ties go to the
    smaller id.

    Rows without an id, a label or a vector, or with a null or non-finite
    component take no part.  Rows that bear the anchor's id are neither its
    positives nor its negatives.  Rows equal in id and score count once for an
    anchor, equal rows are one anchor; rows that share an id but differ are
    separate anchors.  Empty vectors score zero; of two lengths the shorter
    vector is filled up with zeros; very long ones are packed in fewer rows.
    Other columns are ignored; an empty table gives no rows.

    The tree is fitted on ``SAMPLE`` rows and holds all rows; whatever the
    sample, results are exact.  On vectors without structure distances are alike,
    few leaves are left out, and the work nears that of all anchors and rows.
    """
    spark = rows.sparkSession
    valid = vector_rows(rows, id_col, vec_col, F.col(label_col), is_anchor)
    sample, n = _sample(valid)
    tree = fit_tree(sample, n)
    packs = _in_leaves(valid, tree)
    ranges = _ranges(packs, tree)
    salts = np.ones(tree.leaves, np.int64)
    for leaf, size in packs.groupBy("leaf").agg(F.sum("rows")).collect():       # LEAVES rows at most
        salts[leaf] = -(-size // SHARD_ROWS)
    known = spark.sparkContext.broadcast((tree, ranges, salts))
    anchors = _anchors(packs)
    pieces = max(1, -(-(packs.agg(F.sum("n_flags")).first()[0] or 0) // PIECE_ROWS))
    anchors = written(anchors.withColumn("piece", F.pmod("key", F.lit(pieces)).cast("int")), "anchors")
    shards = packs.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))).withColumn(
        "salt", F.pmod(F.xxhash64("ids", "data"), F.element_at(F.lit(salts.tolist()), (F.col("leaf") + 1).cast("int")))
        .cast("int"))

    def near(fact: dict, ids: np.ndarray, scores: np.ndarray) -> Iterator[tuple]:
        if fact.get("least") is not None:
            use = scores >= fact["least"]
            ids, scores = ids[use], scores[use]
        return [(fact["key"], i, s) for i, s in zip(*(x.tolist() for x in best(ids, scores, n_positives)), strict=True)]

    def home(batch: pa.RecordBatch, at: np.ndarray, pack: Pack) -> np.ndarray:
        return np.stack([np.arange(len(at)), route(known.value[0], pack.data)[0]], 1)

    def others(batch: pa.RecordBatch, at: np.ndarray, pack: Pack) -> np.ndarray:
        least = batch.column(batch.schema.get_field_index("least")).to_numpy(zero_copy_only=False)[at].astype(float)
        least = np.where(np.isnan(least), -np.inf, least)
        pairs = meeting(*known.value[:2], pack.data, [(least, np.full(len(at), np.inf))])
        return pairs[pairs[:, 1] != route(known.value[0], pack.data)[0][pairs[:, 0]]]

    def in_windows(batch: pa.RecordBatch, at: np.ndarray, pack: Pack) -> np.ndarray:
        scores = batch.column(batch.schema.get_field_index("scores")).take(pa.array(at)).to_pylist()
        return meeting(*known.value[:2], pack.data, windows(scores, ratio))

    def hard(fact: dict, ids: np.ndarray, scores: np.ndarray) -> Iterator[tuple]:
        out = []
        for place, top in enumerate(fact["scores"], 1):
            if top < 0:
                continue
            use = (scores <= top) & (scores >= -(-ratio[0] * top // ratio[1]))      # whole scores: rounded up
            out += [(fact["key"], place, i, s) for i, s in
                    zip(*(x.tolist() for x in best(ids[use], scores[use], n_negatives)), strict=True)]
        return out

    pairs = "key long, positive_id long, score long"
    first = written(_search(shards, visits(anchors, known, home), pairs, near, True), "near")
    bar = _first(first, ["key"], "positive_id", n_positives).groupBy("key").agg(
        F.when(F.count(F.lit(1)) >= n_positives, F.min("score")).alias("least"))
    rest = _search(shards, visits(anchors.join(bar, "key", "left"), known, others), pairs, near, True)
    positives = written(_first(first.unionByName(rest), ["key"], "positive_id", n_positives), "positives")
    lists = positives.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "score")))["score"].alias("scores"))
    asked = visits(anchors.join(lists, "key"), known, in_windows)
    found = _first(_search(shards, asked, "key long, place int, negative_id long, score long", hard, False),
                   ["key", "place"], "negative_id", n_negatives)
    named = positives.select("key", F.col("rank").alias("place"), "positive_id", F.col("score").alias("positive_score"))
    return found.join(named, ["key", "place"]).join(anchors.select("key", F.col("id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))

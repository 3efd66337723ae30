"""Connected components of a large edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.llm._tables import written

_MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every node with an edge; the root is the smallest node of its component.

    Minima are combined before the shuffle and no neighbour list is built, so
    a node with very many edges costs rows, not one task's memory.  Each round
    is written to the shared scratch folder.
    """
    ordered = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).distinct()
    now = written(ordered, "edges")
    state = _state(now)
    for _ in range(_MAX_ROUNDS):
        if not state[0]:
            break
        now = written(_small_star(written(_large_star(now), "edges")), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the labels of linked positions in place; a label is the least position of its component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up

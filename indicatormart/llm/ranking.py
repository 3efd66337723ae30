"""Quality scores from pairwise preferences (Bradley-Terry).

A document's strength is a weighted sum of text measures.  The weights minimise
the logistic loss on the differences of their measures over all preference
pairs (every document labelled good against every one labelled bad).  The
strength that parts the labels best, of all that occur, becomes the threshold,
and strengths are mapped to 0..1 so that the threshold lies at ``cut``.

The pairs are never formed.  Rows are put in narrow cells of strength; the loss
of a pair is a power series in the two distances from the cells' centres, so
sums of powers per label and cell, over all rows, give the loss and its slope
over all pairs (to about 1e-9 a pair).  One round is one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatormart.llm.quality_rules import measures, probability
from indicatormart.llm._tables import partitions, written

CUT = 0.3
#: Width of a cell of strength, and the highest power summed in it.
WIDTH = 0.25
POWERS = 6
#: Newton steps at most, and the change of every weight at which they end sooner.
ROUNDS = 50
SETTLED = 1e-8
RIDGE = 1e-4

#: What a strength is a sum of, over the measures of ``quality_rules.measures``.
FEATURES = (
    "ln(1 + n_words)",
    "least(n_words, 50) / 50",
    "least(20, word_chars / greatest(n_words, 1))",
    "least(2, n_symbols / greatest(n_words, 1))",
    "double(n_symbols > 0.1 * n_words)",
    "least(1, n_capitals / greatest(word_chars, 1))",
    "double(n_capitals > 0.3 * word_chars)",
    "least(1, n_exclaims / greatest(n_words, 1))",
    "n_repeat_words / greatest(n_words, 1)",
    "double(n_repeat_words > 0.5 * n_words)",
    "n_dup_lines / greatest(n_lines, 1)",
    "n_ended / greatest(n_lines, 1)",
    "n_distinct / greatest(n_words, 1)",
    "double(n_words = 0)",
)


class Ranker(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    cut: float

    def _sum(self, features: Column, start: float) -> Column:
        table = F.lit([float(v) for v in self.weights / self.scale])
        return F.aggregate(F.transform(features, lambda v, j: v * F.get(table, j)), F.lit(float(start)),
                           lambda a, b: a + b)

    def strength(self, features: Column) -> Column:
        return self._sum(features, -float(self.mean @ (self.weights / self.scale)))

    def score(self, features: Column) -> Column:
        bias = np.log(self.cut / (1 - self.cut)) - self.threshold - float(self.mean @ (self.weights / self.scale))
        return probability(self._sum(features, bias))


def _cells(known: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> dict[int, tuple]:
    """Sums over all rows by label: cell centres, ``1, x`` times powers of the distance from the centre, and ``x x'``."""
    wide = len(w) + 1
    size = (POWERS + 1) * wide

    def run(batches: Iterator[pa.RecordBatch]):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = (batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(w)) - mean) / scale
            s = x @ w
            cell = np.floor(s / WIDTH).astype(np.int64)
            order = np.lexsort((cell, label))
            label, cell, x, s = label[order], cell[order], x[order], s[order]
            start = np.flatnonzero(np.r_[True, (np.diff(cell) != 0) | (np.diff(label) != 0)][:len(cell)])
            powers = (s - (cell + 0.5) * WIDTH)[:, None] ** np.arange(POWERS + 1)
            rows = np.concatenate([np.ones((len(x), 1)), x], 1)
            sums = np.add.reduceat(powers[:, :, None] * rows[:, None, :], start).reshape(-1, size) if len(x) else []
            squares = np.add.reduceat(x[:, :, None] * x[:, None, :], start).reshape(len(start), -1) if len(x) else []
            for at, one, two in zip(start, sums, squares, strict=True):
                key, value = (int(label[at]), int(cell[at])), np.concatenate([one, two])
                total[key] = total[key] + value if key in total else value
        yield pa.record_batch({"label": pa.array([k[0] for k in total], pa.int32()),
                               "cell": pa.array([k[1] for k in total], pa.int64()),
                               "data": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    def add(group):
        import pandas as pd
        total = sum(np.frombuffer(x) for x in group["data"])
        return pd.DataFrame({"label": group["label"][:1], "cell": group["cell"][:1], "data": [total.tobytes()]})

    schema = "label int, cell long, data binary"
    found = known.select("label", "features").mapInArrow(run, schema).groupBy("label", "cell") \
        .applyInPandas(add, schema).collect()
    out = {}
    for value in (0, 1):
        some = sorted((r.cell, r.data) for r in found if r.label == value)
        data = np.array([np.frombuffer(d) for _, d in some]).reshape(len(some), size + (wide - 1) ** 2)
        out[value] = ((np.array([c for c, _ in some]) + 0.5) * WIDTH, data[:, :size].reshape(-1, POWERS + 1, wide),
                      data[:, size:].reshape(-1, wide - 1, wide - 1))
    return out


def _derivatives(u: np.ndarray, most: int) -> list[np.ndarray]:
    """``ln(1 + e^u)`` and its derivatives up to ``most``, which are polynomials in the sigmoid."""
    y = 1 / (1 + np.exp(-np.clip(u, -700, 700)))
    out, p = [np.logaddexp(0, u)], np.polynomial.Polynomial([0, 1])
    for _ in range(most):
        out.append(p(y))
        p = p.deriv() * np.polynomial.Polynomial([0, 1, -1])
    return out


def _all_pairs(cells: dict[int, tuple]) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss over all pairs, its slope, and its curvature with strengths at the cells' centres."""
    (bad, b, bb), (good, g, gg) = cells[0], cells[1]
    orders = range(POWERS + 1)
    b = b / np.array([factorial(k) for k in orders])[:, None]
    g = g / np.array([(-1) ** k * factorial(k) for k in orders])[:, None]
    loss, slope, curve = 0.0, np.zeros(b.shape[2] - 1), np.zeros(bb.shape[1:])
    for i in range(0, len(good), 64):                   # a bounded block of cell pairs at a time
        some, squares = g[i:i + 64], gg[i:i + 64]
        d = _derivatives(bad - good[i:i + 64, None], 2 * POWERS + 2)
        for k in orders:
            for j in orders:
                loss += some[:, k, 0] @ d[k + j] @ b[:, j, 0]
                slope += some[:, k, 0] @ d[k + j + 1] @ b[:, j, 1:] - d[k + j + 1] @ b[:, j, 0] @ some[:, k, 1:]
        cross = some[:, 0, 1:].T @ d[2] @ b[:, 0, 1:]
        curve += np.einsum("i,ixy->xy", d[2] @ b[:, 0, 0], squares) \
            + np.einsum("j,jxy->xy", some[:, 0, 0] @ d[2], bb) - cross - cross.T
    n = g[:, 0, 0].sum() * b[:, 0, 0].sum()
    return loss / n, slope / n, curve / n


def _threshold(known: DataFrame, strength: Column) -> float:
    """The strength from which on rows count as good that parts the labels best, of all strengths that occur.

    Of equally good ones that with the widest gap below it, then the least; the
    threshold lies in the middle of the gap.
    """
    spark = known.sparkSession
    one = known.select(strength.alias("s"), F.col("label").cast("long").alias("label")).groupBy("s") \
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
    one = written(one.repartitionByRange(partitions(spark), "s").withColumn("part", F.spark_partition_id()), "strengths")
    parts = one.groupBy("part").agg(F.min("s").alias("s"), F.max("s").alias("most"), F.sum("good").alias("good"),
                                    F.sum("bad").alias("bad")).orderBy("s").collect()
    right, lower, before = sum(r.good for r in parts), None, []
    for r in parts:
        before.append((r.part, right, lower))
        right, lower = right + r.bad - r.good, r.most
    start = F.broadcast(spark.createDataFrame(before, "part int, right_before long, lower_before double"))   # a row a part
    order = Window.partitionBy("part").orderBy("s")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    best = one.join(start, "part").select(
        "s", (F.col("right_before") + F.coalesce(F.sum(F.col("bad") - F.col("good")).over(earlier), F.lit(0))).alias("right"),
        F.coalesce(F.lag("s").over(order), "lower_before").alias("lower")) \
        .orderBy(F.desc("right"), F.desc(F.col("s") - F.col("lower")), "s").first()
    return best.s if best.lower is None else (best.s + best.lower) / 2


def fit(known: DataFrame, cut: float = CUT) -> Ranker:
    """The ranker of all rows ``(label, features)`` of a written table, by Newton steps with halving."""
    width = len(FEATURES)
    total = known.agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"), *(
        f(F.get("features", F.lit(j))).alias(f"{name}{j}") for j in range(width)
        for name, f in (("mean", F.avg), ("scale", F.stddev_pop)))).first()
    mean, scale = (np.array([total[f"{name}{j}"] or 0.0 for j in range(width)]) for name in ("mean", "scale"))
    scale = np.where(scale > 1e-9, scale, 1.0)
    w = np.zeros(width)
    if not total.good or not total.bad:
        return Ranker(mean, scale, w, 0.0, cut)
    least, step = np.inf, np.zeros(width)
    for _ in range(ROUNDS):
        loss, slope, curve = _all_pairs(_cells(known, mean, scale, w))
        loss += RIDGE / 2 * (w @ w)
        if loss > least + 1e-9:                         # too far: half of the last step
            step = step / 2
            w = w + step
        else:
            least = loss
            step = np.linalg.solve(curve + RIDGE * np.eye(width), slope + RIDGE * w)
            w = w - step
        if np.abs(step).max() < SETTLED:
            break
    ranker = Ranker(mean, scale, w, 0.0, cut)
    return ranker._replace(threshold=float(_threshold(known, ranker.strength(F.col("features")))))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality",
                   id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``(doc_id, score, predicted)`` per row of ``docs``; ``learn`` (over ``doc_id``) marks the labels to learn from.

    The fit takes all labelled documents and every pair of a good and a bad
    one; every document is scored.  Null, empty and blank texts are scored by
    their measures (all zero).  Null labels and null ids
    are not learned from; repeated rows are repeated; without both labels all
    scores equal ``cut``; an empty table gives no rows.
    """
    seen = written(measures(docs, id_col, text_col).select("doc_id", F.array(
        *(F.expr(f).cast("double") for f in FEATURES)).alias("features")), "features")
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("doc_id"),
                                                             F.col(label_col).alias("label"))
    known = written(known.join(seen, "doc_id").where(learn).select("doc_id", "label", "features"), "labelled")

    ranker = fit(known, cut)
    return seen.withColumn("score", ranker.score(F.col("features"))).select(
        "doc_id", "score", (F.col("score") >= cut).cast("int").alias("predicted"))

"""SimHash near-duplicates: fingerprints, vantage-point shards and exact Hamming pairs.

A fingerprint has one bit per position that is set in over half of the text's
shingle hashes.  A vantage-point tree built from a bounded sample of
fingerprints splits the Hamming space into shards: at a node with vantage
point v and radius m, fingerprints with d(x, v) <= m lie inside.  A query goes
to every side that its ball of ``max_bits`` touches (triangle bounds), so each
pair within the distance meets in the shard that owns one of the two.  In a
shard the same tree goes on down to small leaves, and the links found are cut
down to a spanning set before they leave the task.  The sample shapes the
shards only; every fingerprint is placed and queried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.llm._components import connected_components, unite
from indicatormart.llm._tables import partitions, same, same_row, small, written

HASH_SEED = 42

#: Fingerprints that a shard owns, the most shards, and sampled fingerprints a shard for the tree.
SHARD_SIZE = 8192
MAX_SHARDS = 16384
SAMPLE = 16
#: Queries of a shard that one task takes; more are dealt to several tasks.
TASK_QUERIES = 1 << 20
_LEAF = 96
_BLOCK = 1 << 21


# -- fingerprints ------------------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text, as unsigned 64 bits (no words: zero)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)], np.uint64)
    else:
        runs = zip(*(words[i:] for i in range(shingle)), strict=False)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(HASH_SEED)), np.uint64,
                             len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)``: the fingerprint as a signed long, and a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = batch.column(2)
            found = np.fromiter((fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))), np.uint64,
                                len(texts))
            yield pa.record_batch({"doc_id": batch.column(0), "text_key": batch.column(1),
                                   "fp": pa.array(found.view(np.int64))})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


# -- vantage points ----------------------------------------------------------------------------

def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def _split(points: np.ndarray, radius: int, tries: int = 6) -> tuple[np.uint64, int, float] | None:
    """Vantage point and radius whose sides overlap least, with the share of queries that both sides get."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, tries).astype(np.int64)]:
        d = _distance(points, v)
        m = int(np.partition(d, (len(d) - 1) // 2)[(len(d) - 1) // 2])
        inside = float((d <= m).mean())
        if inside == 1.0:
            continue
        # work left: queries of a side times the points of that side
        work = float((d <= m + radius).mean()) * inside + float((d > m - radius).mean()) * (1 - inside)
        if best is None or work < best[2]:
            best = (v, m, work)
    return best


def shard_tree(sample: np.ndarray, shards: int, radius: int) -> list[tuple]:
    """Nodes ``(vantage, m, inside, outside)``; children below zero are shards ``-1 - s``."""
    nodes: list[tuple] = []
    leaves = [0]

    def grow(points: np.ndarray, want: int) -> int:
        best = _split(points, radius) if want > 1 and len(points) > 2 else None
        if best is None:
            leaves[0] += 1
            return -leaves[0]
        v, m, _ = best
        near = _distance(points, v) <= m
        at = len(nodes)
        nodes.append(())
        inside = grow(points[near], want // 2)
        nodes[at] = (v, m, inside, grow(points[~near], want // 2))
        return at

    grow(sample, shards)
    return nodes


def visits(nodes: list[tuple], points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard: positions of the points whose ball touches it, and whether the shard owns them."""
    if not nodes:
        yield 0, np.arange(len(points)), np.ones(len(points), bool)
        return
    todo = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        at, who, own = todo.pop()
        if not len(who):
            continue
        if at < 0:
            yield -1 - at, who, own
            continue
        v, m, inside, outside = nodes[at]
        d = _distance(points[who], v)
        near, far = d <= m + radius, d > m - radius
        todo.append((inside, who[near], own[near] & (d[near] <= m)))
        todo.append((outside, who[far], own[far] & (d[far] > m)))


def link(own: np.ndarray, visitors: np.ndarray, radius: int) -> np.ndarray:
    """Labels over ``own`` then ``visitors``: points linked by pairs with an owned point share a label."""
    points = np.concatenate([own, visitors])
    label = np.arange(len(points))
    todo = [(np.arange(len(own)), np.arange(len(points)))]
    while todo:
        mine, asks = todo.pop()
        if not len(mine) or not len(asks):
            continue
        best = _split(points[mine], radius, 3) if len(mine) > _LEAF else None
        if best is not None and best[2] < 0.95:
            v, m, _ = best
            d, q = _distance(points[mine], v), _distance(points[asks], v)
            todo.append((mine[d <= m], asks[q <= m + radius]))
            todo.append((mine[d > m], asks[q > m - radius]))
            continue
        rows = max(1, _BLOCK // len(mine))
        for at in range(0, len(asks), rows):
            some = asks[at:at + rows]
            q, k = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[mine][None, :]) <= radius)
            unite(label, some[q], mine[k])
    return label


def fingerprint_links(prints: DataFrame, column: str, max_bits: int) -> DataFrame:
    """``(a, b)`` signed fingerprints within ``max_bits``: a spanning set of the links of each shard.

    ``prints`` holds distinct fingerprints and should be a written table.
    """
    spark = prints.sparkSession
    n = prints.count()
    shards = 1
    while shards < MAX_SHARDS and n > shards * SHARD_SIZE:
        shards *= 2
    sample = prints.orderBy(F.xxhash64(column), column).limit(SAMPLE * shards).collect() if shards > 1 else []
    tree = shard_tree(np.array([r[column] for r in sample], np.int64).view(np.uint64), shards, max_bits)
    share = sum(len(w) for _, w, _ in visits(tree, np.array([r[column] for r in sample], np.int64).view(np.uint64),
                                             max_bits)) / max(1, len(sample)) if sample else 1
    deals = max(1, int(np.ceil(n * share / shards / TASK_QUERIES)))  # tasks that share the queries of a shard

    def route(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for shard, who, own in visits(tree, points, max_bits):
                asks = points[who]
                deal = (asks % np.uint64(deals)).astype(np.int64)
                for d in range(deals):
                    here = own | (deal == d)   # owned points are in every deal, visitors in one
                    fp = asks[here]
                    yield pa.record_batch({"shard": pa.array(np.full(len(fp), shard * deals + d), pa.int64()),
                                           "fp": pa.array(fp.view(np.int64)), "own": pa.array(own[here])})

    def pairs(rows):
        import pandas as pd
        fp, own = rows["fp"].to_numpy(np.int64), rows["own"].to_numpy(bool)
        order = np.argsort(fp, kind="stable")
        fp, own = fp[order], own[order]
        points = np.concatenate([fp[own], fp[~own]])
        label = link(fp[own].view(np.uint64), fp[~own].view(np.uint64), max_bits)
        moved = label != np.arange(len(label))
        return pd.DataFrame({"a": points[moved], "b": points[label[moved]]})

    routed = prints.select(F.col(column).cast("long").alias("fp")).mapInArrow(route, "shard long, fp long, own boolean")
    return routed.repartition(max(partitions(spark), min(shards * deals, 1 << 16)), "shard").groupBy("shard") \
        .applyInPandas(pairs, "a long, b long")


# -- the operator ------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp, component_id)`` per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text lower-cased in A-Z; a text of
    fewer words than ``shingle`` is one shingle; null, empty and blank texts
    have fingerprint zero and are linked like any other.  ``component_id`` is
    the smallest ``doc_id`` reachable over links of at most ``max_bits`` bits.
    Null ids are never the smallest: a component of null ids only has a null
    ``component_id``.  Repeated rows are repeated in the result; columns of
    other names are ignored; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    comps = written(connected_components(fingerprint_links(prints, "fp", max_bits), "a", "b"), "components")
    rooted = prints.join(comps, prints.fp == comps.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = written(rooted.join(smallest, "root").select("fp", "component_id"), "print_components")
    return rows.join(small(of_print), "fp").select("doc_id", "text_key", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the smallest id.

    Rows of a component that share that id count as ties: the smallest text
    hash stays, and one of fully repeated rows.  Components of null ids keep
    the row of smallest text hash.
    """
    found = written(near_duplicates(docs, id_col, text_col, shingle, max_bits), "near_duplicates")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best")
    group = F.when(F.col("component_id").isNotNull(), F.col("component_id"))
    best = found.groupBy(group.alias("c"), F.when(group.isNull(), F.col("fp")).alias("f")).agg(first) \
        .select(F.col("best.doc_id").alias("k_id"), F.col("best.text_key").alias("k_text"))
    per_row = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    best = best.withColumn("won", F.lit(True))
    marked = written(per_row.join(best, same(F.col("doc_id"), F.col("k_id")) & (F.col("text_key") == F.col("k_text")),
                                  "left").select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text"),
                                                 "n", F.coalesce("won", F.lit(False)).alias("won")), "marked")
    lost = small(marked.where("not won").select("k_id", "k_text"))
    out = docs.join(lost, same_row(docs, id_col, text_col, lost), "left_anti")
    tied = marked.where("won and n > 1").select("k_id", "k_text")
    if tied.isEmpty():
        return out
    tied = small(tied)
    here = same_row(docs, id_col, text_col, tied)
    once = out.join(tied, here, "left_semi").dropDuplicates([id_col, text_col])
    return out.join(tied, here, "left_anti").unionByName(once)

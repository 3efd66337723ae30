"""MinHash containment search of short texts in windows of long ones, as built-in expressions.

A short text (an item) of q shingles belongs to the size class u, the power of
two at or above q.  For that class a document is seen as windows of 2u shingles
with step u, so an item's copy lies whole in at least one window.  An item that
is contained to a share t in a window has a Jaccard similarity of at least
t q / (2u + q - t q) with it, which ``band_settings`` turns into the number of
bands that misses such a window with a probability of at most ``MISS``.

A band can only match where the window holds the shingle that gives the item's
first MinHash of the band.  So a window's MinHash values are computed where a
document has such a shingle, and nowhere else; the result is the same as that
of signatures of all windows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.llm._native import words
from indicatormart.llm._tables import written

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
#: Hash functions of a signature at most, if one row per band needs fewer.
MAX_HASHES = 128
#: Item shingles that one pass over the documents broadcasts; more make more passes.
BLOCK_ROWS = 200_000


def band_settings(similarity: float, miss: float = MISS, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)``: the most rows per band whose bands miss ``similarity`` with at most ``miss``."""
    def bands(rows: int) -> int:
        p = similarity ** rows
        return 1 if p >= 1 else math.ceil(math.log(miss) / math.log1p(-p))

    best = (bands(1), 1)
    for rows in range(2, 9):
        if bands(rows) * rows <= max_hashes:
            best = (bands(rows), rows)
    return best


def least_similarity(q: int, size: int, containment: float = CONTAINMENT) -> float:
    """Jaccard similarity that an item of ``q`` shingles has at least with a window of ``size`` that contains it."""
    shared = math.ceil(containment * q - 1e-9)
    return shared / (size + q - shared)


def grams(word_list: Column, width: int) -> Column:
    """Array of the hashes of all runs of ``width`` words."""
    n = F.size(word_list)
    runs = F.transform(F.sequence(F.lit(0), n - width),
                       lambda i: F.xxhash64(*(F.get(word_list, i + j) for j in range(width))))
    return F.when(n >= width, runs).otherwise(F.array().cast("array<bigint>"))


def item_sets(items: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """Written ``(item, set_id, width, q, u, grams)``; items of equal shingle sets share a ``set_id``.

    An item of fewer words than ``shingle`` is one shingle of all its words;
    items without a word or without an id have no set.
    """
    cut = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), words(F.lower(text_col)).alias("w"))
    cut = cut.where(F.size("w") > 0).withColumn("width", F.least(F.size("w"), F.lit(shingle)))
    by_width = F.coalesce(*(F.when(F.col("width") == k, grams(F.col("w"), k)) for k in range(1, shingle + 1)))
    sets = cut.select("item", "width", F.array_sort(F.array_distinct(by_width)).alias("grams"))
    sets = sets.withColumn("q", F.size("grams"))
    set_id = F.md5(F.concat_ws(",", F.col("width").cast("string"), F.col("grams").cast("array<string>")))
    return written(sets.withColumns({
        "set_id": set_id, "u": F.expr("cast(power(2, ceil(log2(q))) as int)")}), "item_sets")


def banded(sets: DataFrame, containment: float = CONTAINMENT, only_banded: bool = False) -> DataFrame:
    """Written ``(gram, set_id, width, q, u, grams, bands)``, one row per shingle of each distinct set.

    ``bands`` has the bands whose first MinHash this shingle gives: arrays of
    ``(j, value)``, hash function and MinHash value.  ``only_banded``: only
    the shingles that start a band, so a long set is not repeated for each.
    """
    distinct = sets.groupBy("set_id").agg(*(F.first(c).alias(c) for c in ("width", "q", "u", "grams")))
    least = distinct.groupBy("u").agg(F.min("q").alias("q")).collect()   # one row per size class
    out = []
    for r in least:
        b, rows = band_settings(least_similarity(r.q, 2 * r.u, containment))
        values = F.transform(F.sequence(F.lit(1), F.lit(b * rows)), lambda j: F.array_min(F.transform(
            F.col("grams"), lambda x: F.struct(F.xxhash64(j, x).alias("value"), x.alias("gram")))))
        some = distinct.where(F.col("u") == r.u).withColumn("mins", values)
        band = F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda k: F.transform(
            F.sequence(F.lit(1), F.lit(rows)), lambda j: F.struct(
                (k * rows + j).alias("j"), F.get("mins", k * rows + j - 1)["value"].alias("value"),
                F.get("mins", k * rows + j - 1)["gram"].alias("gram"))))
        some = some.withColumn("all", band).withColumn("gram", F.explode("grams"))
        out.append(some.select("gram", "set_id", "width", "q", "u", "grams", F.filter(
            "all", lambda x: F.get(x, 0)["gram"] == F.col("gram")).alias("bands")))
    if not out:
        return written(distinct.select(F.lit(0).cast("long").alias("gram"), "set_id", "width", "q", "u", "grams", F.expr(
            "cast(array() as array<array<struct<j:int,value:bigint,gram:bigint>>>)").alias("bands")), "item_bands")
    found = out[0]
    for more in out[1:]:
        found = found.unionAll(more)
    return written(found.where(F.size("bands") > 0) if only_banded else found, "item_bands")


def _collides(window: Column, bands: Column) -> Column:
    return F.exists(bands, lambda band: F.forall(band, lambda f: F.array_min(
        F.transform(window, lambda x: F.xxhash64(f["j"], x))) == f["value"]))


def document_hits(docs: DataFrame, bands: DataFrame, id_col: str, text_col: str, only_banded: bool) -> list[DataFrame]:
    """Shingles that documents share with items, one frame per pass.

    Columns: ``doc_id, text_key, at, set_id, q, gram, first, second`` where
    the last two tell for both windows around position ``at`` (structs with
    the window's ``start`` and ``shared`` shingles of the item) whether a band
    matches (else null).  ``only_banded``: only shingles that start a band.
    """
    table = bands.where(F.size("bands") > 0) if only_banded else bands
    widths = [r.width for r in table.select("width").distinct().collect()]   # at most the shingle length
    total = table.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    out = []
    for width in sorted(widths):
        cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                          words(F.lower(F.col(text_col))).alias("w"))
        cut = cut.select("doc_id", "text_key", grams(F.col("w"), width).alias("h"))
        # the outer form: an inner one makes the optimizer repeat the word splitting in a filter below it
        at = cut.select("doc_id", "text_key", "h", F.posexplode_outer("h").alias("at", "gram"))
        for k in range(blocks):
            some = table.where((F.col("width") == width) & (F.pmod("gram", F.lit(blocks)) == k))
            hit = at.join(F.broadcast(some), "gram")   # a block of at most about BLOCK_ROWS rows

            def seen(step: int) -> Column:
                number = F.floor(F.col("at") / F.col("u")).cast("int") - step
                window = F.slice("h", number * F.col("u") + 1, 2 * F.col("u"))
                state = F.struct((number * F.col("u")).alias("start"),
                                 F.size(F.array_intersect(window, "grams")).alias("shared"))
                return F.when(number >= 0, F.when(_collides(window, F.col("bands")), state))

            out.append(hit.select("doc_id", "text_key", "at", "set_id", "q", "gram", seen(0).alias("first"),
                                  seen(1).alias("second")))
    return out


def union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionAll(f)
    return out

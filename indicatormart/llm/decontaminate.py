"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact containment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.llm._containment import CONTAINMENT, SHINGLE, banded, document_hits, item_sets, union
from indicatormart.llm._tables import same_row, small, written


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
                 containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, text_key, item_id, n_shared, n_shingles, containment)`` for documents that hold an item.

    Shingles are runs of ``shingle`` lower-cased words.  Items are partitioned
    by size; MinHash bands over windows of a size that fits the partition give
    the candidates; a candidate is kept if the document holds at least the
    share ``containment`` of the item's distinct shingles.  An item of fewer
    words than ``shingle`` is sought as a whole.  Null, empty and blank texts
    and items without an id match nothing; a null ``doc_id`` matches like any
    other; repeated rows (same id and text) give one row; other columns are
    ignored; empty tables give no rows.
    """
    sets = item_sets(items, item_col, item_text_col, shingle)
    found = union(document_hits(docs, banded(sets, containment), id_col, text_col, only_banded=False))
    if found is None:
        found = docs.where("false").select(
            F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
            F.lit("").alias("set_id"), F.lit(0).alias("q"), F.lit(0).cast("long").alias("gram"),
            F.lit(None).alias("first"), F.lit(None).alias("second"))
    near = F.col("first").isNotNull() | F.col("second").isNotNull()
    once = found.withColumn("near", near).groupBy("doc_id", "text_key", "set_id", "q", "gram").agg(
        F.max("near").alias("near"))
    counted = once.groupBy("doc_id", "text_key", "set_id", "q").agg(F.max("near").alias("near"),
                                                                     F.count("*").alias("n_shared"))
    verified = counted.where(F.col("near") & (F.col("n_shared") >= F.col("q") * F.lit(containment) - 1e-9))
    members = small(sets.select("set_id", F.col("item").alias("item_id")))
    return verified.join(members, "set_id").select(
        "doc_id", "text_key", "item_id", "n_shared", F.col("q").cast("long").alias("n_shingles"),
        (F.col("n_shared") / F.col("q")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    bad = written(contaminated(docs, items, id_col, text_col, **options).select(
        F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text")).distinct(), "contaminated")
    bad = small(bad)
    return docs.join(bad, same_row(docs, id_col, text_col, bad), "left_anti")

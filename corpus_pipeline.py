"""A corpus pipeline over ``documents``: five stages, each one operator of ``indicatormart.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame with the
columns of ``documents``; ``run`` writes each result as Parquet to the shared
scratch folder and reads it back as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indicatormart.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from indicatormart.llm._tables import written
from indicatormart.llm.queries import SIMHASH_BITS, SIMHASH_SHINGLE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go; every document stays."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays."""
    return simhash.keep_one(docs, shingle=SIMHASH_SHINGLE, max_bits=SIMHASH_BITS)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target weights."""
    return mixing.keep_sample(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("mixing to target weights", mixture),
]

#: Expectation-maximisation, fingerprints and line sets have no plain SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``documents`` that come out of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs

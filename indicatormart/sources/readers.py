"""Readers: documents, named tables, seeds, inline relations, renames, audits."""

from __future__ import annotations

from typing import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType, StructType


def read_documents(spark: SparkSession, path: str, schema: StructType | None = None,
                   glob: str | None = None, column: str = "payload", multi_line: bool = True) -> DataFrame:
    """Whole JSON documents, one row each, in a single column ``column``.

    With ``schema`` (the document's top-level struct) the fields are typed at
    read time and wrapped into one struct column.  Without it the document is
    kept as VARIANT (``singleVariantColumn``); a file whose top level is an
    array then stays one document (outer array kept), while the typed read
    turns each array element into a row.  ``glob`` picks files by name
    pattern.  ``multi_line=True`` reads one (pretty-printed) document per
    file, each file in one task; ``multi_line=False`` reads JSON Lines (one
    document per line), which splits large files across tasks.  A malformed
    document fails the read.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is None:
        return reader.option("singleVariantColumn", column).json(path)
    df = reader.schema(schema).json(path)
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(column))


#: Types whose row-group statistics Spark's reader turns into aggregates.
_FOOTER_TYPES = (DateType, ByteType, ShortType, IntegerType, LongType)


def footer_query(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Min and max of a column of parquet files, pushed into the scan: footers are read, no column.

    It belongs to a session of its own, since the pushdown is a session setting.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.min(f"`{column}`").alias("lo"), F.max(f"`{column}`").alias("hi"))


def footer_bounds(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """One row ``(lo, hi)`` of a date or integer column from footers; NULLs are ignored.

    None (so that the caller scans the column) for other types, and if a file
    has no statistics of it, as files of NULLs only: Spark's reader then fails.
    """
    kind = spark.read.parquet(path).schema[column].dataType
    if not isinstance(kind, _FOOTER_TYPES):
        return None
    try:
        lo, hi = footer_query(spark, path, column).first()
    except (Py4JJavaError, PySparkException):
        return None
    return spark.range(1).select(F.lit(lo).cast(kind).alias("lo"), F.lit(hi).cast(kind).alias("hi"))


def load_table(spark: SparkSession, source: str, fmt: str = "parquet", schema: StructType | str | None = None,
               options: dict | None = None) -> DataFrame:
    """A named raw source: a catalog table name or a file path.

    File extracts can take an explicit ``schema`` (raw measures as strings,
    e.g. ``schemas.string_schema(cols)``) and reader ``options`` such as
    ``{"header": True}`` for CSV; no schema inference is done for CSV.
    """
    if "/" in source or source.endswith(f".{fmt}"):
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        elif fmt == "csv":
            reader = reader.option("inferSchema", False)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load(source)
    return spark.table(source)


def load_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV seed with a header line and an explicit schema; blank lines skipped."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    keep = F.lit(False)
    for c in df.columns:
        keep = keep | F.col(c).isNotNull()
    return df.filter(keep)


def inline_table(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """A small literal relation (VALUES)."""
    return spark.createDataFrame(list(rows), schema)


def rename_columns(df: DataFrame, mapping: dict[str, str], keep_others: bool = False) -> DataFrame:
    """Select awkward raw names (blanks, slashes, non-ASCII) as canonical names."""
    cols = [F.col(f"`{raw}`").alias(canonical) for raw, canonical in mapping.items()]
    if keep_others:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in mapping]
    return df.select(*cols)


def load_audit(df: DataFrame, series_cols: Sequence[str], region_col: str, as_of=None) -> DataFrame:
    """One-row load record: rows, distinct series, distinct regions, load stamp.

    The stamp is the load time (``current_timestamp()``) unless ``as_of`` gives
    an aggregate over the data (e.g. ``F.max("year")``) for a reproducible record.
    """
    stamp = F.current_timestamp() if as_of is None else as_of
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(*[F.col(c) for c in series_cols]).alias("series_count"),
        F.count_distinct(F.col(region_col)).alias("region_count"),
        stamp.alias("loaded_at"),
    )

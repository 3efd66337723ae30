"""Grain control: finer grain wins, one row per key, month calendar."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DateType, MapType, StructType, TimestampNTZType, TimestampType,
                               VariantType)

from indicatormart.functions._util import as_col, ColumnOrName
from indicatormart.functions import periods as P
from indicatormart.functions.keys import order_fields, Ranked
from indicatormart.operators import membership
from indicatormart.sources.readers import footer_bounds
from indicatormart.sources.sinks import folder_of, materialize


def prefer_finer_grain(df: DataFrame, keys: Sequence[ColumnOrName], grain_col: str = "period_granularity",
                       fine: str = "MONTH", coarse: str = "YEAR", parsed_once: bool = False) -> DataFrame:
    """Drop ``coarse`` rows whose key group also has ``fine`` rows.

    Same result as ``NOT (grain = coarse AND max(grain = fine) OVER (PARTITION BY keys) = 1)``
    but written as an anti-join against the DISTINCT fine keys: the fine rows
    (the bulk) pass through without a shuffle, the key set is reduced map-side
    before it moves, and no task ever buffers one whole key group, so a hot key
    cannot pin a task.  Keys compare NULL-safely, as window partitions do.  A
    fine row counts whatever its value (a NULL month value still removes the
    year row).

    As written the input is read by three branches.  ``parsed_once`` (for an
    input that costs more than a rewrite) writes it once, a folder per grain
    class; the fine keys become a bitmap of bounded size, and only coarse rows
    that hit it go to the exact anti-join.
    """
    if parsed_once:
        return _finer_grain_written(df, keys, grain_col, fine, coarse)
    names = [f"__grain_k{i}" for i in range(len(keys))]
    d = df.withColumns({n: as_col(k) for n, k in zip(names, keys)})
    g = F.col(grain_col)
    fine_keys = d.filter(g == F.lit(fine)).select(*names).distinct()
    # Under three-valued logic a NULL grain behaves like the coarse grain here:
    # NOT (NULL AND has_fine) drops the row exactly when the group has fine rows.
    coarse_rows = d.filter(g.isNull() | (g == F.lit(coarse)))
    cond = reduce(lambda a, b: a & b, [coarse_rows[n].eqNullSafe(fine_keys[n]) for n in names])
    kept = coarse_rows.join(fine_keys, cond, "left_anti")
    others = d.filter(g.isNotNull() & (g != F.lit(coarse)))
    return others.unionByName(kept).drop(*names)


def _finer_grain_written(df: DataFrame, keys: Sequence[ColumnOrName], grain_col: str, fine: str,
                         coarse: str) -> DataFrame:
    names = [f"__grain_k{i}" for i in range(len(keys))]
    g = F.col(grain_col)
    kind = F.when(g == F.lit(fine), "fine").when(g.isNull() | (g == F.lit(coarse)), "coarse").otherwise("other")
    d = materialize(df.withColumns({n: as_col(k) for n, k in zip(names, keys)})
                    .withColumns({"__hash": F.xxhash64(*names), "__class": kind}), "grain_rows", partition_by=["__class"])
    of = lambda c: d.filter(F.col("__class") == c)
    n_fine = of("fine").count()     # from the files' footers
    coarse_rows, kept = of("coarse"), []
    if membership.worthwhile(n_fine):
        bits = membership.bits_for(n_fine)
        words = materialize(membership.bitmap(of("fine"), "__hash", bits), "grain_bitmap")
        flagged = membership.maybe_in(coarse_rows, "__hash", words, bits, "__hit")
        kept = [flagged.filter(~F.col("__hit")).drop("__hit")]
        coarse_rows = flagged.filter("__hit").drop("__hit")
    fine_keys = of("fine").select("__hash", *names).distinct()
    cond = reduce(lambda a, b: a & b, [coarse_rows[n].eqNullSafe(fine_keys[n]) for n in names],
                  coarse_rows["__hash"] == fine_keys["__hash"])
    kept += [coarse_rows.join(fine_keys, cond, "left_anti")]
    through = d.filter(F.col("__class").isin("fine", "other"))
    return reduce(DataFrame.unionByName, [through, *kept]).drop(*names, "__hash", "__class")


def dedupe(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (give a total order).

    ``row_number() = 1`` is planned as a partial WindowGroupLimit before the
    shuffle, so each map task forwards one row per key; hot keys are reduced
    map-side.
    """
    w = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def first_by(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Ranked | ColumnOrName]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order``, as one aggregate.

    A row becomes a struct that starts with an order-preserving key
    (:func:`order_fields`) and goes on with the other columns; the least struct
    of a group is its first row, and rows that tie in the order are settled by
    their other columns.  Each map task keeps that struct per group in a hash
    table: no sort below the exchange, and a hot key sends one row per map task.
    A plain ``min`` of a struct is planned with a sort, as a struct is no
    fixed-width buffer; next to an object aggregate (``collect_set`` of one
    constant) Spark plans an object hash aggregate.  A task with more groups
    than ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` sorts
    them by key inside that aggregate, so memory stays bounded; where keys are
    nearly unique, :func:`dedupe` does less work.

    NULL keys form a group.  Columns without an order (maps, VARIANT) are
    carried beside the key, and then ties in ``order`` are settled arbitrarily.
    """
    fields, plain = order_fields(df, order)
    grouped = {c: f"__key{i}" for i, c in enumerate(keys) if isinstance(c, str)}
    rest = [c for c in df.columns if c not in plain and c not in grouped]
    ordered = [f.alias(f"f{i}") for i, f in enumerate(fields)]
    others = [F.col(f"`{c}`").alias(f"r{i}") for i, c in enumerate(rest)]
    by = [as_col(k).alias(f"__key{i}") for i, k in enumerate(keys)]
    if all(_has_order(df.schema[c].dataType) for c in rest):
        first = F.min(F.struct(*ordered, *others))
    else:
        first = F.min_by(F.struct(*ordered, *others), F.struct(*ordered))
    one = df.groupBy(*by).agg(first.alias("__row"), F.collect_set(F.lit(True)).alias("__hashed"))
    source = {c: f"__row.r{i}" for i, c in enumerate(rest)} | {c: f"__row.f{i}" for c, i in plain.items()} | grouped
    return one.filter(F.size("__hashed") > 0).select(*[F.col(source[c]).alias(c) for c in df.columns])


def _has_order(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_has_order(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def date_bounds(df: DataFrame, col: ColumnOrName, footers: bool = False) -> DataFrame:
    """One row: month-truncated min and max of a date column (NULLs ignored).

    One column is scanned.  With ``footers`` the files' footers answer for a
    date column of a written table (:func:`materialize`); give that only where few
    files hold NULLs alone, as such a file makes Spark fail the attempt before
    the scan.  Months keep the order of their dates, so the two
    extremes are truncated, not every row.
    """
    path = folder_of(df) if footers else None
    ends = footer_bounds(df.sparkSession, path, col) if path and isinstance(col, str) else None
    if ends is None:
        c = as_col(col)
        dated = c if isinstance(df.select(c.alias("c")).schema["c"].dataType, _DATED) else c.cast("date")
        ends = df.agg(F.min(dated).alias("lo"), F.max(dated).alias("hi"))
    return ends.select(P.month_start("lo").alias("lo"), P.month_start("hi").alias("hi"))


#: Types whose order is that of their months.
_DATED = (DateType, TimestampType, TimestampNTZType)


def month_spine(sources: Sequence[tuple[DataFrame, ColumnOrName]], strict_nulls: bool = False,
                footers: bool = False) -> DataFrame:
    """Calendar of every month between the earliest and latest month of all sources.

    Columns: ``date_key`` (YYYYMMDD of the month start), ``month_date``,
    ``year``, ``month_no``, ``year_month_label``.  With ``strict_nulls`` a source
    without any date empties the calendar (LEAST/GREATEST returning NULL);
    by default such a source is skipped.  Only one-row aggregates leave the
    sources; the spine itself is months-long.
    """
    bounds = reduce(DataFrame.unionByName, [date_bounds(df, c, footers) for df, c in sources])
    if strict_nulls:
        agg = bounds.agg(
            F.when(F.count_if(F.col("lo").isNull()) == 0, F.min("lo")).alias("lo"),
            F.when(F.count_if(F.col("hi").isNull()) == 0, F.max("hi")).alias("hi"))
    else:
        agg = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spine = agg.filter(F.col("lo").isNotNull() & F.col("hi").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 MONTH"))).alias("month_date"))
    return spine.select(
        P.month_key("month_date").alias("date_key"),
        "month_date",
        F.year("month_date").alias("year"),
        F.month("month_date").alias("month_no"),
        P.year_month_label("month_date").alias("year_month_label"),
    )

"""Wide <-> long reshaping.

All of these are narrow (no shuffle) except the pivots, which group by their
id columns; the pivots take explicit value lists so no extra distinct job
runs to discover the output columns.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.functions.numbers import year_from_name
from indicatormart.functions.periods import month_date, spelled_month_number


def _quoted(names: Sequence[str]):
    """Column objects for names that may hold dots, blanks or slashes."""
    return [F.col(f"`{c}`") for c in names]


def unpivot_years(df: DataFrame, ids: Sequence[str], year_cols: Sequence[str],
                  value_col: str = "value", year_col: str = "year",
                  drop_nulls: bool = True, value_type: str = "double") -> DataFrame:
    """One row per (ids, year) from a column per year; the year is the digits
    of the column name.  ``drop_nulls`` removes NULL cells (NaN is kept)."""
    src = df.select(*_quoted(ids), *[F.col(f"`{c}`").cast(value_type).alias(c) for c in year_cols])
    long = src.unpivot(_quoted(ids), _quoted(year_cols), "__year_col", value_col)
    if drop_nulls:
        long = long.filter(F.col(value_col).isNotNull())
    return long.withColumn(year_col, year_from_name("__year_col")).drop("__year_col") \
               .select(*_quoted(ids), year_col, value_col)


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name_col: str,
                    value_col: str, drop_nulls: bool = False, value_type: str | None = None) -> DataFrame:
    """Generic wide -> long; NULL cells are kept unless ``drop_nulls``."""
    src = df.select(*_quoted(ids), *[(F.col(f"`{c}`").cast(value_type) if value_type else F.col(f"`{c}`")).alias(c)
                            for c in cols])
    long = src.unpivot(_quoted(ids), _quoted(cols), name_col, value_col)
    if drop_nulls:
        long = long.filter(F.col(value_col).isNotNull())
    return long


def melt_measures(df: DataFrame, ids: Sequence[str],
                  measures: Sequence[tuple[str, str, str, str | None]],
                  value_type: str = "double") -> DataFrame:
    """Measure columns -> rows with per-measure metadata, in one scan.

    ``measures`` holds ``(column, code, name, unit)``; output columns are
    ``ids + source_indicator_code, indicator_name, unit, value``.
    """
    structs = [F.struct(F.lit(code).alias("source_indicator_code"),
                        F.lit(name).alias("indicator_name"),
                        F.lit(unit).cast("string").alias("unit"),
                        F.col(f"`{col}`").cast(value_type).alias("value"))
               for col, code, name, unit in measures]
    return df.select(*_quoted(ids), F.inline(F.array(*structs)))


def stack_headers(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str] | None = None,
                  sep: str = "/", value_type: str = "double") -> DataFrame:
    """Spreadsheet columns named 'Year/Month/Metric' -> long rows.

    Separators after the second belong to the metric.
    Output: ``ids + Year, Month, Metric, Value, Period`` where Period is the
    month start (NULL when year or month cannot be read); rows with a NULL
    Period or Value are dropped, which also removes all-empty rows/columns.
    """
    cols = list(value_cols) if value_cols is not None else [c for c in df.columns if c not in ids]
    long = unpivot_columns(df, ids, cols, "__header", "Value", drop_nulls=True, value_type=value_type)
    parts = F.split(F.col("__header"), "\\" + sep if sep in ".|*+?^$()[]{}\\" else sep, 3)
    long = long.withColumns({
        "Year": F.regexp_substr(F.get(parts, 0), F.lit("[0-9]{4}")),
        "Month": F.trim(F.get(parts, 1)),
        "Metric": F.trim(F.get(parts, 2)),
    })
    period = month_date(F.col("Year").try_cast("int"), spelled_month_number(F.col("Month")))
    return (long.withColumn("Period", period)
                .filter(F.col("Period").isNotNull())
                .select(*_quoted(ids), "Year", "Month", "Metric", "Value", "Period"))


def pivot_metrics(df: DataFrame, ids: Sequence[str], metric_col: str, value_col: str,
                  metrics: Sequence[str], agg: str = "min") -> DataFrame:
    """Long -> wide: one column per metric.  ``agg='min'`` is deterministic;
    ``agg='first'`` keeps the first non-NULL value in arrival order."""
    if agg == "first":
        fn = F.first(value_col, ignorenulls=True)
    elif agg in ("min", "max", "sum", "avg"):
        fn = getattr(F, agg)(value_col)
    else:
        raise ValueError(f"unsupported agg {agg}")
    return df.groupBy(*ids).pivot(metric_col, list(metrics)).agg(fn)


def pivot_roles(df: DataFrame, keys: Sequence[str], role_col: str, value_col: str,
                spec: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Conditional aggregates: ``{out: (agg, roles)}`` -> ``agg(CASE WHEN role IN roles THEN value END)``.

    One hash aggregate with map-side partial aggregation.
    """
    aggs = []
    for out, (agg, roles) in spec.items():
        picked = F.when(F.col(role_col).isin(*roles), F.col(value_col))
        aggs.append(getattr(F, agg)(picked).alias(out))
    return df.groupBy(*keys).agg(*aggs)

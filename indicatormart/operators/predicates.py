"""Row filters and row classifiers."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.functions._util import as_col, ColumnOrName


def tag_source(df: DataFrame, system: str | None = None, code: str | None = None,
               name: str | None = None, grain: str | None = None, **extra) -> DataFrame:
    """Add constant lineage columns (source system, indicator code/name, grain)."""
    cols = {}
    if system is not None:
        cols["source_system"] = F.lit(system)
    if code is not None:
        cols["source_indicator_code"] = F.lit(code)
    if name is not None:
        cols["indicator_name"] = F.lit(name)
    if grain is not None:
        cols["period_granularity"] = F.lit(grain)
    for k, v in extra.items():
        cols[k] = v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(cols)


def drop_aggregate_rows(df: DataFrame, col: str, names: Sequence[str] = (),
                        contains_lower: Sequence[str] = (), ilike_prefixes: Sequence[str] = (),
                        keep_nulls: bool = True) -> DataFrame:
    """Drop rows naming aggregate entities ('Riket', 'Alla regioner…', …).

    ``names``: exact values (``<>`` / NOT IN).  ``contains_lower``: substrings of
    ``lower(col)`` (NOT LIKE '%x%').  ``ilike_prefixes``: case-insensitive
    prefixes.  ``keep_nulls`` decides NULL names: True keeps them (the
    ``coalesce(col,'') NOT IN`` form), False drops them (the ``<>`` form).
    """
    c = F.col(col)
    bad = F.lit(False)
    if names:
        bad = bad | c.isin(*names)
    for s in contains_lower:
        bad = bad | F.lower(c).contains(s)
    for p in ilike_prefixes:
        bad = bad | c.ilike(p + "%")
    if keep_nulls:
        return df.filter(c.isNull() | ~bad)
    return df.filter(c.isNotNull() & ~bad)


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every listed column is not NULL (NaN is kept)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def filter_topic(df: DataFrame, topics: Iterable[str], col: str = "topic") -> DataFrame:
    """Topic filter with a NULL guard: ``coalesce(topic, '') IN topics``."""
    return df.filter(F.coalesce(F.col(col), F.lit("")).isin(*list(topics)))


def classify(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """Searched CASE: the first matching rule wins, else ``default``."""
    if not rules:
        return F.lit(default)
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, label in rules[1:]:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default).cast("string"))


def like_any(c: ColumnOrName, patterns: Sequence[str]) -> Column:
    """SQL LIKE against any pattern (``_`` and ``%`` are live wildcards)."""
    col = as_col(c)
    out = F.lit(False)
    for p in patterns:
        out = out | col.like(p)
    return out

"""Data-quality checks as Spark jobs.

Every check returns rows ``(table_name, check_name, column_name, failures,
severity, status)``.  ``failures`` counts what the declarative test would
return: failing rows for not_null and relationships, failing groups for
unique / unique_combination / accepted_values.  ``status`` is ``pass`` when
``failures = 0``, else ``warn`` or ``fail`` by severity.  Column checks on one
table are fused into a single aggregate (one scan).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.operators.joins import checked_broadcast
from indicatormart.operators.uniqueness import repeated_groups

RESULT_COLUMNS = ("table_name", "check_name", "column_name", "failures", "severity", "status")


def _result(df: DataFrame, table: str, check: str, column: str, failures: Column, severity: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures"),
        F.lit(severity).alias("severity"),
        F.when(failures == 0, F.lit("pass"))
         .otherwise(F.lit("warn" if severity == "warn" else "fail")).alias("status"))


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).when(severity == "warn", F.lit("warn")).otherwise(F.lit("fail"))


def check_columns(df: DataFrame, table: str, not_null: Sequence[str] = (),
                  accepted: dict[str, Sequence[str]] | None = None,
                  severity: dict[str, str] | None = None) -> DataFrame:
    """not_null and accepted_values checks of one table in one pass.

    not_null counts NULL rows in one aggregate.  accepted_values groups by the
    column first (map-side partial aggregation), then counts the distinct
    values outside the list; NULL passes.
    """
    severity = severity or {}
    parts = []
    if not_null:
        aggs = [F.count_if(F.col(c).isNull()).alias(f"__nn{i}") for i, c in enumerate(not_null)]
        one = df.agg(*aggs)
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__nn{i}").alias("failures"),
                                  F.lit(severity.get(c, "error")).alias("severity"))
                         for i, c in enumerate(not_null)])
        nn = one.select(F.inline(rows)).select(
            F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"), "column_name",
            F.col("failures").cast("bigint").alias("failures"), "severity",
            _status(F.col("failures"), F.col("severity")).alias("status"))
        parts.append(nn)
    for c, values in (accepted or {}).items():
        bad = df.select(c).filter(F.col(c).isNotNull() & ~F.col(c).isin(*values)).distinct()
        parts.append(_result(bad.agg(F.count(F.lit(1)).alias("n")), table, "accepted_values", c,
                             F.col("n"), severity.get(c, "error")))
    if not parts:
        raise ValueError("no checks requested")
    return reduce(DataFrame.unionByName, parts)


def check_not_null(df: DataFrame, table: str, col: str, severity: str = "error") -> DataFrame:
    return check_columns(df, table, not_null=[col], severity={col: severity})


def check_accepted(df: DataFrame, table: str, col: str, values: Sequence[str], severity: str = "error") -> DataFrame:
    return check_columns(df, table, accepted={col: values}, severity={col: severity})


#: Rows from which the sketch of :mod:`uniqueness` costs less than one grouped pass per grain.
SKETCH_ROWS = 2_000_000


def check_grains(df: DataFrame, table: str, unique: Sequence[str] = (), combinations: Sequence[Sequence[str]] = (),
                 severity: str = "error", sketch: bool | None = None) -> list[DataFrame]:
    """unique and unique_combination_of_columns tests of one table: groups seen more than once.

    unique skips NULLs; in combinations NULLs group together.  With ``sketch``
    one scan clears the keys that are certainly unique for all grains, and only
    the rest is grouped; without, each grain is grouped over all rows.  By
    default a count of ``df`` decides (a written table's count reads footers only).
    """
    grains = [[c] for c in unique] + [list(c) for c in combinations]
    skip = [True] * len(unique) + [False] * len(combinations)
    if not grains:
        return []
    n_rows = df.count() if sketch is not False else 0
    if sketch or (sketch is None and n_rows >= SKETCH_ROWS):
        repeated = repeated_groups(df, grains, skip, n_rows)
    else:
        repeated = []
        for cols, whole in zip(grains, skip):
            d = df.select(*cols)
            if whole:
                d = d.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
            repeated.append(d.groupBy(*cols).count().filter(F.col("count") > 1))
    return [_result(dup.agg(F.count(F.lit(1)).alias("n")), table, "unique" if whole else "unique_combination_of_columns",
                    ",".join(cols), F.col("n"), severity) for dup, cols, whole in zip(repeated, grains, skip)]


def check_unique_combination(df: DataFrame, table: str, cols: Sequence[str], severity: str = "error",
                             sketch: bool | None = False) -> DataFrame:
    """Groups of ``cols`` seen more than once (NULLs group together)."""
    return check_grains(df, table, combinations=[cols], severity=severity, sketch=sketch)[0]


def check_unique(df: DataFrame, table: str, col: str, severity: str = "error", sketch: bool | None = False) -> DataFrame:
    """Non-NULL values seen more than once."""
    return check_grains(df, table, unique=[col], severity=severity, sketch=sketch)[0]


def check_relationship(df: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str,
                       severity: str = "error") -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti join).

    The parent key set is de-duplicated first and broadcast when the parent
    is proven small; otherwise the anti join shuffles (AQE splits a hot
    child key).
    """
    keys = parent.select(F.col(parent_col).alias("__pk")).filter(F.col("__pk").isNotNull()).distinct()
    child = df.select(F.col(col).alias("__ck")).filter(F.col("__ck").isNotNull())
    orphans = child.join(checked_broadcast(keys, base=parent), child["__ck"] == keys["__pk"], "left_anti")
    return _result(orphans.agg(F.count(F.lit(1)).alias("n")), table, "relationships", col, F.col("n"), severity)


def check_min_distinct(df: DataFrame, table: str, col: str, minimum: int, severity: str = "warn") -> DataFrame:
    """Fewer than ``minimum`` distinct values -> one failure (a cardinality warning)."""
    n = df.agg(F.count_distinct(F.col(col)).alias("n"), F.count(F.lit(1)).alias("rows"))
    return _result(n, table, f"min_distinct_{minimum}", col,
                   F.when(F.col("n") < minimum, F.lit(1)).otherwise(F.lit(0)), severity)


def run_checks(results: Sequence[DataFrame]) -> DataFrame:
    """Stack check results into one report."""
    return reduce(DataFrame.unionByName, results)


def check_model(df: DataFrame, table: str, not_null: Sequence[str] = (), warn_not_null: Sequence[str] = (),
                accepted: dict[str, Sequence[str]] | None = None,
                relationships: dict[str, tuple[DataFrame, str]] | None = None,
                unique: Sequence[str] = (), combinations: Sequence[Sequence[str]] = (),
                sketch: bool | None = False) -> DataFrame:
    """Every declared test of one model, with one scan for the column tests.

    not_null (error / warn), accepted_values and relationships are counted in
    a single aggregate: each parent's DISTINCT key set is left-joined first
    (one match at most per row, broadcast when proven small), so a miss is a
    NULL flag.  unique and unique_combination_of_columns need one grouped
    pass each, or with ``sketch`` one scan that clears most keys (:func:`check_grains`).
    """
    accepted = accepted or {}
    relationships = relationships or {}
    d = df
    flags = {}
    for i, (col, (parent, parent_col)) in enumerate(relationships.items()):
        keys = parent.select(F.col(parent_col).alias(f"__pk{i}")).filter(F.col(f"__pk{i}").isNotNull()).distinct()
        d = d.join(checked_broadcast(keys, base=parent), d[col] == keys[f"__pk{i}"], "left")
        flags[col] = f"__pk{i}"
    specs = []   # (check, column, failure expression, severity)
    for c in not_null:
        specs.append(("not_null", c, F.count_if(F.col(c).isNull()), "error"))
    for c in warn_not_null:
        specs.append(("not_null", c, F.count_if(F.col(c).isNull()), "warn"))
    for c, values in accepted.items():
        bad = F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values), F.col(c))
        specs.append(("accepted_values", c, F.count_distinct(bad), "error"))
    for c, flag in flags.items():
        specs.append(("relationships", c, F.count_if(F.col(c).isNotNull() & F.col(flag).isNull()), "error"))
    parts = []
    if specs:
        one = d.agg(*[e.alias(f"__f{i}") for i, (_, _, e, _) in enumerate(specs)])
        rows = F.array(*[F.struct(F.lit(chk).alias("check_name"), F.lit(col).alias("column_name"),
                                  F.col(f"__f{i}").cast("bigint").alias("failures"), F.lit(sev).alias("severity"))
                         for i, (chk, col, _, sev) in enumerate(specs)])
        parts.append(one.select(F.inline(rows)).select(
            F.lit(table).alias("table_name"), "check_name", "column_name", "failures", "severity",
            _status(F.col("failures"), F.col("severity")).alias("status")))
    parts += check_grains(df, table, unique, combinations, sketch=sketch)
    return run_checks(parts)

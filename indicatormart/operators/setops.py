"""Set operations over fact families."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name (types must already agree)."""
    if not dfs:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION (distinct) with a single DISTINCT over the stacked branches."""
    return union_all(dfs).distinct()

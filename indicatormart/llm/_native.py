"""Words of a text as built-in expressions (no Python in the tasks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word separators: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
_RUN = "[ \\t-\\r]+"


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _RUN))


def ascii_lower(text: Column) -> Column:
    """Lower case in A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_of(text: Column, others: str) -> Column:
    """Characters left after dropping runs of ``others`` (a regular expression class)."""
    return F.length(F.regexp_replace(text, others + "+", ""))

"""Surrogate keys and sort keys."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from indicatormart.functions._util import as_col, ColumnOrName

# The NULL stand-in and separator of the public surrogate-key
# macro the modelled warehouse uses, so keys equal the warehouse's digests.
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# Leading-number pattern of sort labels and the default sort key.
LEADING_NUMBER_RE = r"^[0-9]+"
DEFAULT_SORT_KEY = 999


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over the string forms of ``cols`` joined by '-', NULLs replaced."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    joined = parts[0] if len(parts) == 1 else F.concat_ws(KEY_SEPARATOR, *parts)
    return F.md5(joined)


def label_sort_key(c: ColumnOrName, default: int = DEFAULT_SORT_KEY) -> Column:
    """Leading digits of a label as an int ('18-29' -> 18), else ``default``."""
    lead = F.regexp_substr(as_col(c), F.lit(LEADING_NUMBER_RE)).try_cast("int")
    return F.coalesce(lead, F.lit(default))


class Ranked(NamedTuple):
    """One part of an order: a column, its direction, and whether NULLs come last."""
    column: ColumnOrName
    descending: bool = False
    nulls_last: bool = True


def desc(c: ColumnOrName, nulls_last: bool = True) -> Ranked:
    return Ranked(c, True, nulls_last)


def asc(c: ColumnOrName, nulls_last: bool = True) -> Ranked:
    return Ranked(c, False, nulls_last)


#: Turns the digits of a hexadecimal text around; ``_AFTER_HEX`` follows them all.
_HEX, _AFTER_HEX = "0123456789ABCDEF", "G"


def _inverted(c: Column, kind: ST.DataType) -> list[Column]:
    """Columns whose ascending order is the descending order of ``c`` (a non-NULL value of type ``kind``)."""
    if isinstance(kind, (ST.ByteType, ST.ShortType, ST.IntegerType, ST.LongType)):
        return [F.bitwise_not(c)]                       # -c - 1: no overflow
    if isinstance(kind, ST.DecimalType):
        return [-c]
    if isinstance(kind, (ST.FloatType, ST.DoubleType)):
        return [~F.isnan(c), F.when(F.isnan(c), F.lit(0.0)).otherwise(-c)]      # NaN is the largest value
    if isinstance(kind, ST.BooleanType):
        return [~c]
    if isinstance(kind, ST.DateType):
        return [F.bitwise_not(F.unix_date(c))]
    if isinstance(kind, ST.TimestampType):
        return [F.bitwise_not(F.unix_micros(c))]
    if isinstance(kind, ST.TimestampNTZType):
        zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return [F.bitwise_not(F.timestamp_diff("MICROSECOND", zero, c))]
    if isinstance(kind, (ST.StringType, ST.BinaryType)):
        # a prefix comes after what it begins, so the end sorts after every digit
        return [F.concat(F.translate(F.hex(c), _HEX, _HEX[::-1]), F.lit(_AFTER_HEX))]
    raise TypeError(f"no descending sort key for {kind.simpleString()}")


def order_fields(df: DataFrame, order: Sequence[Ranked | ColumnOrName]) -> tuple[list[Column], dict[str, int]]:
    """Columns whose ascending order, one after another, is ``order`` over the rows of ``df``.

    Each part gives a NULL flag and its value; descending parts are inverted
    (bits, sign, or the digits of the bytes), so that a plain minimum finds
    the first row.  A part is a :class:`Ranked`, or a column (ascending, NULLs
    last).  Strings compare byte by byte, NaN is the largest number and -0.0
    equals 0.0, as in ``ORDER BY``.  The second value tells which field holds a
    column of ``df`` as it is.
    """
    parts = [o if isinstance(o, Ranked) else Ranked(o) for o in order]
    kinds = df.select(*[as_col(o.column).alias(f"k{i}") for i, o in enumerate(parts)]).schema
    fields, plain = [], {}
    for o, field in zip(parts, kinds):
        c = as_col(o.column)
        fields.append(c.isNull() if o.nulls_last else c.isNotNull())
        if isinstance(o.column, str) and not o.descending:
            plain.setdefault(o.column, len(fields))
        fields += _inverted(c, field.dataType) if o.descending else [c]
    return fields, plain

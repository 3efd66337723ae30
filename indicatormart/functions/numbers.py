"""Numbers written in local formats -> typed values (NULL when unparseable).

Integer conversion in the modelled dialect rounds half away from zero, so
integers are parsed through ``decimal(38,0)`` (HALF_UP) rather than a plain
int cast, which would truncate or fail on '12.5'.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicatormart.functions._util import as_col, ColumnOrName

# Characters kept when numbers are read from text.
KEEP_DECIMAL_COMMA_RE = r"[^0-9.,-]"
KEEP_NO_COMMA_RE = r"[^0-9.-]"
DIGITS_ONLY_RE = r"[^0-9]"


def parse_decimal(c: ColumnOrName, comma: str = "dot") -> Column:
    """Keep digits, '.', ',' and '-', then parse as double.

    ``comma="dot"``: decimal comma -> dot ('1 234,5 %' -> 1234.5; '1.234,5' -> NULL).
    ``comma="strip"``: commas are deleted ('1,5' -> 15.0).
    """
    s = as_col(c).cast("string")
    if comma == "dot":
        s = F.replace(F.regexp_replace(s, KEEP_DECIMAL_COMMA_RE, ""), F.lit(","), F.lit("."))
    elif comma == "strip":
        s = F.regexp_replace(s, KEEP_NO_COMMA_RE, "")
    else:
        raise ValueError("comma must be 'dot' or 'strip'")
    return s.try_cast("double")


def parse_decimal_or_dash(c: ColumnOrName) -> Column:
    """Like :func:`parse_decimal`, with '--', '-' and '' read as NULL first."""
    col = as_col(c)
    return F.when(F.trim(col).isin("--", "-", ""), F.lit(None).cast("double")) \
            .otherwise(parse_decimal(col))


def parse_decimal_scale2(c: ColumnOrName) -> Column:
    """Comma -> dot, then decimal(10,2) (rounded half up), returned as double."""
    s = F.replace(as_col(c).cast("string"), F.lit(","), F.lit("."))
    return s.try_cast("decimal(10,2)").cast("double")


def parse_int_round(c: ColumnOrName, to: str = "int") -> Column:
    """Safe integer parse that rounds half away from zero ('12.5' -> 13)."""
    return as_col(c).cast("string").try_cast("decimal(38,0)").try_cast(to)


def strict_int(c: ColumnOrName, to: str = "int") -> Column:
    """Integer cast that fails on bad input under ANSI mode; rounds half up."""
    return as_col(c).cast("decimal(38,0)").cast(to)


def strict_double(c: ColumnOrName) -> Column:
    """Float cast that fails on bad input under ANSI mode."""
    return as_col(c).cast("double")


def year_from_name(c: ColumnOrName) -> Column:
    """Digits of a column name like 'y2021' -> 2021."""
    return F.regexp_replace(as_col(c), DIGITS_ONLY_RE, "").try_cast("int")


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1000.0) -> Column:
    """``num / den * scale`` when ``den > 0``, else NULL (no division error)."""
    n, d = as_col(num), as_col(den)
    return F.when(d > 0, n / d * F.lit(scale))

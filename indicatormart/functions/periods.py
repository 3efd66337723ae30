"""Periods, calendar keys and whole-string regex matching."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicatormart.functions._util import as_col, ColumnOrName

# Swedish month names (long forms) in calendar order.
SWEDISH_MONTHS = ("januari", "februari", "mars", "april", "maj", "juni",
                  "juli", "augusti", "september", "oktober", "november", "december")

# Short and long month spellings accepted in spreadsheet headers.
MONTH_SPELLINGS = {
    "jan": 1, "januari": 1, "feb": 2, "februari": 2, "mar": 3, "mars": 3,
    "apr": 4, "april": 4, "maj": 5, "jun": 6, "juni": 6, "jul": 7, "juli": 7,
    "aug": 8, "augusti": 8, "sep": 9, "sept": 9, "september": 9,
    "okt": 10, "oktober": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}

# Period text patterns.
MONTH_RE = r"[0-9]{4}-[0-9]{2}"
YEAR_RE = r"[0-9]{4}"
LEADING_YEAR_RE = r"^[0-9]{4}"
ANY_YEAR_RE = r"[0-9]{4}"
TWO_DIGITS_RE = r"[0-9]{2}"


def full_match(c: ColumnOrName, pattern: str) -> Column:
    """True when the WHOLE string matches ``pattern`` (Spark's rlike searches; ``$`` would pass a final newline)."""
    return as_col(c).rlike("\\A(?:" + pattern + ")\\z")


def period_granularity(c: ColumnOrName) -> Column:
    """'YYYY-MM' -> MONTH, 'YYYY' -> YEAR, anything else -> UNKNOWN."""
    col = as_col(c)
    return (F.when(full_match(col, MONTH_RE), F.lit("MONTH"))
             .when(full_match(col, YEAR_RE), F.lit("YEAR"))
             .otherwise(F.lit("UNKNOWN")))


def period_year(c: ColumnOrName) -> Column:
    """Leading four digits as int, NULL if the text does not start with them."""
    return F.regexp_substr(as_col(c), F.lit(LEADING_YEAR_RE)).try_cast("int")


def period_month(c: ColumnOrName) -> Column:
    """Month start for 'YYYY-MM' text ('2024-13' -> NULL), else NULL."""
    col = as_col(c)
    return F.when(full_match(col, MONTH_RE), F.try_to_date(col, "yyyy-MM"))


def period_filter_date(granularity: ColumnOrName, month: ColumnOrName, year: ColumnOrName) -> Column:
    """Month date for MONTH rows, else January 1st of the year."""
    return F.when(as_col(granularity) == "MONTH", as_col(month)) \
            .otherwise(F.make_date(as_col(year), F.lit(1), F.lit(1)))


def period_filter_label(granularity: ColumnOrName, month: ColumnOrName, year: ColumnOrName) -> Column:
    """'YYYY-MM' for MONTH rows, 'YYYY' otherwise."""
    return F.when(as_col(granularity) == "MONTH", F.date_format(as_col(month), "yyyy-MM")) \
            .otherwise(as_col(year).cast("string"))


def _month_map() -> Column:
    return F.create_map(*chain.from_iterable(
        (F.lit(name), F.lit(i + 1)) for i, name in enumerate(SWEDISH_MONTHS)))


def named_month_number(c: ColumnOrName) -> Column:
    """Month number of text like 'mars 2024' (first word, any case), else NULL."""
    low = F.lower(as_col(c))
    word = F.substring_index(low, " ", 1)
    return F.when(F.instr(low, " ") > 0, _month_map()[word])


def named_month_year(c: ColumnOrName) -> Column:
    """First four-digit run as the year."""
    return F.regexp_substr(as_col(c), F.lit(ANY_YEAR_RE)).try_cast("int")


def spelled_month_number(c: ColumnOrName) -> Column:
    """Month from a header cell: short/long name (dots removed) or two digits."""
    key = F.replace(F.lower(F.trim(as_col(c).cast("string"))), F.lit("."), F.lit(""))
    mapping = F.create_map(*chain.from_iterable(
        (F.lit(k), F.lit(v)) for k, v in MONTH_SPELLINGS.items()))
    digits = F.regexp_substr(as_col(c).cast("string"), F.lit(TWO_DIGITS_RE)).try_cast("int")
    return F.coalesce(mapping[key], digits)


def month_date(year: ColumnOrName, month: ColumnOrName) -> Column:
    """First day of the month, NULL when either part is NULL or invalid."""
    y, m = as_col(year), as_col(month)
    return F.when(y.isNotNull() & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def month_start(c: ColumnOrName) -> Column:
    """Truncate a date/timestamp to the first day of its month (as a DATE)."""
    return F.trunc(as_col(c).cast("date"), "MM")


def month_key(c: ColumnOrName) -> Column:
    """YYYYMMDD int key of the month start (e.g. 20240301)."""
    d = as_col(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + 1).cast("int")


def year_key(c: ColumnOrName) -> Column:
    """YYYY0101 int key of a year."""
    return (as_col(c).cast("int") * 10000 + 101).cast("int")


def year_start(c: ColumnOrName) -> Column:
    return F.make_date(as_col(c).cast("int"), F.lit(1), F.lit(1))


def year_month_label(c: ColumnOrName) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def least_strict(*cols: ColumnOrName) -> Column:
    """LEAST that is NULL when any input is NULL (Spark's skips NULLs)."""
    cs = [as_col(c) for c in cols]
    any_null = F.lit(False)
    for c in cs:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.least(*cs))


def greatest_strict(*cols: ColumnOrName) -> Column:
    cs = [as_col(c) for c in cols]
    any_null = F.lit(False)
    for c in cs:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cs))

"""Text cleaning: Column -> Column, all built-in Spark expressions.

Regex notes (Java regex on Spark):
  * ``rlike`` is a substring search; whole-string matches go through
    :func:`indicatormart.functions.periods.full_match`.
  * ``(?i)`` folds ASCII only; patterns that must fold Å/Ä/Ö use ``(?iu)``.
  * Java has no POSIX ``[[:space:]]``; ``\\s`` is used instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicatormart.functions._util import as_col, ColumnOrName

# Spellings of the gender codes in the sources.
FEMALE_SPELLINGS = ("k", "kvinna", "kvinnor")
MALE_SPELLINGS = ("m", "man", "män")
FEMALE_WORDS = ("kvinnor", "kvinna")
MALE_WORDS = ("män", "man")

# Cleaning patterns of the sources (Java regex; (?iu) = Unicode case folding).
SLUG_RE = r"[^A-Za-z0-9]+"
BLANK_RUN_RE = r"\s+"
LETTER_S_RUN_RE = "s+"
TRAILING_S_RE = "s$"
TRAILING_S_ANY_CASE_RE = "(?iu)s$"
REGION_PREFIX_ANY_CASE_RE = r"(?iu)^region(en)?\s+"
LAN_SUFFIX_ANY_CASE_RE = r"(?iu)\s+län\s*$"
REGION_PREFIX_RE = r"^Region\s+"
LAN_SUFFIX_RE = r"\s+län$"
UPPER_REGION_PREFIX_RE = r"^\s*REGION\s+"
UPPER_LAN_SUFFIX_RE = r"\s+LÄN\s*$"


def trim_lower(c: ColumnOrName) -> Column:
    return F.lower(F.trim(as_col(c)))


def trim_upper(c: ColumnOrName) -> Column:
    return F.upper(F.trim(as_col(c)))


def blank_to_null(c: ColumnOrName) -> Column:
    """NULLIF(TRIM(c), '')."""
    t = F.trim(as_col(c))
    return F.when(t == F.lit(""), F.lit(None).cast("string")).otherwise(t)


def first_non_blank(*cols: ColumnOrName) -> Column:
    """COALESCE(NULLIF(TRIM(a), ''), ..., TRIM(last)) — a fallback title."""
    if not cols:
        raise ValueError("first_non_blank needs at least one column")
    parts = [blank_to_null(c) for c in cols[:-1]] + [F.trim(as_col(cols[-1]))]
    return F.coalesce(*parts)


def initcap_words(c: ColumnOrName) -> Column:
    """First letter of each blank-separated word upper, the rest lower."""
    return F.initcap(F.trim(as_col(c)))


def slug(c: ColumnOrName) -> Column:
    """Runs of anything but ASCII letters/digits -> '_', lower case (ä -> '_')."""
    return F.lower(F.regexp_replace(as_col(c), SLUG_RE, "_"))


def snake(c: ColumnOrName) -> Column:
    """Runs of blanks -> '_', lower case."""
    return F.lower(F.regexp_replace(as_col(c), BLANK_RUN_RE, "_"))


def letter_s_runs(c: ColumnOrName) -> Column:
    """Runs of the letter ``s`` -> '_', lower case.

    Reproduces a source pattern written as ``'\\s+'`` with a single backslash:
    the dialect drops the unknown escape, so the pattern is ``s+``.
    """
    return F.lower(F.regexp_replace(as_col(c), LETTER_S_RUN_RE, "_"))


def drop_trailing_s(c: ColumnOrName, ignore_case: bool = False) -> Column:
    """Remove ONE trailing ``s`` (``S`` too when ``ignore_case``)."""
    return F.regexp_replace(as_col(c), TRAILING_S_ANY_CASE_RE if ignore_case else TRAILING_S_RE, "")


def strip_region_prefix(c: ColumnOrName) -> Column:
    """Drop a leading 'Region ' / 'Regionen ' (any case) after trimming."""
    return F.regexp_replace(F.trim(as_col(c)), REGION_PREFIX_ANY_CASE_RE, "")


def strip_lan_suffix(c: ColumnOrName) -> Column:
    """Drop a trailing ' län' (any case, Unicode-aware)."""
    return F.regexp_replace(as_col(c), LAN_SUFFIX_ANY_CASE_RE, "")


def clean_kpi_region(c: ColumnOrName) -> Column:
    """KPI-style names: strip the Region prefix, then one trailing 's'."""
    return drop_trailing_s(strip_region_prefix(c))


def clean_area_name(c: ColumnOrName) -> Column:
    """Personnel-style names: strip ' län', then one trailing s/S, then trim."""
    return F.trim(drop_trailing_s(strip_lan_suffix(c), ignore_case=True))


def clean_column_region(c: ColumnOrName, special: dict[str, str] | None = None) -> Column:
    """Wide-by-region column names: special cases first, else strip the
    case-sensitive 'Region ' prefix and ' län' suffix."""
    col = as_col(c)
    stripped = F.regexp_replace(F.regexp_replace(col, REGION_PREFIX_RE, ""), LAN_SUFFIX_RE, "")
    out = None
    for raw, good in (special or {}).items():
        out = (F.when(col == F.lit(raw), F.lit(good)) if out is None
               else out.when(col == F.lit(raw), F.lit(good)))
    return stripped if out is None else out.otherwise(stripped)


def region_name_norm(c: ColumnOrName) -> Column:
    """Join key for names: trim, strip 'Region ' / ' län' (case-sensitive),
    collapse blank runs, upper."""
    col = F.regexp_replace(F.trim(as_col(c)), REGION_PREFIX_RE, "")
    col = F.regexp_replace(col, LAN_SUFFIX_RE, "")
    return F.upper(F.regexp_replace(col, BLANK_RUN_RE, " "))


def upper_pattern_norm(c: ColumnOrName) -> Column:
    """Strip an UPPER-case 'REGION ' prefix and ' LÄN' suffix, then upper.

    The patterns are case-sensitive and applied before ``upper``, so on
    mixed-case input they do nothing; the alias map does the real work.
    """
    col = F.regexp_replace(as_col(c), UPPER_REGION_PREFIX_RE, "")
    col = F.regexp_replace(col, UPPER_LAN_SUFFIX_RE, "")
    return F.upper(col)


def collapse_upper(c: ColumnOrName) -> Column:
    """UPPER(TRIM(c)) with blank runs collapsed to one blank."""
    return F.regexp_replace(F.upper(F.trim(as_col(c))), BLANK_RUN_RE, " ")


def normalize_gender(c: ColumnOrName, short_codes: bool = True, trim: bool = True) -> Column:
    """Map gender spellings to F / M / ALL; anything else (NULL too) is ALL."""
    col = as_col(c)
    key = F.lower(F.trim(col)) if trim else F.lower(col)
    female = FEMALE_SPELLINGS if short_codes else FEMALE_WORDS
    male = MALE_SPELLINGS if short_codes else MALE_WORDS
    return (F.when(key.isin(*female), F.lit("F"))
             .when(key.isin(*male), F.lit("M"))
             .otherwise(F.lit("ALL")))

"""Key resolution: facts joined to small dimensions.

Facts are the large side; every dimension here is small by nature (regions,
genders, age groups, indicators, months).  A dimension is broadcast only
after its row count has been checked against a bound
(:func:`checked_broadcast`); above the bound the join is left to the
optimizer (sort-merge with AQE skew splitting, or a runtime broadcast when
AQE measures the side as small).  Alias maps are fixed literal lists, so they
become a map lookup expression and need no join at all.
"""

from __future__ import annotations

import weakref
from itertools import chain
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.functions._util import as_col, ColumnOrName
from indicatormart.functions.keys import surrogate_key
from indicatormart.sources.sinks import materialize

Cleaner = Callable[[Column], Column]

# A dimension with at most this many rows is broadcast to every task.  Lookups
# project the dimension to its key and the taken columns first, so 500k rows
# stay in the tens of MB; the dimensions of this warehouse hold tens to
# thousands of rows (regions, genders, age groups, months, indicators).
DEFAULT_BROADCAST_ROWS = 500_000
DEFAULT_BROADCAST_BYTES = 64 << 20


_SMALL: "weakref.WeakKeyDictionary[DataFrame, dict[int, bool]]" = weakref.WeakKeyDictionary()


def is_small(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True if ``dim`` provably has at most ``max_rows`` rows.

    A plain count: every task sends one number, and on written dimensions the
    files' footers answer it.  Rows also have to fit ``DEFAULT_BROADCAST_BYTES``
    at 32 bytes a value.  The answer is remembered per DataFrame, so a dimension reused by many
    joins is checked once.
    """
    seen = _SMALL.setdefault(dim, {})
    if max_rows not in seen:
        width = 32 * len(dim.columns)
        seen[max_rows] = dim.count() <= min(max_rows, DEFAULT_BROADCAST_BYTES // max(1, width))
    return seen[max_rows]


def checked_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      base: DataFrame | None = None) -> DataFrame:
    """``broadcast(dim)`` when the size check passes, else ``dim`` unchanged
    (the optimizer then plans a shuffle join; AQE may still broadcast it
    after measuring the shuffled side, or split skewed partitions).

    ``base`` is a frame with at least as many rows as ``dim`` (``dim`` is a
    projection/filter of it) whose check result can be reused.
    """
    return F.broadcast(dim) if is_small(base if base is not None else dim, max_rows) else dim


def lookup(fact: DataFrame, dim: DataFrame, fact_on: Sequence[ColumnOrName],
           dim_on: Sequence[ColumnOrName], take: Sequence[str] | dict[str, str],
           how: str = "left", extra_condition: Column | None = None,
           max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, size_base: DataFrame | None = None) -> DataFrame:
    """Equi-join ``fact`` to ``dim`` on expressions and bring back ``take``.

    ``take`` is a list of dim columns, or a mapping ``{dim_col: output_name}``.
    ``how="left"`` keeps unmatched facts with NULLs; ``how="inner"`` drops them.
    ``extra_condition`` (on dim columns only) becomes part of the ON clause, so
    with a left join it limits matches without filtering facts.  ``size_base``
    is a frame ``dim`` was filtered/projected from; its (memoized) size check
    stands for ``dim``'s.
    """
    if len(fact_on) != len(dim_on):
        raise ValueError("fact_on and dim_on must have the same length")
    mapping = dict(take) if isinstance(take, dict) else {c: c for c in take}
    fkeys = [f"__fk{i}" for i in range(len(fact_on))]
    dkeys = [f"__dk{i}" for i in range(len(dim_on))]
    d = dim if extra_condition is None else dim.filter(extra_condition)
    d = d.select(*[as_col(e).alias(k) for e, k in zip(dim_on, dkeys)],
                 *[F.col(src).alias(dst) for src, dst in mapping.items()])
    f = fact.select("*", *[as_col(e).alias(k) for e, k in zip(fact_on, fkeys)])
    cond = None
    for a, b in zip(fkeys, dkeys):
        c = f[a] == d[b]
        cond = c if cond is None else cond & c
    base = size_base if size_base is not None else dim
    joined = f.join(checked_broadcast(d, max_broadcast_rows, base=base), cond, how)
    return joined.drop(*fkeys, *dkeys)


def lookup_by_spelling(fact: DataFrame, dim: DataFrame, raw: ColumnOrName, clean_raw: Cleaner, dim_col: ColumnOrName,
                       take: dict[str, str], how: str = "left") -> DataFrame:
    """``lookup`` of ``clean_raw(raw)`` in ``dim_col``, cleaning each distinct spelling once.

    The distinct spellings of ``raw`` (one column of ``fact``, reduced
    map-side) are written, cleaned and resolved to a dictionary from spelling to
    the taken columns; the facts join that on the raw spelling, so no
    expression of ``clean_raw`` runs per row.  If the spellings are too many
    to broadcast, cleaning runs per row as in :func:`lookup`.  A NULL spelling
    matches nothing.  ``fact`` is read twice: give a written one or a cheap scan.
    """
    c = as_col(raw)
    names = materialize(fact.select(c.alias("__raw")).filter(F.col("__raw").isNotNull()).distinct(), "spellings")
    if not is_small(names):
        return lookup(fact, dim, [clean_raw(c)], [dim_col], take, how=how)
    inner = {src: f"__taken{i}" for i, src in enumerate(take)}
    known = materialize(lookup(names, dim, [clean_raw(F.col("__raw"))], [dim_col], inner, how="inner"), "spelling_keys")
    return lookup(fact, known, [c], [F.col("__raw")], {inner[src]: dst for src, dst in take.items()}, how=how)


def resolve_key(fact: DataFrame, dim: DataFrame, fact_col: ColumnOrName, dim_col: str,
                key: str, normalize: Cleaner | None = None, keep_unmatched: bool = True,
                out: str | None = None, spellings_once: bool = False) -> DataFrame:
    """Attach ``dim.key`` by matching ``fact_col`` to ``dim_col``.

    ``normalize`` (Column -> Column) is applied to both sides first, or with
    ``spellings_once`` to each distinct spelling (:func:`lookup_by_spelling`).
    ``keep_unmatched=False`` drops facts with no match.
    """
    fa, da = as_col(fact_col), F.col(dim_col)
    if normalize is not None and spellings_once:
        return lookup_by_spelling(fact, dim, fa, normalize, normalize(da), {key: out or key},
                                  how="left" if keep_unmatched else "inner")
    if normalize is not None:
        fa, da = normalize(fa), normalize(da)
    return lookup(fact, dim, [fa], [da], {key: out or key},
                  how="left" if keep_unmatched else "inner")


def constant_lookup(dim: DataFrame, match: dict[str, object], take: str) -> Column:
    """``take`` of the single ``dim`` row whose columns equal constants (NULL if
    none), as a scalar subquery: looked up once per query, no join at all.

    For facts whose lookup keys are constants (a source that tags every row
    with one system and code); an equi-join on literals would be folded into
    a filter and planned as a nested-loop join.  ``dim`` must be unique on the
    matched columns (a second match raises).
    """
    cond = None
    for c, v in match.items():
        e = F.col(c) == F.lit(v)
        cond = e if cond is None else cond & e
    return dim.filter(cond).select(take).scalar()


def resolve_indicator(fact: DataFrame, dim: DataFrame, system_col: ColumnOrName = "source_system",
                      code_col: ColumnOrName = "source_indicator_code", normalize: bool = False,
                      out: str = "indicator_key") -> DataFrame:
    """Attach ``indicator_key`` by (system, code); ``normalize`` compares
    ``upper(trim())`` of both sides (may fan out on case-only duplicates)."""
    fs, fc = as_col(system_col), as_col(code_col)
    ds, dc = F.col("source_system"), F.col("source_indicator_code")
    if normalize:
        fs, fc, ds, dc = (F.upper(F.trim(x)) for x in (fs, fc, ds, dc))
    return lookup(fact, dim, [fs, fc], [ds, dc], {"indicator_key": out})


def alias_lookup(c: ColumnOrName, mapping: Iterable[tuple[str, str]],
                 case_insensitive: bool = False) -> Column:
    """``coalesce(mapping[c], c)`` for a fixed list of (bad, good) pairs."""
    pairs = list(mapping)
    col = as_col(c)
    if not pairs:
        return col
    if case_insensitive:
        m = F.create_map(*chain.from_iterable((F.lit(b.upper()), F.lit(g)) for b, g in pairs))
        return F.coalesce(m[F.upper(col)], col)
    m = F.create_map(*chain.from_iterable((F.lit(b), F.lit(g)) for b, g in pairs))
    return F.coalesce(m[col], col)


def apply_alias(df: DataFrame, col: str, mapping: Iterable[tuple[str, str]], out: str | None = None,
                case_insensitive: bool = False) -> DataFrame:
    """Replace known bad spellings in ``col`` (result in ``out``, default in place)."""
    return df.withColumn(out or col, alias_lookup(col, mapping, case_insensitive))


def derive_dim(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """DISTINCT non-null combinations of ``cols`` with a surrogate key."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return (df.select(*cols).filter(cond).distinct()
              .withColumn(key, surrogate_key(*cols)))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """``coalesce(col, default)`` for each listed column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})

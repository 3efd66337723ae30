"""Aggregations used by the facts and marts."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.functions._util import as_col, ColumnOrName


#: Bits of a limb.  A long holds the sum of 2^37 limbs.
LIMB = 26
#: Weights of the limbs as powers of 2^LIMB, lowest first: magnitudes below 2^78, to multiples of 2^-78.
POWERS = (-3, -2, -1, 0, 1, 2)


def exact_sum(value: ColumnOrName) -> Column:
    """Sum of doubles that does not depend on the order they are added in.

    Each magnitude is cut into six limbs of 26 bits (powers of two, so without
    rounding); the limbs are summed as longs, which is exact and associative, in
    a hash aggregate with a map-side part.  The total is put together once a
    group, within one unit in the last place of the exact sum.  Bits below 2^-78 are
    cut off; NaN, infinities and magnitudes from 2^78 on are added as plain
    doubles.  NULLs are skipped, a group without a value gives NULL.  2^37 rows
    of a group fit; beyond, the sum of longs fails under ANSI.
    """
    v = as_col(value).cast("double")
    size = F.abs(v)
    inside = size < F.lit(2.0 ** (LIMB * 3))
    sign = F.when(v < 0, F.lit(-1)).otherwise(F.lit(1))
    base = F.lit(2.0 ** LIMB)

    def limb(power: int) -> Column:
        scaled = size * F.lit(2.0 ** (-LIMB * power))
        digit = F.floor(scaled if power == POWERS[-1] else scaled % base)
        return F.coalesce(F.sum(F.when(inside, sign * digit)), F.lit(0).cast("bigint"))

    limbs = F.array(*[limb(p) for p in POWERS])
    outside = F.sum(F.when(~inside, v))
    total = F.transform(F.array(_carried(limbs)), _total)[0]
    return F.when(F.count(v) > 0, F.coalesce(outside + total, total))


def _carried(limbs: Column) -> Column:
    """Limb sums with carries passed up: all but the last lie in [0, 2^LIMB)."""
    zero = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("done"))
    mask = F.lit((1 << LIMB) - 1).cast("bigint")

    def step(acc: Column, limb: Column) -> Column:
        whole = limb + acc["carry"]
        return F.struct(F.shiftright(whole, LIMB).alias("carry"),
                        F.concat(acc["done"], F.array(whole.bitwiseAND(mask))).alias("done"))

    return F.aggregate(limbs, zero, step, lambda acc: F.concat(acc["done"], F.array(acc["carry"])))


def _total(carried: Column) -> Column:
    """The value of carried limbs; a negative total is turned around first, so that nothing cancels."""
    negative = F.element_at(carried, -1) < 0
    turned = _carried(F.transform(F.slice(carried, 1, len(POWERS)), lambda x: -x))
    return F.when(negative, -_value(turned, F.element_at(turned, -1) - F.element_at(carried, -1))).otherwise(
        _value(carried, F.element_at(carried, -1)))


def _value(limbs: Column, top: Column) -> Column:
    """Non-negative limbs as a double: pairs of limbs are exact, and are added from the smallest up."""
    at = lambda i: F.element_at(limbs, i + 1)
    pair = lambda i: (at(i) + F.shiftleft(at(i + 1), LIMB)).cast("double") * F.lit(2.0 ** (LIMB * POWERS[i]))
    high = top.cast("double") * F.lit(2.0 ** (LIMB * (POWERS[-1] + 1)))
    return pair(0) + pair(2) + pair(4) + high


def exact_avg(value: ColumnOrName) -> Column:
    """Average of doubles that does not depend on their order: :func:`exact_sum` by the count (NULL without a value)."""
    n = F.count(as_col(value))
    return F.when(n > 0, exact_sum(value) / n)


def sum_by(df: DataFrame, keys: Sequence[ColumnOrName], value: ColumnOrName, out: str = "value") -> DataFrame:
    """``sum(value)`` per key as a double, the same whatever the order of the rows (NULL keys form their own group)."""
    return df.groupBy(*[as_col(k) for k in keys]).agg(exact_sum(value).alias(out))


def global_bounds(df: DataFrame, col: ColumnOrName, prefix: str = "") -> DataFrame:
    """One-row min / max of a column."""
    c = as_col(col)
    return df.agg(F.min(c).alias(f"{prefix}min"), F.max(c).alias(f"{prefix}max"))

"""Exact ratios and means.

Sums are carried as integers, so results do not depend on the order in which
partial sums are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio_round(a: Column, b: Column, digits: int) -> Column:
    """``a / b`` rounded half up to ``digits`` decimals, NULL where ``b`` is 0.

    For whole numbers with ``a`` >= 0. Works in integers throughout: doubles put
    exact halves on either side of the border.
    """
    wide = "decimal(38,0)"
    scale = 10**digits
    divisor = F.nullif(b.cast(wide), F.lit(0).cast(wide))
    steps = F.call_function("div", 2 * scale * a.cast(wide) + divisor, 2 * divisor)
    return steps.cast("double") / F.lit(float(scale))


def hundredths(value: Column) -> Column:
    """A decimal with two places as a whole number of hundredths.

    A ``bigint`` sum of these stays exact and fast; the sum type of a short
    decimal would overflow after some 10^11 rows.
    """
    return (value * 100).cast("bigint")


def mean(total: Column, count: Column, scale: int = 1) -> Column:
    """Mean from an integer total of ``1/scale`` units; NULL when nothing was counted.

    Divides two whole numbers once, so the result is the double nearest to the
    true mean.
    """
    return total.cast("double") / F.nullif(count * scale, F.lit(0).cast("bigint"))


def mean_of(value: Column) -> Column:
    """Aggregate: mean of a whole-number column."""
    return mean(F.sum(value.cast("bigint")), F.count(value))


def mean_of_hundredths(value: Column) -> Column:
    """Aggregate: mean of a ``decimal(p,2)`` column."""
    return mean(F.sum(hundredths(value)), F.count(value), 100)

"""Percentages with exact half-up rounding.

Counts are integers, so two-decimal percentages are computed in whole hundredths instead
of floating point: 99.985 always becomes 99.99, on every engine and in every row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.periods import int_div

PCT = "decimal(10,2)"


def _from_hundredths(hundredths: Column) -> Column:
    return (hundredths.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(PCT)


def pct(good: Column, total: Column, when_empty: int | None = 0) -> Column:
    """``round(100 * good / total, 2)`` for non-negative counts."""
    good, total = good.cast("bigint"), total.cast("bigint")
    value = _from_hundredths(int_div(good * 20_000 + total, total * 2))
    empty = F.lit(when_empty).cast(PCT)
    return F.when(total == 0, empty).otherwise(value)


def mean_pct(pct_sum: Column, n: Column) -> Column:
    """Half-up mean of ``n`` non-negative two-decimal percentages whose sum is ``pct_sum``."""
    hundredths = (pct_sum * 100).cast("bigint")
    n = n.cast("bigint")
    return F.when(n > 0, _from_hundredths(int_div(hundredths * 2 + n, n * 2)))


def change_pct(value: Column, base: Column, *, signed_base: bool, digits: int | None = 2) -> Column:
    """``100 * (value - base) / base``, over ``abs(base)`` unless ``signed_base``.

    NULL when the base is NULL or zero. The difference is taken before leaving decimals.
    """
    below = base if signed_base else F.abs(base)
    ratio = F.lit(100.0) * (value - base).cast("double") / F.nullif(below, F.lit(0)).cast("double")
    return ratio if digits is None else F.round(ratio, digits)

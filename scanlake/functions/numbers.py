"""Exact half-up rounding, free of floating-point ties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are summed as whole billionths, so sums do not depend on row order.
UNITS = 1_000_000_000


def div(a: Column, b: Column) -> Column:
    """Integer division."""
    return F.call_function("div", a, b)


def half_up4(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half up to 4 decimals, both non-negative integers."""
    num = numerator.cast("decimal(28,0)") * F.lit(20000).cast("decimal(5,0)")
    den = denominator.cast("decimal(28,0)")
    twice = den * F.lit(2).cast("decimal(1,0)")
    return div(num + den, twice).cast("double") / F.lit(10000.0)


def score_units(score: Column, scale: int) -> Column:
    """A score on 0..scale as whole billionths; null where the score does not count."""
    valid = score.isNotNull() & (score >= 0) & ~F.isnan(score.cast("double"))
    return F.when(valid, F.floor(score.cast("double") * F.lit(UNITS / scale) + 0.5))


def mean_of_units(total: Column, count: Column) -> Column:
    """Mean of ``count`` scores with unit sum ``total``, 4 decimals, 0.0 if there are none."""
    whole = count.cast("decimal(14,0)") * F.lit(UNITS).cast("decimal(10,0)")
    return F.when(count > 0, half_up4(total, whole)).otherwise(F.lit(0.0))

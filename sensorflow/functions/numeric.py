"""Arithmetic that treats NaN as "no" and never divides by zero.

Spark orders NaN above every number and, in ANSI mode, raises on x / 0. The detectors need comparisons
that are false whenever NaN takes part, so all of them go through the helpers below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def is_finite(value: Column) -> Column:
    return is_number(value) & (F.abs(value) < F.lit(INFINITY))


def above(left: Column, right: Column) -> Column:
    return is_number(left) & is_number(right) & (left > right)


def below(left: Column, right: Column) -> Column:
    return is_number(left) & is_number(right) & (left < right)


def outside(value: Column, low: Column, high: Column) -> Column:
    return below(value, low) | above(value, high)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, null where the denominator is zero."""
    return F.when(denominator != 0, numerator / denominator)


def capped(value: Column, limit: float = 1.0) -> Column:
    return F.least(value, F.lit(limit))


def round_half_even(value: Column, scale: Column) -> Column:
    """Round the product with ``scale`` half to even; numbers too big to have decimals stay as they are."""
    return F.when(F.abs(value) < 1e16, F.rint(value * scale) / scale).otherwise(value)

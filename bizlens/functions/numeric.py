"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column, precision: int = 12) -> Column:
    """Money is decimal with cents, never a binary float."""
    return c.cast(f"decimal({precision},2)")


def zero_guard(den: Column, value: Column, default=0.0) -> Column:
    """``IF(d = 0, default, value)`` for a value computed from the divisor d."""
    return F.when(den == 0, F.lit(default)).otherwise(value)


def safe_ratio(num: Column, den: Column, default=0) -> Column:
    """``IF(d = 0, default, n / d)``; NULL divisor gives NULL."""
    return zero_guard(den, F.try_divide(num, den), default)


def round_half_even(c: Column, scale: int = 0) -> Column:
    """Numpy / Python rounding (2.5 -> 2)."""
    return F.bround(c, scale)


def nullif(a: Column, b: Column) -> Column:
    """H26."""
    return F.nullif(a, b)

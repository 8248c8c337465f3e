"""Null-safe and zero-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def pct(num: Column | str, den: Column | str) -> Column:
    """100 * num / den, and 0.0 for an empty, zero or null denominator."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den * 100.0).otherwise(0.0)


def clamp_min(value: Column | str, floor: int = 0) -> Column:
    """The value, never below ``floor``; null stays null."""
    value = _col(value)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))

"""Arithmetic shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when the denominator is zero or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def round_half_away(col: Column, digits: int = 0) -> Column:
    """Round a double half away from zero on its binary value."""
    scale = float(10**digits)
    return F.signum(col) * F.floor(F.abs(col) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def sum_when(condition: Column, value: Column) -> Column:
    """Filtered sum: NULL when no row meets the condition."""
    return F.sum(F.when(condition, value))


def has_dropped(prior: Column, last: Column, minimum, drop_pct) -> Column:
    """The value mattered before and has fallen by at least ``drop_pct`` since."""
    return (prior >= F.lit(minimum)) & (last <= F.lit(1 - drop_pct) * prior)

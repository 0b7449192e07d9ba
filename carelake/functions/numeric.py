"""Rounding with one definition for every report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double half away from zero after scaling by ten to ``digits``."""
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def rounded_mean(total: Column, count: Column, digits: int) -> Column:
    """Rounded mean from an exact total and a count; no rows give NULL."""
    return round_half_away(total.cast("double") / F.nullif(count, F.lit(0)), digits)


def rounded_pct(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage; a zero or NULL whole gives NULL."""
    whole_double = whole.cast("double")
    return round_half_away(
        part.cast("double") / F.nullif(whole_double, F.lit(0.0)) * F.lit(100.0), digits
    )

"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(col: Column, digits: int) -> Column:
    """Round a double at the scaled binary value, halves away from zero (``F.round`` goes through decimal text)."""
    scale = float(10**digits)
    return F.signum(col) * F.floor(F.abs(col) * scale + 0.5).cast("double") / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def exact_sum(col: Column) -> Column:
    """Sum of money as a decimal, which does not depend on the order of the rows."""
    return F.sum(col.try_cast("decimal(38,4)"))


def percent_text(col: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", col * 100.0)

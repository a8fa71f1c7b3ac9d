"""Numeric expressions, with the rounding rule named explicitly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(number: Column, digits: int = 0) -> Column:
    """SQL ``ROUND``: ties go away from zero."""
    return F.round(number, digits)


def half_even(number: Column, digits: int = 0) -> Column:
    """Array-library rounding: scale, round ties to even, scale back."""
    scale = float(10**digits)
    return F.rint(number * scale) / scale


def clip(number: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to ``[low, high]``; an open end is ``None``. Null stays null."""
    bounded = number
    if low is not None:
        bounded = F.when(bounded < low, F.lit(low)).otherwise(bounded)
    if high is not None:
        bounded = F.when(bounded > high, F.lit(high)).otherwise(bounded)
    return bounded


def guarded_ratio(top: Column, bottom: Column, default: float) -> Column:
    """``top / bottom`` where ``bottom`` is positive, else ``default``."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(default))


def ratio_or_null(top: Column, bottom: Column) -> Column:
    """Division that answers null for a zero or missing divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def floor_div(number: Column, by: int) -> Column:
    return F.floor(number / F.lit(by)).cast("int")

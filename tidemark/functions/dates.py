"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_text(day: Column) -> Column:
    """``2024-03``."""
    return F.date_format(day, "yyyy-MM")


def quarter_text(day: Column) -> Column:
    """``2024Q1``."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def date_key(day: Column) -> Column:
    """``20240315`` as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def to_date_or_null(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Parse a date; unreadable text becomes null instead of an error."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def delay_days(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``; a negative delay is an error -> null."""
    days = F.datediff(end, start)
    return F.when(days >= 0, days)

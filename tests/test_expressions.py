"""Expressions on hand-computed values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, rules, text


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("snapdragon 7s", "Snapdragon 7S"),
        ("INTEL i9", "Intel I9"),
        ("  e-commerce ", "E-Commerce"),
        ("hp", "Hp"),
        ("é'x", "É'X"),
        ("", ""),
        (None, None),
    ],
)
def test_tidy_text(spark, raw, want):
    assert one(spark, text.tidy_text(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize("value, digits, want", [(2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (-2.5, 0, -2.0)])
def test_half_even(spark, value, digits, want):
    assert one(spark, numbers.half_even(F.lit(value), digits)) == want


def test_half_up(spark):
    assert one(spark, numbers.half_up(F.lit(2.5), 0)) == 3.0


@pytest.mark.parametrize(
    "age, band", [(17, None), (18, "18-24"), (24, "18-24"), (25, "25-34"), (54, "45-54"), (100, "55+"), (101, None), (None, None)]
)
def test_age_band_edges(spark, age, band):
    assert one(spark, rules.age_band(F.lit(age).cast("int"))) == band


@pytest.mark.parametrize(
    "score, right, left",
    [(0.1, "Low", "Low"), (0.15, "Low", "Watch"), (0.45, "Watch", "High"), (0.5, "High", "High"), (None, None, None)],
)
def test_tier_edges(spark, score, right, left):
    col = F.lit(score).cast("double")
    assert one(spark, rules.risk_tier(col)) == right
    assert one(spark, rules.risk_tier(col, closed="left")) == left


@pytest.mark.parametrize(
    "r, f, m, want",
    [
        (5, 5, 5, "Champions"),
        (3, 3, 1, "Loyal Customers"),
        (5, 1, 5, "New / Promising"),
        (2, 4, 4, "At Risk (High Value)"),
        (1, 1, 1, "Lost / Churned"),
        (1, 3, 3, "Needs Attention"),
    ],
)
def test_segments(spark, r, f, m, want):
    assert one(spark, rules.rfm_segment(F.lit(r), F.lit(f), F.lit(m))) == want


def test_delay_and_parsing(spark):
    day = F.lit("2024-03-10").cast("date")
    assert one(spark, dates.delay_days(day, F.lit("2024-03-15").cast("date"))) == 5
    assert one(spark, dates.delay_days(day, F.lit("2024-03-09").cast("date"))) is None
    assert one(spark, dates.to_date_or_null(F.lit("nonsense"))) is None
    assert one(spark, dates.to_date_or_null(F.lit("2024-02-29"))) == dt.date(2024, 2, 29)
    assert one(spark, dates.date_key(day)) == 20240310
    assert one(spark, dates.quarter_text(day)) == "2024Q1"


def test_guards(spark):
    assert one(spark, numbers.guarded_ratio(F.lit(1.0), F.lit(0.0), 99.0)) == 99.0
    assert one(spark, numbers.ratio_or_null(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.clip(F.lit(7.0), 0.0, 5.0)) == 5.0
    assert one(spark, text.money_text(F.lit(1234567.5))) == "Rs.1,234,568"
    assert one(spark, text.char_count(F.lit("a.b.c"), ".")) == 2

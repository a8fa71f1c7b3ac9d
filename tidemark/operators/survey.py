"""Totals rows, pivots, gaps and trends over long survey tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import half_even

# --- fixed values: category order of the survey's levels ------------------------
LEVEL_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# ----------------------------------------------------------------------------------


def tenths_mean(column: str) -> Column:
    """Mean of one-decimal values, summed exactly as decimals."""
    return F.sum(F.col(column).cast("decimal(12,1)")).cast("double") / F.count(column)


def group_mean_round(df: DataFrame, keys: Sequence[str], value: str, digits: int = 1) -> DataFrame:
    return df.groupBy(*keys).agg(half_even(tenths_mean(value), digits).alias(value))


def with_totals(df: DataFrame, value: str = "rate") -> DataFrame:
    """Append one ``Total``/``Person`` row per year and level."""
    totals = group_mean_round(df, ["year", "level"], value).select(
        "year", "level", F.lit("Total").alias("region"), F.lit("Person").alias("gender"), value
    )
    return df.unionByName(totals).orderBy("year", "level", "region", "gender")


def category_rank(column: str, order: Sequence[str]) -> Column:
    """Position of a category in an explicit order; unknown categories give null."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column)), F.lit(0))


def sort_category(df: DataFrame, column: str, order: Sequence[str], only_listed: bool = False) -> DataFrame:
    """The listed categories in the listed order, then the others by name.

    Others have no rank; ``only_listed`` leaves them out.
    """
    ranked = df.withColumn("category_rank", category_rank(column, order))
    if only_listed:
        ranked = ranked.where(F.col("category_rank").isNotNull())
    return ranked.orderBy(F.asc_nulls_last("category_rank"), column)


def pivot_years(
    totals: DataFrame, years: Sequence[int] | None = None, order: Sequence[str] = LEVEL_ORDER
) -> DataFrame:
    """Level x year matrix in the given row order, over every year that there is.

    ``totals`` has a row per year and level, so its years are a short list.
    """
    if years is None:
        years = [r["year"] for r in totals.select("year").distinct().orderBy("year").collect()]
    wide = totals.groupBy("level").pivot("year", list(years)).agg(F.first("rate"))
    return sort_category(wide.withColumnsRenamed({str(y): f"y{y}" for y in years}), "level", order)


def pivot_gap(
    df: DataFrame, split: str, values: tuple[str, str], order: Sequence[str] = LEVEL_ORDER
) -> DataFrame:
    """Mean per level and split value side by side, and their gap."""
    wide = df.groupBy("level").pivot(split, list(values)).agg(tenths_mean("rate"))
    left, right = values
    gap = wide.withColumn("gap", F.col(left) - F.col(right))
    return sort_category(gap, "level", order)


def cell_ratio(df: DataFrame, top: str, bottom: str) -> DataFrame:
    """Ratio of two levels' rates, one decimal; ``df`` holds one year's totals."""

    def cell(level: str) -> Column:
        return F.max(F.when(F.col("level") == level, F.col("rate")))

    return df.agg(half_even(F.try_divide(cell(top), cell(bottom)), 1).alias("ratio"))


def extremes(df: DataFrame, order: Sequence[str] = LEVEL_ORDER) -> DataFrame:
    """Highest and lowest level; the first in category order wins a tie."""
    rank = category_rank("level", order)
    high = F.min(F.struct((-F.col("rate")).alias("v"), rank.alias("r"), F.col("level").alias("k")))
    low = F.min(F.struct(F.col("rate").alias("v"), rank.alias("r"), F.col("level").alias("k")))
    return df.agg(high.alias("high"), low.alias("low")).select(
        F.col("high.k").alias("highest"),
        (-F.col("high.v")).alias("highest_rate"),
        F.col("low.k").alias("lowest"),
        F.col("low.v").alias("lowest_rate"),
    )


def latest_year(df: DataFrame) -> DataFrame:
    """The rows of the last year that the table has."""
    return df.where(F.col("year") == df.agg(F.max("year")).scalar())


def only_totals(df: DataFrame) -> DataFrame:
    return df.where((F.col("region") == "Total") & (F.col("gender") == "Person"))


def trend_by_level(df: DataFrame) -> DataFrame:
    return only_totals(df).select("level", "year", "rate").orderBy("level", "year")


def yearly_change(df: DataFrame, category: str) -> DataFrame:
    """Change against the category's previous year; one row per year and category."""
    by_year = Window.partitionBy(category).orderBy("year")
    return df.withColumn("change", half_even(F.col("rate") - F.lag("rate").over(by_year), 2))


def gap_reversals(df: DataFrame) -> DataFrame:
    """Years in which the sign of the Male - Female gap flipped."""
    wide = df.groupBy("year").pivot("gender", ["Male", "Female"]).agg(tenths_mean("rate"))
    gap = wide.withColumn("gap", F.col("Male") - F.col("Female"))
    before = F.lag("gap").over(Window.orderBy("year"))  # one row per year
    return gap.withColumn("reversed", F.coalesce((F.signum("gap") * F.signum(before)) < 0, F.lit(False)).cast("int"))


def complement_pct(df: DataFrame, column: str, name: str) -> DataFrame:
    """``100 - x``, two decimals."""
    return df.withColumn(name, half_even(100 - F.col(column), 2))

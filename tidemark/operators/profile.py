"""Profiles and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio_or_null
from tidemark.operators.ordered import exact_quantiles
from tidemark.session import measured

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per input row and column: ``column``, ``value``."""
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keep), list(columns), "column", "value")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column."""
    values = long_form(df, columns).where(F.col("value").isNotNull())
    basics = values.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return basics.join(exact_quantiles(values, "value", QUARTILES, ["column"]), "column")


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with at least one null and how many."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return row.unpivot([], list(df.columns), "column", "nulls").where("nulls > 0")


class Audit:
    """Row counts of the steps of a job, taken while the job runs (no step is run again to count it).

    A task that is run twice because an executor was lost may be counted twice.
    """

    def __init__(self):
        self.steps: list[tuple[str, Observation]] = []

    def step(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, counted as it passes; it has to be part of one action."""
        seen = Observation()
        self.steps.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def table(self, last: DataFrame) -> DataFrame:
        """Rows after each step and the number the step removed, once ``last`` has run."""
        last.write.format("noop").mode("overwrite").save()
        counts = [(name, seen.get["rows"]) for name, seen in self.steps]
        before = [counts[0][1] if counts else 0, *[n for _, n in counts]]
        rows = [(i, name, n, before[i] - n) for i, (name, n) in enumerate(counts)]
        return last.sparkSession.createDataFrame(rows, "step int, stage string, rows_after long, removed long")


def shape_range(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("inward_date").alias("first_date"),
        F.max("inward_date").alias("last_date"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.countDistinct("customer_name").alias("customers"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts and shares, largest first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    whole = df.where(F.col(column).isNotNull()).agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("share", ratio_or_null(F.col("n"), whole)).orderBy(F.desc("n"), column)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form, every pair from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(x).alias("metric_a"), F.lit(y).alias("metric_b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles, the 1.5-IQR whiskers that lie on data, and outliers, per group.

    The whiskers are conditional extremes against the quartiles, one row per group,
    so the values themselves aren't shuffled.
    """
    known = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    quartiles = measured(exact_quantiles(known, value, QUARTILES, [group]), "quartiles")
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    inside = (F.col(value) >= F.col("p25") - reach) & (F.col(value) <= F.col("p75") + reach)
    return (
        known.select(group, value).join(quartiles, group)
        .groupBy(group, "p25", "p50", "p75")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from min to max, the last one closed, plus the median."""
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    span = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("span")).scalar()
    median = exact_quantiles(known, "v", {"median": 0.5}).scalar()
    lo, hi = F.col("_span.lo"), F.col("_span.hi")
    width = (hi - lo) / bins
    spot = F.when(hi > lo, F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1))).otherwise(0)
    return (
        known.withColumn("_span", span)
        .groupBy(spot.cast("int").alias("bin"), (lo + spot * width).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("median", median)
    )


def schema_check(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: is it there, how many of its values are null."""
    present = [c for c in required if c in df.columns]
    counts = {
        c: F.count_if(F.col(c).isNull()) if c in present else F.lit(None).cast("long") for c in required
    }
    row = df.agg(*[expr.alias(c) for c, expr in counts.items()])
    return row.unpivot([], list(required), "column", "nulls").withColumn(
        "present", F.col("column").isin(present).cast("int")
    )


def topk_signed(
    contributions: DataFrame, row_keys: Sequence[str], value: str, n: int, ties: str = "feature"
) -> DataFrame:
    """Per row and sign, the ``n`` largest values by size; zeros have no sign."""
    sign = F.when(F.col(value) > 0, "up").when(F.col(value) < 0, "down")
    best = Window.partitionBy(*row_keys, "direction").orderBy(F.desc(F.abs(value)), ties)
    return (
        contributions.withColumn("direction", sign)
        .where(F.col("direction").isNotNull())
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= n)
    )

"""Cleaning operators and the cleaning plan's steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import delay_days, month_text, quarter_text, to_date_or_null
from tidemark.functions.rules import age_band
from tidemark.functions.text import sentinel_to_null, tidy_text
from tidemark.operators.ordered import exact_quantiles
from tidemark.session import measured

TEXT_COLUMNS = ["region", "brand", "product_type", "processor", "gender", "income_bracket"]
CRITICAL_COLUMNS = ["order_id", "price", "quantity_sold", "inward_date", "region"]
TRIM_QUANTILES = (0.001, 0.999)


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], together: Column | None = None
) -> DataFrame:
    """The first row per key in a total order.

    The ``= 1`` filter lets Spark prune each key to one row in every map task,
    so a key that holds a third of the table sends on one row per task.
    ``together``, an expression of the keys, may name what ``df`` is partitioned by.
    """
    first = Window.partitionBy(*([] if together is None else [together]), *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def drop_repeats(df: DataFrame) -> DataFrame:
    """Drop rows that repeat another row in every column."""
    return df.distinct()


def standardize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim and title-case ``columns``; null stays null."""
    return df.withColumns({name: tidy_text(F.col(name)) for name in columns})


def null_sentinels(df: DataFrame, column: str, *sentinels: str) -> DataFrame:
    return df.withColumn(column, sentinel_to_null(F.col(column), *sentinels))


def fill_constant(df: DataFrame, values: dict[str, str | int | float]) -> DataFrame:
    return df.fillna(values)


def fill_group_median(df: DataFrame, column: str, group: str) -> DataFrame:
    """Null -> median of the row's group; a null group keeps its nulls.

    The medians are exact and computed from value counts, never by collecting a
    group.  They are written once, so Spark joins them by their measured size.
    """
    known = df.where(F.col(group).isNotNull())
    medians = measured(exact_quantiles(known, column, {"_median": 0.5}, [group]), "medians")
    return (
        df.join(medians, group, "left")
        .withColumn(column, F.coalesce(F.col(column), F.col("_median").cast(df.schema[column].dataType)))
        .select(*df.columns)
    )


def zero_as_missing(
    df: DataFrame, columns: Sequence[str], exclude_zeros: bool = False
) -> DataFrame:
    """0 -> column mean.  The mean counts the zeros unless ``exclude_zeros``."""

    def observed(name: str) -> Column:
        return F.when(F.col(name) != 0, F.col(name)) if exclude_zeros else F.col(name)

    means = df.agg(F.struct(*[F.avg(observed(c)).alias(c) for c in columns]).alias("means"))
    filled = df.withColumn("_means", means.scalar())
    return filled.withColumns(
        {c: F.when(F.col(c) == 0, F.col("_means")[c]).otherwise(F.col(c)) for c in columns}
    ).drop("_means")


def safe_cast(df: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
    """Cast text columns; what cannot be read becomes null."""
    return df.withColumns(
        {
            name: to_date_or_null(F.col(name))
            if isinstance(kind, T.DateType)
            else F.col(name).try_cast(kind)
            for name, kind in kinds.items()
        }
    )


def drop_null_critical(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(columns))


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def trim_edges(
    df: DataFrame, column: str, low: float = TRIM_QUANTILES[0], high: float = TRIM_QUANTILES[1]
) -> DataFrame:
    """One row (low, high): two exact quantiles."""
    return exact_quantiles(df, column, {"low": low, "high": high})


def between_edges(df: DataFrame, column: str, edges: DataFrame) -> DataFrame:
    """Rows whose value lies between the edges, ends included."""
    bounds = edges.select(F.struct("low", "high").alias("edges")).scalar()
    value = F.col(column).cast("double")
    return (
        df.withColumn("_edges", bounds)
        .where((value >= F.col("_edges.low")) & (value <= F.col("_edges.high")))
        .drop("_edges")
    )


def quantile_trim(
    df: DataFrame, column: str, low: float = TRIM_QUANTILES[0], high: float = TRIM_QUANTILES[1]
) -> DataFrame:
    """Keep rows whose value lies between two exact quantiles, ends included."""
    return between_edges(df, column, trim_edges(df, column, low, high))


def with_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", (F.col("price") * F.col("quantity_sold")).cast("decimal(14,2)"))


def with_periods(df: DataFrame, day: str = "inward_date") -> DataFrame:
    return df.withColumns(
        {
            "order_month": month_text(F.col(day)),
            "order_quarter": quarter_text(F.col(day)),
            "order_year": F.year(day),
        }
    )


def with_dispatch_delay(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "dispatch_delay_days", delay_days(F.col("inward_date"), F.col("dispatch_date"))
    )


def with_age_band(df: DataFrame, age: str = "customer_age") -> DataFrame:
    return df.withColumn("age_band", age_band(F.col(age)))


def row_order(df: DataFrame) -> list[str]:
    """A total order for keep-first: dates and amounts first, then the rest."""
    leading = ["inward_date", "dispatch_date", "price", "quantity_sold"]
    return leading + [c for c in df.columns if c not in leading]


def dedupe_sales(raw: DataFrame, together: Column | None = None) -> DataFrame:
    """One line per order id.  Lines that repeat in full share their id too, so
    a second pass over whole rows would only add a shuffle.

    ``together`` is an expression of the id alone by which the lines were just
    joined: equal ids lie in one partition then and are not shuffled again.
    """
    return keep_first(raw, ["order_id"], row_order(raw), together)


def repair_text(df: DataFrame) -> DataFrame:
    """Tidy categories, sentinels as null, missing processor as a category."""
    texted = standardize_text(df, TEXT_COLUMNS)
    for column in ("region", "processor"):
        texted = null_sentinels(texted, column, "Nan")
    return fill_constant(texted, {"processor": "Unknown"})


def derive_sales(df: DataFrame) -> DataFrame:
    return with_age_band(with_dispatch_delay(with_periods(with_revenue(df))))


def usable_lines(lines: DataFrame) -> DataFrame:
    """Lines with all critical columns and a positive price."""
    return keep_positive(drop_null_critical(lines), "price")


def clean_sales(raw: DataFrame, together: Column | None = None) -> DataFrame:
    """Raw order lines -> analysis-ready lines.

    The medians and the trim edges each need a look at all lines before the
    lines themselves can pass, so the deduplicated lines are written once and
    those looks only read the columns they need.
    """
    lines = measured(repair_text(dedupe_sales(raw, together)), "sales_lines")
    filled = fill_group_median(lines, "ram_gb", "product_type")
    return derive_sales(quantile_trim(usable_lines(filled), "price"))

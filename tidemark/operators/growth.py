"""Month-over-month growth, drop alerts and cohort retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start
from tidemark.functions.numbers import half_up, ratio_or_null
from tidemark.operators.reports import total


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per calendar month; one row per month ever seen."""
    return sales.groupBy(month_start(F.col("inward_date")).alias("month")).agg(
        total("revenue").alias("monthly_revenue")
    )


def month_growth(monthly: DataFrame) -> DataFrame:
    """Growth against the previous *existing* month."""
    in_order = Window.orderBy("month")  # one row per month
    prior = F.lag("monthly_revenue").over(in_order)
    return monthly.withColumn("prior_month_revenue", prior).select(
        F.year("month").alias("year_num"),
        F.month("month").alias("month_num"),
        "monthly_revenue",
        "prior_month_revenue",
        half_up(
            ratio_or_null(
                (F.col("monthly_revenue") - F.col("prior_month_revenue")) * 100.0,
                F.col("prior_month_revenue"),
            ),
            1,
        ).alias("mom_growth_pct"),
    )


def calendar_growth(monthly: DataFrame) -> DataFrame:
    """Growth against the previous *calendar* month; no such month gives null."""
    prior = monthly.select(
        F.add_months("month", 1).alias("month"),
        F.col("monthly_revenue").alias("prior_month_revenue"),
    )
    return monthly.join(prior, "month", "left").withColumn(
        "growth",
        ratio_or_null(
            F.col("monthly_revenue") - F.col("prior_month_revenue"), F.col("prior_month_revenue")
        ),
    )


def drop_alerts(growth: DataFrame, limit_pct: float = 10.0) -> DataFrame:
    """Months whose revenue fell by more than ``limit_pct`` percent."""
    change = ratio_or_null(
        (F.col("monthly_revenue") - F.col("prior_month_revenue")) * 100.0,
        F.col("prior_month_revenue"),
    )
    return growth.where(change < -limit_pct)


MONTHS = 64  # months in one mask


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _active(offset: int) -> Column:
    """Was the customer active ``offset`` months after the first one?"""
    spot = F.col("_first") - F.col("_base") + offset
    mask = F.get("_masks", F.floor(spot / MONTHS).cast("int"))
    return F.coalesce(F.getbit(mask, (spot % MONTHS).cast("int")), F.lit(0)) == 1


def customer_months(sales: DataFrame) -> DataFrame:
    """One row per customer: the first month, and a bit for every month with a purchase.

    The bits are or-ed together in a single aggregation, so a customer of any size
    leaves each map task as one row.  There is one mask per 64 months of the table.
    """
    bought = sales.where(F.col("customer_name").isNotNull() & F.col("inward_date").isNotNull()).select(
        "customer_name", _month_number(F.col("inward_date")).alias("_month")
    )
    low, high = bought.agg(F.min("_month"), F.max("_month")).first()
    base, masks = low or 0, ((high or 0) - (low or 0)) // MONTHS + 1
    place = F.col("_month") - base
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place % MONTHS)
    parts = [F.coalesce(F.bit_or(F.when(F.floor(place / MONTHS) == k, bit)), F.lit(0).cast("long")) for k in range(masks)]
    found = bought.groupBy("customer_name").agg(F.min("_month").alias("_first"), F.array(*parts).alias("_masks"))
    first = F.make_date(F.floor(F.col("_first") / 12).cast("int"), F.col("_first") % 12 + 1, F.lit(1))
    return found.select("customer_name", first.alias("cohort_month"), "_first", F.lit(base).alias("_base"), "_masks")


def cohort_second_month(months: DataFrame) -> DataFrame:
    """Cohort size and how many of it bought again in the following month."""
    return (
        months.groupBy("cohort_month")
        .agg(F.count(F.lit(1)).alias("cohort_size"), F.count_if(_active(1)).alias("retained_month_2"))
        .orderBy("cohort_month")
    )


def cohort_curve(months: DataFrame, last: int = 12) -> DataFrame:
    """Share of each cohort active 0..``last`` months after its first month; offsets without anyone are left out."""
    counted = months.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"), F.array(*[F.count_if(_active(k)) for k in range(last + 1)]).alias("_active")
    )
    return (
        counted.select("cohort_month", "cohort_size", F.posexplode("_active").alias("month_offset", "active"))
        .where(F.col("active") > 0)
        .withColumn("retention", ratio_or_null(F.col("active"), F.col("cohort_size")))
    )

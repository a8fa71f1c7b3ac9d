"""KPI reports on the flat sales table and on the star.

Every report reduces the fact on the map side first; windows only ever run
over the reduced rows, whose number is bounded by the calendar or by the
report's own groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import half_even, half_up, ratio_or_null
from tidemark.functions.text import money_text, one_decimal_text, whole_text


def total(column: str) -> Column:
    """A sum that is 0, not null, when there is nothing to add."""
    return F.coalesce(F.sum(column).cast("double"), F.lit(0.0))


def mean(column: str) -> Column:
    """Mean as exact sum over count, so the order of the rows cannot matter."""
    return ratio_or_null(F.sum(column), F.count(column))


def share_of_all(part: str, digits: int = 1) -> Column:
    """Percent of the grand total, over an already reduced frame."""
    return half_up(F.col(part) * 100.0 / F.sum(part).over(Window.partitionBy()), digits)


# --- star reports ---------------------------------------------------------------


def with_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Inner equi-join of the fact with one dimension."""
    return fact.join(dim, fact[fact_key] == dim[dim_key])


def monthly_sales(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        with_dim(fact, dates, "inward_date_key", "date_key")
        .groupBy("year_num", "month_num", "month_name")
        .agg(
            total("revenue").alias("total_revenue"),
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("quantity_sold").alias("total_units"),
        )
        .orderBy("year_num", "month_num")
    )


def brand_sales(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_key").agg(
        F.sum("revenue").alias("_revenue"), F.sum("quantity_sold").alias("_units"),
        F.sum("price").alias("_price"), F.count("price").alias("_priced"),
    )
    return (
        with_dim(per_product, products, "product_key", "product_key")
        .groupBy("brand", "product_type")
        .agg(
            total("_revenue").alias("total_revenue"),
            F.sum("_units").alias("total_units"),
            half_up(ratio_or_null(F.sum("_price"), F.sum("_priced")), 0).alias("avg_price"),
        )
        .orderBy(F.desc("total_revenue"), "brand", "product_type")
    )


def region_share(fact: DataFrame, regions: DataFrame) -> DataFrame:
    return (
        with_dim(fact, regions, "region_key", "region_key")
        .groupBy("region_name")
        .agg(total("revenue").alias("region_revenue"))
        .withColumn("pct_of_total_revenue", share_of_all("region_revenue"))
        .orderBy(F.desc("region_revenue"), "region_name")
    )


def region_share_by_subquery(fact: DataFrame, regions: DataFrame) -> DataFrame:
    """The same share through a scalar subquery for the grand total."""
    return fact.sparkSession.sql(
        """
        SELECT r.region_name,
               CAST(SUM(f.revenue) AS DOUBLE) AS region_revenue,
               ROUND(CAST(SUM(f.revenue) AS DOUBLE) * 100.0D
                     / (SELECT CAST(SUM(revenue) AS DOUBLE) FROM {fact}), 1) AS pct_of_total
        FROM {fact} f JOIN {regions} r ON f.region_key = r.region_key
        GROUP BY r.region_name
        ORDER BY region_revenue DESC, r.region_name
        """,
        fact=fact,
        regions=regions,
    )


def top_customers(fact: DataFrame, customers: DataFrame, n: int = 10, unique_orders: bool = False) -> DataFrame:
    """Top ``n`` customers; the fact is reduced per customer before the join.

    Order ids that are known to be unique are only counted.
    """
    orders = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    per_customer = fact.groupBy("customer_key").agg(
        orders.alias("total_orders"),
        total("revenue").alias("lifetime_revenue"),
    )
    return (
        per_customer.join(customers, "customer_key")
        .select("customer_name", "rfm_segment", "total_orders", "lifetime_revenue")
        .orderBy(F.desc("lifetime_revenue"), "customer_name")
        .limit(n)
    )


def segment_share(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, revenue and share by segment.  Customer keys are unique after
    the first reduction, so counting rows counts distinct customers."""
    per_customer = fact.groupBy("customer_key").agg(F.sum("revenue").alias("revenue"))
    return (
        per_customer.join(customers, "customer_key")
        .groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers_in_segment"),
            total("revenue").alias("segment_revenue"),
        )
        .withColumn("pct_of_revenue", share_of_all("segment_revenue"))
        .orderBy(F.desc("segment_revenue"), "rfm_segment")
    )


def dispatch_delay(fact: DataFrame, products: DataFrame, regions: DataFrame) -> DataFrame:
    """Mean delay by type and region; lines without a delay are left out."""
    known = (
        fact.where(F.col("dispatch_delay_days").isNotNull())
        .groupBy("product_key", "region_key")
        .agg(F.sum("dispatch_delay_days").alias("_days"), F.count(F.lit(1)).alias("_orders"))
    )
    both = with_dim(
        with_dim(known, products, "product_key", "product_key").drop(products["product_key"]),
        regions, "region_key", "region_key",
    )
    return (
        both.groupBy("product_type", "region_name")
        .agg(
            half_up(ratio_or_null(F.sum("_days"), F.sum("_orders")), 1).alias("avg_dispatch_delay_days"),
            F.sum("_orders").alias("orders"),
        )
        .orderBy(F.desc("avg_dispatch_delay_days"), "product_type", "region_name")
    )


def top_processors(fact: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` processors per type with ties kept; pruned before the shuffle."""
    units = (
        with_dim(
            fact.groupBy("product_key").agg(F.sum("quantity_sold").alias("_units")), products, "product_key", "product_key"
        )
        .groupBy("product_type", "processor")
        .agg(F.sum("_units").alias("units_sold"))
    )
    best = Window.partitionBy("product_type").orderBy(F.desc("units_sold"))
    return (
        units.withColumn("rnk", F.rank().over(best))
        .where(F.col("rnk") <= n)
        .orderBy("product_type", "rnk", "processor")
    )


def demographics(fact: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = fact.groupBy("customer_key").agg(F.sum("revenue").alias("revenue"))
    return (
        per_customer.join(customers, "customer_key")
        .groupBy("age_band", "income_bracket")
        .agg(total("revenue").alias("total_revenue"), F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("total_revenue"), "age_band", "income_bracket")
    )


# --- flat reports ---------------------------------------------------------------


def per_customer(sales: DataFrame, keys: Sequence[str] = (), customer: str = "customer_name") -> DataFrame:
    """Sales reduced to one row per key and customer.

    Order ids are unique after cleaning (``constraint_violations`` counts those
    that aren't), so orders are counted, and customers are rows of this table.
    """
    return sales.groupBy(*keys, customer).agg(
        F.sum("revenue").alias("_revenue"), F.count("order_id").alias("_orders"), F.sum("quantity_sold").alias("_units"),
        F.sum("dispatch_delay_days").alias("_days"), F.count("dispatch_delay_days").alias("_delays"),
    )


def exec_kpis(sales: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    return per_customer(sales).agg(
        total("_revenue").alias("total_revenue"),
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("_units"), F.lit(0)).alias("total_units"),
        F.count("customer_name").alias("unique_customers"),
        ratio_or_null(F.sum("_days"), F.sum("_delays")).alias("avg_dispatch_delay"),
    ).withColumns(
        {
            "average_order_value": ratio_or_null(F.col("total_revenue"), F.col("total_orders")),
            "revenue_per_customer": ratio_or_null(F.col("total_revenue"), F.col("unique_customers")),
        }
    )


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum per group, largest first; rows with a missing key are left out."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(total(value).alias(name))
        .orderBy(F.desc(name), *keys)
    )


def kpi_by_type(sales: DataFrame) -> DataFrame:
    return (
        sales.dropna(subset=["product_type"])
        .groupBy("product_type")
        .agg(
            total("revenue").alias("revenue"),
            F.sum("quantity_sold").alias("units"),
            mean("price").alias("avg_price"),
        )
        .orderBy(F.desc("revenue"), "product_type")
    )


def top_by(df: DataFrame, key: str, value: str, name: str, n: int = 5) -> DataFrame:
    return sum_by(df, [key], value, name).limit(n)


def region_kpis(sales: DataFrame) -> DataFrame:
    """Revenue, orders, customers and share; the share rounds half to even."""
    return (
        per_customer(sales.dropna(subset=["region"]), ["region"])
        .groupBy("region")
        .agg(
            total("_revenue").alias("revenue"),
            F.sum("_orders").alias("orders"),
            F.count("customer_name").alias("customers"),
        )
        .withColumn(
            "revenue_share_pct",
            half_even(F.col("revenue") / F.sum("revenue").over(Window.partitionBy()) * 100, 1),
        )
        .orderBy(F.desc("revenue"), "region")
    )


def best_worst_month(sales: DataFrame) -> DataFrame:
    """Month with the highest and the lowest revenue; the earlier wins a tie."""
    monthly = sum_by(sales, ["order_month"], "revenue", "revenue")
    high = F.min(F.struct((-F.col("revenue")).alias("v"), F.col("order_month").alias("m")))
    low = F.min(F.struct(F.col("revenue").alias("v"), F.col("order_month").alias("m")))
    return monthly.agg(high.alias("high"), low.alias("low")).select(
        F.col("high.m").alias("best_month"),
        (-F.col("high.v")).alias("best_revenue"),
        F.col("low.m").alias("worst_month"),
        F.col("low.v").alias("worst_revenue"),
    )


def kpi_summary(sales: DataFrame) -> DataFrame:
    """The formatted KPI/value table."""
    region = top_by(sales, "region", "revenue", "v", 1).select("region").scalar()
    brand = top_by(sales, "brand", "revenue", "v", 1).select("brand").scalar()
    month = best_worst_month(sales).select("best_month").scalar()
    k = exec_kpis(sales)
    lines = [
        ("Total Revenue", money_text(F.col("total_revenue"))),
        ("Total Orders", whole_text(F.col("total_orders"))),
        ("Total Units Sold", whole_text(F.col("total_units"))),
        ("Average Order Value", money_text(F.col("average_order_value"))),
        ("Unique Customers", whole_text(F.col("unique_customers"))),
        ("Top Region", region),
        ("Top Brand", brand),
        ("Best Month", month),
        ("Avg Dispatch Delay (days)", one_decimal_text(F.col("avg_dispatch_delay"))),
    ]
    values = k.select(*[value.alias(f"v{i}") for i, (_, value) in enumerate(lines)])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("kpi"), F.col(f"v{i}").alias("value")) for i, (name, _) in enumerate(lines)]
    )
    return values.select(F.inline(pairs))


def month_combo(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("order_month")
        .agg(total("revenue").alias("revenue"), F.countDistinct("order_id").alias("orders"))
        .orderBy("order_month")
    )


def spec_table(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("ram_gb", "rom_gb")
        .agg(F.sum("quantity_sold").alias("units"), mean("price").alias("avg_price"))
        .orderBy(F.desc("units"), "ram_gb", "rom_gb")
    )


def price_volume(sales: DataFrame) -> DataFrame:
    return (
        sales.dropna(subset=["brand"])
        .groupBy("brand")
        .agg(mean("price").alias("avg_price"), F.sum("quantity_sold").alias("units"))
        .orderBy("brand")
    )


def region_scorecard(sales: DataFrame) -> DataFrame:
    return (
        per_customer(sales.dropna(subset=["region"]), ["region"])
        .groupBy("region")
        .agg(
            F.sum("_orders").alias("orders"),
            total("_revenue").alias("revenue"),
            ratio_or_null(F.sum("_days"), F.sum("_delays")).alias("avg_delay"),
            F.count("customer_name").alias("customers"),
        )
        .withColumn("revenue_share", F.col("revenue") / F.sum("revenue").over(Window.partitionBy()))
        .orderBy("region")
    )


def share_ignoring(df: DataFrame, dim: str, others: Sequence[str], value: str) -> DataFrame:
    """A group's share of the total over all values of ``dim`` while the other
    dimensions stay fixed."""
    grouped = df.groupBy(dim, *others).agg(total(value).alias(value))
    whole = F.sum(value).over(Window.partitionBy(*others))
    return grouped.withColumn("share", ratio_or_null(F.col(value), whole))


def reconcile(flat: DataFrame, star: DataFrame) -> DataFrame:
    """The same KPI by two routes: full join of both and their difference."""
    left = flat.select("kpi", F.col("value").alias("flat_value"))
    right = star.select("kpi", F.col("value").alias("star_value"))
    return left.join(right, "kpi", "full").withColumn(
        "difference", F.col("flat_value") - F.col("star_value")
    )


def kpi_values(df: DataFrame, customer: str) -> DataFrame:
    """Headline numbers in long form, from a flat or a star fact."""
    row = per_customer(df, customer=customer).agg(
        F.sum("_revenue").cast("double").alias("revenue"),
        F.sum("_orders").cast("double").alias("orders"),
        F.sum("_units").cast("double").alias("units"),
        F.count(customer).cast("double").alias("customers"),
    )
    return row.unpivot([], ["revenue", "orders", "units", "customers"], "kpi", "value")

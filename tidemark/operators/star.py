"""Star schema: dimensions, fact, keyed inserts and the contract check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.functions.rules import outcome_label
from tidemark.operators.clean import keep_first, row_order
from tidemark.operators.ordered import with_rank
from tidemark.schemas import LABEL, STAR_CONTRACT

PRODUCT_COLUMNS = ["product_type", "brand", "processor", "ram_gb", "rom_gb"]


def dim_region(sales: DataFrame) -> DataFrame:
    """Distinct regions, keyed in name order."""
    names = sales.select(F.col("region").alias("region_name")).dropna().distinct()
    return with_rank(names, ["region_name"], "region_key").select("region_key", "region_name")


def customer_keys(sales: DataFrame) -> DataFrame:
    """Surrogate key per customer name, in name order."""
    names = sales.select("customer_name").dropna().distinct()
    return with_rank(names, ["customer_name"], "customer_key")


def dim_customer(sales: DataFrame, segments: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """First line of every customer plus key and segment."""
    traits = ["customer_name", "customer_age", "gender", "income_bracket", "age_band"]
    lines = sales.select("order_id", *traits).where(F.col("customer_name").isNotNull())
    first = keep_first(lines, ["customer_name"], ["order_id", *traits[1:]])
    scored = segments.select("customer_name", "segment", "rfm_total")
    keyed = first.join(customer_keys(sales) if keys is None else keys, "customer_name")
    return keyed.join(scored, "customer_name", "left").select(
        "customer_key",
        "customer_name",
        F.col("customer_age").alias("age"),
        "gender",
        "income_bracket",
        "age_band",
        F.col("segment").alias("rfm_segment"),
        F.col("rfm_total").alias("rfm_total_score"),
    )


def customer_segments(keys: DataFrame, segments: DataFrame) -> DataFrame:
    """Key, name and segment of every customer: the columns of ``dim_customer`` that
    need no look at the lines."""
    scored = segments.select("customer_name", F.col("segment").alias("rfm_segment"))
    return keys.join(scored, "customer_name", "left").select("customer_key", "customer_name", "rfm_segment")


def customer_sales(sales: DataFrame, keys: DataFrame) -> DataFrame:
    """The fact's columns for reports by customer: as ``fact_sales``, without the joins
    with products and regions, which add no rows and take none."""
    lines = sales.select("customer_name", "order_id", "revenue")
    return lines.join(keys.select("customer_key", "customer_name"), "customer_name", "left").select(
        "order_id", "customer_key", "revenue"
    )


def dim_product(sales: DataFrame) -> DataFrame:
    """Distinct five-column specs, keyed in spec order (nulls first)."""
    specs = sales.select(*PRODUCT_COLUMNS).distinct()
    return with_rank(specs, PRODUCT_COLUMNS, "product_key").select("product_key", *PRODUCT_COLUMNS)


def _calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.month(day).alias("month_num"),
        F.quarter(day).alias("quarter_num"),
        F.year(day).alias("year_num"),
    )


def dim_date(sales: DataFrame) -> DataFrame:
    """Every date seen as inward or dispatch date."""
    seen = sales.select(F.explode(F.array("inward_date", "dispatch_date")).alias("full_date"))
    return _calendar_columns(seen.dropna().distinct())


def dim_calendar(sales: DataFrame) -> DataFrame:
    """Every date between the first and the last one seen, without gaps."""
    seen = sales.select(F.explode(F.array("inward_date", "dispatch_date")).alias("d"))
    span = seen.agg(F.min("d").alias("first"), F.max("d").alias("last"))
    return _calendar_columns(
        span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date"))
    )


def dim_month(features: DataFrame) -> DataFrame:
    """Relative months 0..max with relative year and quarter."""
    last = features.agg(F.max("month_index").alias("last"))
    month = F.col("month_index")
    return last.select(F.explode(F.sequence(F.lit(0), F.col("last").cast("int"))).alias("month_index")).select(
        month,
        (F.floor(month / 12) + 1).cast("int").alias("relative_year"),
        (F.floor(month / 3) + 1).cast("int").alias("relative_quarter"),
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` where null matches null; right key columns are dropped."""
    marked = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = reduce(and_, [left[k].eqNullSafe(marked[f"_right_{k}"]) for k in keys])
    return left.join(marked, match, how).drop(*[f"_right_{k}" for k in keys])


def fact_sales(
    sales: DataFrame, customers: DataFrame, products: DataFrame, regions: DataFrame
) -> DataFrame:
    """Natural keys -> surrogate keys.  Date keys are computed, not looked up.

    ``customers`` needs the name and key only.  Products come first: their five wide
    columns leave with that join and are not shuffled again for the customers.
    """
    keyed = (
        join_null_safe(sales, products, PRODUCT_COLUMNS, "left")
        .join(regions.select("region_key", F.col("region_name").alias("region")), "region", "left")
        .join(customers.select("customer_key", "customer_name"), "customer_name", "left")
    )
    return keyed.select(
        "order_id",
        "customer_key",
        "product_key",
        "region_key",
        date_key(F.col("inward_date")).alias("inward_date_key"),
        date_key(F.col("dispatch_date")).alias("dispatch_date_key"),
        "price",
        "quantity_sold",
        "revenue",
        "dispatch_delay_days",
    )


def upsert_ignore(target: DataFrame, arrivals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append rows whose key is new; the first of several arrivals with one key wins.

    A target that ``sources.files.bucketed`` keeps by the keys is joined where it
    lies: only the arrivals are shuffled, into its buckets.
    """
    first = keep_first(arrivals, keys, row_order_of(arrivals))
    return target.unionByName(first.join(target.select(*keys), list(keys), "left_anti"))


def row_order_of(df: DataFrame) -> list[str]:
    """The sales order where the columns exist, else all columns in their order."""
    return row_order(df) if {"inward_date", "price"} <= set(df.columns) else list(df.columns)


def constraint_violations(
    tables: Mapping[str, DataFrame], contract: Mapping[str, dict] = STAR_CONTRACT
) -> DataFrame:
    """One row per constraint: how many keys or rows break it.

    Duplicates are counted after a map-side pre-aggregation; orphans are the
    rows left over by an anti join on the distinct foreign keys.  The nulls of
    all required columns of a table are counted in one pass.
    """
    checks = []

    def report(name: str, rule: str, columns: Sequence[str], broken: DataFrame) -> None:
        checks.append(
            broken.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations")).select(
                F.lit(name).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(",".join(columns)).alias("columns"),
                "violations",
            )
        )

    for name, rules in contract.items():
        df = tables[name]
        for rule, columns in [("primary", rules["primary"])] + [("unique", c) for c in rules["unique"]]:
            repeats = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
            report(name, rule, columns, repeats.select(F.lit(1).alias("_n")))
        if rules["required"]:   # all in one pass
            nulls = [
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit("required").alias("rule"),
                    F.lit(column).alias("columns"),
                    F.count_if(F.col(column).isNull()).alias("violations"),
                )
                for column in rules["required"]
            ]
            checks.append(df.agg(F.array(*nulls).alias("_nulls")).select(F.inline("_nulls")))
        for column, (parent, parent_key) in rules.get("foreign", {}).items():
            used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
            parents = tables[parent].select(F.col(parent_key).alias(column))
            report(name, "foreign", [column], used.join(parents, column, "left_anti"))
    return reduce(DataFrame.unionByName, checks)


def write_star(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Parquet tables; the fact is partitioned by order year for pruning."""
    for name, df in tables.items():
        if name == "fact_sales":
            year = F.floor(F.col("inward_date_key") / 10000).cast("int")
            df.withColumn("order_year", year).write.mode("overwrite").partitionBy("order_year").parquet(
                f"{folder}/{name}"
            )
        else:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")


def scored_fact(features: DataFrame) -> DataFrame:
    """Risk fact per entity and month; ``features`` carries score and tier."""
    return features.select(
        "company_id",
        "month_index",
        "risk_score",
        "risk_tier",
        F.col("runway_months_latest").alias("runway_months"),
        F.col("mrr_latest").alias("mrr"),
        F.col("churn_rate_latest").alias("churn_rate"),
        F.col("ltv_cac_ratio_latest").alias("ltv_cac_ratio"),
        "burn_multiple",
        "composite_risk_index",
        "consecutive_low_runway_months",
        F.col(LABEL).alias(f"actual_{LABEL}"),
    )


def dim_company(entities: DataFrame) -> DataFrame:
    return entities.withColumn("outcome", outcome_label(F.col("failed"), F.col("acquired")))

"""Recency, frequency, monetary scoring and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import rfm_segment
from tidemark.operators.ordered import exact_quantiles, with_rank
from tidemark.operators.profile import long_form
from tidemark.session import measured
from tidemark.sources.files import inline_table

# --- fixed values: recommended action per segment -----------------------------
SEGMENT_ACTIONS = [
    ("Champions", "Reward with early access / loyalty perks. Protect, don't discount."),
    ("Loyal Customers", "Upsell premium SKUs (e.g. higher RAM/ROM variants). Cross-sell accessories."),
    ("New / Promising", "Onboard with a second-purchase incentive within 30 days."),
    ("At Risk (High Value)", "Urgent win-back campaign — high revenue customers going cold."),
    ("Needs Attention", "Re-engagement email/SMS with a moderate discount."),
    ("Lost / Churned", "Low-cost reactivation only; do not over-invest."),
]
# ------------------------------------------------------------------------------
QUINTILES = {"e1": 0.2, "e2": 0.4, "e3": 0.6, "e4": 0.8}


def rfm_base(sales: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Days since the last purchase (to the day after the newest one), orders, revenue.

    Where order ids are known to be unique they are only counted: finding the distinct
    ones would shuffle every line.
    """
    orders = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    snapshot = sales.agg(F.date_add(F.max("inward_date"), 1)).scalar()
    return (
        sales.where(F.col("customer_name").isNotNull())
        .groupBy("customer_name")
        .agg(
            F.max("inward_date").alias("_last"),
            orders.alias("frequency"),
            F.sum("revenue").alias("monetary"),
        )
        .select(
            "customer_name",
            F.datediff(snapshot, F.col("_last")).alias("recency"),
            "frequency",
            "monetary",
        )
    )


def _quintile(value: Column, edges: Column) -> Column:
    """1..5 by right-closed quantile edges."""
    return 1 + sum((value > edges[name]).cast("int") for name in QUINTILES)


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintile scores.  Recency and monetary use exact interpolated quantile
    edges; frequency is ranked first (ties by name), so its quintiles are even.

    The customer table is written once: edges, ranks and scores all read it."""
    base = measured(base, "rfm_base")
    long = long_form(base, ["recency", "monetary"])
    edges = measured(exact_quantiles(long, "value", QUINTILES, ["column"]), "rfm_edges")

    def edges_of(column: str) -> Column:
        return edges.where(F.col("column") == column).select(F.struct(*QUINTILES)).scalar()

    size = base.agg(F.count(F.lit(1))).scalar()
    ranked = with_rank(base, ["frequency", "customer_name"], "_rank").withColumns(
        {"_r": edges_of("recency"), "_m": edges_of("monetary"), "_size": size}
    )
    even = F.try_divide((F.col("_rank") - 1) * 5, F.col("_size") - 1)
    scored = ranked.withColumns(
        {
            "r_score": (6 - _quintile(F.col("recency").cast("double"), F.col("_r"))).cast("int"),
            "f_score": F.greatest(F.lit(1), F.coalesce(F.ceil(even), F.lit(1))).cast("int"),
            "m_score": _quintile(F.col("monetary").cast("double"), F.col("_m")).cast("int"),
        }
    )
    marks = [F.col(name) for name in ("r_score", "f_score", "m_score")]
    return scored.select(
        *base.columns,
        *marks,
        F.concat(*[m.cast("string") for m in marks]).alias("rfm_score"),
        (marks[0] + marks[1] + marks[2]).alias("rfm_total"),
    )


def with_segment(scores: DataFrame) -> DataFrame:
    return scores.withColumn(
        "segment", rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    )


def segment_actions(spark: SparkSession) -> DataFrame:
    return inline_table(spark, SEGMENT_ACTIONS, "segment string, recommended_action string")


def map_values(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Dictionary lookup: unmatched keys give null."""
    return df.join(mapping, key, "left")


def attach_segment(sales: DataFrame, segments: DataFrame) -> DataFrame:
    """Segment and total score back on every line."""
    return sales.join(
        segments.select("customer_name", "segment", "rfm_total"), "customer_name", "left"
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    size = F.count(F.lit(1))
    return (
        segments.groupBy("segment")
        .agg(
            size.alias("customers"),
            (F.sum("monetary").cast("double") / size).alias("avg_monetary"),
            (F.sum("frequency").cast("double") / size).alias("avg_frequency"),
            (F.sum("recency").cast("double") / size).alias("avg_recency"),
        )
        .orderBy(F.desc("avg_monetary"), "segment")
    )

"""Refresh queries: the given tables read as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import bases, learning
from tidemark.plans.bases import Query, registrar
from tidemark.learn import models
from tidemark.session import fresh_path, measured
from tidemark.sources import tables
from tidemark.streaming import refresh, sales

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)


def event_stream(spark, folder) -> DataFrame:
    """The event table as a stream; event time as an instant."""
    schema = tables.table(spark, folder, "events").schema
    stream = refresh.landing(spark, f"{folder}/events*.parquet", schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def st_incremental_refresh(spark, folder):
    sink, mark = fresh_path(spark, "events_clean"), fresh_path(spark, "mark")

    def clean(batch: DataFrame) -> DataFrame:
        return batch.where("value > 0").withColumn("event_type", F.initcap("event_type"))

    refresh.incremental_refresh(event_stream(spark, folder), sink, mark, clean)
    saved = spark.read.parquet(sink)
    return saved.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(14,2)")).alias("total")
    )


@query
def st_sales_refresh(spark, folder):
    """Raw sales land in three parts, the lines of one order id and some repeated lines
    spread over them; the clean table after the third refresh."""
    raw = bases.flat(spark, folder)
    part = F.pmod(F.xxhash64(*raw.columns), F.lit(3))
    landed = measured(raw.withColumn("_part", part).unionByName(raw.where("order_id % 10 = 0").withColumn("_part", (part + 1) % 3)), "sales_landing")
    source, sink, mark = (fresh_path(spark, n) for n in ("sales_in", "sales_lines", "mark"))
    for k in range(3):
        landed.where(F.col("_part") == k).drop("_part").write.mode("append").parquet(source)
        sales.sales_refresh(refresh.landing(spark, source, raw.schema), sink, mark)
    current = sales.current_sales(spark, sink, raw.schema)
    return current.select("order_id", "customer_name", "product_type", "ram_gb", "price", "revenue", "order_quarter", "dispatch_delay_days", "age_band")


@query
def st_dedupe(spark, folder):
    sink, mark = fresh_path(spark, "events_once"), fresh_path(spark, "mark")
    daily = event_stream(spark, folder).select(
        "ts", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    refresh.append_new(daily, sink, mark, ["user_id", "event_type", "day"])
    return spark.read.parquet(sink).select("user_id", "event_type", "day")


@query
def st_window_revenue(spark, folder):
    sink, mark = fresh_path(spark, "event_totals"), fresh_path(spark, "mark")
    bought = event_stream(spark, folder).where("event_type = 'purchase'")
    refresh.keep_current(refresh.windowed_totals(bought, "ts", "value"), sink, mark)
    current = refresh.current_totals(spark, sink)
    return current.select(F.date_format("bucket_start", "yyyy-MM-dd").alias("bucket"), "revenue", "events")


@query
def st_revenue_revisions(spark, folder):
    """Purchases land in three parts by user; each part revises the days of the parts before it."""
    events = tables.table(spark, folder, "events")
    part = F.pmod(F.coalesce("user_id", F.lit(0)), F.lit(3))
    source, sink, mark = (fresh_path(spark, n) for n in ("events_in", "revisions", "mark"))
    for k in range(3):
        events.where((part == k) & (F.col("event_type") == "purchase")).write.mode("append").parquet(source)
        stream = refresh.landing(spark, source, events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        refresh.keep_revisions(refresh.revised_totals(stream, "ts", "value"), sink, mark)
    latest = refresh.latest_revisions(spark, sink)
    return latest.select(F.date_format("bucket_start", "yyyy-MM-dd").alias("bucket"), "revenue", "events", "versions", "corrections")


@query
def st_batch_score(spark, folder):
    """Score the feature table as it would arrive, batch by batch, and tell how far
    each score is from that of a single run over the whole table."""
    rows = bases.features(spark, folder)
    path = fresh_path(spark, "features_landing")
    rows.write.parquet(path)
    sink, mark = fresh_path(spark, "scores"), fresh_path(spark, "mark")
    fit = learning.model(spark, folder, "LogisticRegression")
    stream = refresh.landing(spark, path, rows.schema, files_per_batch=4)
    refresh.batch_score(
        stream, sink, mark, lambda batch: models.score(fit, batch).select("company_id", "month_index", "risk_score")
    )
    streamed = spark.read.parquet(sink).select("company_id", "month_index", F.col("risk_score").alias("streamed"))
    at_once = models.score(fit, rows).select("company_id", "month_index", "risk_score")
    return at_once.join(streamed, ["company_id", "month_index"], "full").select(
        "company_id", "month_index", (F.col("streamed") - F.col("risk_score")).alias("difference")
    )

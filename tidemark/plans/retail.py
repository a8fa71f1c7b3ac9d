"""Retail queries: files, cleaning, star, joins, KPIs, RFM, growth."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import dates, numbers, text
from tidemark.operators import clean, growth, ordered, reports, rfm, star
from tidemark.plans.bases import Query, customer_star, features, flat, registrar, sales, segments, star_tables
from tidemark.session import fresh_path
from tidemark.sources import files, tables

BUCKETS = 64   # of the order table; about one per 128 MB at scale

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)


# --- files ------------------------------------------------------------------------


@query
def op_read_csv(spark, folder):
    source = tables.table(spark, folder, "customer")
    path = fresh_path(spark, "customer_csv")
    files.write_csv(source, path)
    return files.read_csv(spark, path, source.schema)


@query
def op_read_csv_dates(spark, folder):
    day = F.when(F.col("o_orderkey") % 50 == 0, "unknown").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    source = tables.table(spark, folder, "orders").select("o_orderkey", "o_custkey", day.alias("order_date"))
    path = fresh_path(spark, "orders_csv")
    files.write_csv(source, path)
    kinds = T.StructType([*source.schema.fields[:2], T.StructField("order_date", T.DateType())])
    return files.read_csv_dates(spark, path, kinds, ["order_date"])


@query
def op_inline_table(spark, folder):
    counted = segments(spark, folder).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    return rfm.segment_actions(spark).join(counted, "segment")


@query
def op_write_csv(spark, folder):
    source = sales(spark, folder)
    path = fresh_path(spark, "sales_csv")
    files.write_csv(source, path)
    back = files.read_csv(spark, path, source.schema)
    return back.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("revenue"))


@query
def op_sql_read(spark, folder):
    built = star_tables(spark, folder)
    return files.run_sql(
        spark,
        """
        SELECT p.brand, r.region_name, COUNT(*) AS orders, CAST(SUM(f.revenue) AS DOUBLE) AS revenue
        FROM {fact} f JOIN {products} p ON f.product_key = p.product_key
                      JOIN {regions} r ON f.region_key = r.region_key
        GROUP BY p.brand, r.region_name
        """,
        fact=built["fact_sales"],
        products=built["dim_product"],
        regions=built["dim_region"],
    )


@query
def op_upsert_ignore(spark, folder):
    lines = flat(spark, folder).select("order_id", "customer_name", "inward_date", "dispatch_date", "price", "quantity_sold")
    old = clean.keep_first(lines.where("quantity_sold <= 25"), ["order_id"], clean.row_order(lines))
    path = fresh_path(spark, "orders")
    old = files.bucketed(old, ["order_id"], BUCKETS, path.rsplit("/", 1)[1].replace("-", "_"), path)
    return star.upsert_ignore(old, lines, ["order_id"]).select("order_id", "customer_name", "price")


@query
def op_star_schema(spark, folder):
    path = fresh_path(spark, "star")
    star.write_star(star_tables(spark, folder), path)
    parts = [
        spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in ("dim_region", "dim_customer", "dim_product", "dim_date", "fact_sales")
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


@query
def op_constraint_violations(spark, folder):
    """A damaged copy of the star: repeated orders, missing and orphaned keys."""
    built = dict(star_tables(spark, folder))
    fact = built["fact_sales"]
    damaged = fact.withColumn("product_key", F.when(F.col("order_id") % 50 != 0, F.col("product_key")))
    built["fact_sales"] = damaged.unionByName(damaged.where("order_id % 40 = 0"))
    built["dim_product"] = built["dim_product"].where("product_key % 10 <> 0")
    return star.constraint_violations(built)


@query
def op_dim_calendar(spark, folder):
    return star.dim_calendar(sales(spark, folder))


# --- star build -------------------------------------------------------------------


@query
def op_dim_region(spark, folder):
    return star.dim_region(sales(spark, folder))


@query
def op_dim_customer(spark, folder):
    return star.dim_customer(sales(spark, folder), segments(spark, folder))


@query
def op_dim_product(spark, folder):
    return star.dim_product(sales(spark, folder))


@query
def op_dim_date(spark, folder):
    return star.dim_date(sales(spark, folder))


@query
def op_fact_sales(spark, folder):
    built = star_tables(spark, folder)
    keys = built["dim_customer"].select("customer_key", "customer_name")
    return star.fact_sales(sales(spark, folder), keys, built["dim_product"], built["dim_region"])


# --- cleaning ---------------------------------------------------------------------


@query
def op_dedupe_key(spark, folder):
    lines = flat(spark, folder)
    return clean.keep_first(lines, ["order_id"], clean.row_order(lines)).select(
        "order_id", "price", "quantity_sold", "region", "dispatch_date"
    )


@query
def op_dedupe_full(spark, folder):
    return clean.drop_repeats(flat(spark, folder).select("customer_name", "product_type", "region"))


@query
def op_title_trim(spark, folder):
    keys = ["region", "gender", "income_bracket", "processor"]
    return clean.standardize_text(flat(spark, folder), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query
def op_sentinel_null(spark, folder):
    lines = clean.standardize_text(flat(spark, folder), ["region"])
    return clean.null_sentinels(lines, "region", "Nan").groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query
def op_fill_const(spark, folder):
    return (
        clean.fill_constant(flat(spark, folder), {"processor": "Unknown"})
        .groupBy("processor")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def op_fill_group_median(spark, folder):
    return (
        clean.fill_group_median(flat(spark, folder), "ram_gb", "product_type")
        .groupBy("product_type", "ram_gb")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _cast_text(spark, folder):
    return clean.safe_cast(
        tables.sales_text(spark, folder),
        {
            "order_id": T.LongType(),
            "price": schemas.PRICE,
            "quantity_sold": T.IntegerType(),
            "inward_date": T.DateType(),
            "dispatch_date": T.DateType(),
            "customer_age": T.IntegerType(),
        },
    )


@query
def op_safe_cast(spark, folder):
    return _cast_text(spark, folder).select("order_id", "price", "quantity_sold", "inward_date", "customer_age")


@query
def op_drop_null_critical(spark, folder):
    return clean.drop_null_critical(_cast_text(spark, folder)).select("order_id", "price", "quantity_sold", "region")


@query
def op_filter_positive(spark, folder):
    return clean.keep_positive(tables.table(spark, folder, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query
def op_quantile_trim(spark, folder):
    return clean.quantile_trim(flat(spark, folder).select("order_id", "price"), "price")


@query
def op_revenue(spark, folder):
    return clean.with_revenue(flat(spark, folder)).select("order_id", "price", "quantity_sold", "revenue")


@query
def op_period_cols(spark, folder):
    return clean.with_periods(flat(spark, folder)).select("order_id", "order_month", "order_quarter", "order_year")


@query
def op_dispatch_delay(spark, folder):
    return clean.with_dispatch_delay(flat(spark, folder)).select("order_id", "dispatch_delay_days")


@query
def op_age_band(spark, folder):
    lines = flat(spark, folder).withColumn("customer_age", F.col("customer_age") + F.col("order_id") % 40 - 5)
    return clean.with_age_band(lines).groupBy("customer_age", "age_band").agg(F.count(F.lit(1)).alias("n"))


@query
def op_value_map(spark, folder):
    mapped = rfm.map_values(segments(spark, folder), rfm.segment_actions(spark), "segment")
    return mapped.select("customer_name", "segment", "recommended_action")


# --- joins ------------------------------------------------------------------------


@query
def op_join_inner_dim(spark, folder):
    built = star_tables(spark, folder)
    return reports.with_dim(built["fact_sales"], built["dim_region"], "region_key", "region_key").select(
        "order_id", "region_name"
    )


@query
def op_join_star(spark, folder):
    built = star_tables(spark, folder)
    return (
        built["fact_sales"]
        .join(built["dim_product"], "product_key")
        .join(built["dim_region"], "region_key")
        .select("order_id", "product_type", "brand", "region_name")
    )


@query
def op_join_left(spark, folder):
    some = segments(spark, folder).where("segment <> 'Champions'")
    return rfm.attach_segment(sales(spark, folder), some).select("order_id", "segment", "rfm_total")


@query
def op_join_multikey(spark, folder):
    built = star_tables(spark, folder)
    return star.join_null_safe(
        sales(spark, folder), built["dim_product"], star.PRODUCT_COLUMNS, "left"
    ).select("order_id", "product_key")


@query
def op_join_semi(spark, folder):
    chosen = segments(spark, folder).where("segment = 'Champions'").select("customer_name")
    return sales(spark, folder).join(chosen, "customer_name", "left_semi").select("order_id", "customer_name")


@query
def op_join_anti(spark, folder):
    loaded = star_tables(spark, folder)["fact_sales"].select("order_id")
    return flat(spark, folder).select("order_id", "customer_name").join(loaded, "order_id", "left_anti")


@query
def op_join_scalar(spark, folder):
    lines = sales(spark, folder)
    whole = lines.agg(F.struct(F.sum("revenue").alias("all"), F.max("revenue").alias("top")).alias("s")).scalar()
    return lines.withColumn("_s", whole).select(
        "order_id",
        (F.col("revenue").cast("double") * 1e6 / F.col("_s.all").cast("double")).alias("ppm_of_total"),
        (F.col("_s.top") - F.col("revenue")).alias("below_top"),
    )


# --- star reports -----------------------------------------------------------------


@query
def q1_monthly(spark, folder):
    built = star_tables(spark, folder)
    return reports.monthly_sales(built["fact_sales"], built["dim_date"])


@query
def q2_brand(spark, folder):
    built = star_tables(spark, folder)
    return reports.brand_sales(built["fact_sales"], built["dim_product"])


@query
def q3_region_share(spark, folder):
    built = star_tables(spark, folder)
    return reports.region_share(built["fact_sales"], built["dim_region"])


@query
def q3b_region_share_subq(spark, folder):
    built = star_tables(spark, folder)
    return reports.region_share_by_subquery(built["fact_sales"], built["dim_region"])


@query
def q4_top_customers(spark, folder):
    fact, customers = customer_star(spark, folder)
    return reports.top_customers(fact, customers, unique_orders=True)


@query
def q5_segment_share(spark, folder):
    return reports.segment_share(*customer_star(spark, folder))


@query
def q6_mom(spark, folder):
    return growth.month_growth(growth.monthly_revenue(sales(spark, folder)))


@query
def q7_delay(spark, folder):
    built = star_tables(spark, folder)
    return reports.dispatch_delay(built["fact_sales"], built["dim_product"], built["dim_region"])


@query
def q8_top3_rank(spark, folder):
    built = star_tables(spark, folder)
    return reports.top_processors(built["fact_sales"], built["dim_product"])


@query
def q9_cohort_m2(spark, folder):
    return growth.cohort_second_month(growth.customer_months(sales(spark, folder)))


@query
def q10_demographics(spark, folder):
    built = star_tables(spark, folder)
    return reports.demographics(built["fact_sales"], built["dim_customer"])


# --- flat reports -----------------------------------------------------------------


@query
def op_exec_kpis(spark, folder):
    return reports.exec_kpis(sales(spark, folder))


@query
def op_kpi_by_type(spark, folder):
    return reports.kpi_by_type(sales(spark, folder))


@query
def op_topn_brand(spark, folder):
    return reports.top_by(sales(spark, folder), "brand", "revenue", "revenue")


@query
def op_topn_processor(spark, folder):
    return reports.top_by(sales(spark, folder), "processor", "quantity_sold", "units")


@query
def op_region_kpis(spark, folder):
    return reports.region_kpis(sales(spark, folder))


@query
def op_best_worst_month(spark, folder):
    return reports.best_worst_month(sales(spark, folder))


@query
def op_quarterly(spark, folder):
    return reports.sum_by(sales(spark, folder), ["order_quarter"], "revenue", "revenue")


@query
def op_by_age_band(spark, folder):
    return reports.sum_by(sales(spark, folder), ["age_band"], "revenue", "revenue")


@query
def op_by_income(spark, folder):
    return reports.sum_by(sales(spark, folder), ["income_bracket"], "revenue", "revenue")


@query
def op_kpi_summary(spark, folder):
    return reports.kpi_summary(sales(spark, folder))


@query
def op_month_combo(spark, folder):
    return reports.month_combo(sales(spark, folder))


@query
def op_spec_table(spark, folder):
    return reports.spec_table(sales(spark, folder))


@query
def op_price_volume(spark, folder):
    return reports.price_volume(sales(spark, folder))


@query
def op_region_scorecard(spark, folder):
    return reports.region_scorecard(sales(spark, folder))


@query
def op_kpi_reconcile(spark, folder):
    return reports.reconcile(
        reports.kpi_values(sales(spark, folder), "customer_name"),
        reports.kpi_values(star_tables(spark, folder)["fact_sales"], "customer_key"),
    )


@query
def op_share_of_total(spark, folder):
    return reports.share_ignoring(sales(spark, folder), "region", ["product_type"], "revenue")


# --- RFM, growth, cohorts ---------------------------------------------------------


@query
def op_rfm_base(spark, folder):
    return rfm.rfm_base(sales(spark, folder))


@query
def op_rfm_scores(spark, folder):
    return rfm.rfm_scores(rfm.rfm_base(sales(spark, folder)))


@query
def op_rfm_segment(spark, folder):
    scored = segments(spark, folder)
    return rfm.map_values(scored, rfm.segment_actions(spark), "segment").select(
        "customer_name", "rfm_score", "segment", "recommended_action"
    )


@query
def op_rfm_attach(spark, folder):
    return rfm.attach_segment(sales(spark, folder), segments(spark, folder)).select("order_id", "segment", "rfm_total")


@query
def op_segment_summary(spark, folder):
    return rfm.segment_summary(segments(spark, folder))


@query
def op_prior_calendar_month(spark, folder):
    return growth.calendar_growth(growth.monthly_revenue(sales(spark, folder)))


@query
def op_drop_alert(spark, folder):
    return growth.drop_alerts(growth.month_growth(growth.monthly_revenue(sales(spark, folder))))


@query
def op_cohort_curve(spark, folder):
    return growth.cohort_curve(growth.customer_months(sales(spark, folder)))


# --- sort, limit, set operations --------------------------------------------------


@query
def op_limit(spark, folder):
    return sales(spark, folder).orderBy(F.desc("revenue"), "order_id").limit(100).select("order_id", "revenue")


@query
def op_union_all(spark, folder):
    lines = sales(spark, folder)
    days = lines.select(F.lit("inward").alias("kind"), F.col("inward_date").alias("day"))
    sent = lines.select(F.lit("dispatch").alias("kind"), F.col("dispatch_date").alias("day"))
    return days.unionByName(sent).groupBy("kind", "day").agg(F.count(F.lit(1)).alias("n"))


@query
def op_distinct(spark, folder):
    return sales(spark, folder).select("customer_name", "order_month").distinct()


@query
def op_sort_multi(spark, folder):
    """The position in the sorted order is part of the result."""
    per_month = sales(spark, folder).groupBy("order_year", "region").agg(reports.total("revenue").alias("revenue"))
    ranked = ordered.with_rank(
        per_month.withColumn("_down", -F.col("revenue")), ["order_year", "_down", "region"], "position"
    )
    return ranked.drop("_down").orderBy("order_year", F.desc("revenue"), "region")


# --- scalar functions -------------------------------------------------------------


@query
def fn_string(spark, folder):
    name = F.col("p_name")
    return tables.table(spark, folder, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        text.title_case(F.concat(name, F.lit(" 7s-pro"))).alias("titled"),
        F.upper(name).alias("shouted"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("snake"),
        F.concat_ws("/", "p_type", "p_brand").alias("joined"),
        F.col("p_size").cast("string").alias("size_text"),
    )


@query
def fn_format(spark, folder):
    amount = F.col("o_totalprice").cast("decimal(14,2)")
    return tables.table(spark, folder, "orders").select(
        "o_orderkey",
        text.money_text(amount).alias("money"),
        text.whole_text(F.col("o_orderkey") * 1000).alias("whole"),
        text.one_decimal_text((F.col("o_orderkey") % 97) / 8).alias("one_decimal"),
        text.percent_text((F.col("o_orderkey") % 64) / 64, 0).alias("percent"),
    )


@query
def fn_date(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return tables.table(spark, folder, "orders").select(
        "o_orderkey",
        dates.to_date_or_null(F.date_format(day, "yyyy-MM-dd")).alias("parsed"),
        F.date_add(day, 1).alias("next_day"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).alias("age_days"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.quarter(day).alias("q"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        dates.date_key(day).alias("date_key"),
        dates.month_start(day).alias("month_start"),
        F.add_months(day, 1).alias("next_month"),
    )


@query
def fn_math(spark, folder):
    balance = F.col("c_acctbal")
    return tables.table(spark, folder, "customer").select(
        "c_custkey",
        numbers.half_up(balance, 0).alias("up"),
        numbers.half_even(balance, 1).alias("even"),
        F.abs(balance).alias("size"),
        numbers.clip(balance, 0.0, 5000.0).alias("clipped"),
        numbers.floor_div(F.col("c_custkey"), 12).alias("dozens"),
        F.greatest(F.lit(0.0), balance).alias("not_negative"),
    )


@query
def fn_conditional(spark, folder):
    lines = flat(spark, folder)
    return lines.select(
        "order_id",
        F.when(F.col("price") > 50000, "high").when(F.col("price") > 20000, "mid").otherwise("low").alias("band"),
        F.coalesce("processor", F.lit("none")).alias("processor"),
        F.col("ram_gb").isNotNull().alias("has_ram"),
    )


@query
def op_dim_month(spark, folder):
    return star.dim_month(features(spark, folder))

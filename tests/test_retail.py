"""Cleaning, star, RFM and growth on small hand-made tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import clean, growth, profile, reports, rfm, star
from tidemark.sources import files, tables


def test_keep_first_uses_the_total_order(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "z")], "k int, v string")
    got = {r.k: r.v for r in clean.keep_first(df, ["k"], ["v"]).collect()}
    assert got == {1: "a", 2: None}


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = clean.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_lines_joined_to_their_orders_are_not_shuffled_again(spark, data):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = tables.sales_flat(spark, data)
        plain, kept = clean.dedupe_sales(raw), clean.dedupe_sales(raw, tables.order_of_line())
        shuffles = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (raw, plain, kept)]
        assert shuffles == [shuffles[0], shuffles[0] + 1, shuffles[0]]
        assert kept.exceptAll(plain).isEmpty() and kept.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_wide_product_columns_leave_before_the_customers_join(spark, data):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = clean.derive_sales(clean.repair_text(tables.sales_flat(spark, data)))
        fact = star.fact_sales(lines, star.customer_keys(lines), star.dim_product(lines), star.dim_region(lines))
        plan = fact._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    joins = [line for line in plan if "Join LeftOuter" in line]
    assert "customer_name" in joins[0] and "ram_gb" in joins[2]     # the outermost join comes first


def test_median_fill(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, None), ("c", 8.0)]
    got = clean.fill_group_median(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()
    assert sorted((r.g or "", r.v if r.v is not None else -1) for r in got) == sorted(
        [("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", -1), ("", -1), ("c", 8.0)]
    )


def test_trim_keeps_both_ends(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    got = [r.v for r in clean.quantile_trim(df, "v", 0.1, 0.9).collect()]
    assert min(got) == 10.0 and max(got) == 90.0 and len(got) == 81


def test_zero_as_missing_both_ways(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (4.0,)], "v double")
    assert sorted(r.v for r in clean.zero_as_missing(df, ["v"]).collect()) == [2.0, 2.0, 4.0]
    assert sorted(r.v for r in clean.zero_as_missing(df, ["v"], exclude_zeros=True).collect()) == [2.0, 3.0, 4.0]


def test_safe_cast(spark):
    df = spark.createDataFrame([("12.5", "2024-01-05"), ("n/a", "soon"), (None, None)], "p string, d string")
    got = clean.safe_cast(df, {"p": T.DecimalType(12, 2), "d": T.DateType()}).collect()
    assert [r.p is None for r in got] == [False, True, True]
    assert got[0].d == dt.date(2024, 1, 5) and got[1].d is None


def test_upsert_skips_known_keys(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert {(r.k, r.v) for r in star.upsert_ignore(old, new, ["k"]).collect()} == {(1, "old"), (2, "a")}


def test_null_safe_join_matches_nulls(spark):
    left = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    right = spark.createDataFrame([(10, None), (20, "x")], "r int, k string")
    assert {(r.id, r.r) for r in star.join_null_safe(left, right, ["k"], "left").collect()} == {(1, 10), (2, 20)}


def test_violations_find_each_kind(spark):
    contract = {
        "parent": {"primary": ["id"], "unique": [], "required": []},
        "child": {"primary": ["id"], "unique": [["code"]], "required": ["code"], "foreign": {"p": ("parent", "id")}},
    }
    tables = {
        "parent": spark.createDataFrame([(1,), (2,)], "id int"),
        "child": spark.createDataFrame([(1, "a", 1), (1, "b", 9), (3, "b", 9), (4, None, None)], "id int, code string, p int"),
    }
    got = {(r.table_name, r.rule): r.violations for r in star.constraint_violations(tables, contract).collect()}
    assert got == {("parent", "primary"): 0, ("child", "primary"): 1, ("child", "unique"): 1, ("child", "required"): 1, ("child", "foreign"): 2}


@pytest.mark.parametrize("n", [97, 100, 101])
def test_rfm_scores_match_quantile_cuts(spark, n):
    rng = np.random.default_rng(n)
    base = pd.DataFrame(
        {
            "customer_name": [f"c{i:03d}" for i in range(n)],
            "recency": rng.integers(1, 60, n),
            "frequency": rng.integers(1, 6, n),
            "monetary": np.round(rng.random(n) * 1e5, 2),
        }
    )
    got = rfm.rfm_scores(spark.createDataFrame(base)).toPandas().sort_values("customer_name").reset_index(drop=True)
    r = pd.qcut(base["recency"], 5, labels=[5, 4, 3, 2, 1]).astype(int)
    f = pd.qcut(base["frequency"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    m = pd.qcut(base["monetary"], 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert list(got["r_score"]) == list(r)
    assert list(got["f_score"]) == list(f)
    assert list(got["m_score"]) == list(m)
    assert list(got["rfm_total"]) == list(r + f + m)


def test_lag_and_calendar_month_differ(spark):
    rows = [(dt.date(2024, 1, 1), 100.0), (dt.date(2024, 2, 1), 80.0), (dt.date(2024, 4, 1), 40.0)]
    monthly = spark.createDataFrame(rows, "month date, monthly_revenue double")
    by_row = {r.month_num: r.mom_growth_pct for r in growth.month_growth(monthly).collect()}
    assert by_row == {1: None, 2: -20.0, 4: -50.0}
    by_date = {r.month.month: r.growth for r in growth.calendar_growth(monthly).collect()}
    assert by_date[2] == pytest.approx(-0.2) and by_date[4] is None
    assert {r.month_num for r in growth.drop_alerts(growth.month_growth(monthly), 30.0).collect()} == {4}


def test_cohorts(spark):
    days = {"x": [(2024, 1), (2024, 2)], "y": [(2024, 1), (2024, 3)], "z": [(2024, 2)]}
    rows = [(name, dt.date(y, m, 5)) for name, months in days.items() for y, m in months] * 3
    months = growth.customer_months(spark.createDataFrame(rows, "customer_name string, inward_date date"))
    got = {r.cohort_month.month: (r.cohort_size, r.retained_month_2) for r in growth.cohort_second_month(months).collect()}
    assert got == {1: (2, 1), 2: (1, 0)}
    curve = {(r.cohort_month.month, r.month_offset): r.retention for r in growth.cohort_curve(months).collect()}
    assert curve[(1, 2)] == 0.5 and curve[(2, 0)] == 1.0


def test_ties_of_best_month_go_to_the_earlier(spark):
    df = spark.createDataFrame([("2024-02", 5.0), ("2024-01", 5.0)], "order_month string, revenue double")
    row = reports.best_worst_month(df).first()
    assert row.best_month == row.worst_month == "2024-01"


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([], "revenue double, order_id int, quantity_sold int, customer_name string, dispatch_delay_days int")
    row = reports.exec_kpis(df).first()
    assert row.total_revenue == 0.0 and row.average_order_value is None


def test_csv_round_trip_with_bad_fields(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,day,amount\n1,2024-01-02,3.5\n2,never,oops\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("amount", T.DoubleType())])
    got = files.read_csv_dates(spark, str(path), schema, ["day"]).orderBy("id").collect()
    assert got[0].day == dt.date(2024, 1, 2) and got[0].amount == 3.5
    assert got[1].day is None and got[1].amount is None
    assert files.bootstrap_schema(spark, str(path), 1.0).names == ["id", "day", "amount"]


def test_describe_matches_pandas(spark):
    frame = pd.DataFrame({"a": [1.0, 2.0, 2.0, 9.0], "b": [5.0, None, 7.0, 8.0]})
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "a double, b double")
    got = profile.describe(df, ["a", "b"]).toPandas().set_index("column")
    want = frame.describe()
    for column in ("a", "b"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got.loc[column, ours] == pytest.approx(want.loc[theirs, column])


def test_star_partitions_are_pruned(spark, data, tmp_path):
    from tidemark.plans.bases import star_tables

    star.write_star(star_tables(spark, data), str(tmp_path / "star"))
    plan = spark.read.parquet(str(tmp_path / "star/fact_sales")).where("order_year = 1998").agg(F.sum("revenue"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in text
    assert "ReadSchema: struct<revenue:decimal(14,2)>" in text


def test_upsert_leaves_a_bucketed_target_where_it_lies(spark, tmp_path):
    target = spark.range(400).select((F.col("id") * 2).alias("k"), F.lit("old").alias("v"))
    arrivals = spark.range(500).select("id", F.lit("new").alias("v")).toDF("k", "v").unionByName(
        spark.createDataFrame([(1, "again"), (None, "no key")], "k long, v string")
    )
    name = f"upsert_target_{tmp_path.name.replace('-', '_')}"
    kept = files.bucketed(target, ["k"], 8, name, str(tmp_path / "target"))
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = star.upsert_ignore(kept, arrivals, ["k"])
        rows = got.collect()
        plan = got._jdf.queryExecution().explainString(
            spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
        spark.sql(f"DROP TABLE {name}")
    plain = star.upsert_ignore(target, arrivals, ["k"]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, plain)) and len(rows) == 651
    lines = plan.split("== Initial Plan ==")[1].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(n for n, line in enumerate(lines) if "Bucketed: true" in line)
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):       # what the target's rows go through
        if line.strip() and depth(line) < level:
            above, level = [*above, line], depth(line)
    assert any("LeftAnti" in line for line in above) and not any("Exchange" in line for line in above), plan


def test_reports_by_customer_need_no_whole_fact(spark, tmp_path):
    """They give the whole star's rows without building its fact and products."""
    import shutil

    from tidemark.operators import reports
    from tidemark.plans import bases, retail
    from tidemark.session import is_staged

    folder = str(shutil.copytree("/root/testdata/sf0.001", tmp_path / "tables"))
    top = retail.QUERIES["q4_top_customers"](spark, folder).collect()
    shares = retail.QUERIES["q5_segment_share"](spark, folder).collect()
    assert not any(is_staged(spark, folder, name) for name in ("fact_sales", "dim_product", "dim_customer"))
    built = bases.star_tables(spark, folder)
    fact, customers = built["fact_sales"], built["dim_customer"]
    assert top == bases.publish(reports.top_customers(fact, customers)).collect() and len(top) == 10
    assert shares == bases.publish(reports.segment_share(fact, customers)).collect()
    assert top == retail.QUERIES["q4_top_customers"](spark, folder).collect()

"""Distributed ranks and quantiles against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordered import exact_quantiles, running_totals, value_ranks, with_rank


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(3)
    n = 3000
    values = rng.integers(0, 400, n).astype(float)
    values[: n // 3] = 77.0  # one value holds a third of all rows
    groups = np.where(rng.random(n) < 0.4, "a", "b")
    return pd.DataFrame({"g": groups, "v": values})


@pytest.mark.parametrize("ranges", [2, 7, 1024])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, skewed, ranges, descending):
    counts = skewed.groupby(["g", "v"]).size().reset_index(name="n")
    got = running_totals(spark.createDataFrame(counts), "v", ["n"], ["g"], descending, ranges).toPandas()
    want = counts.sort_values("v", ascending=not descending)
    want["n_before"] = want.groupby("g")["n"].cumsum() - want["n"]
    want["n_total"] = want.groupby("g")["n"].transform("sum")
    keys = ["g", "v"]
    pd.testing.assert_frame_equal(
        got.sort_values(keys).reset_index(drop=True)[list(want.columns)],
        want.sort_values(keys).reset_index(drop=True),
        check_dtype=False,
    )


def test_quantiles_match_numpy(spark, skewed):
    probs = {"q0": 0.0, "q001": 0.001, "q37": 0.37, "q5": 0.5, "q1": 1.0}
    got = exact_quantiles(spark.createDataFrame(skewed), "v", probs).first().asDict()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(skewed["v"], p), abs=1e-12)


def test_group_quantiles_match_pandas(spark, skewed):
    got = exact_quantiles(spark.createDataFrame(skewed), "v", {"m": 0.5}, ["g"]).toPandas().set_index("g")["m"]
    want = skewed.groupby("g")["v"].median()
    assert got.to_dict() == pytest.approx(want.to_dict())


def test_quantiles_of_many_rows_use_brackets_and_stay_exact(spark):
    """Enough rows that most values lie outside the brackets; one value is hot."""
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(500.25)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 997.0).alias("v"),
        (F.col("id") % 2).alias("g"),
    )
    frame = df.toPandas()
    probs = {"a": 0.001, "b": 0.0015, "c": 0.25, "d": 0.5, "e": 0.75, "f": 0.9995, "top": 1.0}
    got = exact_quantiles(df.repartition(9), "v", probs).first().asDict()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(frame["v"], p), abs=1e-9), name
    by_group = exact_quantiles(df, "v", probs, ["g"]).toPandas().set_index("g")
    for g, part in frame.groupby("g"):
        for name, p in probs.items():
            assert by_group.loc[g, name] == pytest.approx(np.quantile(part["v"], p), abs=1e-9), name


def test_rank_orders_by_several_columns(spark):
    rows = [(i % 3, f"name{i:04d}") for i in range(500)]
    got = with_rank(spark.createDataFrame(rows, "f int, name string"), ["f", "name"], "r").toPandas()
    want = got.sort_values(["f", "name"])
    assert list(want["r"]) == list(range(1, 501))


def test_ranks_do_not_depend_on_partitioning(spark, skewed):
    df = spark.createDataFrame(skewed)
    one = value_ranks(df.coalesce(1), "v", ["g"])
    many = value_ranks(df.repartition(7), "v", ["g"])
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_empty_input(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, "v", {"m": 0.5}).first()["m"] is None
    assert with_rank(empty, ["v"], "r").count() == 0


def test_no_single_task_sort_of_the_values(spark, skewed):
    plan = with_rank(spark.createDataFrame(skewed).select("v").distinct(), ["v"], "r")
    text = plan._jdf.queryExecution().executedPlan().toString()
    inside = [line for line in text.splitlines() if "Window" in line and "_key" in line]
    assert inside and all("[_range" in line for line in inside)


def test_a_missed_bracket_is_no_answer(spark, monkeypatch):
    from tidemark.operators import ordered

    values = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    right = ordered._brackets

    def wrong(df, probabilities, group, margin):
        moved = right(df, probabilities, group, margin)
        return moved.withColumn("_b", F.col("_b").withField("high0", F.col("_b.low0")))

    monkeypatch.setattr(ordered, "_brackets", wrong)
    with pytest.raises(Exception, match="outside of its bracket"):
        ordered.exact_quantiles(values, "v", {"median": 0.5}).collect()


def test_staged_tables_follow_their_files(spark, tmp_path):
    from tidemark.session import staged

    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")

    def make():
        return spark.read.parquet(f"{tmp_path}/t.parquet")

    assert staged(spark, str(tmp_path), "copy", make).count() == 3
    spark.range(4).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert staged(spark, str(tmp_path), "copy", make).count() == 7

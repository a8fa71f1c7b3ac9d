"""A leak planted in any feature family is caught by name."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import leakage, panel
from tidemark.schemas import ENGINEERED, METRICS
from tests.test_panel import panel_row

FLAGS = ["founder_conflict_flag"]


def ahead(first, last):
    return Window.partitionBy("company_id").orderBy("month_index").rowsBetween(first, last)


def whole():
    return Window.partitionBy("company_id")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    table = [
        panel_row(c, m, **{k: float(np.round(rng.random(), 3)) for k in METRICS})
        for c, n in [("a", 30), ("b", 25), ("c", 1), ("d", 2), ("e", 18)] for m in range(n)
    ]
    return spark.createDataFrame(table).repartition(3).cache()


def check(rows, spoil=None):
    def build(df):
        made = panel.window_features(df)
        return made if spoil is None else made.withColumn("sector_of_all", F.lit(1)).withColumns(spoil)

    return leakage.leakage_check(rows, build, ENGINEERED, METRICS, FLAGS).first()


def test_real_features_do_not_look_ahead(rows):
    found = check(rows)
    assert found.moved_rows == 0 and found.moved_features == [] and 0 < found.compared_rows < rows.count()


@pytest.mark.parametrize(
    "name, leak",
    [
        ("mrr_slope_6m", lambda: F.coalesce(F.regr_slope("mrr", "month_index").over(ahead(-3, 2)), F.lit(0.0))),
        ("nps_score_pct_change_6m", lambda: F.coalesce(F.last("nps_score").over(ahead(0, 1)), F.lit(0.0))),
        ("churn_rate_volatility_6m", lambda: F.coalesce(F.stddev_samp("churn_rate").over(ahead(-2, 1)), F.lit(0.0))),
        ("consecutive_low_runway_months", lambda: F.sum(F.when(F.col("runway_months") < 0.1, 1).otherwise(0)).over(whole())),
        ("founder_conflict_ever", lambda: F.max("founder_conflict_flag").over(whole())),
        ("capital_efficiency", lambda: F.sum("burn_rate").over(whole())),
        ("glassdoor_rating_latest", lambda: F.last("glassdoor_rating").over(ahead(0, 1))),
        ("headcount_latest", lambda: F.avg("headcount").over(Window.partitionBy("sector_of_all"))),
    ],
)
def test_planted_leaks_are_named(rows, name, leak):
    found = check(rows, {name: leak()})
    assert found.moved_features == [name] and found.moved_rows > 0

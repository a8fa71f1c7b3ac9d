"""Panel features: invariants, block independence and brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.panel import (
    HORIZON, MIN_HISTORY, attach_static, latest_row, panel_features, sample_row, window_features,
)
from tidemark.schemas import ENGINEERED, LABEL, METRICS


def panel_row(company, month, **values):
    row = dict.fromkeys(METRICS, 1.0)
    row.update(company_id=company, month_index=month, founder_conflict_flag=0, failed=False, acquired=False, fail_month=-1)
    row.update(values)
    return row


@pytest.fixture(scope="module")
def tiny():
    """One entity that ends at month 9 and a healthy survivor."""
    rows = [
        panel_row(
            "FAILS", m, mrr=10000.0 + 100 * m, cash_on_hand=max(50000.0 - 5000 * m, 0.0), burn_rate=8000.0,
            runway_months=max(6 - 0.5 * m, 0.0), churn_rate=0.05 + 0.01 * m, growth_rate_mom=0.02 - 0.005 * m,
            failed=(m == 9), fail_month=9,
        )
        for m in range(12)
    ]
    rows += [
        panel_row("LIVES", m, mrr=50000.0 + 2000 * m, burn_rate=20000.0, runway_months=40.0, churn_rate=0.03, growth_rate_mom=0.05)
        for m in range(15)
    ]
    return pd.DataFrame(rows)


@pytest.fixture(scope="module")
def rough():
    """Random entities with flags of every kind; one holds a third of the rows."""
    rng = np.random.default_rng(11)
    rows = []
    for company, length in [("hot", 60), ("a", 40), ("b", 30), ("c", 1), ("d", 2), ("e", 47)]:
        for m in range(length):
            rows.append(
                panel_row(
                    company, m, mrr=float(rng.integers(0, 5) * 10), burn_rate=float(rng.integers(0, 4) * 7),
                    runway_months=float(rng.integers(0, 12)), churn_rate=float(rng.integers(0, 30)) / 100,
                    headcount=float(rng.integers(1, 9)), nps_score=float(rng.integers(-50, 50)),
                    growth_rate_mom=float(rng.integers(-5, 5)) / 10, ltv_cac_ratio=float(rng.integers(0, 40)) / 10,
                    founder_conflict_flag=int(rng.random() < 0.06),
                )
            )
    return pd.DataFrame(rows)


def brute_force(panel):
    """The same features by plain loops over each entity's history."""
    out = []
    for company, frame in panel.groupby("company_id"):
        frame = frame.sort_values("month_index").reset_index(drop=True)
        for i, row in frame.iterrows():
            past = frame.iloc[: i + 1]
            record = {"company_id": company, "month_index": row.month_index}
            for metric, span in (("mrr", 3), ("mrr", 6), ("churn_rate", 6), ("ltv_cac_ratio", 6)):
                y = past[metric].to_numpy()[-span:]
                slope = np.polyfit(np.arange(len(y)), y, 1)[0] if len(y) > 1 else 0.0
                record[f"{metric}_{span}"] = slope
            base = past["mrr"].to_numpy()[-6] if i >= 5 else None
            record["mrr_change"] = (row.mrr - base) / abs(base) if base else 0.0
            record["burn_std"] = past["burn_rate"].tail(6).std(ddof=1) if i else 0.0
            for name, flags in (
                ("neg", past["growth_rate_mom"] < 0), ("low", past["runway_months"] < 6), ("high", past["churn_rate"] > 0.15),
            ):
                run = 0
                for flag in reversed(list(flags)):
                    if not flag:
                        break
                    run += 1
                record[name] = run
            hits = np.flatnonzero(past["founder_conflict_flag"] == 1)
            record["ever"] = int(len(hits) > 0)
            record["since"] = i - hits[-1] if len(hits) else 999
            burned = past["burn_rate"].sum()
            record["efficiency"] = row.mrr * 12 / burned if burned > 0 else 0.0
            out.append(record)
    return pd.DataFrame(out)


NAMES = {
    "mrr_3": "mrr_slope_3m", "mrr_6": "mrr_slope_6m", "churn_rate_6": "churn_rate_slope_6m", "ltv_cac_ratio_6": "ltv_cac_slope_6m",
    "mrr_change": "mrr_pct_change_6m", "burn_std": "burn_rate_volatility_6m", "neg": "consecutive_neg_growth_months",
    "low": "consecutive_low_runway_months", "high": "consecutive_high_churn_months", "ever": "founder_conflict_ever",
    "since": "months_since_founder_conflict", "efficiency": "capital_efficiency",
}


def check_against_loops(got, want):
    keys = ["company_id", "month_index"]
    both = got.merge(want, on=keys)
    assert len(both) == len(want) == len(got)
    for plain, name in NAMES.items():
        left = both[name] if name in both else both[f"{name}_x"]
        np.testing.assert_allclose(left.astype(float), both[plain].astype(float), atol=1e-9, err_msg=name)


@pytest.mark.parametrize("block", [5, 8, 1024])
def test_blocks_match_plain_loops(spark, rough, block):
    got = window_features(spark.createDataFrame(rough), block=block).select("company_id", "month_index", *NAMES.values())
    check_against_loops(got.toPandas(), brute_force(rough))


def test_rolling_windows_count_rows_when_months_are_missing(spark, rough):
    gaps = rough.copy()
    gaps["month_index"] = gaps["month_index"] * 700 + gaps["month_index"] % 3
    got = window_features(spark.createDataFrame(gaps), position=None, block=8)
    check_against_loops(got.select("company_id", "month_index", *NAMES.values()).toPandas(), brute_force(gaps))


def test_no_rows_at_or_after_the_end(spark, tiny):
    rows = panel_features(spark.createDataFrame(tiny)).where("company_id = 'FAILS'")
    assert rows.agg(F.max("month_index")).first()[0] < 9


def test_label_looks_forward_only(spark, tiny):
    rows = panel_features(spark.createDataFrame(tiny)).where("company_id = 'FAILS'").collect()
    assert {r["month_index"] for r in rows} == set(range(3, 9))
    for r in rows:
        t = r["month_index"]
        assert r[LABEL] == int(t < 9 <= t + HORIZON)


def test_minimum_history(spark, tiny):
    assert panel_features(spark.createDataFrame(tiny)).agg(F.min("month_index")).first()[0] >= MIN_HISTORY


def test_survivor_is_never_positive(spark, tiny):
    rows = panel_features(spark.createDataFrame(tiny)).where("company_id = 'LIVES'")
    assert rows.where(F.col(LABEL) != 0).isEmpty()


def test_no_missing_values(spark, tiny):
    rows = panel_features(spark.createDataFrame(tiny))
    nulls = rows.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in ENGINEERED]).first()
    assert sum(nulls) == 0


def test_a_future_change_moves_no_earlier_feature(spark, tiny):
    changed = tiny.copy()
    changed.loc[(changed.company_id == "LIVES") & (changed.month_index == 14), "mrr"] = 999_999_999.0
    early = "company_id = 'LIVES' AND month_index < 14"
    before = panel_features(spark.createDataFrame(tiny)).where(early)
    after = panel_features(spark.createDataFrame(changed)).where(early)
    assert before.count() == 11
    assert before.exceptAll(after).isEmpty()


def test_acquisition_option(spark):
    rows = [panel_row("X", m, acquired=True, fail_month=8) for m in range(9)]
    df = spark.createDataFrame(pd.DataFrame(rows))
    assert panel_features(df).where(F.col(LABEL) == 1).count() == 5
    assert panel_features(df, exclude_acquired=True).where(F.col(LABEL) == 1).isEmpty()


def test_input_order_does_not_matter(spark, rough):
    keys = ["company_id", "month_index"]
    once = panel_features(spark.createDataFrame(rough).coalesce(1)).select(*keys, *NAMES.values())
    again = panel_features(spark.createDataFrame(rough.sample(frac=1, random_state=5)).repartition(7)).select(*keys, *NAMES.values())
    assert once.exceptAll(again).isEmpty()


def test_entity_rows(spark, rough):
    df = spark.createDataFrame(rough)
    last = {r.company_id: r.month_index for r in latest_row(df).collect()}
    assert last == rough.groupby("company_id")["month_index"].max().to_dict()
    drawn = sample_row(df)
    assert drawn.count() == rough["company_id"].nunique()
    assert drawn.exceptAll(sample_row(df.repartition(5))).isEmpty()


def test_static_columns_keep_unmatched_rows(spark, tiny):
    from tidemark.schemas import STATIC_CATEGORIES, STATIC_NUMERIC

    rows = panel_features(spark.createDataFrame(tiny))
    master = spark.createDataFrame(
        [("LIVES", "SaaS", "India", "Seed", 2020, 2, 0, 0.5, 1e6)],
        "company_id string, sector string, region string, initial_funding_stage string, founded_year int, founder_count int,"
        "founder_prior_exits int, founder_technical_pct double, initial_capital double",
    )
    joined = attach_static(rows, master)
    assert joined.count() == rows.count()
    assert joined.where("company_id = 'FAILS' AND sector IS NOT NULL").isEmpty()
    assert set(STATIC_CATEGORIES + STATIC_NUMERIC) <= set(joined.columns)

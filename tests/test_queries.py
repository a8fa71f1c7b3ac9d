"""Registered queries next to their DuckDB statements."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from checks.registry import CHECKS  # noqa: E402
from tidemark.plans.registry import QUERIES  # noqa: E402
from tools.compare import compare, connect  # noqa: E402

ROWS_ONLY = {
    "ml_logistic", "ml_random_forest", "ml_boosted_a", "ml_boosted_b",
    "ml_snapshot_model", "ml_model_compare", "ml_calibrate", "ml_grid_search", "ml_ridge_price", "ml_score_tier",
    "ml_portfolio", "ml_what_if", "ml_monotonic_check", "ml_contributions", "fn_json_out", "ml_chain_choice", "ml_chain_threshold", "ml_chain_report", "ml_chain_cohorts",
    "ml_chain_explained", "ml_chain_importance",
}
SAMPLE = [
    "q1_monthly", "q2_brand", "q3_region_share", "q3b_region_share_subq", "q4_top_customers", "q5_segment_share", "q6_mom", "q7_delay",
    "q8_top3_rank", "q9_cohort_m2", "q10_demographics", "op_fact_sales", "op_constraint_violations", "op_kpi_summary",
    "op_panel_features", "op_pivot_year", "ml_roc_auc", "ml_cost_threshold", "st_window_revenue",
]


def test_every_query_has_a_check_or_is_known_not_to():
    assert set(QUERIES) - set(CHECKS) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, data, name):
    _, rows, verdict = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], data)
    assert verdict == "same" and rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5

"""Risk-panel queries: rolling features, label, reports and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numbers import clip, guarded_ratio
from tidemark.functions.rules import outcome_label, risk_tier
from tidemark.operators import leakage, ordered, panel, profile, risk_reports, star
from tidemark.plans import bases
from tidemark.plans.bases import Query, registrar
from tidemark.schemas import ENGINEERED, FEATURES, LABEL, METRICS

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)
KEYS = ["company_id", "month_index"]


def _windowed(spark, folder):
    return panel.window_features(bases.entity_panel(spark, folder), "month_index")


# --- windows ----------------------------------------------------------------------


@query
def op_rolling_slope(spark, folder):
    return _windowed(spark, folder).select(
        *KEYS, "mrr_slope_3m", "mrr_slope_6m", "churn_rate_slope_3m", "headcount_slope_6m", "ltv_cac_slope_6m"
    )


@query
def op_pct_change_lag5(spark, folder):
    return _windowed(spark, folder).select(*KEYS, *[c for c in ENGINEERED if c.endswith("pct_change_6m")])


@query
def op_rolling_std(spark, folder):
    return _windowed(spark, folder).select(*KEYS, *[c for c in ENGINEERED if c.endswith("volatility_6m")])


@query
def op_trailing_run(spark, folder):
    return _windowed(spark, folder).select(*KEYS, *[c for c in ENGINEERED if c.startswith("consecutive_")])


@query
def op_ever_flag(spark, folder):
    return _windowed(spark, folder).select(*KEYS, "founder_conflict_ever")


@query
def op_since_flag(spark, folder):
    return _windowed(spark, folder).select(*KEYS, "months_since_founder_conflict")


@query
def op_cumsum_eff(spark, folder):
    return _windowed(spark, folder).select(*KEYS, "capital_efficiency")


@query
def op_risk_index(spark, folder):
    return _windowed(spark, folder).select(*KEYS, "composite_risk_index")


@query
def op_forward_label(spark, folder):
    rows = bases.entity_panel(spark, folder)
    return rows.select(
        *KEYS,
        panel.forward_label().alias(LABEL),
        panel.forward_label(exclude_acquired=True).alias("label_failure_only"),
    )


@query
def op_history_filter(spark, folder):
    return panel.history_filter(bases.entity_panel(spark, folder)).select(*KEYS, "fail_month")


@query
def op_panel_features(spark, folder):
    return panel.panel_features(bases.entity_panel(spark, folder), position="month_index")


@query
def op_attach_static(spark, folder):
    rows = panel.panel_features(bases.entity_panel(spark, folder), position="month_index")
    return panel.attach_static(rows, bases.entities(spark, folder)).select(
        *KEYS, "sector", "region", "founded_year", "founder_count", "founder_prior_exits", "founder_technical_pct",
        "initial_funding_stage", "initial_capital", "company_age_months_at_t",
    )


@query
def op_latest_row(spark, folder):
    return panel.latest_row(bases.features(spark, folder)).select(
        *KEYS, "mrr_latest", "runway_months_latest", "composite_risk_index"
    )


@query
def op_group_sample(spark, folder):
    return panel.sample_row(bases.features(spark, folder)).select(*KEYS, "mrr_latest")


@query
def op_trajectory(spark, folder):
    """Score per month of every entity, in month order."""
    return bases.rule_scored(spark, folder).select(*KEYS, "risk_score").orderBy(*KEYS)


# --- derivations ------------------------------------------------------------------


@query
def op_scored_fact(spark, folder):
    return bases.risk_fact(spark, folder)


@query
def op_dim_company(spark, folder):
    return star.dim_company(bases.entities(spark, folder))


@query
def op_risk_tier(spark, folder):
    score = F.col("risk_score")
    return bases.rule_scored(spark, folder).select(
        *KEYS, score, risk_tier(score).alias("tier_right"), risk_tier(score, closed="left").alias("tier_left")
    )


@query
def op_outcome_label(spark, folder):
    return bases.entities(spark, folder).select(
        "company_id", outcome_label(F.col("failed"), F.col("acquired")).alias("outcome")
    )


@query
def op_clip(spark, folder):
    return bases.features(spark, folder).select(
        *KEYS,
        clip(F.col("runway_months_latest"), 0.0, 36.0).alias("runway"),
        clip(F.col("churn_rate_latest"), 0.1, 0.6).alias("churn"),
        clip(F.col("nps_score_latest"), low=0.0).alias("nps"),
    )


@query
def op_guarded_ratio(spark, folder):
    return bases.entity_panel(spark, folder).select(
        *KEYS, guarded_ratio(F.col("burn_rate"), F.col("mrr"), panel.NO_REVENUE).alias("burn_multiple")
    )


@query
def op_snapshot_derive(spark, folder):
    forms = bases.features(spark, folder).drop("burn_multiple", "capital_efficiency", "composite_risk_index")
    return panel.snapshot_derive(forms).select(*KEYS, "burn_multiple", "capital_efficiency", "composite_risk_index")


@query
def op_rename_view(spark, folder):
    return risk_reports.display_view(bases.rule_scored(spark, folder))


@query
def op_filter_eq_in_range(spark, folder):
    return risk_reports.filter_portfolio(
        bases.rule_scored(spark, folder),
        equals={"risk_tier": "High", "region": "All", "initial_funding_stage": None},
        among={"sector": ["SaaS", "Fintech", "EdTech"]},
        at_most={"runway_months_latest": 24.0},
    ).select(*KEYS, "sector", "risk_tier", "runway_months_latest")


# --- joins ------------------------------------------------------------------------


@query
def op_join_inner_merge(spark, folder):
    """Drop the clashing columns of one side, then merge."""
    scores = bases.rule_scored(spark, folder).drop("sector", "region")
    return scores.join(bases.entities(spark, folder).select("company_id", "sector", "region"), "company_id").select(
        *KEYS, "risk_score", "sector", "region"
    )


@query
def op_panel_outcome_join(spark, folder):
    return risk_reports.attach_outcome(bases.entity_panel(spark, folder), bases.entities(spark, folder)).select(
        *KEYS, "churn_rate", "failed"
    )


# --- reports ----------------------------------------------------------------------


@query
def op_sector_failure_rate(spark, folder):
    return risk_reports.sector_failure_rate(bases.entities(spark, folder))


@query
def op_outcome_counts(spark, folder):
    return risk_reports.outcome_counts(bases.companies(spark, folder))


@query
def op_sector_tier_summary(spark, folder):
    return risk_reports.sector_tier_summary(bases.risk_fact(spark, folder), bases.companies(spark, folder))


@query
def op_high_risk_rate(spark, folder):
    return risk_reports.high_risk_rate(bases.risk_fact(spark, folder))


@query
def op_avg_risk_runway(spark, folder):
    return risk_reports.averages(bases.risk_fact(spark, folder))


@query
def op_backtest_precision(spark, folder):
    return risk_reports.backtest_precision(bases.risk_fact(spark, folder))


@query
def op_hist_failure_rate(spark, folder):
    return risk_reports.historical_failure_rate(bases.companies(spark, folder))


@query
def op_portfolio_counts(spark, folder):
    latest = panel.latest_row(bases.rule_scored(spark, folder))
    return risk_reports.portfolio_counts(latest)


@query
def op_risk_trend(spark, folder):
    return risk_reports.risk_trend(bases.risk_fact(spark, folder))


@query
def op_sort_dynamic(spark, folder):
    """Both directions of the sort; the position in it is part of the result."""
    latest = panel.latest_row(bases.rule_scored(spark, folder))
    parts = []
    for key, first in (("risk_score", -F.col("risk_score")), ("runway_months_latest", F.col("runway_months_latest"))):
        placed = ordered.with_rank(latest.withColumn("first", first), ["first", "company_id"], "position")
        parts.append(
            risk_reports.sort_portfolio(placed, key, "company_id").select(
                F.lit(key).alias("sort_key"), "company_id", F.col(key).alias("value"), "position"
            )
        )
    return parts[0].unionByName(parts[1])


# --- profiles ---------------------------------------------------------------------

# --- fixed values: the metrics of the correlation matrix ---
CORE_METRICS = [
    "mrr", "cash_on_hand", "burn_rate", "runway_months", "churn_rate", "nps_score", "attrition_rate", "ltv_cac_ratio", "growth_rate_mom",
]
# ------------------------------------------------------------


@query
def op_corr_matrix(spark, folder):
    return profile.corr_matrix(bases.entity_panel(spark, folder), CORE_METRICS)


@query
def op_box_stats(spark, folder):
    joined = risk_reports.attach_outcome(bases.entity_panel(spark, folder), bases.entities(spark, folder))
    return profile.box_stats(joined, "churn_rate", "failed")


@query
def op_histogram(spark, folder):
    """In which month failed entities failed."""
    failed = bases.entities(spark, folder).where("failed")
    return profile.histogram(failed, "fail_month")


@query
def op_value_counts(spark, folder):
    return profile.value_counts(bases.features(spark, folder), LABEL)


@query
def op_schema_check(spark, folder):
    return profile.schema_check(bases.features(spark, folder), [*FEATURES, "not_a_feature"])


@query
def op_leakage_check(spark, folder):
    """Features of the whole panel before and after all metrics behind every entity's
    cut are replaced: no row up to a cut may move."""
    found = leakage.leakage_check(
        bases.entity_panel(spark, folder), lambda rows: panel.window_features(rows, "month_index"), ENGINEERED, METRICS, ["founder_conflict_flag"]
    )
    return found.select("compared_rows", "moved_rows")

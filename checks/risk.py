"""Check statements of the risk-panel queries."""

from __future__ import annotations

from checks.sql import COUNTS, ENGINEERED, rnd, rounded, statement

CHECKS: dict[str, str] = {}
KEYS = "company_id, month_index"


def check(name: str, body: str, *needs: str) -> None:
    CHECKS[name] = statement(body, *needs)


def _columns(name: str, columns: list[str], source: str = "windows") -> None:
    check(name, f"SELECT {KEYS}, {rounded(columns)} FROM {source}", source)


_columns("op_rolling_slope", ["mrr_slope_3m", "mrr_slope_6m", "churn_rate_slope_3m", "headcount_slope_6m", "ltv_cac_slope_6m"])
_columns("op_pct_change_lag5", [c for c in ENGINEERED if c.endswith("pct_change_6m")])
_columns("op_rolling_std", [c for c in ENGINEERED if c.endswith("volatility_6m")])
_columns("op_trailing_run", [c for c in ENGINEERED if c.startswith("consecutive_")])
_columns("op_ever_flag", ["founder_conflict_ever"])
_columns("op_since_flag", ["months_since_founder_conflict"])
_columns("op_cumsum_eff", ["capital_efficiency"])
_columns("op_risk_index", ["composite_risk_index"])
check(
    "op_forward_label",
    f"""SELECT {KEYS}, CASE WHEN fail_month > month_index AND fail_month <= month_index + 6 THEN 1 ELSE 0 END AS label_fail_within_6m,
               CASE WHEN fail_month > month_index AND fail_month <= month_index + 6 AND NOT acquired THEN 1 ELSE 0 END AS label_failure_only
        FROM panel""",
    "panel",
)
check(
    "op_history_filter",
    f"SELECT {KEYS}, fail_month FROM panel WHERE month_index >= 3 AND (fail_month = -1 OR fail_month > month_index)",
    "panel",
)
check("op_panel_features", f"SELECT {KEYS}, {rounded(ENGINEERED)}, label_fail_within_6m FROM features", "features")
check(
    "op_attach_static",
    f"""SELECT {KEYS}, sector, region, founded_year, founder_count, founder_prior_exits, {rnd('founder_technical_pct')} AS founder_technical_pct,
               initial_funding_stage, initial_capital, company_age_months_at_t FROM features""",
    "features",
)
_latest = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY month_index DESC) AS place FROM {0}) WHERE place = 1)"
check(
    "op_latest_row",
    f"SELECT {KEYS}, {rounded(['mrr_latest', 'runway_months_latest', 'composite_risk_index'])} FROM {_latest.format('features')}",
    "features",
)
check(
    "op_group_sample",
    f"""SELECT {KEYS}, {rnd('mrr_latest')} AS mrr_latest FROM (
        SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY md5(concat_ws('|', company_id, month_index, 42)), month_index) AS place
        FROM features) WHERE place = 1""",
    "features",
)
check("op_trajectory", f"SELECT {KEYS}, {rnd('risk_score')} AS risk_score FROM scored", "scored")
_fact = rounded(
    ["risk_score", "risk_tier", "runway_months", "mrr", "churn_rate", "ltv_cac_ratio", "burn_multiple", "composite_risk_index",
     "consecutive_low_runway_months", "actual_label_fail_within_6m"],
    COUNTS | {"risk_tier", "actual_label_fail_within_6m"},
)
check("op_scored_fact", f"SELECT {KEYS}, {_fact} FROM risk_fact", "risk_fact")
check(
    "op_dim_company",
    f"""SELECT * REPLACE ({rnd('founder_technical_pct')} AS founder_technical_pct, CAST(failed AS INTEGER) AS failed,
                          CAST(acquired AS INTEGER) AS acquired) FROM companies""",
    "companies",
)
check(
    "op_risk_tier",
    f"""SELECT {KEYS}, {rnd('risk_score')} AS risk_score, risk_tier AS tier_right,
               CASE WHEN risk_score < 0.15e0 THEN 'Low' WHEN risk_score < 0.45e0 THEN 'Watch' ELSE 'High' END AS tier_left FROM scored""",
    "scored",
)
check("op_outcome_label", "SELECT company_id, outcome FROM companies", "companies")
check(
    "op_clip",
    f"""SELECT {KEYS}, {rnd('greatest(0e0, least(36e0, runway_months_latest))')} AS runway,
               {rnd('greatest(0.1e0, least(0.6e0, churn_rate_latest))')} AS churn, {rnd('greatest(0e0, nps_score_latest)')} AS nps FROM features""",
    "features",
)
check("op_guarded_ratio", f"SELECT {KEYS}, {rnd('CASE WHEN mrr > 0 THEN burn_rate / mrr ELSE 99e0 END')} AS burn_multiple FROM panel", "panel")
check(
    "op_snapshot_derive",
    f"""SELECT {KEYS}, {rnd('CASE WHEN mrr > 0 THEN burn_rate / mrr ELSE 99e0 END')} AS burn_multiple,
               {rnd('CASE WHEN burn_rate > 0 THEN mrr * 12 / (burn_rate * greatest(month_index, 1)) ELSE 0e0 END')} AS capital_efficiency,
               CAST(25 * CAST(runway_months < 6 AS INTEGER) + 15 * CAST(growth_rate_mom < 0 AS INTEGER)
                    + 15 * CAST(churn_rate > 0.20e0 AS INTEGER) + 10 * CAST(ltv_cac_ratio < 1 AS INTEGER)
                    + 10 * CAST(attrition_rate > 0.15e0 AS INTEGER) + 10 * CAST(glassdoor_rating < 2.5e0 AS INTEGER)
                    + 5 * founder_conflict_ever AS DOUBLE) AS composite_risk_index
        FROM features""",
    "features",
)
check(
    "op_rename_view",
    f"""SELECT company_id AS company, sector, region, {rnd('risk_score')} AS risk_score, risk_tier AS tier,
               {rnd('runway_months_latest')} AS runway_mo, {rnd('mrr_latest')} AS mrr, {rnd('churn_rate_latest')} AS churn,
               {rnd('ltv_cac_ratio_latest')} AS ltv_cac, {rnd('composite_risk_index')} AS heuristic_risk_idx FROM scored""",
    "scored",
)
check(
    "op_filter_eq_in_range",
    f"""SELECT {KEYS}, sector, risk_tier, {rnd('runway_months_latest')} AS runway_months_latest FROM scored
        WHERE risk_tier = 'High' AND sector IN ('SaaS', 'Fintech', 'EdTech') AND runway_months_latest <= 24""",
    "scored",
)
check(
    "op_join_inner_merge",
    f"SELECT s.company_id, s.month_index, {rnd('risk_score')} AS risk_score, m.sector, m.region FROM scored s JOIN master m ON s.company_id = m.company_id",
    "scored", "master",
)
check(
    "op_panel_outcome_join",
    f"""SELECT p.company_id, p.month_index, {rnd('churn_rate')} AS churn_rate, CAST(m.failed AS INTEGER) AS failed
        FROM panel p JOIN master m ON p.company_id = m.company_id""",
    "panel", "master",
)

# reports
check(
    "op_sector_failure_rate",
    f"SELECT sector, {rnd('CAST(count(*) FILTER (failed) AS DOUBLE) / count(*)')} AS failure_rate FROM master GROUP BY sector",
    "master",
)
check(
    "op_outcome_counts",
    f"SELECT outcome, count(*) AS companies, {rnd('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM companies)')} AS share FROM companies GROUP BY outcome",
    "companies",
)
check(
    "op_sector_tier_summary",
    f"""SELECT sector, risk_tier, count(*) AS company_months, {rnd('avg(risk_score)')} AS avg_risk_score, {rnd('avg(runway_months)')} AS avg_runway
        FROM risk_fact f JOIN companies c ON f.company_id = c.company_id GROUP BY ALL""",
    "risk_fact", "companies",
)
check(
    "op_high_risk_rate",
    f"""SELECT count(DISTINCT company_id) AS total_companies, count(DISTINCT company_id) FILTER (risk_tier = 'High') AS high_risk_companies,
               {rnd("CAST(count(DISTINCT company_id) FILTER (risk_tier = 'High') AS DOUBLE) / count(DISTINCT company_id)")} AS high_risk_rate
        FROM risk_fact""",
    "risk_fact",
)
check(
    "op_avg_risk_runway",
    f"SELECT {rnd('avg(risk_score)')} AS avg_risk_score, {rnd('avg(runway_months)')} AS avg_runway FROM risk_fact",
    "risk_fact",
)
check(
    "op_backtest_precision",
    f"""SELECT flagged, failed_later, {rnd('CASE WHEN flagged > 0 THEN CAST(failed_later AS DOUBLE) / flagged ELSE 0e0 END')} AS precision FROM (
        SELECT count(*) AS flagged, CAST(coalesce(sum(actual_label_fail_within_6m), 0) AS BIGINT) AS failed_later FROM risk_fact WHERE risk_tier = 'High')""",
    "risk_fact",
)
check(
    "op_hist_failure_rate",
    f"""SELECT count(*) FILTER (outcome = 'Failed') AS failed_companies, count(*) AS companies,
               {rnd("CAST(count(*) FILTER (outcome = 'Failed') AS DOUBLE) / count(*)")} AS failure_rate FROM companies""",
    "companies",
)
check(
    "op_portfolio_counts",
    f"""SELECT count(*) AS companies, count(*) FILTER (risk_tier = 'High') AS high, count(*) FILTER (risk_tier = 'Watch') AS watch,
               {rnd('avg(risk_score)')} AS avg_risk_score FROM {_latest.format('scored')}""",
    "scored",
)
check(
    "op_risk_trend",
    f"""SELECT a.month_index, {rnd('a.s')} AS avg_risk_score, {rnd('b.s')} AS prior_score, {rnd('a.s - b.s')} AS risk_trend
        FROM (SELECT month_index, avg(risk_score) AS s FROM risk_fact GROUP BY 1) a
        LEFT JOIN (SELECT month_index, avg(risk_score) AS s FROM risk_fact GROUP BY 1) b ON a.month_index = b.month_index + 1""",
    "risk_fact",
)
check(
    "op_sort_dynamic",
    f"""SELECT 'risk_score' AS sort_key, company_id, {rnd('risk_score')} AS value,
               row_number() OVER (ORDER BY risk_score DESC, company_id) AS position FROM {_latest.format('scored')}
        UNION ALL
        SELECT 'runway_months_latest', company_id, {rnd('runway_months_latest')},
               row_number() OVER (ORDER BY runway_months_latest, company_id) FROM {_latest.format('scored')}""",
    "scored",
)

# profiles
CORE = ["mrr", "cash_on_hand", "burn_rate", "runway_months", "churn_rate", "nps_score", "attrition_rate", "ltv_cac_ratio", "growth_rate_mom"]
check(
    "op_corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, {rnd(f'corr({a}, {b})')} AS corr FROM panel" for a in CORE for b in CORE
    ),
    "panel",
)
check(
    "op_box_stats",
    f"""SELECT CAST(failed AS INTEGER) AS failed, {rnd('p25')} AS p25, {rnd('p50')} AS p50, {rnd('p75')} AS p75,
               {rnd('min(churn_rate) FILTER (inside)')} AS whisker_low, {rnd('max(churn_rate) FILTER (inside)')} AS whisker_high,
               count(*) FILTER (NOT inside) AS outliers
        FROM (SELECT *, churn_rate >= p25 - 1.5e0 * (p75 - p25) AND churn_rate <= p75 + 1.5e0 * (p75 - p25) AS inside
              FROM (SELECT p.churn_rate, m.failed FROM panel p JOIN master m ON p.company_id = m.company_id) x
              JOIN (SELECT m.failed AS f, quantile_cont(churn_rate, 0.25) AS p25, quantile_cont(churn_rate, 0.5) AS p50,
                           quantile_cont(churn_rate, 0.75) AS p75
                    FROM panel p JOIN master m ON p.company_id = m.company_id GROUP BY m.failed) q ON x.failed = q.f)
        GROUP BY failed, p25, p50, p75""",
    "panel", "master",
)
check(
    "op_histogram",
    f"""SELECT CAST(spot AS INTEGER) AS bin, {rnd('lo + spot * width')} AS bin_start, count(*) AS n,
               {rnd('(SELECT quantile_cont(CAST(fail_month AS DOUBLE), 0.5) FROM master WHERE failed)')} AS median
        FROM (SELECT lo, width, CASE WHEN width > 0 THEN least(floor((fail_month - lo) / width), 29) ELSE 0 END AS spot FROM master,
                     (SELECT CAST(min(fail_month) AS DOUBLE) AS lo, (max(fail_month) - min(fail_month)) / 30e0 AS width FROM master WHERE failed)
              WHERE failed)
        GROUP BY spot, lo, width""",
    "master",
)
check(
    "op_value_counts",
    f"""SELECT label_fail_within_6m, count(*) AS n, {rnd('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM features)')} AS share
        FROM features GROUP BY 1""",
    "features",
)
check(
    "op_leakage_check",
    """SELECT count(*) AS compared_rows, CAST(0 AS BIGINT) AS moved_rows FROM panel JOIN (
           SELECT company_id, min(month_index) + CAST(floor(
                      CAST('0x' || substr(md5(company_id || '|7'), 1, 8) AS BIGINT) / 4294967296e0 * (max(month_index) - min(month_index))) AS BIGINT) AS cut
           FROM panel GROUP BY company_id) USING (company_id)
       WHERE month_index <= cut""",
    "panel",
)
_features = ENGINEERED + [
    "founded_year", "founder_count", "founder_prior_exits", "founder_technical_pct", "initial_capital",
    "company_age_months_at_t", "sector", "region", "initial_funding_stage",
]
check(
    "op_schema_check",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, 1 AS present FROM features" for c in _features
    )
    + " UNION ALL SELECT 'not_a_feature', NULL, 0",
    "features",
)

"""Check statements of the model metrics, explanations and refreshes."""

from __future__ import annotations

from checks.sql import ENGINEERED, REGIONS, SECTORS, STAGES, dbl, rnd, statement

CHECKS: dict[str, str] = {}
KEYS = "company_id, month_index"


def check(name: str, body: str, *needs: str) -> None:
    CHECKS[name] = statement(body, *needs)


def _draw(*parts: str) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT) / 4294967296e0)"


check(
    "ml_entity_split",
    f"""SELECT split, count(DISTINCT company_id) AS entities, count(*) AS n_rows, CAST(0 AS BIGINT) AS entities_in_two_parts FROM (
        SELECT company_id, CASE WHEN u < 0.15e0 THEN 'test' WHEN u < 0.15e0 + 0.15e0 THEN 'validation' ELSE 'train' END AS split
        FROM (SELECT company_id, {_draw('company_id', '42')} AS u FROM features)) GROUP BY split""",
    "features",
)
check(
    "ml_row_split",
    f"SELECT record_id, CASE WHEN {_draw('record_id', '0')} < 0.25e0 THEN 'test' ELSE 'train' END AS split FROM records",
    "records",
)
check(
    "ml_class_weights",
    f"""SELECT label_fail_within_6m, count(*) AS n, {rnd('(SELECT count(*) FROM features) / (2e0 * count(*))')} AS balanced_weight,
               {rnd("(SELECT count(*) FILTER (label_fail_within_6m = 0) / count(*) FILTER (label_fail_within_6m = 1) FROM features)")} AS neg_pos_ratio
        FROM features GROUP BY 1""",
    "features",
)
_numeric = ENGINEERED + [
    "founded_year", "founder_count", "founder_prior_exits", "founder_technical_pct", "initial_capital", "company_age_months_at_t",
]
_slots = [
    f"SELECT '{c}' AS feature, 0e0 AS mean, CASE WHEN min({c}) < max({c}) THEN 1e0 ELSE 0e0 END AS std FROM features" for c in _numeric
]
for _column, _names in (("sector", SECTORS), ("region", REGIONS), ("initial_funding_stage", STAGES)):
    _hit = f"CASE WHEN f.{_column} = l.v THEN 1e0 ELSE 0e0 END"
    _slots.append(
        f"""SELECT '{_column}=' || l.v AS feature, {rnd(f'avg({_hit})')} AS mean, {rnd(f'stddev_samp({_hit})')} AS std
            FROM features f, (SELECT DISTINCT {_column} AS v FROM features) l GROUP BY l.v"""
    )
check("ml_preprocess", " UNION ALL ".join(_slots), "features")
_columns = ["length", "spaces", "periods", "marks", "zeros", "toxic"]
_scaled = ", ".join(
    f"""{rnd(f'''({c} - (SELECT avg({c}) FROM records WHERE toxic = 0))
        / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END FROM records WHERE toxic = 0)''')} AS {c}"""
    for c in _columns
)
check("ml_standardize", f"SELECT record_id, {_scaled}, outcome FROM records", "records")

_mean = "(SELECT CAST(sum(price) AS DOUBLE) / count(price) FROM clean)"
_effects = " ".join(
    f"""JOIN (SELECT {c} AS k, CAST(sum(price) AS DOUBLE) / count(price) - {_mean} AS w FROM clean GROUP BY {c}) w_{c}
        ON s.{c} IS NOT DISTINCT FROM w_{c}.k"""
    for c in ("product_type", "brand", "processor", "region")
)
check(
    "ml_price_breakdown",
    f"""SELECT order_id, {rnd(f'''{_mean} + w_product_type.w + w_brand.w + w_processor.w + w_region.w
        + coalesce(ram_gb, 0) * (SELECT regr_slope(CAST(price AS DOUBLE), ram_gb) FROM clean)
        + coalesce(rom_gb, 0) * (SELECT regr_slope(CAST(price AS DOUBLE), rom_gb) FROM clean)''', 3)} AS estimated_price
        FROM clean s {_effects}""",
    "clean",
)

# metrics on the rule score
_counts = "(SELECT risk_score AS s, count(*) FILTER (label_fail_within_6m = 1) AS pos, count(*) FILTER (label_fail_within_6m = 0) AS neg{extra} FROM scored GROUP BY ALL)"
_auc = f"""SELECT {{keys}} {{result}} AS roc_auc FROM (
    SELECT *, coalesce(sum(neg) OVER (PARTITION BY {{part}} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM {_counts})"""
_auc_value = rnd("CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / nullif(2 * sum(pos) * sum(neg), 0)")
check("ml_roc_auc", _auc.format(keys="", result=_auc_value, part="1", extra=""), "scored")
check(
    "ml_cohort_auc",
    _auc.format(keys="founded_year,", result=_auc_value, part="founded_year", extra=", founded_year") + " GROUP BY founded_year",
    "scored",
)
_curve = f"""(SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p FROM {_counts.format(extra='')}
             WINDOW w AS (ORDER BY s DESC))"""
check("ml_avg_precision", f"SELECT {rnd('sum(CAST(pos AS DOUBLE) / p * tp / (tp + fp))')} AS avg_precision FROM {_curve}", "scored")
check(
    "ml_cost_threshold",
    f"""SELECT {rnd('s')} AS threshold, {rnd('cost')} AS cost FROM (
        SELECT s, (5e0 * (p - tp) + CASE WHEN tp > 0 THEN fp ELSE p END) / p AS cost FROM {_curve}) ORDER BY cost, s LIMIT 1""",
    "scored",
)
_cells = """(SELECT CAST(count(*) FILTER ({hit} AND {truth}) AS DOUBLE) AS tp, CAST(count(*) FILTER ({hit} AND NOT {truth}) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (NOT {hit} AND {truth}) AS DOUBLE) AS fn, CAST(count(*) FILTER (NOT {hit} AND NOT {truth}) AS DOUBLE) AS tn FROM scored)"""
_bad = {"hit": "(risk_score >= {t})", "truth": "(label_fail_within_6m = 1)"}


def _grid(threshold: str, positive: bool = True) -> str:
    hit = _bad["hit"].format(t=threshold)
    if positive:
        return _cells.format(hit=hit, truth=_bad["truth"])
    return _cells.format(hit=f"(NOT {hit})", truth=f"(NOT {_bad['truth']})")


check(
    "ml_f1_brier",
    f"""SELECT {rnd('2 * tp / (2 * tp + fp + fn)')} AS f1,
               {rnd('(SELECT avg((risk_score - label_fail_within_6m) * (risk_score - label_fail_within_6m)) FROM scored)')} AS brier
        FROM {_grid('0.5e0')}""",
    "scored",
)
check(
    "ml_confusion",
    f"""SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
               {rnd('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy, {rnd('tp / (tp + fp)')} AS precision, {rnd('tp / (tp + fn)')} AS recall,
               {rnd('2 * tp / (2 * tp + fp + fn)')} AS f1 FROM {_grid('0.3e0')}""",
    "scored",
)
_class = """SELECT '{name}' AS class, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
            coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, CAST(tp + fn AS BIGINT) AS support FROM {cells}"""
_classes = "(" + _class.format(name="Healthy", cells=_grid("0.3e0", False)) + " UNION ALL " + _class.format(name="At-Risk", cells=_grid("0.3e0")) + ")"
_weighted = ", ".join(f"sum({c} * support) / sum(support) AS {c}" for c in ("precision", "recall", "f1"))
check(
    "ml_class_report",
    f"""SELECT class, {rnd('precision')} AS precision, {rnd('recall')} AS recall, {rnd('f1')} AS f1, CAST(support AS BIGINT) AS support FROM (
        SELECT * FROM {_classes}
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM {_classes}
        UNION ALL SELECT 'weighted avg', {_weighted}, sum(support) FROM {_classes})""",
    "scored",
)

# explanations by one-feature slopes
_long = "(" + " UNION ALL ".join(
    f"""SELECT {KEYS}, '{c}' AS feature, {rnd(f'''(SELECT regr_slope(CAST(label_fail_within_6m AS DOUBLE), CAST({c} AS DOUBLE)) FROM features)
        * ({c} - (SELECT avg({c}) FROM features))''')} AS contribution FROM features"""
    for c in _numeric
) + ")"
_ranked = f"""(SELECT *, row_number() OVER (PARTITION BY {KEYS}, direction ORDER BY abs(contribution) DESC, feature) AS place FROM (
    SELECT *, CASE WHEN contribution > 0 THEN 'up' WHEN contribution < 0 THEN 'down' END AS direction FROM {_long}) WHERE direction IS NOT NULL)"""
check(
    "ml_global_importance",
    f"""SELECT feature, {rnd('avg(abs(contribution))')} AS mean_abs_contribution FROM {_long} GROUP BY feature
        ORDER BY avg(abs(contribution)) DESC NULLS LAST, feature LIMIT 15""",
    "features",
)
check(
    "op_topk_signed",
    f"SELECT {KEYS}, direction, CAST(place AS INTEGER) AS place, feature, contribution FROM {_ranked} WHERE place <= 3",
    "features",
)
check(
    "ml_local_top",
    f"""SELECT {KEYS}, coalesce(string_agg(feature, ',' ORDER BY place) FILTER (direction = 'up'), '') AS up,
               coalesce(string_agg(feature, ',' ORDER BY place) FILTER (direction = 'down'), '') AS down
        FROM {_ranked} WHERE place <= 5 GROUP BY ALL""",
    "features",
)
# --- fixed values: readable names of the main features ---
_names = {
    "runway_months_latest": "months of cash runway remaining",
    "churn_rate_latest": "current customer churn rate",
    "mrr_slope_6m": "6-month MRR growth trend",
    "consecutive_low_runway_months": "consecutive months with runway under 6 months",
    "consecutive_neg_growth_months": "consecutive months of revenue decline",
    "ltv_cac_ratio_latest": "LTV:CAC ratio",
    "attrition_rate_latest": "employee attrition rate",
    "founder_conflict_ever": "history of founder conflict",
    "glassdoor_rating_latest": "Glassdoor employee rating",
    "burn_multiple": "burn multiple (burn / revenue)",
    "consecutive_high_churn_months": "consecutive months of elevated churn",
    "churn_rate_slope_6m": "6-month churn rate trend",
    "nps_score_latest": "Net Promoter Score",
    "capital_efficiency": "capital efficiency (annualized revenue / cumulative burn)",
}
# ----------------------------------------------------------
_plain = "replace(replace(replace(replace(feature, '_latest', ''), '_slope_6m', ' trend'), '_slope_3m', ' short-term trend'), '_', ' ')"
_name = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _names.items()) + f" ELSE {_plain} END"
check(
    "ml_narrative",
    f"""SELECT {KEYS}, company_id || '''s risk score is primarily driven by ' || CASE len(up)
               WHEN 0 THEN 'no single dominant risk factor -- risk is diffuse across several moderate signals.'
               WHEN 1 THEN up[1] || '.' WHEN 2 THEN up[1] || ' and ' || up[2] || '.'
               ELSE up[1] || ', ' || up[2] || ' and ' || up[3] || '.' END
               || CASE WHEN len(down) > 0 THEN ' This is partially offset by relatively healthy ' || array_to_string(down, ' and ') || '.' ELSE '' END AS narrative
        FROM (SELECT {KEYS}, coalesce(list({_name} ORDER BY place) FILTER (direction = 'up' AND place <= 3), []) AS up,
                     coalesce(list({_name} ORDER BY place) FILTER (direction = 'down' AND place <= 2), []) AS down
              FROM {_ranked} GROUP BY {KEYS})""",
    "features",
)
_snapshot = [
    "mrr_latest", "cash_on_hand_latest", "burn_rate_latest", "runway_months_latest", "churn_rate_latest", "cac_payback_months_latest",
    "nps_score_latest", "headcount_latest", "attrition_rate_latest", "product_release_count_latest", "press_mentions_latest",
    "glassdoor_rating_latest", "ltv_cac_ratio_latest", "growth_rate_mom_latest", "founder_conflict_ever", "burn_multiple",
    "capital_efficiency", "composite_risk_index", "founded_year", "founder_count", "founder_prior_exits", "founder_technical_pct",
    "initial_capital", "company_age_months_at_t", "sector", "region", "initial_funding_stage",
]
check(
    "ml_snapshot_schema",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, 1 AS present, 0 AS needs_history FROM features" for c in _snapshot
    ),
    "features",
)

# models: what must hold whatever was fitted
check("op_model_io", f"SELECT {KEYS}, 0e0 AS difference FROM features", "features")
check("st_batch_score", f"SELECT {KEYS}, 0e0 AS difference FROM features", "features")

# refreshes
check(
    "st_incremental_refresh",
    f"""SELECT upper(event_type[1]) || event_type[2:] AS event_type, count(*) AS n, {dbl('sum(CAST(value AS DECIMAL(14,2)))')} AS total
        FROM events WHERE value > 0 GROUP BY 1""",
)
check(
    "st_sales_refresh",
    f"""SELECT order_id, customer_name, product_type, {dbl('ram_gb')} AS ram_gb, {dbl('price')} AS price, {dbl('revenue')} AS revenue,
               order_quarter, dispatch_delay_days, age_band FROM clean""",
    "clean",
)
check("st_dedupe", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
check(
    "st_window_revenue",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS bucket, {dbl('sum(CAST(value AS DECIMAL(14,2)))')} AS revenue, count(*) AS events
        FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
check(
    "st_revenue_revisions",
    f"""WITH parts AS (
          SELECT (coalesce(user_id, 0) % 3 + 3) % 3 AS part, date_trunc('day', ts) AS day,
                 sum(CAST(value AS DECIMAL(14,2))) AS revenue, count(*) AS events
          FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL GROUP BY 1, 2
        ),
        seen AS (SELECT part, max(max(day)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM parts GROUP BY 1)
        SELECT strftime(day, '%Y-%m-%d') AS bucket, {dbl('sum(revenue)')} AS revenue, sum(events)::BIGINT AS events, count(*) AS versions,
               count(*) FILTER (day + INTERVAL 1 DAY <= newest - INTERVAL 7 DAY) AS corrections
        FROM parts JOIN seen USING (part) GROUP BY 1""",
)

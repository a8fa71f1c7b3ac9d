"""Shared table expressions and helpers for the check statements."""

from __future__ import annotations


def rnd(expr: str, digits: int = 6) -> str:
    """Round half up on the shortest decimal text of a double."""
    return f"CAST(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def even(expr: str, digits: int) -> str:
    """Scale, round ties to even, scale back."""
    scale = f"1e{digits}"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def title(expr: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({expr}, '(\\p{{L}}+|\\P{{L}}+)'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


SALES_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "inward_date", "dispatch_date", "price", "quantity_sold", "order_id", "customer_name", "product_type",
        "brand", "processor", "ram_gb", "rom_gb", "region", "customer_age", "gender", "income_bracket",
    )
)


def _labels(names: list[str], key: str) -> str:
    return "CASE " + " ".join(f"WHEN {key} % {len(names)} = {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


SECTORS = ["SaaS", "Fintech", "HealthTech", "E-commerce", "AI/ML", "EdTech", "Marketplace", "DeepTech", "ClimateTech", "ConsumerApps"]
REGIONS = ["US-WestCoast", "US-EastCoast", "US-Other", "Europe", "India", "SEA", "LatAm"]
STAGES = ["Pre-Seed", "Seed", "Series A", "Series B", "Series C+"]

# name -> (tables it needs, statement)
TABLES: dict[str, tuple[list[str], str]] = {}

TABLES["flat"] = (
    [],
    """
    SELECT l_orderkey * 10 + l_linenumber AS order_id, c_name AS customer_name, p_type AS product_type,
           p_brand AS brand, CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE p_name END AS processor,
           CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS ram_gb,
           CAST(64 * (1 + l_partkey % 4) AS DOUBLE) AS rom_gb,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity_sold,
           CASE WHEN l_orderkey % 89 = 0 THEN 'nan' WHEN l_orderkey % 7 = 0 THEN r_name
                WHEN l_orderkey % 5 = 0 THEN ' ' || lower(r_name) || ' ' ELSE lower(r_name) END AS region,
           CAST(o_orderdate AS DATE) AS inward_date, CAST(l_shipdate AS DATE) AS dispatch_date,
           CAST(18 + c_custkey % 60 AS INTEGER) AS customer_age,
           CASE WHEN c_custkey % 2 = 0 THEN 'MALE' ELSE 'female' END AS gender, c_mktsegment AS income_bracket
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    """,
)
TABLES["deduped"] = (
    ["flat"],
    f"""
    SELECT DISTINCT * EXCLUDE (place) FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {SALES_ORDER}) AS place FROM flat)
    WHERE place = 1
    """,
)
TABLES["texted"] = (
    ["deduped"],
    f"""
    SELECT * REPLACE (
        nullif({title('trim(region)')}, 'Nan') AS region, {title('trim(brand)')} AS brand,
        {title('trim(product_type)')} AS product_type,
        coalesce(nullif({title('trim(processor)')}, 'Nan'), 'Unknown') AS processor,
        {title('trim(gender)')} AS gender, {title('trim(income_bracket)')} AS income_bracket)
    FROM deduped
    """,
)
TABLES["repaired"] = (
    ["texted"],
    """
    SELECT t.* REPLACE (coalesce(t.ram_gb, m.med) AS ram_gb) FROM texted t
    LEFT JOIN (SELECT product_type, quantile_cont(ram_gb, 0.5) AS med FROM texted GROUP BY product_type) m
      ON t.product_type = m.product_type
    """,
)
TABLES["usable"] = (
    ["repaired"],
    """
    SELECT * FROM repaired WHERE order_id IS NOT NULL AND quantity_sold IS NOT NULL AND inward_date IS NOT NULL
      AND region IS NOT NULL AND price > 0
    """,
)
TABLES["clean"] = (
    ["usable"],
    """
    SELECT *, CAST(price * quantity_sold AS DECIMAL(14,2)) AS revenue, strftime(inward_date, '%Y-%m') AS order_month,
           CAST(year(inward_date) AS VARCHAR) || 'Q' || CAST(quarter(inward_date) AS VARCHAR) AS order_quarter,
           CAST(year(inward_date) AS INTEGER) AS order_year,
           CASE WHEN dispatch_date >= inward_date THEN CAST(dispatch_date - inward_date AS INTEGER) END AS dispatch_delay_days,
           CASE WHEN customer_age <= 17 OR customer_age > 100 THEN NULL WHEN customer_age <= 24 THEN '18-24'
                WHEN customer_age <= 34 THEN '25-34' WHEN customer_age <= 44 THEN '35-44'
                WHEN customer_age <= 54 THEN '45-54' ELSE '55+' END AS age_band
    FROM usable
    WHERE CAST(price AS DOUBLE) >= (SELECT quantile_cont(CAST(price AS DOUBLE), 0.001) FROM usable)
      AND CAST(price AS DOUBLE) <= (SELECT quantile_cont(CAST(price AS DOUBLE), 0.999) FROM usable)
    """,
)
TABLES["rfm_base"] = (
    ["clean"],
    """
    SELECT customer_name, CAST((SELECT max(inward_date) FROM clean) + 1 - max(inward_date) AS INTEGER) AS recency,
           count(DISTINCT order_id) AS frequency, sum(revenue) AS monetary
    FROM clean GROUP BY customer_name
    """,
)
TABLES["rfm"] = (
    ["rfm_base"],
    """
    SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                   WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
                   WHEN r_score >= 4 AND f_score <= 2 THEN 'New / Promising'
                   WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'At Risk (High Value)'
                   WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost / Churned'
                   ELSE 'Needs Attention' END AS segment,
           CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
           r_score + f_score + m_score AS rfm_total
    FROM (
      SELECT b.*, CAST(5 - list_sum(list_transform(e.r, lambda q: CAST(recency > q AS INTEGER))) AS INTEGER) AS r_score,
             CAST(greatest(1, ceil((row_number() OVER (ORDER BY frequency, customer_name) - 1) * 5 / (e.n - 1))) AS INTEGER) AS f_score,
             CAST(1 + list_sum(list_transform(e.m, lambda q: CAST(CAST(monetary AS DOUBLE) > q AS INTEGER))) AS INTEGER) AS m_score
      FROM rfm_base b, (SELECT quantile_cont(CAST(recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS r,
                               quantile_cont(CAST(monetary AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS m, count(*) AS n
                        FROM rfm_base) e)
    """,
)
ACTIONS = """(VALUES
    ('Champions', 'Reward with early access / loyalty perks. Protect, don''t discount.'),
    ('Loyal Customers', 'Upsell premium SKUs (e.g. higher RAM/ROM variants). Cross-sell accessories.'),
    ('New / Promising', 'Onboard with a second-purchase incentive within 30 days.'),
    ('At Risk (High Value)', 'Urgent win-back campaign — high revenue customers going cold.'),
    ('Needs Attention', 'Re-engagement email/SMS with a moderate discount.'),
    ('Lost / Churned', 'Low-cost reactivation only; do not over-invest.')) AS a(segment, recommended_action)"""
TABLES["dim_region"] = (
    ["clean"],
    """
    SELECT row_number() OVER (ORDER BY region) AS region_key, region AS region_name
    FROM (SELECT DISTINCT region FROM clean)
    """,
)
TABLES["dim_customer"] = (
    ["clean", "rfm"],
    """
    SELECT row_number() OVER (ORDER BY c.customer_name) AS customer_key, c.customer_name, customer_age AS age, gender,
           income_bracket, age_band, segment AS rfm_segment, rfm_total AS rfm_total_score
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_name ORDER BY order_id) AS place FROM clean) c
    JOIN rfm r ON c.customer_name = r.customer_name WHERE place = 1
    """,
)
TABLES["dim_product"] = (
    ["clean"],
    """
    SELECT row_number() OVER (ORDER BY product_type NULLS FIRST, brand NULLS FIRST, processor NULLS FIRST,
                              ram_gb NULLS FIRST, rom_gb NULLS FIRST) AS product_key, *
    FROM (SELECT DISTINCT product_type, brand, processor, ram_gb, rom_gb FROM clean)
    """,
)
TABLES["dates_seen"] = (
    ["clean"],
    """
    SELECT DISTINCT d FROM (SELECT inward_date AS d FROM clean UNION ALL SELECT dispatch_date FROM clean)
    WHERE d IS NOT NULL
    """,
)
DATE_COLUMNS = f"""
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, {day('d')} AS full_date, dayname(d) AS day_name,
    monthname(d) AS month_name, CAST(month(d) AS INTEGER) AS month_num, CAST(quarter(d) AS INTEGER) AS quarter_num,
    CAST(year(d) AS INTEGER) AS year_num
"""
TABLES["dim_date"] = (["dates_seen"], f"SELECT {DATE_COLUMNS} FROM dates_seen")
TABLES["fact"] = (
    ["clean", "dim_customer", "dim_product", "dim_region"],
    """
    SELECT order_id, customer_key, product_key, region_key,
           CAST(strftime(inward_date, '%Y%m%d') AS INTEGER) AS inward_date_key,
           CAST(strftime(dispatch_date, '%Y%m%d') AS INTEGER) AS dispatch_date_key,
           price, quantity_sold, revenue, dispatch_delay_days
    FROM clean s JOIN dim_customer c ON s.customer_name = c.customer_name JOIN dim_region r ON s.region = r.region_name
    JOIN dim_product p ON s.product_type IS NOT DISTINCT FROM p.product_type AND s.brand IS NOT DISTINCT FROM p.brand
      AND s.processor IS NOT DISTINCT FROM p.processor AND s.ram_gb IS NOT DISTINCT FROM p.ram_gb
      AND s.rom_gb IS NOT DISTINCT FROM p.rom_gb
    """,
)
TABLES["panel"] = (
    [],
    """
    SELECT user_id AS company_id, CAST(row_number() OVER w - 1 AS INTEGER) AS month_index, mrr, top_value * 8 AS cash_on_hand,
           burn_rate, CASE WHEN burn_rate - mrr > 0 THEN least(99e0, top_value * 8 / (burn_rate - mrr)) ELSE 99e0 END AS runway_months,
           errors / n AS churn_rate, CAST(1 + user_id % 20 AS DOUBLE) AS cac_payback_months,
           100e0 * (views - errors) / n AS nps_score, n AS headcount, 0.5e0 * errors / n AS attrition_rate,
           CASE WHEN errors >= 2 THEN 1 ELSE 0 END AS founder_conflict_flag, clicks AS product_release_count,
           views AS press_mentions, 1 + 4e0 * (n - errors) / n AS glassdoor_rating, top_value / 50 AS ltv_cac_ratio,
           coalesce((mrr - lag(mrr) OVER w) / greatest(lag(mrr) OVER w, 1e0), 0e0) AS growth_rate_mom,
           user_id % 3 = 0 AS failed, user_id % 3 <> 0 AND user_id % 11 = 0 AS acquired,
           CAST(CASE WHEN user_id % 3 = 0 OR user_id % 11 = 0 THEN count(*) OVER (PARTITION BY user_id) - 1 ELSE -1 END AS INTEGER) AS fail_month
    FROM (
      SELECT user_id, CAST(ts AS DATE) AS d, CAST(count(*) AS INTEGER) AS n,
             CAST(coalesce(sum(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS mrr,
             CAST(coalesce(sum(CAST(value AS DECIMAL(12,2))), 0) AS DOUBLE) AS burn_rate, max(value) AS top_value,
             CAST(count(*) FILTER (event_type = 'error') AS INTEGER) AS errors,
             CAST(count(*) FILTER (event_type = 'click') AS INTEGER) AS clicks,
             CAST(count(*) FILTER (event_type = 'view') AS INTEGER) AS views
      FROM events GROUP BY user_id, CAST(ts AS DATE))
    WINDOW w AS (PARTITION BY user_id ORDER BY d)
    """,
)
TABLES["master"] = (
    ["panel"],
    f"""
    SELECT company_id, {_labels(SECTORS, 'company_id')} AS sector, {_labels(REGIONS, 'company_id')} AS region,
           CAST(2014 + company_id % 9 AS INTEGER) AS founded_year, CAST(1 + company_id % 3 AS INTEGER) AS founder_count,
           CAST(company_id % 4 AS INTEGER) AS founder_prior_exits, (company_id % 5) / 4e0 AS founder_technical_pct,
           {_labels(STAGES, 'company_id')} AS initial_funding_stage,
           CAST(100000 * (1 + company_id % 50) AS DOUBLE) AS initial_capital, CAST(count(*) AS INTEGER) AS months_observed,
           bool_or(failed) AS failed, bool_or(acquired) AS acquired, max(fail_month) AS fail_month
    FROM panel GROUP BY company_id
    """,
)

TREND = ["mrr", "churn_rate", "runway_months", "headcount", "nps_score", "burn_rate"]
METRICS = [
    "mrr", "cash_on_hand", "burn_rate", "runway_months", "churn_rate", "cac_payback_months", "nps_score", "headcount",
    "attrition_rate", "product_release_count", "press_mentions", "glassdoor_rating", "ltv_cac_ratio", "growth_rate_mom",
]


def _slope(metric: str, frame: str) -> str:
    return f"CASE WHEN month_index < 1 THEN 0e0 ELSE regr_slope(CAST({metric} AS DOUBLE), CAST(month_index AS DOUBLE)) OVER {frame} END"


_trend = ",\n".join(
    f"{_slope(m, 'w3')} AS {m}_slope_3m, {_slope(m, 'w6')} AS {m}_slope_6m, "
    f"CASE WHEN lag({m}, 5) OVER w <> 0 THEN ({m} - lag({m}, 5) OVER w) / abs(lag({m}, 5) OVER w) ELSE 0e0 END AS {m}_pct_change_6m"
    for m in TREND
)
_vol = ", ".join(
    f"CASE WHEN month_index < 1 THEN 0e0 ELSE stddev_samp(CAST({m} AS DOUBLE)) OVER w6 END AS {m}_volatility_6m"
    for m in ("churn_rate", "growth_rate_mom", "burn_rate")
)


def _island(flag: str, name: str) -> str:
    return f"sum(CASE WHEN {flag} THEN 0 ELSE 1 END) OVER w AS {name}_island"


def _run(flag: str, name: str) -> str:
    return (
        f"CAST(sum(CASE WHEN {flag} THEN 1 ELSE 0 END) OVER "
        f"(PARTITION BY company_id, {name}_island ORDER BY month_index) AS INTEGER)"
    )


TABLES["islands"] = (
    ["panel"],
    f"""
    SELECT *, {_island('growth_rate_mom < 0', 'neg')}, {_island('runway_months < 6', 'low')}, {_island('churn_rate > 0.15e0', 'high')}
    FROM panel WINDOW w AS (PARTITION BY company_id ORDER BY month_index)
    """,
)
TABLES["windows"] = (
    ["islands"],
    f"""
    SELECT *, CASE WHEN mrr > 0 THEN burn_rate / mrr ELSE 99e0 END AS burn_multiple,
           CASE WHEN cum_burn > 0 THEN mrr * 12 / cum_burn ELSE 0e0 END AS capital_efficiency,
           least(100e0, greatest(0e0, CAST(
             CASE WHEN runway_months < 6 THEN 25 ELSE 0 END + CASE WHEN consecutive_neg_growth_months >= 2 THEN 15 ELSE 0 END
             + CASE WHEN churn_rate > 0.20e0 THEN 15 ELSE 0 END + CASE WHEN consecutive_high_churn_months >= 2 THEN 10 ELSE 0 END
             + CASE WHEN ltv_cac_ratio < 1 THEN 10 ELSE 0 END + CASE WHEN attrition_rate > 0.15e0 THEN 10 ELSE 0 END
             + CASE WHEN glassdoor_rating < 2.5e0 THEN 10 ELSE 0 END + 5 * founder_conflict_ever AS DOUBLE))) AS composite_risk_index,
           CASE WHEN fail_month > month_index AND fail_month <= month_index + 6 THEN 1 ELSE 0 END AS label_fail_within_6m
    FROM (
      SELECT *, {", ".join(f"{m} AS {m}_latest" for m in METRICS)},
             {_trend},
             {_vol},
             {_slope('ltv_cac_ratio', 'w6')} AS ltv_cac_slope_6m,
             {_run('growth_rate_mom < 0', 'neg')} AS consecutive_neg_growth_months,
             {_run('runway_months < 6', 'low')} AS consecutive_low_runway_months,
             {_run('churn_rate > 0.15e0', 'high')} AS consecutive_high_churn_months,
             max(founder_conflict_flag) OVER w AS founder_conflict_ever,
             CAST(coalesce(month_index - max(CASE WHEN founder_conflict_flag = 1 THEN month_index END) OVER w, 999) AS INTEGER) AS months_since_founder_conflict,
             sum(burn_rate) OVER w AS cum_burn
      FROM islands
      WINDOW w AS (PARTITION BY company_id ORDER BY month_index),
             w3 AS (PARTITION BY company_id ORDER BY month_index ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
             w6 AS (PARTITION BY company_id ORDER BY month_index ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
    """,
)
ENGINEERED = (
    [f"{m}_latest" for m in METRICS]
    + [f"{m}_{k}" for m in TREND for k in ("slope_3m", "slope_6m", "pct_change_6m")]
    + [f"{m}_volatility_6m" for m in ("churn_rate", "growth_rate_mom", "burn_rate")]
    + ["consecutive_neg_growth_months", "consecutive_low_runway_months", "consecutive_high_churn_months", "founder_conflict_ever",
       "months_since_founder_conflict", "burn_multiple", "capital_efficiency", "ltv_cac_slope_6m", "composite_risk_index"]
)
COUNTS = {
    "headcount_latest", "product_release_count_latest", "press_mentions_latest", "consecutive_neg_growth_months",
    "consecutive_low_runway_months", "consecutive_high_churn_months", "founder_conflict_ever", "months_since_founder_conflict",
}


def rounded(names: list[str], whole: set[str] = COUNTS) -> str:
    return ", ".join(n if n in whole else f"{rnd(n)} AS {n}" for n in names)


TABLES["features"] = (
    ["windows", "master"],
    """
    SELECT w.*, m.sector, m.region, m.founded_year, m.founder_count, m.founder_prior_exits, m.founder_technical_pct,
           m.initial_funding_stage, m.initial_capital, month_index AS company_age_months_at_t
    FROM windows w LEFT JOIN master m ON w.company_id = m.company_id
    WHERE month_index >= 3 AND NOT (w.fail_month <> -1 AND w.fail_month <= month_index)
    """,
)
TIER = "CASE WHEN risk_score <= 0.15e0 THEN 'Low' WHEN risk_score <= 0.45e0 THEN 'Watch' ELSE 'High' END"
TABLES["scored"] = (
    ["features"],
    f"""
    SELECT *, {TIER} AS risk_tier FROM (
      SELECT *, (composite_risk_index + least(consecutive_low_runway_months, 10)) / 110e0 AS risk_score FROM features)
    """,
)
TABLES["risk_fact"] = (
    ["scored"],
    """
    SELECT company_id, month_index, risk_score, risk_tier, runway_months_latest AS runway_months, mrr_latest AS mrr,
           churn_rate_latest AS churn_rate, ltv_cac_ratio_latest AS ltv_cac_ratio, burn_multiple, composite_risk_index,
           consecutive_low_runway_months, label_fail_within_6m AS actual_label_fail_within_6m
    FROM scored
    """,
)
TABLES["companies"] = (
    ["master"],
    "SELECT *, CASE WHEN failed THEN 'Failed' WHEN acquired THEN 'Acquired' ELSE 'Active' END AS outcome FROM master",
)
TABLES["survey"] = (
    [],
    f"""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS level,
           CASE WHEN o_custkey % 3 = 0 THEN 'Urban' ELSE 'Rural' END AS region,
           CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
           {even("CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / count(*) / 10000", 1)} AS rate
    FROM orders GROUP BY ALL
    """,
)
TENTHS = "CAST(sum(CAST(rate AS DECIMAL(12,1))) AS DOUBLE) / count(rate)"
TABLES["totals"] = (
    ["survey"],
    f"SELECT year, level, 'Total' AS region, 'Person' AS gender, {even(TENTHS, 1)} AS rate FROM survey GROUP BY year, level",
)
TABLES["survey_all"] = (["survey", "totals"], "SELECT * FROM survey UNION ALL BY NAME SELECT * FROM totals")
TABLES["records"] = (
    [],
    """
    SELECT doc_id AS record_id, CAST(n_chars AS DOUBLE) AS length,
           CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS spaces,
           CAST(length(text) - length(replace(text, '.', '')) AS DOUBLE) AS periods,
           CAST(length(text) - length(replace(text, '!', '')) AS DOUBLE) AS marks,
           CAST(length(text) - length(replace(text, '0', '')) AS DOUBLE) AS zeros,
           CAST(toxic AS DOUBLE) AS toxic, CAST(1 - quality AS INTEGER) AS outcome
    FROM labels JOIN documents USING (doc_id)
    """,
)


def statement(body: str, *needs: str) -> str:
    """``body`` with the shared tables it needs in front, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in TABLES[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body.strip()
    parts = [f"{name} AS ({TABLES[name][1].strip()})" for name in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()

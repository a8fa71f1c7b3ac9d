"""Check statements of the survey queries and table profiles."""

from __future__ import annotations

from checks.sql import day, dbl, even, rnd, statement

CHECKS: dict[str, str] = {}
LAST = "(SELECT max(year) FROM survey)"
LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RANK = "CASE level " + " ".join(f"WHEN '{v}' THEN {i + 1}" for i, v in enumerate(LEVELS)) + " END"


def check(name: str, body: str, *needs: str) -> None:
    CHECKS[name] = statement(body, *needs)


check("op_group_mean_round", "SELECT year, level, rate FROM totals", "totals")
check("op_totals_rows", "SELECT year, level, region, gender, rate FROM survey_all", "survey_all")
_cells = ", ".join(f"max(rate) FILTER (year = {y}) AS y{y}" for y in range(1995, 2002))
check("op_pivot_year", f"SELECT level, {_cells}, {RANK} AS category_rank FROM totals GROUP BY level", "totals")


def _gap(split: str, left: str, right: str) -> str:
    def side(value: str) -> str:
        return f"CAST(sum(CAST(rate AS DECIMAL(12,1))) FILTER ({split} = '{value}') AS DOUBLE) / count(rate) FILTER ({split} = '{value}')"

    return f"""SELECT level, {rnd(side(left))} AS "{left}", {rnd(side(right))} AS "{right}", {rnd(f'{side(left)} - {side(right)}')} AS gap,
               {RANK} AS category_rank FROM survey WHERE year = {LAST} GROUP BY level"""


check("op_pivot_gender", _gap("gender", "Male", "Female"), "survey")
check("op_pivot_region", _gap("region", "Rural", "Urban"), "survey")
check(
    "op_cell_ratio",
    f"""SELECT {even(f"(SELECT rate FROM totals WHERE year = {LAST} AND level = '1-URGENT') / (SELECT rate FROM totals WHERE year = {LAST} AND level = '5-LOW')", 1)} AS ratio""",
    "survey", "totals",
)
check(
    "op_latest_extremes",
    f"""SELECT h.level AS highest, h.rate AS highest_rate, l.level AS lowest, l.rate AS lowest_rate
        FROM (SELECT * FROM totals WHERE year = {LAST} ORDER BY rate DESC, level LIMIT 1) h,
             (SELECT * FROM totals WHERE year = {LAST} ORDER BY rate, level LIMIT 1) l""",
    "survey", "totals",
)
check("op_trend_by_level", "SELECT level, year, rate FROM totals", "totals")
check(
    "op_yoy_change",
    f"""SELECT c.level, c.year, c.rate, c.change, {rnd('g.gap')} AS gap, g.reversed
        FROM (SELECT level, year, rate, {even('rate - lag(rate) OVER (PARTITION BY level ORDER BY year)', 2)} AS change FROM totals) c
        JOIN (SELECT year, gap, CASE WHEN sign(gap) * sign(lag(gap) OVER (ORDER BY year)) < 0 THEN 1 ELSE 0 END AS reversed FROM (
                SELECT year, CAST(sum(CAST(rate AS DECIMAL(12,1))) FILTER (gender = 'Male') AS DOUBLE) / count(*) FILTER (gender = 'Male')
                           - CAST(sum(CAST(rate AS DECIMAL(12,1))) FILTER (gender = 'Female') AS DOUBLE) / count(*) FILTER (gender = 'Female') AS gap
                FROM survey GROUP BY year)) g ON c.year = g.year""",
    "survey", "totals",
)
check("op_complement_pct", f"SELECT year, level, region, gender, rate, {even('100 - rate', 2)} AS rest FROM survey", "survey")
check(
    "op_sort_category",
    f"SELECT level, rate, {RANK} AS category_rank FROM totals WHERE year = {LAST}",
    "survey", "totals",
)

# profiles
check("op_drop_columns", "SELECT record_id, length, spaces, periods, outcome FROM records", "records")
_filled = ", ".join(
    f"{rnd(f'CASE WHEN {c} = 0 THEN (SELECT avg({c}) FROM records) ELSE {c} END')} AS {c}"
    for c in ("length", "spaces", "periods", "marks", "zeros")
)
check("op_zero_as_missing", f"SELECT record_id, {_filled}, toxic, outcome FROM records", "records")
check(
    "op_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(v) AS count, {rnd('avg(v)')} AS mean, {rnd('stddev_samp(v)')} AS std, min(v) AS min, max(v) AS max,
            {rnd('quantile_cont(v, 0.25)')} AS p25, {rnd('quantile_cont(v, 0.5)')} AS p50, {rnd('quantile_cont(v, 0.75)')} AS p75
            FROM (SELECT CAST({c} AS DOUBLE) AS v FROM clean)"""
        for c in ("ram_gb", "rom_gb", "price", "quantity_sold", "revenue", "dispatch_delay_days")
    ),
    "clean",
)
_columns = [
    "order_id", "customer_name", "product_type", "brand", "processor", "ram_gb", "rom_gb", "price", "quantity_sold", "region",
    "inward_date", "dispatch_date", "customer_age", "gender", "income_bracket",
]
check(
    "op_null_counts",
    "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM flat" for c in _columns)
    + ") WHERE nulls > 0",
    "flat",
)
_stages = [
    ("raw", "SELECT count(*) FROM flat"),
    ("deduplicated", "SELECT count(*) FROM deduped"),
    ("critical columns known", "SELECT count(*) FROM usable"),
    ("positive price", "SELECT count(*) FROM usable"),
    ("price trimmed", "SELECT count(*) FROM clean"),
]
check(
    "op_stage_audit",
    "SELECT step, stage, rows_after, coalesce(lag(rows_after) OVER (ORDER BY step) - rows_after, 0) AS removed FROM ("
    + " UNION ALL ".join(f"SELECT {i} AS step, '{n}' AS stage, ({q}) AS rows_after" for i, (n, q) in enumerate(_stages))
    + ")",
    "flat", "deduped", "usable", "clean",
)
check(
    "op_shape_range",
    f"""SELECT count(*) AS n_rows, {day('min(inward_date)')} AS first_date, {day('max(inward_date)')} AS last_date,
               {dbl('sum(revenue)')} AS total_revenue, count(DISTINCT customer_name) AS customers FROM clean""",
    "clean",
)

"""Check statements of the retail queries."""

from __future__ import annotations

from checks.sql import ACTIONS, DATE_COLUMNS, SALES_ORDER, big, day, dbl, even, rnd, statement, title

CHECKS: dict[str, str] = {}


def check(name: str, body: str, *needs: str) -> None:
    CHECKS[name] = statement(body, *needs)


# files
check("op_read_csv", f"SELECT c_custkey, c_name, c_nationkey, {rnd('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer")
check(
    "op_read_csv_dates",
    f"SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {day('o_orderdate')} END AS order_date FROM orders",
)
check(
    "op_inline_table",
    f"""SELECT a.segment, a.recommended_action, c.customers FROM {ACTIONS}
        JOIN (SELECT segment, count(*) AS customers FROM rfm GROUP BY segment) c ON a.segment = c.segment""",
    "rfm",
)
check("op_write_csv", f"SELECT region, count(*) AS n, {dbl('sum(revenue)')} AS revenue FROM clean GROUP BY region", "clean")
check(
    "op_sql_read",
    f"""SELECT p.brand, r.region_name, count(*) AS orders, {dbl('sum(f.revenue)')} AS revenue
        FROM fact f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_region r ON f.region_key = r.region_key
        GROUP BY p.brand, r.region_name""",
    "fact",
)
_first = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY inward_date, dispatch_date, price,
              quantity_sold, customer_name) AS place FROM flat {{where}}) WHERE place = 1)"""
check(
    "op_upsert_ignore",
    f"""SELECT order_id, customer_name, {dbl('price')} AS price FROM (
          SELECT * FROM {_first.format(where='WHERE quantity_sold <= 25')}
          UNION ALL
          SELECT * FROM {_first.format(where='')}
          WHERE order_id NOT IN (SELECT order_id FROM flat WHERE quantity_sold <= 25))""",
    "flat",
)
check(
    "op_star_schema",
    """SELECT 'dim_region' AS table_name, count(*) AS n_rows FROM dim_region
       UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer UNION ALL SELECT 'dim_product', count(*) FROM dim_product
       UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'fact_sales', count(*) FROM fact""",
    "fact", "dim_date",
)
_damaged = """(SELECT * REPLACE (CASE WHEN order_id % 50 <> 0 THEN product_key END AS product_key) FROM fact
              UNION ALL
              SELECT * REPLACE (CASE WHEN order_id % 50 <> 0 THEN product_key END AS product_key) FROM fact WHERE order_id % 40 = 0)"""
_kept = "(SELECT * FROM dim_product WHERE product_key % 10 <> 0)"


def _line(table: str, rule: str, columns: str, count: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{columns}' AS columns, CAST(({count}) AS BIGINT) AS violations"


def _repeats(source: str, columns: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {columns} HAVING count(*) > 1)"


def _nulls(source: str, column: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} IS NULL"


def _orphans(column: str, parent: str, key: str) -> str:
    return f"SELECT count(*) FROM {_damaged} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"


_lines = [
    _line("dim_customer", "primary", "customer_key", _repeats("dim_customer", "customer_key")),
    _line("dim_customer", "unique", "customer_name", _repeats("dim_customer", "customer_name")),
    _line("dim_customer", "required", "customer_name", _nulls("dim_customer", "customer_name")),
    _line("dim_product", "primary", "product_key", _repeats(_kept, "product_key")),
    _line("dim_product", "unique", "product_type,brand,processor,ram_gb,rom_gb", _repeats(_kept, "product_type,brand,processor,ram_gb,rom_gb")),
    _line("dim_product", "required", "product_type", _nulls(_kept, "product_type")),
    _line("dim_product", "required", "brand", _nulls(_kept, "brand")),
    _line("dim_region", "primary", "region_key", _repeats("dim_region", "region_key")),
    _line("dim_region", "unique", "region_name", _repeats("dim_region", "region_name")),
    _line("dim_region", "required", "region_name", _nulls("dim_region", "region_name")),
    _line("dim_date", "primary", "date_key", _repeats("dim_date", "date_key")),
    _line("dim_date", "unique", "full_date", _repeats("dim_date", "full_date")),
    _line("dim_date", "required", "full_date", _nulls("dim_date", "full_date")),
    _line("fact_sales", "primary", "order_id", _repeats(_damaged, "order_id")),
]
_lines += [
    _line("fact_sales", "required", c, _nulls(_damaged, c))
    for c in ("customer_key", "product_key", "region_key", "inward_date_key", "price", "quantity_sold", "revenue")
]
_lines += [
    _line("fact_sales", "foreign", "customer_key", _orphans("customer_key", "dim_customer", "customer_key")),
    _line("fact_sales", "foreign", "product_key", _orphans("product_key", _kept, "product_key")),
    _line("fact_sales", "foreign", "region_key", _orphans("region_key", "dim_region", "region_key")),
    _line("fact_sales", "foreign", "inward_date_key", _orphans("inward_date_key", "dim_date", "date_key")),
]
check("op_constraint_violations", " UNION ALL ".join(_lines), "fact", "dim_date")
check(
    "op_dim_calendar",
    f"""SELECT {DATE_COLUMNS} FROM (SELECT CAST(unnest(generate_series((SELECT min(d) FROM dates_seen),
        (SELECT max(d) FROM dates_seen), INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dates_seen",
)
check(
    "op_dim_month",
    """SELECT CAST(m AS INTEGER) AS month_index, CAST(m // 12 + 1 AS INTEGER) AS relative_year, CAST(m // 3 + 1 AS INTEGER) AS relative_quarter
       FROM (SELECT unnest(generate_series(0, (SELECT max(month_index) FROM features))) AS m)""",
    "features",
)

# star build
check("op_dim_region", "SELECT * FROM dim_region", "dim_region")
check("op_dim_customer", "SELECT * FROM dim_customer", "dim_customer")
check("op_dim_product", "SELECT * FROM dim_product", "dim_product")
check("op_dim_date", "SELECT * FROM dim_date", "dim_date")
check("op_fact_sales", f"SELECT * REPLACE ({dbl('price')} AS price, {dbl('revenue')} AS revenue) FROM fact", "fact")

# cleaning
check(
    "op_dedupe_key",
    f"""SELECT order_id, {dbl('price')} AS price, quantity_sold, region, {day('dispatch_date')} AS dispatch_date FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {SALES_ORDER}) AS place FROM flat) WHERE place = 1""",
    "flat",
)
check("op_dedupe_full", "SELECT DISTINCT customer_name, product_type, region FROM flat", "flat")
_titles = ", ".join(f"{title(f'trim({c})')} AS {c}" for c in ("region", "gender", "income_bracket", "processor"))
check(
    "op_title_trim",
    f"SELECT region, gender, income_bracket, processor, count(*) AS n FROM (SELECT {_titles} FROM flat) GROUP BY ALL",
    "flat",
)
check(
    "op_sentinel_null",
    f"SELECT region, count(*) AS n FROM (SELECT nullif({title('trim(region)')}, 'Nan') AS region FROM flat) GROUP BY region",
    "flat",
)
check("op_fill_const", "SELECT coalesce(processor, 'Unknown') AS processor, count(*) AS n FROM flat GROUP BY 1", "flat")
check(
    "op_fill_group_median",
    """SELECT f.product_type, coalesce(f.ram_gb, m.med) AS ram_gb, count(*) AS n FROM flat f
       LEFT JOIN (SELECT product_type, quantile_cont(ram_gb, 0.5) AS med FROM flat GROUP BY product_type) m
         ON f.product_type = m.product_type
       GROUP BY 1, 2""",
    "flat",
)
_cast = """SELECT order_id, CASE WHEN order_id % 101 <> 0 THEN CAST(price AS DOUBLE) END AS price,
                  CASE WHEN order_id % 103 <> 0 THEN quantity_sold END AS quantity_sold,
                  CASE WHEN order_id % 107 <> 0 THEN strftime(inward_date, '%Y-%m-%d') END AS inward_date, customer_age, region
           FROM flat"""
check("op_safe_cast", f"SELECT order_id, price, quantity_sold, inward_date, customer_age FROM ({_cast})", "flat")
check(
    "op_drop_null_critical",
    f"""SELECT order_id, price, quantity_sold, region FROM ({_cast})
        WHERE price IS NOT NULL AND quantity_sold IS NOT NULL AND inward_date IS NOT NULL AND region IS NOT NULL""",
    "flat",
)
check("op_filter_positive", f"SELECT c_custkey, {rnd('c_acctbal')} AS c_acctbal FROM customer WHERE c_acctbal > 0")
check(
    "op_quantile_trim",
    f"""SELECT order_id, {dbl('price')} AS price FROM flat
        WHERE {dbl('price')} >= (SELECT quantile_cont({dbl('price')}, 0.001) FROM flat)
          AND {dbl('price')} <= (SELECT quantile_cont({dbl('price')}, 0.999) FROM flat)""",
    "flat",
)
check("op_revenue", f"SELECT order_id, {dbl('price')} AS price, quantity_sold, {dbl('price * quantity_sold')} AS revenue FROM flat", "flat")
check(
    "op_period_cols",
    """SELECT order_id, strftime(inward_date, '%Y-%m') AS order_month, year(inward_date) || 'Q' || quarter(inward_date) AS order_quarter,
              CAST(year(inward_date) AS INTEGER) AS order_year FROM flat""",
    "flat",
)
check(
    "op_dispatch_delay",
    "SELECT order_id, CASE WHEN dispatch_date >= inward_date THEN CAST(dispatch_date - inward_date AS INTEGER) END AS dispatch_delay_days FROM flat",
    "flat",
)
check(
    "op_age_band",
    """SELECT a AS customer_age, CASE WHEN a <= 17 OR a > 100 THEN NULL WHEN a <= 24 THEN '18-24' WHEN a <= 34 THEN '25-34'
              WHEN a <= 44 THEN '35-44' WHEN a <= 54 THEN '45-54' ELSE '55+' END AS age_band, count(*) AS n
       FROM (SELECT customer_age + order_id % 40 - 5 AS a FROM flat) GROUP BY ALL""",
    "flat",
)
check(
    "op_value_map",
    f"SELECT customer_name, r.segment, recommended_action FROM rfm r LEFT JOIN {ACTIONS} ON r.segment = a.segment",
    "rfm",
)

# joins
check("op_join_inner_dim", "SELECT order_id, region_name FROM fact f JOIN dim_region r ON f.region_key = r.region_key", "fact")
check(
    "op_join_star",
    """SELECT order_id, product_type, brand, region_name FROM fact f JOIN dim_product p ON f.product_key = p.product_key
       JOIN dim_region r ON f.region_key = r.region_key""",
    "fact",
)
check(
    "op_join_left",
    """SELECT order_id, segment, rfm_total FROM clean c
       LEFT JOIN (SELECT * FROM rfm WHERE segment <> 'Champions') r ON c.customer_name = r.customer_name""",
    "clean", "rfm",
)
check("op_join_multikey", "SELECT order_id, product_key FROM fact", "fact")
check(
    "op_join_semi",
    "SELECT order_id, customer_name FROM clean WHERE customer_name IN (SELECT customer_name FROM rfm WHERE segment = 'Champions')",
    "clean", "rfm",
)
check("op_join_anti", "SELECT order_id, customer_name FROM flat WHERE order_id NOT IN (SELECT order_id FROM clean)", "flat", "clean")
check(
    "op_join_scalar",
    f"""SELECT order_id, {rnd("CAST(revenue AS DOUBLE) * 1e6 / CAST((SELECT sum(revenue) FROM clean) AS DOUBLE)")} AS ppm_of_total,
               {dbl('(SELECT max(revenue) FROM clean) - revenue')} AS below_top FROM clean""",
    "clean",
)

# star reports
check(
    "q1_monthly",
    f"""SELECT year_num, month_num, month_name, {dbl('sum(revenue)')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
               {big('sum(quantity_sold)')} AS total_units
        FROM fact JOIN dim_date ON inward_date_key = date_key GROUP BY ALL""",
    "fact", "dim_date",
)
check(
    "q2_brand",
    f"""SELECT brand, product_type, {dbl('sum(revenue)')} AS total_revenue, {big('sum(quantity_sold)')} AS total_units,
               {rnd("CAST(sum(price) AS DOUBLE) / count(price)", 0)} AS avg_price
        FROM fact f JOIN dim_product p ON f.product_key = p.product_key GROUP BY ALL""",
    "fact",
)
_share = """SELECT region_name, CAST(sum(revenue) AS DOUBLE) AS region_revenue,
            {rounded} AS {name} FROM fact f JOIN dim_region r ON f.region_key = r.region_key GROUP BY region_name"""
_pct = "CAST(sum(revenue) AS DOUBLE) * 100e0 / (SELECT CAST(sum(revenue) AS DOUBLE) FROM fact)"
check("q3_region_share", _share.format(rounded=rnd(_pct, 1), name="pct_of_total_revenue"), "fact")
check("q3b_region_share_subq", _share.format(rounded=rnd(_pct, 1), name="pct_of_total"), "fact")
check(
    "q4_top_customers",
    f"""SELECT customer_name, rfm_segment, count(DISTINCT order_id) AS total_orders, {dbl('sum(revenue)')} AS lifetime_revenue
        FROM fact f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY ALL
        ORDER BY lifetime_revenue DESC, customer_name LIMIT 10""",
    "fact",
)
check(
    "q5_segment_share",
    f"""SELECT rfm_segment, count(DISTINCT c.customer_key) AS customers_in_segment, {dbl('sum(revenue)')} AS segment_revenue,
               {rnd(_pct, 1)} AS pct_of_revenue
        FROM fact f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY rfm_segment""",
    "fact",
)
_growth = f"""SELECT year_num, month_num, monthly_revenue, prior_month_revenue,
       {rnd("(monthly_revenue - prior_month_revenue) * 100e0 / nullif(prior_month_revenue, 0)", 1)} AS mom_growth_pct
     FROM (SELECT *, lag(monthly_revenue) OVER (ORDER BY year_num, month_num) AS prior_month_revenue FROM (
        SELECT CAST(year(inward_date) AS INTEGER) AS year_num, CAST(month(inward_date) AS INTEGER) AS month_num,
               CAST(sum(revenue) AS DOUBLE) AS monthly_revenue FROM clean GROUP BY ALL))"""
check("q6_mom", _growth, "clean")
check(
    "op_drop_alert",
    f"SELECT * FROM ({_growth}) WHERE (monthly_revenue - prior_month_revenue) * 100e0 / nullif(prior_month_revenue, 0) < -10",
    "clean",
)
check(
    "q7_delay",
    f"""SELECT product_type, region_name, {rnd("CAST(sum(dispatch_delay_days) AS DOUBLE) / count(dispatch_delay_days)", 1)} AS avg_dispatch_delay_days,
               count(*) AS orders
        FROM fact f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_region r ON f.region_key = r.region_key
        WHERE dispatch_delay_days IS NOT NULL GROUP BY ALL""",
    "fact",
)
check(
    "q8_top3_rank",
    f"""SELECT product_type, processor, {big('units')} AS units_sold, CAST(rnk AS INTEGER) AS rnk FROM (
          SELECT product_type, processor, sum(quantity_sold) AS units,
                 rank() OVER (PARTITION BY product_type ORDER BY sum(quantity_sold) DESC) AS rnk
          FROM fact f JOIN dim_product p ON f.product_key = p.product_key GROUP BY product_type, processor) WHERE rnk <= 3""",
    "fact",
)
_months = """(SELECT DISTINCT customer_name, CAST(date_trunc('month', inward_date) AS DATE) AS m,
              min(CAST(date_trunc('month', inward_date) AS DATE)) OVER (PARTITION BY customer_name) AS cohort FROM clean)"""
check(
    "q9_cohort_m2",
    f"""SELECT {day('cohort')} AS cohort_month, count(DISTINCT customer_name) AS cohort_size,
               count(DISTINCT CASE WHEN m = cohort + INTERVAL 1 MONTH THEN customer_name END) AS retained_month_2
        FROM {_months} GROUP BY cohort""",
    "clean",
)
check(
    "q10_demographics",
    f"""SELECT age_band, income_bracket, {dbl('sum(revenue)')} AS total_revenue, count(DISTINCT c.customer_key) AS customers
        FROM fact f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY ALL""",
    "fact",
)

# flat reports
_orders = "count(DISTINCT order_id)"
_people = "count(DISTINCT customer_name)"
check(
    "op_exec_kpis",
    f"""SELECT {dbl('sum(revenue)')} AS total_revenue, {_orders} AS total_orders, {big('sum(quantity_sold)')} AS total_units,
               {_people} AS unique_customers,
               {rnd("CAST(sum(dispatch_delay_days) AS DOUBLE) / count(dispatch_delay_days)")} AS avg_dispatch_delay,
               {rnd(f"CAST(sum(revenue) AS DOUBLE) / {_orders}")} AS average_order_value,
               {rnd(f"CAST(sum(revenue) AS DOUBLE) / {_people}")} AS revenue_per_customer
        FROM clean""",
    "clean",
)
_mean_price = rnd("CAST(sum(price) AS DOUBLE) / count(price)")
check(
    "op_kpi_by_type",
    f"""SELECT product_type, {dbl('sum(revenue)')} AS revenue, {big('sum(quantity_sold)')} AS units, {_mean_price} AS avg_price
        FROM clean WHERE product_type IS NOT NULL GROUP BY product_type""",
    "clean",
)
check("op_topn_brand", f"SELECT brand, {dbl('sum(revenue)')} AS revenue FROM clean GROUP BY brand ORDER BY 2 DESC, 1 LIMIT 5", "clean")
check("op_topn_processor", f"SELECT processor, {dbl('sum(quantity_sold)')} AS units FROM clean GROUP BY processor ORDER BY 2 DESC, 1 LIMIT 5", "clean")
check(
    "op_region_kpis",
    f"""SELECT region, {dbl('sum(revenue)')} AS revenue, {_orders} AS orders, {_people} AS customers,
               {even("CAST(sum(revenue) AS DOUBLE) / (SELECT CAST(sum(revenue) AS DOUBLE) FROM clean) * 100", 1)} AS revenue_share_pct
        FROM clean GROUP BY region""",
    "clean",
)
_monthly = "(SELECT order_month AS m, CAST(sum(revenue) AS DOUBLE) AS v FROM clean GROUP BY order_month)"
check(
    "op_best_worst_month",
    f"""SELECT b.m AS best_month, b.v AS best_revenue, w.m AS worst_month, w.v AS worst_revenue
        FROM (SELECT * FROM {_monthly} ORDER BY v DESC, m LIMIT 1) b, (SELECT * FROM {_monthly} ORDER BY v, m LIMIT 1) w""",
    "clean",
)
for _name, _key in (("op_quarterly", "order_quarter"), ("op_by_age_band", "age_band"), ("op_by_income", "income_bracket")):
    check(_name, f"SELECT {_key}, {dbl('sum(revenue)')} AS revenue FROM clean WHERE {_key} IS NOT NULL GROUP BY {_key}", "clean")
check(
    "op_kpi_summary",
    f"""SELECT unnest(['Total Revenue', 'Total Orders', 'Total Units Sold', 'Average Order Value', 'Unique Customers', 'Top Region',
                       'Top Brand', 'Best Month', 'Avg Dispatch Delay (days)']) AS kpi,
               unnest([format('Rs.{{:,.0f}}', rev), format('{{:,}}', orders), format('{{:,}}', units), format('Rs.{{:,.0f}}', rev / orders),
                       format('{{:,}}', people),
                       (SELECT region FROM clean GROUP BY region ORDER BY sum(revenue) DESC, region LIMIT 1),
                       (SELECT brand FROM clean GROUP BY brand ORDER BY sum(revenue) DESC, brand LIMIT 1),
                       (SELECT m FROM {_monthly} ORDER BY v DESC, m LIMIT 1), format('{{:.1f}}', delay)]) AS value
        FROM (SELECT {dbl('sum(revenue)')} AS rev, {_orders} AS orders, {big('sum(quantity_sold)')} AS units, {_people} AS people,
                     {even("CAST(sum(dispatch_delay_days) AS DOUBLE) / count(dispatch_delay_days)", 1)} AS delay FROM clean)""",
    "clean",
)
check("op_month_combo", f"SELECT order_month, {dbl('sum(revenue)')} AS revenue, {_orders} AS orders FROM clean GROUP BY order_month", "clean")
check("op_spec_table", f"SELECT ram_gb, rom_gb, {big('sum(quantity_sold)')} AS units, {_mean_price} AS avg_price FROM clean GROUP BY ALL", "clean")
check("op_price_volume", f"SELECT brand, {_mean_price} AS avg_price, {big('sum(quantity_sold)')} AS units FROM clean GROUP BY brand", "clean")
check(
    "op_region_scorecard",
    f"""SELECT region, {_orders} AS orders, {dbl('sum(revenue)')} AS revenue,
               {rnd("CAST(sum(dispatch_delay_days) AS DOUBLE) / count(dispatch_delay_days)")} AS avg_delay, {_people} AS customers,
               {rnd("CAST(sum(revenue) AS DOUBLE) / (SELECT CAST(sum(revenue) AS DOUBLE) FROM clean)")} AS revenue_share
        FROM clean GROUP BY region""",
    "clean",
)
_kpis = "(SELECT unnest(['revenue', 'orders', 'units', 'customers']) AS kpi, unnest([CAST(sum(revenue) AS DOUBLE), count(DISTINCT order_id), sum(quantity_sold), count(DISTINCT {who})]) AS value FROM {source})"
check(
    "op_kpi_reconcile",
    f"""SELECT kpi, {dbl('a.value')} AS flat_value, {dbl('b.value')} AS star_value, {dbl('a.value - b.value')} AS difference
        FROM {_kpis.format(who='customer_name', source='clean')} a FULL JOIN {_kpis.format(who='customer_key', source='fact')} b USING (kpi)""",
    "clean", "fact",
)
check(
    "op_share_of_total",
    f"""SELECT region, product_type, revenue, {rnd("revenue / sum(revenue) OVER (PARTITION BY product_type)")} AS share
        FROM (SELECT region, product_type, {dbl('sum(revenue)')} AS revenue FROM clean GROUP BY ALL)""",
    "clean",
)

# RFM, growth, cohorts
check("op_rfm_base", f"SELECT customer_name, recency, frequency, {dbl('monetary')} AS monetary FROM rfm_base", "rfm_base")
check(
    "op_rfm_scores",
    f"""SELECT customer_name, recency, frequency, {dbl('monetary')} AS monetary, r_score, f_score, m_score, rfm_score, rfm_total FROM rfm""",
    "rfm",
)
check(
    "op_rfm_segment",
    f"SELECT customer_name, rfm_score, r.segment, recommended_action FROM rfm r JOIN {ACTIONS} ON r.segment = a.segment",
    "rfm",
)
check("op_rfm_attach", "SELECT order_id, segment, rfm_total FROM clean c LEFT JOIN rfm r ON c.customer_name = r.customer_name", "clean", "rfm")
check(
    "op_segment_summary",
    f"""SELECT segment, count(*) AS customers, {rnd("CAST(sum(monetary) AS DOUBLE) / count(*)")} AS avg_monetary,
               {rnd("CAST(sum(frequency) AS DOUBLE) / count(*)")} AS avg_frequency, {rnd("CAST(sum(recency) AS DOUBLE) / count(*)")} AS avg_recency
        FROM rfm GROUP BY segment""",
    "rfm",
)
_some = "(SELECT CAST(date_trunc('month', inward_date) AS DATE) AS month, CAST(sum(revenue) AS DOUBLE) AS v FROM clean GROUP BY 1)"
check(
    "op_prior_calendar_month",
    f"""SELECT {day('a.month')} AS month, a.v AS monthly_revenue, b.v AS prior_month_revenue, {rnd("(a.v - b.v) / b.v")} AS growth
        FROM {_some} a LEFT JOIN {_some} b ON a.month = b.month + INTERVAL 1 MONTH""",
    "clean",
)
check(
    "op_cohort_curve",
    f"""SELECT {day('cohort')} AS cohort_month, CAST(o AS INTEGER) AS month_offset, active, size AS cohort_size,
               {rnd("CAST(active AS DOUBLE) / size")} AS retention
        FROM (SELECT cohort, datediff('month', cohort, m) AS o, count(*) AS active,
                     max(count(*) FILTER (m = cohort)) OVER (PARTITION BY cohort) AS size
              FROM {_months} GROUP BY cohort, o) WHERE o <= 12""",
    "clean",
)

# sort, limit, set operations
check("op_limit", f"SELECT order_id, {dbl('revenue')} AS revenue FROM clean ORDER BY revenue DESC, order_id LIMIT 100", "clean")
check(
    "op_union_all",
    f"""SELECT kind, {day('d')} AS day, count(*) AS n FROM (SELECT 'inward' AS kind, inward_date AS d FROM clean
        UNION ALL SELECT 'dispatch', dispatch_date FROM clean) GROUP BY kind, d""",
    "clean",
)
check("op_distinct", "SELECT DISTINCT customer_name, order_month FROM clean", "clean")
check(
    "op_sort_multi",
    f"""SELECT order_year, region, revenue, row_number() OVER (ORDER BY order_year, revenue DESC, region) AS position
        FROM (SELECT order_year, region, {dbl('sum(revenue)')} AS revenue FROM clean GROUP BY ALL)""",
    "clean",
)

# scalar functions
check(
    "fn_string",
    f"""SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, {title("(p_name || ' 7s-pro')")} AS titled, upper(p_name) AS shouted,
               replace(p_name, ' ', '_') AS snake, p_type || '/' || p_brand AS joined, CAST(p_size AS VARCHAR) AS size_text FROM part""",
)
check(
    "fn_format",
    f"""SELECT o_orderkey, format('Rs.{{:,.0f}}', round_even(CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE), 0)) AS money,
               format('{{:,}}', o_orderkey * 1000) AS whole,
               format('{{:.1f}}', {even("(o_orderkey % 97) / 8", 1)}) AS one_decimal,
               format('{{:.0f}}%', round_even((o_orderkey % 64) / 64 * 100, 0)) AS percent
        FROM orders""",
)
check(
    "fn_date",
    f"""SELECT o_orderkey, {day('d')} AS parsed, {day('d + 1')} AS next_day, CAST(DATE '2002-01-01' - d AS INTEGER) AS age_days,
               CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, CAST(quarter(d) AS INTEGER) AS q, dayname(d) AS day_name,
               monthname(d) AS month_name, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
               {day("date_trunc('month', d)")} AS month_start, {day("d + INTERVAL 1 MONTH")} AS next_month
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
check(
    "fn_math",
    f"""SELECT c_custkey, {rnd('c_acctbal', 0)} AS up, {even('c_acctbal', 1)} AS even, {rnd('abs(c_acctbal)')} AS size,
               {rnd('least(5000e0, greatest(0e0, c_acctbal))')} AS clipped, CAST(c_custkey // 12 AS INTEGER) AS dozens,
               {rnd('greatest(0e0, c_acctbal)')} AS not_negative FROM customer""",
)
check(
    "fn_conditional",
    """SELECT order_id, CASE WHEN price > 50000 THEN 'high' WHEN price > 20000 THEN 'mid' ELSE 'low' END AS band,
              coalesce(processor, 'none') AS processor, CAST(ram_gb IS NOT NULL AS INTEGER) AS has_ram FROM flat""",
    "flat",
)

"""Fixed schemas; nothing in the engine relies on inferred types."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


PRICE = T.DecimalType(12, 2)
REVENUE = T.DecimalType(14, 2)

# Flat sales, one row per order line.
SALES = _schema(
    order_id=T.LongType(),
    customer_name=T.StringType(),
    product_type=T.StringType(),
    brand=T.StringType(),
    processor=T.StringType(),
    ram_gb=T.DoubleType(),
    rom_gb=T.DoubleType(),
    price=PRICE,
    quantity_sold=T.IntegerType(),
    region=T.StringType(),
    inward_date=T.DateType(),
    dispatch_date=T.DateType(),
    customer_age=T.IntegerType(),
    gender=T.StringType(),
    income_bracket=T.StringType(),
)
# The same row as it arrives in a text export: everything is text.
SALES_TEXT = _schema(**{field.name: T.StringType() for field in SALES})

DIM_CUSTOMER = _schema(
    customer_key=T.LongType(),
    customer_name=T.StringType(),
    age=T.IntegerType(),
    gender=T.StringType(),
    income_bracket=T.StringType(),
    age_band=T.StringType(),
    rfm_segment=T.StringType(),
    rfm_total_score=T.IntegerType(),
)
DIM_PRODUCT = _schema(
    product_key=T.LongType(),
    product_type=T.StringType(),
    brand=T.StringType(),
    processor=T.StringType(),
    ram_gb=T.DoubleType(),
    rom_gb=T.DoubleType(),
)
DIM_REGION = _schema(region_key=T.LongType(), region_name=T.StringType())
DIM_DATE = _schema(
    date_key=T.IntegerType(),
    full_date=T.DateType(),
    day_name=T.StringType(),
    month_name=T.StringType(),
    month_num=T.IntegerType(),
    quarter_num=T.IntegerType(),
    year_num=T.IntegerType(),
)
FACT_SALES = _schema(
    order_id=T.LongType(),
    customer_key=T.LongType(),
    product_key=T.LongType(),
    region_key=T.LongType(),
    inward_date_key=T.IntegerType(),
    dispatch_date_key=T.IntegerType(),
    price=PRICE,
    quantity_sold=T.IntegerType(),
    revenue=REVENUE,
    dispatch_delay_days=T.IntegerType(),
)

# Contract of the star: primary key, unique, not-null and foreign-key columns.
STAR_CONTRACT = {
    "dim_customer": {"primary": ["customer_key"], "unique": [["customer_name"]], "required": ["customer_name"]},
    "dim_product": {
        "primary": ["product_key"],
        "unique": [["product_type", "brand", "processor", "ram_gb", "rom_gb"]],
        "required": ["product_type", "brand"],
    },
    "dim_region": {"primary": ["region_key"], "unique": [["region_name"]], "required": ["region_name"]},
    "dim_date": {"primary": ["date_key"], "unique": [["full_date"]], "required": ["full_date"]},
    "fact_sales": {
        "primary": ["order_id"],
        "unique": [],
        "required": ["customer_key", "product_key", "region_key", "inward_date_key", "price", "quantity_sold", "revenue"],
        "foreign": {
            "customer_key": ("dim_customer", "customer_key"),
            "product_key": ("dim_product", "product_key"),
            "region_key": ("dim_region", "region_key"),
            "inward_date_key": ("dim_date", "date_key"),
        },
    },
}

# --- fixed values: feature names of the risk models ---------------------------
METRICS = [
    "mrr", "cash_on_hand", "burn_rate", "runway_months", "churn_rate",
    "cac_payback_months", "nps_score", "headcount", "attrition_rate",
    "product_release_count", "press_mentions", "glassdoor_rating",
    "ltv_cac_ratio", "growth_rate_mom",
]
TREND_METRICS = ["mrr", "churn_rate", "runway_months", "headcount", "nps_score", "burn_rate"]
VOLATILITY_METRICS = ["churn_rate", "growth_rate_mom", "burn_rate"]
STATIC_NUMERIC = ["founded_year", "founder_count", "founder_prior_exits", "founder_technical_pct", "initial_capital"]
STATIC_CATEGORIES = ["sector", "region", "initial_funding_stage"]
LABEL = "label_fail_within_6m"
# ------------------------------------------------------------------------------

ENGINEERED = (
    [f"{m}_latest" for m in METRICS]
    + [f"{m}_{kind}" for m in TREND_METRICS for kind in ("slope_3m", "slope_6m", "pct_change_6m")]
    + [f"{m}_volatility_6m" for m in VOLATILITY_METRICS]
    + [
        "consecutive_neg_growth_months", "consecutive_low_runway_months", "consecutive_high_churn_months",
        "founder_conflict_ever", "months_since_founder_conflict",
        "burn_multiple", "capital_efficiency", "ltv_cac_slope_6m", "composite_risk_index",
    ]
)
NUMERIC_FEATURES = ENGINEERED + STATIC_NUMERIC + ["company_age_months_at_t"]
FEATURES = NUMERIC_FEATURES + STATIC_CATEGORIES
SNAPSHOT_NUMERIC = (
    [f"{m}_latest" for m in METRICS]
    + ["founder_conflict_ever", "burn_multiple", "capital_efficiency", "composite_risk_index"]
    + STATIC_NUMERIC
    + ["company_age_months_at_t"]
)
SNAPSHOT_FEATURES = SNAPSHOT_NUMERIC + STATIC_CATEGORIES

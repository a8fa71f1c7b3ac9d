"""Leakage-safe features over an entity-month panel.

All windows look back only.  They run on *blocks* of consecutive row positions
of an entity instead of on whole entities, so an entity that holds a third of
the panel is spread over many tasks:

* a rolling frame of ``w`` rows needs the ``w - 1`` rows before its block, which
  travel along as halo copies;
* a running sum or running maximum needs one number from all earlier blocks,
  which comes from a small table with one row per entity and block.

Run lengths and "rows since" counters are differences to a running maximum of
row positions, so they need nothing beyond that.

A panel holds one row per entity and month; ``clean.keep_first`` makes it so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.numbers import clip, guarded_ratio
from tidemark.schemas import (
    ENGINEERED,
    LABEL,
    METRICS,
    STATIC_CATEGORIES,
    STATIC_NUMERIC,
    TREND_METRICS,
    VOLATILITY_METRICS,
)

# --- fixed values ---------------------------------------------------------------
HORIZON = 6          # months the label looks ahead
MIN_HISTORY = 3      # first month index that is kept
SHORT, LONG = 3, 6   # rolling frames in rows
NEVER = 999          # "months since" when it never happened
NO_REVENUE = 99.0    # burn multiple without revenue
# ----------------------------------------------------------------------------------
BLOCK = 1024         # row positions per block; any size gives the same result
HALO = LONG - 1


def with_row_position(panel: DataFrame, order: str = "month_index", span: int = BLOCK) -> DataFrame:
    """Add ``_pos``, the 0-based row number inside the entity, for panels whose
    months have gaps.  Rows are numbered inside spans of ``order`` values and
    shifted by the number of rows in earlier spans."""
    placed = panel.withColumn("_span", F.floor(F.col(order) / span))
    sizes = placed.groupBy("company_id", "_span").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("company_id").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "company_id", "_span", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("company_id", "_span").orderBy(order)
    return (
        placed.join(offsets, ["company_id", "_span"])
        .withColumn("_pos", (F.col("_offset") + F.row_number().over(inside) - 1).cast("long"))
        .drop("_span", "_offset")
    )


def _flags() -> dict[str, Column]:
    """Monthly stress flags; a missing metric raises no flag."""
    raw = {
        "neg_growth": F.col("growth_rate_mom") < 0,
        "low_runway": F.col("runway_months") < 6,
        "high_churn": F.col("churn_rate") > 0.15,
        "conflict": F.col("founder_conflict_flag") == 1,
    }
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in raw.items()}


def _scan_inputs() -> dict[str, Column]:
    """Columns whose running maximum or sum the features need."""
    flags = _flags()
    marks = {
        f"_calm_{name}": F.when(~flags[name], F.col("_pos"))
        for name in ("neg_growth", "low_runway", "high_churn")
    }
    marks["_conflict_at"] = F.when(flags["conflict"], F.col("_pos"))
    return marks


def blocked(panel: DataFrame, position: str = "month_index", block: int = BLOCK) -> DataFrame:
    """Give every row its block and add halo copies of the rows before a block."""
    pos = panel.withColumn("_pos", F.col(position).cast("long"))
    own = F.floor(F.col("_pos") / block)
    tail = F.col("_pos") % block >= block - HALO
    homes = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        pos.withColumn("_block", F.explode(homes))
        .withColumn("_halo", F.floor(F.col("_pos") / block) != F.col("_block"))
        .withColumns(_scan_inputs())
    )


def carried(rows: DataFrame) -> DataFrame:
    """Per entity and block: running values of all earlier blocks."""
    marks = list(_scan_inputs())
    own = rows.where(~F.col("_halo"))
    per_block = own.groupBy("company_id", "_block").agg(
        F.sum("burn_rate").alias("_burn"), *[F.max(m).alias(m) for m in marks]
    )
    earlier = (
        Window.partitionBy("company_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return per_block.select(
        "company_id",
        "_block",
        F.coalesce(F.sum("_burn").over(earlier), F.lit(0.0)).alias("_burn_carry"),
        *[F.max(m).over(earlier).alias(f"{m}_carry") for m in marks],
    )


def _in_block() -> WindowSpec:
    return Window.partitionBy("company_id", "_block").orderBy("_pos")


def rolling_slope(metric: str, frame: int) -> Column:
    """Least-squares slope over the last ``frame`` rows, 0 below two rows."""
    rows = _in_block().rowsBetween(-(frame - 1), 0)
    return F.coalesce(F.regr_slope(F.col(metric).cast("double"), F.col("_pos").cast("double")).over(rows), F.lit(0.0))


def pct_change(metric: str) -> Column:
    """Change against the row five back, relative to its size; 0 without a base."""
    base = F.lag(metric, LONG - 1).over(_in_block()).cast("double")
    return F.when(base != 0, (F.col(metric) - base) / F.abs(base)).otherwise(0.0)


def rolling_std(metric: str) -> Column:
    """Sample deviation over six rows, 0 for a single row."""
    rows = _in_block().rowsBetween(-(LONG - 1), 0)
    return F.coalesce(F.stddev_samp(F.col(metric).cast("double")).over(rows), F.lit(0.0))


def _last_at(mark: str) -> Column:
    """Position of the latest mark up to this row, null if there was none."""
    so_far = _in_block().rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(~F.col("_halo"), F.col(mark))
    return F.greatest(F.max(own).over(so_far), F.col(f"{mark}_carry"))


def trailing_run(flag: str) -> Column:
    """Length of the flag's current run: distance to the last row without it."""
    return (F.col("_pos") - F.coalesce(_last_at(f"_calm_{flag}"), F.lit(-1))).cast("int")


def cumulative_burn() -> Column:
    so_far = _in_block().rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("_halo"), 0.0).otherwise(F.col("burn_rate"))
    return F.col("_burn_carry") + F.sum(own).over(so_far)


def risk_index() -> Column:
    """Weighted sum of eight conditions, clipped to 0..100."""
    rules = [
        (25, F.col("runway_months_latest") < 6),
        (15, F.col("consecutive_neg_growth_months") >= 2),
        (15, F.col("churn_rate_latest") > 0.20),
        (10, F.col("consecutive_high_churn_months") >= 2),
        (10, F.col("ltv_cac_ratio_latest") < 1.0),
        (10, F.col("attrition_rate_latest") > 0.15),
        (10, F.col("glassdoor_rating_latest") < 2.5),
        (5, F.col("founder_conflict_ever") == 1),
    ]
    points = sum(F.when(rule, float(weight)).otherwise(0.0) for weight, rule in rules)
    return clip(points, 0.0, 100.0)


def forward_label(exclude_acquired: bool = False) -> Column:
    """1 if the entity ends within the next six months, strictly after this row.

    ``fail_month`` is also set on acquisition; ``exclude_acquired`` keeps those
    endings out of the positives.
    """
    ends = (F.col("fail_month") > F.col("month_index")) & (
        F.col("fail_month") <= F.col("month_index") + HORIZON
    )
    if exclude_acquired:
        ends = ends & ~F.col("acquired")
    return F.when(ends, 1).otherwise(0)


def history_filter(rows: DataFrame) -> DataFrame:
    """Keep rows with enough history and before the entity's end.  It runs after
    the windows: the dropped rows are part of their frames."""
    ended = (F.col("fail_month") != -1) & (F.col("fail_month") <= F.col("month_index"))
    return rows.where((F.col("month_index") >= MIN_HISTORY) & ~ended)


def window_features(
    panel: DataFrame, position: str | None = None, block: int = BLOCK
) -> DataFrame:
    """Every engineered column for every panel row.

    ``None`` computes the positions of an entity's rows; ``position`` names a
    column that is known to number them from 0 without gaps, which saves a sort.
    """
    if position is None:
        panel, position = with_row_position(panel), "_pos"
    rows = blocked(panel, position, block)
    rows = rows.join(carried(rows), ["company_id", "_block"])
    burn = cumulative_burn()
    conflict = _last_at("_conflict_at")
    rows = rows.withColumns(
        {
            **{
                f"{m}_{name}": expr
                for m in TREND_METRICS
                for name, expr in (
                    ("slope_3m", rolling_slope(m, SHORT)),
                    ("slope_6m", rolling_slope(m, LONG)),
                    ("pct_change_6m", pct_change(m)),
                )
            },
            **{f"{m}_volatility_6m": rolling_std(m) for m in VOLATILITY_METRICS},
            "ltv_cac_slope_6m": rolling_slope("ltv_cac_ratio", LONG),
            "consecutive_neg_growth_months": trailing_run("neg_growth"),
            "consecutive_low_runway_months": trailing_run("low_runway"),
            "consecutive_high_churn_months": trailing_run("high_churn"),
            "_conflict": conflict,
            "_burn_so_far": burn,
        }
    ).where(~F.col("_halo"))
    rows = rows.withColumns(
        {
            **{f"{m}_latest": F.col(m) for m in METRICS},
            "founder_conflict_ever": F.when(F.col("_conflict").isNotNull(), 1).otherwise(0),
            "months_since_founder_conflict": F.coalesce(
                F.col("_pos") - F.col("_conflict"), F.lit(NEVER)
            ).cast("int"),
            "burn_multiple": guarded_ratio(F.col("burn_rate"), F.col("mrr"), NO_REVENUE),
            "capital_efficiency": guarded_ratio(F.col("mrr") * 12, F.col("_burn_so_far"), 0.0),
        }
    )
    return rows.withColumn("composite_risk_index", risk_index())


def panel_features(
    panel: DataFrame,
    position: str | None = None,
    exclude_acquired: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Panel -> feature rows with the forward label."""
    rows = window_features(panel, position, block).withColumn(LABEL, forward_label(exclude_acquired))
    return history_filter(rows).select("company_id", "month_index", *ENGINEERED, LABEL)


def attach_static(features: DataFrame, entities: DataFrame) -> DataFrame:
    """Master columns on every feature row; age is the month index."""
    static = entities.select("company_id", *STATIC_CATEGORIES, *STATIC_NUMERIC)
    return features.join(static, "company_id", "left").withColumn(
        "company_age_months_at_t", F.col("month_index")
    )


def latest_row(df: DataFrame, order: str = "month_index") -> DataFrame:
    """The last row per entity, reduced on the map side."""
    rest = [c for c in df.columns if c != "company_id"]
    return (
        df.groupBy("company_id")
        .agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
        .select(*[F.col("company_id") if c == "company_id" else F.col(f"_last.{c}").alias(c) for c in df.columns])
    )


def sample_row(df: DataFrame, seed: int = 42, order: str = "month_index") -> DataFrame:
    """One pseudo-random row per entity, the same one on every run."""
    draw = F.md5(F.concat_ws("|", F.col("company_id").cast("string"), F.col(order).cast("string"), F.lit(str(seed))))
    first = Window.partitionBy("company_id").orderBy(draw, order)
    return df.withColumn("_draw", F.row_number().over(first)).where("_draw = 1").drop("_draw")


def snapshot_derive(forms: DataFrame) -> DataFrame:
    """Derived columns of a single-snapshot record.  Without a history, burn so
    far is burn times age and the index has no run-length terms."""
    age = F.greatest(F.col("company_age_months_at_t"), F.lit(1))
    rules = [
        (25, F.col("runway_months_latest") < 6),
        (15, F.col("growth_rate_mom_latest") < 0),
        (15, F.col("churn_rate_latest") > 0.20),
        (10, F.col("ltv_cac_ratio_latest") < 1.0),
        (10, F.col("attrition_rate_latest") > 0.15),
        (10, F.col("glassdoor_rating_latest") < 2.5),
        (5, F.col("founder_conflict_ever") == 1),
    ]
    points = sum(F.when(rule, float(weight)).otherwise(0.0) for weight, rule in rules)
    return forms.withColumns(
        {
            "burn_multiple": guarded_ratio(F.col("burn_rate_latest"), F.col("mrr_latest"), NO_REVENUE),
            "capital_efficiency": F.when(
                F.col("burn_rate_latest") > 0,
                F.col("mrr_latest") * 12 / (F.col("burn_rate_latest") * age),
            ).otherwise(0.0),
            "composite_risk_index": clip(points, high=100.0),
        }
    )

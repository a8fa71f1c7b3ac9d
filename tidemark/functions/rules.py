"""Business rules as ``CASE`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Upper edges of the right-closed age bands; ages up to 17 and over 100 have no band.
AGE_BANDS = ((24, "18-24"), (34, "25-34"), (44, "35-44"), (54, "45-54"), (100, "55+"))
AGE_FLOOR = 17
# Risk tiers: Low up to 0.15, Watch up to 0.45, High above.
TIER_EDGES = (0.15, 0.45)
TIER_NAMES = ("Low", "Watch", "High")
# ----------------------------------------------------------------------------


def age_band(age: Column) -> Column:
    """Right-closed bands; an age outside every band gives null."""
    band = F.when(age <= AGE_FLOOR, F.lit(None).cast("string"))
    for upper, label in AGE_BANDS:
        band = band.when(age <= upper, label)
    return band


def risk_tier(score: Column, closed: str = "right") -> Column:
    """Tier of a probability.  ``closed='right'`` puts an edge value in the lower
    tier (the export rule), ``closed='left'`` in the higher one (the form rule)."""
    low, high = TIER_EDGES
    if closed == "right":
        below = (score <= low, score <= high)
    elif closed == "left":
        below = (score < low, score < high)
    else:
        raise ValueError("closed must be 'right' or 'left'")
    return (
        F.when(below[0], TIER_NAMES[0])
        .when(below[1], TIER_NAMES[1])
        .when(score.isNotNull(), TIER_NAMES[2])
    )


def outcome_label(failed: Column, acquired: Column) -> Column:
    """Failure wins over acquisition; neither means the entity is active."""
    return F.when(failed, "Failed").when(acquired, "Acquired").otherwise("Active")


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Customer segment from three quintile scores; the first matching rule wins."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "New / Promising")
        .when((r <= 2) & (f >= 4) & (m >= 4), "At Risk (High Value)")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Lost / Churned")
        .otherwise("Needs Attention")
    )

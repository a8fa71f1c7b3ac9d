"""Ranks, running totals and exact quantiles without a one-task sort.

A window without a partition key (or with a hot one) puts all its rows in one
task.  Here the rows are first counted per distinct key, which collapses hot
keys on the map side.  The distinct keys are then cut into ranges at sampled
cut points, so that every range is a window partition of its own, and the
totals of the ranges before it are added as an offset.  The cut points only
balance the work: any cut points give the same, exact answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import measured

RANGES = 1024         # ranges at least
RANGE_KEYS = 1_000_000  # distinct keys in a range at most, on average
ACCURACY = 10_000  # the sketch is off by at most 1/ACCURACY of the ranks
MARGIN = 0.001     # ten times that, to either side


def _cut_points(keys: DataFrame, key: str, ranges: int, unique: bool) -> DataFrame:
    """One row: a sorted array of at most ``ranges - 1`` distinct keys.

    Taking the smallest hashes is a repeatable sample, and a top-k is pruned in
    every task before anything is sent on.  Keys known to be unique need no
    ``distinct`` and so no shuffle.
    """
    own = keys.select(key) if unique else keys.select(key).distinct()
    return (
        own.orderBy(F.xxhash64(key), key)
        .limit(ranges - 1)
        .agg(F.sort_array(F.collect_list(key)).alias("cuts"))
    )


def _with_range(counts: DataFrame, key: str, ranges: int, unique: bool) -> DataFrame:
    """Add ``_range``: how many cut points lie below the key, by binary search.

    Every halving is a column of its own that builds on the one before, which
    keeps the search in generated code.
    """
    halvings = list(reversed(range((ranges - 1).bit_length())))
    found, steps = F.lit(0), []
    for bit in halvings:
        probe = F.get(F.col("_cuts"), found + ((1 << bit) - 1))
        steps.append((found + F.when(probe < F.col(key), 1 << bit).otherwise(0)).alias(f"_step{bit}"))
        found = F.col(f"_step{bit}")
    return (
        counts.withColumn("_cuts", _cut_points(counts, key, ranges, unique).scalar())
        .select(*counts.columns, "_cuts", *steps)
        .select(*counts.columns, found.alias("_range"))
    )


def running_totals(
    counts: DataFrame,
    key: str,
    weights: Sequence[str],
    group: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``<w>_before`` and ``<w>_total`` for every weight column.

    ``counts`` holds one row per (group, key), neither of them null.  ``before``
    sums the weight over the keys ahead of this one in its group (the smaller
    ones, or the larger ones if ``descending``), ``total`` over the whole group.
    The counts are written once, as the cut points, the offsets and the totals
    each look at them.  The number of ranges follows the number of keys.
    """
    group = list(group)
    counts = measured(counts, "counts")
    ranges = ranges or max(RANGES, -(-counts.count() // RANGE_KEYS))
    placed = _with_range(counts, key, ranges, unique=not group)

    def ahead(order: str) -> Column:
        return F.col(order).desc() if descending else F.col(order).asc()

    over_ranges = Window.partitionBy(*group).orderBy(ahead("_range"))
    totals = placed.groupBy(*group, "_range").agg(*[F.sum(w).alias(w) for w in weights])
    offsets = totals.select(
        *group,
        "_range",
        *[
            F.coalesce(
                F.sum(w).over(over_ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias(f"_{w}_offset")
            for w in weights
        ],
        *[F.sum(w).over(Window.partitionBy(*group)).alias(f"{w}_total") for w in weights],
    )
    inside = (
        Window.partitionBy(*group, "_range")
        .orderBy(ahead(key))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Null-safe equality keeps the optimizer from deriving filters out of the
    # search expression behind ``_range``.
    keys = [*group, "_range"]
    offsets = offsets.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    if not group:
        offsets = F.broadcast(offsets)  # at most ``ranges`` rows, one per million keys
    match = reduce(and_, [placed[k].eqNullSafe(offsets[f"_of_{k}"]) for k in keys])
    return placed.join(offsets, match).select(
        *counts.columns,
        *[f"{w}_total" for w in weights],
        *[
            (F.col(f"_{w}_offset") + F.coalesce(F.sum(w).over(inside), F.lit(0))).alias(f"{w}_before")
            for w in weights
        ],
    )


def value_ranks(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Distinct values with ``n``, ``n_before`` and ``n_total`` per group."""
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return running_totals(counts, value, ["n"], group)


def _brackets(values: DataFrame, probabilities: Sequence[float], group: Sequence[str], margin: float) -> DataFrame:
    """Per group and probability, two values that enclose the exact quantile.

    The sketch is off by at most ``1 / ACCURACY`` of the ranks and the bracket
    reaches ``margin`` to either side.  Where the margin is less than a few rows
    the bracket is the whole group.
    """
    ends = [min(max(p + side * margin, 0.0), 1.0) for p in probabilities for side in (-1, 1)]
    sketch = values.groupBy(*group).agg(
        F.percentile_approx("_v", ends, ACCURACY).alias("_ends"),
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    small = F.col("_n") * margin < 4
    bounds = []
    for k, p in enumerate(probabilities):
        low, high = F.get("_ends", F.lit(2 * k)), F.get("_ends", F.lit(2 * k + 1))
        bounds += [
            F.when(small | F.lit(p <= margin), F.col("_min")).otherwise(low).alias(f"low{k}"),
            F.when(small | F.lit(p >= 1 - margin), F.col("_max")).otherwise(high).alias(f"high{k}"),
        ]
    return sketch.select(*group, F.struct("_min", *bounds).alias("_b"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    group: Sequence[str] = (),
    margin: float = MARGIN,
) -> DataFrame:
    """Exact, linearly interpolated quantiles as doubles: one row per group.

    A mergeable sketch first brackets each quantile.  In a second pass the
    values inside the brackets are counted one by one and those between two
    brackets only as a sum, so hardly anything is shuffled, and the ranks in
    the brackets are still exact.  Should a sketch miss, so that a quantile lies
    outside of its bracket, the query fails and ``margin`` has to be raised.
    """
    group = list(group)
    values = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"))
    probabilities = sorted({float(q) for q in quantiles.values()})
    brackets = _brackets(values, probabilities, group, margin)
    if group:
        placed = values.join(measured(brackets, "brackets"), group)
    else:
        placed = values.withColumn("_b", brackets.scalar())
    v, spots = F.col("_v"), range(len(probabilities))
    inside = reduce(or_, [(v >= F.col(f"_b.low{k}")) & (v <= F.col(f"_b.high{k}")) for k in spots])
    below = F.greatest(F.col("_b._min"), *[F.when(v > F.col(f"_b.high{k}"), F.col(f"_b.high{k}")) for k in spots])
    reduced = placed.select(*group, F.when(inside, v).otherwise(below).alias("_v"), inside.alias("_inside"))
    counts = reduced.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("n"), F.count_if("_inside").alias("_own"))
    ranked = running_totals(counts, "_v", ["n"], group)

    def at(position: Column) -> Column:
        here = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
        # values between two brackets are counted behind those at the edge before them
        inside_it = position < F.col("n_before") + F.col("_own")
        missed = F.raise_error(F.lit("a quantile lies outside of its bracket: raise the margin")).cast("double")
        return F.max(F.when(here & inside_it, F.col("_v")).when(here, missed))

    picks = []
    for name, q in quantiles.items():
        spot = (F.col("n_total") - 1) * F.lit(float(q))
        floor = F.floor(spot)
        picks += [
            at(floor).alias(f"_{name}_lo"),
            at(F.least(floor + 1, F.col("n_total") - 1)).alias(f"_{name}_hi"),
            F.max(spot - floor).alias(f"_{name}_part"),
        ]
    found = ranked.groupBy(*group).agg(*picks)
    return found.select(
        *group,
        *[
            (
                F.col(f"_{name}_lo")
                + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * F.col(f"_{name}_part")
            ).alias(name)
            for name in quantiles
        ],
    )


def with_rank(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the 1-based position of every row in the global order of ``order``.

    ``order`` must be unique and not null; the position is exact and nothing is
    sorted in a single task.
    """
    keyed = df.select("*", F.struct(*order).alias("_key"), F.lit(1).cast("long").alias("_n"))
    return (
        running_totals(keyed, "_key", ["_n"])
        .withColumn(name, F.col("_n_before") + 1)
        .drop("_key", "_n", "_n_before", "_n_total")
    )

"""Does a feature look ahead?  Disturb what comes later and see if anything earlier moves.

Every entity gets a cut of its own, drawn from its id.  In a second copy of the panel
all metrics of all rows behind their entity's cut are replaced.  Features of the rows
up to the cut must come out the same from both copies.  Two runs of the features so
test every entity, metric and window at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.learn.split import draw
from tidemark.session import measured


def cuts(panel: DataFrame, entity: str, order: str, seed: int) -> DataFrame:
    """Rows (entity, _cut): a value of ``order`` below the entity's last one, if it has several."""
    spans = panel.groupBy(entity).agg(F.min(order).alias("_from"), F.max(order).alias("_to"))
    drawn = F.floor(draw(entity, seed=seed) * (F.col("_to") - F.col("_from"))).cast("long")
    return spans.select(entity, (F.col("_from") + drawn).alias("_cut"))


def disturbed(panel: DataFrame, cut: DataFrame, metrics: Sequence[str], flags: Sequence[str], entity: str, order: str) -> DataFrame:
    """The panel with other metrics and turned flags behind every entity's cut, of the same types."""
    kinds = dict(panel.dtypes)
    after = F.col(order) > F.col("_cut")

    def other(name: str) -> Column:
        if name in flags:
            return (1 - F.coalesce(F.col(name), F.lit(0))).cast(kinds[name])
        noise = F.pmod(F.xxhash64(F.lit(name), entity, order), F.lit(2001)) - 1000
        return ((1 + F.abs(F.coalesce(F.col(name), F.lit(0)))) * noise).cast(kinds[name])

    placed = panel.join(cut, entity)
    return placed.withColumns({c: F.when(after, other(c)).otherwise(F.col(c)) for c in (*metrics, *flags)}).select(*panel.columns)


def leakage_check(
    panel: DataFrame, build: Callable[[DataFrame], DataFrame], features: Sequence[str], metrics: Sequence[str],
    flags: Sequence[str] = (), entity: str = "company_id", order: str = "month_index", seed: int = 7,
) -> DataFrame:
    """One row (compared_rows, moved_rows, moved_features) for the features that ``build`` makes of a panel.

    ``build`` keeps a row per entity and order.  Values are compared by hashes of
    nine decimals.  A row that only one run has is moved.
    """
    keys = [entity, order]
    cut = measured(cuts(panel, entity, order, seed), "cuts")

    def run(rows: DataFrame, name: str) -> DataFrame:
        built = build(rows)
        kinds = dict(built.dtypes)
        values = [F.round(f, 9) if kinds[f] in ("double", "float") else F.col(f) for f in features]
        own = built.select(*keys, F.array(*[F.hash(v) for v in values]).alias(name))
        return own.join(cut, entity).where(F.col(order) <= F.col("_cut")).drop("_cut")

    plain = run(panel, "_plain")
    other = run(disturbed(panel, cut, metrics, flags, entity, order), "_other")
    both = plain.join(other, keys, "full")
    spots = range(len(features))
    differ = [~F.get("_plain", F.lit(i)).eqNullSafe(F.get("_other", F.lit(i))) for i in spots]
    names = F.array(*[F.when(F.count_if(d) > 0, F.lit(f)) for f, d in zip(features, differ, strict=True)])
    return both.agg(
        F.count(F.lit(1)).alias("compared_rows"),
        F.count_if(~F.col("_plain").eqNullSafe(F.col("_other"))).alias("moved_rows"),
        F.array_compact(names).alias("moved_features"),
    )

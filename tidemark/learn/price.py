"""Linear price model and its per-row breakdown."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.learn.prepare import feature_names, preparation
from tidemark.session import measured

NUMERIC = ["ram_gb", "rom_gb"]
CATEGORIES = ["product_type", "brand", "processor", "region"]


def fit_price(sales: DataFrame, alpha: float = 1.0) -> PipelineModel:
    """Ridge regression of the price on specs; ``alpha`` penalises the summed
    squared error, which divides by the row count in Spark's averaged one."""
    rows = sales.dropna(subset=[*NUMERIC, *CATEGORIES, "price"]).withColumn(
        "_price", F.col("price").cast("double")
    )
    model = LinearRegression(
        labelCol="_price", predictionCol="predicted_price", regParam=alpha / max(rows.count(), 1), standardization=False
    )
    return Pipeline(stages=[*preparation(NUMERIC, CATEGORIES, scale=False), model]).fit(rows)


def price_metrics(model: PipelineModel, sales: DataFrame) -> DataFrame:
    """Mean absolute error and R² in one pass over the predictions."""
    scored = model.transform(sales.dropna(subset=[*NUMERIC, *CATEGORIES, "price"]))
    y, guess = F.col("price").cast("double"), F.col("predicted_price")
    return scored.agg(
        F.avg(F.abs(y - guess)).alias("mae"),
        (1 - F.sum((y - guess) * (y - guess)) / (F.var_pop(y) * F.count(y))).alias("r2"),
    )


def coefficient_table(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """The fitted weights as rows ``term, level, weight``; numbers have no level.

    They are written once, so that joins know their size."""
    fitted = model.stages[-1]
    names = feature_names(model.transform(sample.limit(0)), NUMERIC)
    rows = [("base", None, float(fitted.intercept))]
    for name, weight in zip(names, fitted.coefficients):
        term, _, level = name.partition("=")
        rows.append((term, level or None, float(weight)))
    return measured(sample.sparkSession.createDataFrame(rows, "term string, level string, weight double"), "weights")


def with_parts(
    specs: DataFrame, weights: DataFrame, numeric: Sequence[str] = NUMERIC, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """``specs`` with one ``part_<term>`` column per term: base, categories, numbers.

    ``weights`` has one row per term and level, as many as the model has weights.  The
    levels of a category are joined to the rows, so a row looks its level up instead of
    going through all of them; Spark broadcasts them where their size allows it.  An
    unknown level contributes 0.
    """
    own = F.col("level").isNull()
    singles = weights.agg(
        F.struct(
            *[
                F.coalesce(F.first(F.when((F.col("term") == t) & own, F.col("weight")), ignorenulls=True), F.lit(0.0)).alias(t)
                for t in ["base", *numeric]
            ]
        )
    ).scalar()
    joined = specs
    for c in categories:
        levels = weights.where(F.col("term") == c).select(F.col("level").alias("_level"), F.col("weight").alias(f"part_{c}"))
        joined = joined.join(levels, F.col(c).cast("string").eqNullSafe(F.col("_level")), "left").drop("_level")
    parts = {"part_base": F.col("_singles.base")}
    for c in categories:
        parts[f"part_{c}"] = F.coalesce(F.col(f"part_{c}"), F.lit(0.0))
    for c in numeric:
        parts[f"part_{c}"] = F.col(f"_singles.{c}") * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return joined.withColumn("_singles", singles).withColumns(parts).drop("_singles")


def price_breakdown(
    specs: DataFrame, weights: DataFrame, keys: Sequence[str],
    numeric: Sequence[str] = NUMERIC, categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """Additive contributions in long form: base, one per category and one per number.

    The rows of a key add up to its estimated price, device type included.
    """
    terms = [("base", F.lit(None).cast("string")), *[(c, F.col(c).cast("string")) for c in categories], *[(c, F.lit(None).cast("string")) for c in numeric]]
    cells = [F.struct(F.lit(t).alias("term"), level.alias("level"), F.col(f"part_{t}").alias("contribution")) for t, level in terms]
    return with_parts(specs, weights, numeric, categories).select(*keys, F.inline(F.array(*cells)))


def estimated_price(
    specs: DataFrame, weights: DataFrame, keys: Sequence[str],
    numeric: Sequence[str] = NUMERIC, categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """The sum of a row's parts, row by row."""
    names = ["base", *categories, *numeric]
    total = reduce(add, [F.col(f"part_{n}") for n in names])
    return with_parts(specs, weights, numeric, categories).select(*keys, total.alias("estimated_price"))


def breakdown_total(breakdown: DataFrame, keys: Sequence[str]) -> DataFrame:
    return breakdown.groupBy(*keys).agg(F.sum("contribution").alias("estimated_price"))

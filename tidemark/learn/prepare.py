"""Feature preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preparation(numeric: Sequence[str], categories: Sequence[str], scale: bool = True) -> list:
    """Stages that scale the numbers and one-hot encode the categories.

    The indexer keeps unknown values in an extra slot behind the known ones and
    the encoder drops that last slot, so an unknown value encodes as all zeros
    and every known one has its own column.
    """
    numbers = "_numbers" if scale else "_unscaled"
    stages = [VectorAssembler(inputCols=list(numeric), outputCol="_unscaled")]
    if scale:
        stages.append(StandardScaler(inputCol="_unscaled", outputCol="_numbers", withMean=True, withStd=True))
    if categories:
        index = [f"_{c}_index" for c in categories]
        encoded = [f"_{c}_hot" for c in categories]
        stages += [
            StringIndexer(
                inputCols=list(categories), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(inputCols=index, outputCols=encoded, dropLast=True),
        ]
    else:
        encoded = []
    return [*stages, VectorAssembler(inputCols=[numbers, *encoded], outputCol="features")]


def feature_names(prepared: DataFrame, numeric: Sequence[str], column: str = "features") -> list[str]:
    """Names of the vector's slots: the numbers, then ``category=value``."""
    attributes = prepared.schema[column].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a.get("name", "") for kind in attributes.values() for a in kind}
    names = []
    for i in range(len(slots)):
        if i < len(numeric):
            names.append(numeric[i])
        else:
            category, _, value = slots[i].partition("_hot_")
            names.append(f"{category.lstrip('_')}={value}")
    return names


def standardize(train: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale ``target`` by mean and population deviation of ``train``.

    A column without spread is only centred.
    """
    fitted = train.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        )
    ).scalar()
    scaled = {}
    for c in columns:
        std = F.col(f"_fit.{c}_std")
        scaled[c] = (F.col(c) - F.col(f"_fit.{c}_mean")) / F.when(std > 0, std).otherwise(1.0)
    return target.withColumn("_fit", fitted).withColumns(scaled).drop("_fit")


def without_working_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])

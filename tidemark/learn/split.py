"""Repeatable splits and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def draw(*keys: str, seed: int = 42) -> Column:
    """A number in [0, 1) that depends only on the keys and the seed, so that any
    engine with MD5 makes the same split."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def entity_split(
    df: DataFrame, key: str = "company_id", validation: float = 0.15, test: float = 0.15, seed: int = 42
) -> DataFrame:
    """Add ``split``; all rows of an entity land in the same part, without a shuffle."""
    u = draw(key, seed=seed)
    part = F.when(u < test, "test").when(u < test + validation, "validation").otherwise("train")
    return df.withColumn("split", part)


def row_split(df: DataFrame, key: str, test: float = 0.25, seed: int = 0) -> DataFrame:
    return df.withColumn("split", F.when(draw(key, seed=seed) < test, "test").otherwise("train"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class, n / (2 * n_class), and the negative:positive ratio."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    sizes = df.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) == 0).alias("neg"),
        )
    ).scalar()
    return counted.withColumn("_s", sizes).select(
        label,
        "n",
        (F.col("_s.n") / (2.0 * F.col("n"))).alias("balanced_weight"),
        F.try_divide(F.col("_s.neg").cast("double"), F.col("_s.pos").cast("double")).alias("neg_pos_ratio"),
    )


def with_balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight rows so that both classes count the same."""
    sizes = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"))).scalar()
    own = F.when(F.col(label) == 1, F.col("_s.pos")).otherwise(F.col("_s.n") - F.col("_s.pos"))
    return df.withColumn("_s", sizes).withColumn(name, F.col("_s.n") / (2.0 * own)).drop("_s")


def with_positive_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight positives by the negative:positive ratio, negatives by 1."""
    ratio = df.agg(
        F.try_divide(
            F.count_if(F.col(label) == 0).cast("double"), F.count_if(F.col(label) == 1).cast("double")
        )
    ).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(1.0))

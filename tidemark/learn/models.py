"""Classifiers, calibration and persistence."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.learn.boosting import BoostedClassifier
from tidemark.learn.isotonic import MonotoneCurve, fit_curve
from tidemark.learn.prepare import preparation, without_working_columns
from tidemark.schemas import LABEL, NUMERIC_FEATURES, STATIC_CATEGORIES
from tidemark.session import exists

SEED = 42


def logistic(rows: int, label: str = LABEL, strength: float = 1.0, **options) -> LogisticRegression:
    """L2 logistic regression; ``strength`` is the inverse penalty on the summed
    loss, which divides by the row count in Spark's averaged loss."""
    settings = {"maxIter": 2000, "regParam": 1.0 / (strength * max(rows, 1)), "standardization": False}
    return LogisticRegression(labelCol=label, **{**settings, **options})


def random_forest(label: str = LABEL, **options) -> RandomForestClassifier:
    settings = {"numTrees": 300, "maxDepth": 10, "minInstancesPerNode": 20, "seed": SEED}
    return RandomForestClassifier(labelCol=label, **{**settings, **options})


def boosted(label: str = LABEL, **options) -> GBTClassifier:
    """Boosted trees, 400 rounds of depth 5 by default."""
    settings = {
        "maxIter": 400, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8", "seed": SEED,
    }
    return BoostedClassifier(labelCol=label, **{**settings, **options})


def boosted_deep(label: str = LABEL, **options) -> GBTClassifier:
    return boosted(label, **{"maxDepth": 6, **options})


def boosted_snapshot(label: str = LABEL, **options) -> GBTClassifier:
    return boosted(label, **{"maxIter": 300, "maxDepth": 4, "stepSize": 0.06, **options})


def fit(
    train: DataFrame,
    classifier,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categories: Sequence[str] = STATIC_CATEGORIES,
    weight: str | None = "weight",
) -> PipelineModel:
    """Preparation plus classifier, fitted on ``train``."""
    if weight is not None and weight in train.columns:
        classifier = classifier.copy().setWeightCol(weight)
    return Pipeline(stages=[*preparation(numeric, categories), classifier]).fit(train)


def score(model, df: DataFrame, name: str = "risk_score") -> DataFrame:
    """Probability of class 1 as a plain column."""
    scored = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return without_working_columns(scored).drop("features", "rawPrediction", "probability", "prediction")


class Calibrated:
    """A classifier followed by a monotone map of its scores."""

    def __init__(self, model: PipelineModel, curve: MonotoneCurve):
        self.model, self.curve = model, curve

    def score(self, df: DataFrame, name: str = "risk_score") -> DataFrame:
        raw = score(self.model, df, "raw_score")
        return self.curve.copy({self.curve.outputCol: name}).transform(raw).drop("raw_score")


def calibrate(model: PipelineModel, validation: DataFrame, label: str = LABEL) -> Calibrated:
    """Isotonic calibration on the scores of ``validation``."""
    return Calibrated(model, fit_curve(score(model, validation, "raw_score"), "raw_score", label, "risk_score"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def keep_model(spark: SparkSession, path: str, make: Callable[[], PipelineModel]) -> PipelineModel:
    """The model under ``path``, made and saved there if it isn't whole.

    A model is whole once its mark is written; what a lost driver left halfway is
    made again.
    """
    mark = f"{path}-whole"
    if exists(spark, mark):
        return load_model(path)
    model = make()
    save_model(model, path)
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(mark)
    return model

"""A scorer as one pipeline: checked features, model, calibration, threshold.

All stages can be written and read, so a scorer that was chosen, calibrated and tuned
is saved whole and gives the same scores and flags wherever it is loaded again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.learn.isotonic import MonotoneCurve
from tidemark.learn.prepare import without_working_columns

MODEL_COLUMNS = ["features", "rawPrediction", "probability", "prediction"]


class FeatureList(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """The columns a scorer needs; a table that lacks one is refused by name."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        missing = sorted(set(self.getInputCols()) - set(df.columns))
        if missing:
            raise ValueError(f"features missing: {', '.join(missing)}")
        return df


class ClassProbability(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The probability of class 1 as a plain column; the model's own columns go."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._setDefault(inputCol="probability")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn(self.getOutputCol(), vector_to_array(self.getInputCol())[1])
        return without_working_columns(scored).drop(*MODEL_COLUMNS)


class Cutoff(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """1 where a score reaches the threshold, else 0; null where there is no score."""

    threshold = Param(Params._dummy(), "threshold", "the least score that is flagged", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, threshold=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        flagged = (F.col(self.getInputCol()) >= self.getOrDefault("threshold")).cast("int")
        return df.withColumn(self.getOutputCol(), flagged)


def scorer(
    model: PipelineModel, curve: MonotoneCurve | None, features: Sequence[str], threshold: float | None = None,
    score: str = "risk_score", flag: str = "flagged",
) -> PipelineModel:
    """Everything from feature columns to ``score`` (and ``flag``) as one pipeline.

    ``curve`` maps the column ``raw_score``; without it the model's probability is the score.
    """
    stages = [FeatureList(inputCols=list(features)), *model.stages]
    stages.append(ClassProbability(outputCol=score if curve is None else curve.getInputCol()))
    if curve is not None:
        stages.append(curve.copy({curve.outputCol: score}))
    if threshold is not None:
        stages.append(Cutoff(inputCol=score, outputCol=flag, threshold=threshold))
    return PipelineModel(stages)

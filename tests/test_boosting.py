"""Boosted trees by whole columns are Spark's trees."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array

from tidemark.learn import boosting, models, split

NUMERIC = ["x1", "x2", "x3", "x4"]
SETTINGS = {"labelCol": "label", "maxIter": 8, "maxDepth": 4, "stepSize": 0.2, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    n = 1500
    x = rng.normal(size=(n, 4)).round(2)
    kind = rng.choice(["red", "green", "blue"], n)
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] * x[:, 2] + (kind == "red"))))
    frame = pd.DataFrame(x, columns=NUMERIC).assign(kind=kind, own=np.arange(n), label=(rng.random(n) < chance).astype(int))
    path = str(tmp_path_factory.mktemp("rows") / "t")
    spark.createDataFrame(frame).coalesce(1).sortWithinPartitions("own").write.parquet(path)
    return split.with_balanced_weight(spark.read.parquet(path), "label")


def raw(model, df):
    scored = model.transform(df).orderBy("own").select(vector_to_array("rawPrediction")[1].alias("r"))
    return np.array([row.r for row in scored.collect()])


@pytest.mark.parametrize("settings", [{}, {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 20}])
def test_trees_are_those_of_spark(spark, rows, monkeypatch, settings):
    theirs = models.fit(rows, GBTClassifier(**{**SETTINGS, **settings}), NUMERIC, ["kind"])
    want = raw(theirs, rows)
    for local, exact in ((1 << 24, 1 << 24), (1 << 24, 0), (0, 0)):  # one task, one child of two, a job per level
        monkeypatch.setattr(boosting, "LOCAL", local)
        monkeypatch.setattr(boosting, "EXACT", exact)
        ours = models.fit(rows, boosting.BoostedClassifier(**{**SETTINGS, **settings}), NUMERIC, ["kind"])
        assert ours.stages[-1].treeWeights == theirs.stages[-1].treeWeights
        assert raw(ours, rows) == pytest.approx(want, abs=1e-9)
        assert ours.stages[-1].featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray())


def test_a_boosted_fit_has_fewer_jobs_than_rounds(spark, rows):
    context = spark.sparkContext
    context.setJobGroup("boosted", "")
    models.fit(rows, models.boosted("label", maxIter=60, maxDepth=2), NUMERIC, ["kind"])
    context.setJobGroup("after", "")
    assert len(context.statusTracker().getJobIdsForGroup("boosted")) < 60


def test_scores_are_made_anew_from_the_trees(spark, rows, monkeypatch):
    # small nodes have ties that the rounding of sums decides, and a node more would change the subsets drawn
    settings = {**SETTINGS, "maxIter": 5, "maxDepth": 3, "featureSubsetStrategy": "all", "minInstancesPerNode": 40}
    whole = raw(models.fit(rows, boosting.BoostedClassifier(**settings), NUMERIC, ["kind"]), rows)
    monkeypatch.setattr(boosting, "LOCAL", 0)
    monkeypatch.setattr(boosting, "REBUILT", 2)
    monkeypatch.setattr(boosting, "CHUNK", 400)  # draws of a later chunk go on where the one before ended
    again = models.fit(rows, boosting.BoostedClassifier(**settings), NUMERIC, ["kind"])
    assert raw(again, rows) == pytest.approx(whole, abs=1e-9)


def test_a_saved_model_scores_the_same(rows, tmp_path):
    model = models.fit(rows, models.boosted("label", maxIter=3), NUMERIC, ["kind"])
    models.save_model(model, str(tmp_path / "m"))
    assert raw(models.load_model(str(tmp_path / "m")), rows).tolist() == raw(model, rows).tolist()


def test_pure_labels_and_constant_features_are_leaves(spark):
    df = spark.createDataFrame([(float(i), 3.0, "a", 1) for i in range(20)], "x1 double, x2 double, kind string, label int")
    model = models.fit(df, models.boosted("label", maxIter=3), ["x1", "x2"], ["kind"], weight=None)
    theirs = models.fit(df, GBTClassifier(labelCol="label", maxIter=3, subsamplingRate=0.8, stepSize=0.05, seed=42), ["x1", "x2"], ["kind"], weight=None)
    assert [r.risk_score for r in models.score(model, df).collect()] == pytest.approx([r.risk_score for r in models.score(theirs, df).collect()])

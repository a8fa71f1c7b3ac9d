"""The grid fitted in common passes next to single fits."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tidemark.learn import prepare, search, split

NAMES = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 3)) * [1.0, 20.0, 0.1] + [0, 5, -1]
    y = rng.random(500) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.05 * x[:, 1] + 3 * (x[:, 2] + 1))))
    table = [(i, *map(float, r), 3.0, int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(table, "id long, a double, b double, c double, flat double, label int").cache()


def test_search_equals_single_fits(spark, rows):
    folds, strengths = 3, (0.01, 1.0, 100.0)
    spark.sparkContext.setJobGroup("search", "search")
    found = search.grid_search(rows, NAMES, "label", ["id"], folds, strengths)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("search"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 100 and found.passes < search.PASSES
    placed = rows.withColumn("fold", F.floor(split.draw("id") * folds).cast("int"))
    for ratio, strength, accuracy in found.table:
        shares = []
        for fold in range(folds):
            model = LogisticRegression(labelCol="label", regParam=strength, elasticNetParam=ratio, standardization=False, maxIter=500, tol=1e-10)
            fit = Pipeline(stages=[*prepare.preparation(NAMES, []), model]).fit(placed.where(F.col("fold") != fold))
            shares.append(fit.transform(placed.where(F.col("fold") == fold)).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
        assert accuracy == pytest.approx(np.mean(shares), abs=1e-9), (ratio, strength)
    for (ratio, strength, _), weights in zip(found.table, found.fits):
        model = LogisticRegression(labelCol="label", regParam=strength, elasticNetParam=ratio, standardization=False, maxIter=500, tol=1e-12)
        fit = Pipeline(stages=[*prepare.preparation(NAMES, []), model]).fit(rows).stages[-1]
        assert weights == pytest.approx([fit.intercept, *fit.coefficients.toArray()], abs=2e-4)


def test_search_of_odd_tables(spark, rows):
    with pytest.raises(Exception, match="missing number"):
        search.grid_search(rows.withColumn("a", F.when(F.col("id") != 7, F.col("a"))), NAMES, "label", ["id"], 2, (1.0,))
    one_class = search.grid_search(rows.withColumn("label", F.lit(1)), NAMES, "label", ["id"], 2, (1.0,))
    assert [a for _, _, a in one_class.table] == [1.0, 1.0]
    with pytest.raises(ValueError, match="no rows"):
        search.grid_search(rows.limit(0), NAMES, "label", ["id"], 2, (1.0,))


def test_a_step_reaches_the_minimum_where_columns_go_together():
    """Coordinate descent alone stops far from it: two columns differ by a millionth."""
    near = 1 - 1e-6
    bend = np.array([[1.0, 0.0, 0.0], [0.0, 1.0, near], [0.0, near, 1.0]])
    gradient, strength = np.array([0.3, -0.5, -0.5 + 4e-7]), 0.01
    new = search.newton_step(np.zeros(3), gradient, bend, strength, 1.0)
    slope = gradient + bend @ new
    assert abs(slope[0]) < 1e-9
    for own, at in zip(new[1:], slope[1:], strict=True):
        assert abs(at + strength * np.sign(own)) < 1e-9 if own else abs(at) <= strength + 1e-9

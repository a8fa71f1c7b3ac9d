"""Distributed isotonic calibration next to plain pooling, and saved scorers."""

import random
import subprocess
import sys
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.learn import deploy, isotonic, models, split


def plain_blocks(points):
    """Pool adjacent violators over (score, label, weight), exactly."""
    own = {}
    for x, y, w in points:
        total, weight = own.get(x, (Fraction(0), Fraction(0)))
        own[x] = total + Fraction(y) * Fraction(w), weight + Fraction(w)
    stack = []
    for x in sorted(own):
        stack.append([x, x, *own[x]])
        while len(stack) > 1 and stack[-2][2] / stack[-2][3] >= stack[-1][2] / stack[-1][3]:
            _, high, total, weight = stack.pop()
            stack[-1] = [stack[-1][0], high, stack[-1][2] + total, stack[-1][3] + weight]
    return [(a, b, float(t / w), float(w)) for a, b, t, w in stack]


def cases():
    rng = random.Random(4)
    noisy = [(round(rng.random(), 3), int(rng.random() < 0.5), 1.0) for _ in range(3000)]
    rising = [(i / 500, int(rng.random() < i / 500), 1.0) for i in range(500) for _ in range(2)]
    return {
        "noisy": noisy,
        "rising": rising,
        "reversed": [(i / 400, float(400 - i), 1.0) for i in range(400)],
        "strict": [(i / 400, float(i), 2.0) for i in range(400)],
        "constant": [(i / 400, 0.25, 1.0) for i in range(400)],
        "one score": [(0.5, i % 2, 1.0) for i in range(300)],
        "hot score": [(0.5, i % 3 == 0, 1.0) for i in range(300)] + rising,
        "saw": [((i * 7 % 900) / 900, float(i % 13), float(1 + i % 5)) for i in range(900)],
        "one": [(0.5, 1, 1.0)],
    }


@pytest.mark.parametrize("name", sorted(cases()))
@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_blocks_equal_plain_pooling(spark, name, ranges):
    points = [(float(x), float(y), float(w)) for x, y, w in cases()[name]]
    df = spark.createDataFrame(points, "s double, y double, w double").repartition(4)
    got = isotonic.isotonic_blocks(df, "s", "y", "w", ranges).orderBy("low").collect()
    want = plain_blocks(points)
    assert [(r.low, r.high) for r in got] == [(a, b) for a, b, _, _ in want]
    assert [(r.value, r.weight) for r in got] == [pytest.approx((v, w)) for _, _, v, w in want]


def test_blocks_of_nothing_and_nulls(spark):
    rows = [(None, 1.0, 1.0), (0.2, None, 1.0), (0.3, 1.0, 0.0), (0.4, 1.0, 1.0), (0.6, 0.0, 3.0)]
    df = spark.createDataFrame(rows, "s double, y double, w double")
    assert [tuple(r) for r in isotonic.isotonic_blocks(df, "s", "y", "w", 3).collect()] == [(0.4, 0.6, 0.25, 4.0)]
    assert isotonic.isotonic_blocks(df.limit(0), "s", "y").count() == 0


def test_curve_interpolates_between_its_corners(spark):
    rng = np.random.default_rng(2)
    for count in (1, 2, 3, 7, 8, 9, 100):
        cuts = np.sort(rng.random(count))
        heights = np.sort(rng.random(count))
        values = [*np.linspace(-0.2, 1.2, 57), *cuts]
        curve = isotonic.MonotoneCurve(inputCol="s", outputCol="p", cuts=cuts.tolist(), heights=heights.tolist())
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "s double")
        got = [r.p for r in curve.transform(df).collect()]
        assert got[:-1] == pytest.approx(np.interp(values, cuts, heights).tolist()) and got[-1] is None


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 2))
    table = [(i, float(a), float(b), "red" if a > b else "blue", int(rng.random() < 1 / (1 + np.exp(-a + b)))) for i, (a, b) in enumerate(x)]
    return split.with_balanced_weight(spark.createDataFrame(table, "id int, a double, b double, kind string, label int"), "label").cache()


def test_scorer_is_saved_whole(spark, rows, tmp_path):
    model = models.fit(rows, models.random_forest("label", numTrees=4, maxDepth=3), ["a", "b"], ["kind"])
    found = models.calibrate(model, rows, "label")
    whole = deploy.scorer(model, found.curve, ["a", "b", "kind"], 0.4)
    path = str(tmp_path / "scorer")
    whole.write().overwrite().save(path)
    scored = whole.transform(rows).select("id", "risk_score", "flagged")
    again = deploy.PipelineModel.load(path)
    assert again.transform(rows).select("id", "risk_score", "flagged").exceptAll(scored).isEmpty()
    assert found.score(rows).select("id", "risk_score", (F.col("risk_score") >= 0.4).cast("int")).exceptAll(scored).isEmpty()
    assert set(whole.transform(rows).columns) == {*rows.columns, "raw_score", "risk_score", "flagged"}
    with pytest.raises(ValueError, match="features missing: b, kind"):
        again.transform(rows.drop("b", "kind"))
    # in a session of its own the loaded scorer gives the same numbers
    rows.write.parquet(str(tmp_path / "rows"))
    scored.write.parquet(str(tmp_path / "scored"))
    script = f"""
from tidemark.session import build_session
from pyspark.ml import PipelineModel
spark = build_session("fresh", **{{"spark.master": "local[2]", "spark.ui.enabled": "false"}})
got = PipelineModel.load({path!r}).transform(spark.read.parquet({str(tmp_path / "rows")!r})).select("id", "risk_score", "flagged")
print("differing", got.exceptAll(spark.read.parquet({str(tmp_path / "scored")!r})).count(), got.count())
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, cwd=str(__import__("pathlib").Path(__file__).parent.parent))
    assert "differing 0 900" in out.stdout, out.stderr[-2000:]

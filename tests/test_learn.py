"""Metrics by brute force, model sanity and explanations."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.learn import explain, metrics, models, prepare, price, scenarios, split

NUMERIC = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def scored():
    rng = np.random.default_rng(5)
    n = 600
    score = np.round(rng.random(n), 2)
    score[: n // 3] = 0.4  # a third of all rows share one score
    label = (rng.random(n) < score).astype(int)
    return pd.DataFrame({"s": score, "y": label, "g": rng.integers(0, 3, n)})


def pair_auc(frame):
    pos, neg = frame.s[frame.y == 1].to_numpy(), frame.s[frame.y == 0].to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def step_precision(frame):
    total, seen_recall, area = frame.y.sum(), 0.0, 0.0
    for t in sorted(frame.s.unique(), reverse=True):
        flagged = frame[frame.s >= t]
        recall, precision = flagged.y.sum() / total, flagged.y.mean()
        area += (recall - seen_recall) * precision
        seen_recall = recall
    return area


def test_auc_and_precision(spark, scored):
    df = spark.createDataFrame(scored)
    assert metrics.roc_auc(df, "s", "y").first()[0] == pytest.approx(pair_auc(scored), abs=1e-12)
    assert metrics.average_precision(df, "s", "y").first()[0] == pytest.approx(step_precision(scored), abs=1e-12)
    by_group = {r.g: r.roc_auc for r in metrics.roc_auc(df, "s", "y", ["g"]).collect()}
    for g, frame in scored.groupby("g"):
        assert by_group[g] == pytest.approx(pair_auc(frame), abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    assert metrics.roc_auc(df, "s", "y").first()[0] is None


def test_cost_threshold(spark, scored):
    total = scored.y.sum()
    best = min(
        (
            (5.0 * (total - scored.y[scored.s >= t].sum()) + (1 - scored.y[scored.s >= t]).sum()) / total,
            t,
        )
        for t in scored.s.unique()
        if scored.y[scored.s >= t].sum() > 0
    )
    row = metrics.cost_threshold(spark.createDataFrame(scored), "s", "y").first()
    assert (row.cost, row.threshold) == pytest.approx(best)


def test_confusion_either_class(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] + [(0, 0)] * 4, "p int, y int")
    row = metrics.confusion(df, "p", "y").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (3, 2, 1, 4) and row.precision == 0.6 and row.recall == 0.75
    other = metrics.confusion(df, "p", "y", positive=0).first()
    assert (other.tp, other.fp, other.fn, other.tn) == (4, 1, 2, 3) and other.accuracy == row.accuracy


def test_split_keeps_entities_together(spark):
    df = spark.range(2000).select((F.col("id") % 200).alias("company_id"), "id")
    parts = split.entity_split(df)
    assert parts.groupBy("company_id").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()
    share = {r.split: r["count"] / 2000 for r in parts.groupBy("split").count().collect()}
    assert 0.05 < share["test"] < 0.27 and 0.05 < share["validation"] < 0.27


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(8)
    n = 800
    x = rng.normal(size=(n, 3))
    kind = rng.choice(["red", "green", "blue"], n)
    logit = 2 * x[:, 0] - x[:, 1] + (kind == "red")
    frame = pd.DataFrame(x, columns=NUMERIC).assign(
        kind=kind, company_id=np.arange(n), label=(rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    )
    return split.with_balanced_weight(spark.createDataFrame(frame), "label").cache()


def fit(training, classifier):
    return models.fit(training, classifier, NUMERIC, ["kind"])


@pytest.mark.parametrize(
    "make",
    [
        lambda: models.logistic(800, "label", maxIter=50),
        lambda: models.random_forest("label", numTrees=5, maxDepth=4),
        lambda: models.boosted("label", maxIter=5, maxDepth=3),
    ],
)
def test_probabilities_and_quality(training, make):
    scored = models.score(fit(training, make()), training)
    low, high = scored.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0 <= low <= high <= 1
    assert metrics.average_precision(scored, "risk_score", "label").first()[0] > 0.55


def test_unknown_category_encodes_as_zeros(training):
    model = fit(training, models.logistic(800, "label", maxIter=5))
    prepared = model.transform(training.limit(1).withColumn("kind", F.lit("violet")))
    names = prepare.feature_names(prepared, NUMERIC)
    assert names == [*NUMERIC, "kind=blue", "kind=green", "kind=red"]
    vector = prepared.select(vector_to_array("features").alias("v")).first().v
    assert vector[3:] == [0.0, 0.0, 0.0]


def test_calibration_is_monotone_and_in_range(training):
    model = fit(training, models.random_forest("label", numTrees=5, maxDepth=4))
    curve = models.calibrate(model, training, "label")
    raw = models.score(model, training, "raw").select("company_id", "raw")
    both = raw.join(curve.score(training).select("company_id", "risk_score"), "company_id").toPandas().sort_values("raw")
    assert both.risk_score.between(0, 1).all()
    assert (both.risk_score.diff().dropna() >= -1e-12).all()


def test_save_and_load(training, tmp_path):
    model = fit(training, models.logistic(800, "label", maxIter=5))
    models.save_model(model, str(tmp_path / "m"))
    again = models.score(models.load_model(str(tmp_path / "m")), training).select("company_id", "risk_score")
    assert models.score(model, training).select("company_id", "risk_score").exceptAll(again).isEmpty()


def test_scenarios(training):
    model = fit(training, models.logistic(800, "label", maxIter=50))
    rows = training.limit(20)
    scorer = lambda df: models.score(model, df)
    table = scenarios.what_if(rows, {"same": {}, "up": {"x1": 9.0}}, scorer).toPandas()
    assert len(table) == 40
    assert table[table.scenario == "same"].delta.abs().max() < 1e-12
    assert scenarios.direction_violations(rows, "x1", 3.0, -3.0, scorer).isEmpty()
    assert scenarios.direction_violations(rows, "x1", -3.0, 3.0, scorer).count() == 20


def test_levers_stay_in_their_ranges(spark):
    rows = spark.createDataFrame([(1, 50.0, -1.0), (2, 3.0, None)], "company_id int, a double, b double")
    made = scenarios.with_scenarios(rows, {"same": {}, "far": {"a": 99.0}, "near": {"b": 0.5}}, {"a": (0.0, 36.0), "b": (0.0, 1.0)})
    got = {(r.company_id, r.scenario): (r.a, r.b) for r in made.collect()}
    assert got == {
        (1, "same"): (36.0, 0.0), (1, "far"): (36.0, 0.0), (1, "near"): (36.0, 0.5),
        (2, "same"): (3.0, None), (2, "far"): (36.0, None), (2, "near"): (3.0, 0.5),
    }


def tree_value(nodes, spot, row, known):
    """Expected leaf value when only the features in ``known`` are given."""
    node = nodes[spot]
    if node["left"] < 0:
        return node["value"]
    left, right = nodes[node["left"]], nodes[node["right"]]
    if node["feature"] in known:
        goes_left = row[node["feature"]] in node["cut"] if node["arity"] > 0 else row[node["feature"]] <= node["cut"][0]
        return tree_value(nodes, node["left"] if goes_left else node["right"], row, known)
    share = left["cover"] / node["cover"]
    return share * tree_value(nodes, node["left"], row, known) + (1 - share) * tree_value(nodes, node["right"], row, known)


@pytest.mark.parametrize("forest", [True, False])
def test_contributions_are_shapley_values(spark, training, forest):
    maker = models.random_forest("label", numTrees=3, maxDepth=3) if forest else models.boosted("label", maxIter=3, maxDepth=3)
    model = fit(training, maker)
    fitted = model.stages[-1]
    prepared = model.transform(training.orderBy("company_id").limit(6))
    names = prepare.feature_names(prepared, NUMERIC)
    got = explain.tree_contributions(prepared, fitted, names, ["company_id"]).toPandas()
    table = explain._ensemble_nodes(spark, fitted)
    trees = []
    for _, frame in table.groupby("tree"):
        trees.append(
            {
                r.id: {
                    "left": r.left, "right": r.right, "feature": r.feature, "cut": list(r.cut), "arity": r.arity,
                    "cover": sum(r.stats) if forest else r.stats[0],
                    "value": r.stats[1] / sum(r.stats) if forest else r.prediction,
                }
                for r in frame.itertuples()
            }
        )
    weights = [w / (len(trees) if forest else 1) for w in fitted.treeWeights]
    size = len(names)
    for record in prepared.select("company_id", vector_to_array("features").alias("x")).collect():
        f = lambda known: sum(w * tree_value(t, 0, record.x, known) for w, t in zip(weights, trees))
        mine = got[got.company_id == record.company_id].set_index("feature")
        assert mine.base_value.iloc[0] == pytest.approx(f(frozenset()))
        assert mine.contribution.sum() + mine.base_value.iloc[0] == pytest.approx(f(frozenset(range(size))))
        for i, name in enumerate(names):
            rest = [j for j in range(size) if j != i]
            phi = sum(
                factorial(k) * factorial(size - 1 - k) / factorial(size) * (f(frozenset(c) | {i}) - f(frozenset(c)))
                for k in range(size)
                for c in combinations(rest, k)
            )
            assert mine.loc[name, "contribution"] == pytest.approx(phi, abs=1e-9)


@pytest.mark.parametrize(
    "make",
    [
        lambda: models.logistic(800, "label", maxIter=50),
        lambda: models.random_forest("label", numTrees=4, maxDepth=4),
        lambda: models.boosted("label", maxIter=4, maxDepth=3),
    ],
)
def test_explained_rows_add_up_and_rank(spark, training, make):
    model = fit(training, make())
    prepared = model.transform(training).repartition(3)
    names = prepare.feature_names(prepared, NUMERIC)
    mean = np.mean([r.v for r in prepared.select(vector_to_array("features").alias("v")).collect()], axis=0)
    contributions = explain.Contributions(spark, model.stages[-1], mean)
    rows, importance = explain.explained(prepared, contributions, names, ["company_id"], 2)
    got = {r.company_id: r for r in rows.collect()}
    assert len(got) == training.count()
    x = {r.company_id: np.array(r.v) for r in prepared.select("company_id", vector_to_array("features").alias("v")).collect()}
    sums = np.zeros(len(names))
    for key, r in got.items():
        assert r.base_value + r.contribution_sum == pytest.approx(r.model_score, abs=1e-9)
        phi = contributions.of(x[key][None, :])[0]
        sums += np.abs(phi)
        for side, sign in ((r.top_risk_drivers, 1), (r.top_protective_factors, -1)):
            want = sorted((-abs(v), n) for v, n in zip(phi, names) if v * sign > 0)[:2]
            assert [d.feature for d in side] == [n for _, n in want]
            assert [d.abs_shap for d in side] == pytest.approx([-v for v, _ in want])
    found = {r.feature: r.mean_abs_contribution for r in importance.collect()}
    assert found == pytest.approx(dict(zip(names, sums / len(got))))
    if not hasattr(model.stages[-1], "coefficients"):
        long = explain.tree_contributions(prepared, model.stages[-1], names, ["company_id"])
        assert {r.feature: r.m for r in long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("m")).collect()} == pytest.approx(found)
    empty, none = explain.explained(prepared.limit(0), contributions, names, ["company_id"])
    assert empty.count() == 0 and none.count() == 0


def test_leaves_are_worked_out_once_per_pattern(monkeypatch):
    """Many rows cost a leaf of two features four patterns, with the results of rows taken alone."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3)).round(1)
    x[0, 0], x[1, 1] = np.nan, np.inf
    paths = [
        (1.0, {0: (-np.inf, 0.5, 0.6), 1: (-0.2, np.inf, 0.3)}), (-2.0, {2: (-1.0, 0.4, 0.5), 0: (0.5, np.inf, 0.4)}),
        (0.5, {1: (-np.inf, 0.0, 0.7)}), (3.0, {}),
    ]
    _, packed = explain._pack(paths)
    alone = np.concatenate([explain._shapley(x[i : i + 1], packed) for i in range(len(x))])
    worked, parts = [], explain._leaf_parts
    monkeypatch.setattr(explain, "_leaf_parts", lambda passes, values, share: worked.append(len(passes)) or parts(passes, values, share))
    assert explain._shapley(x, packed) == pytest.approx(alone, abs=1e-12)
    assert sorted(worked) == [2, 4]


def test_tops_break_ties_by_name():
    up, down = explain.signed_tops(np.array([[0.5, -0.1, 0.5, 0.0, -0.1]]), ["b", "z", "a", "n", "y"], 5)
    assert [d["feature"] for d in up[0]] == ["a", "b"] and [d["feature"] for d in down[0]] == ["y", "z"]


def test_narrative_wording(spark):
    rows = [
        (1, "runway_months_latest", 0.5), (1, "mrr_slope_3m", 0.4), (1, "burn_rate_latest", 0.3), (1, "churn_rate_latest", 0.2),
        (1, "nps_score_latest", -0.9), (2, "runway_months_latest", -0.1), (3, "mrr_latest", 0.2),
    ]
    long = spark.createDataFrame(rows, "id int, feature string, contribution double")
    told = explain.narrative(explain.local_top(long, ["id"]), F.concat(F.lit("firm-"), F.col("id").cast("string")))
    text = {r.id: r.narrative for r in told.collect()}
    assert text[1] == (
        "firm-1's risk score is primarily driven by months of cash runway remaining, mrr short-term trend and burn rate. "
        "This is partially offset by relatively healthy Net Promoter Score."
    )
    assert text[2].startswith("firm-2's risk score is primarily driven by no single dominant risk factor")
    assert text[3] == "firm-3's risk score is primarily driven by mrr."


def test_price_parts_add_up(spark, data):
    from tidemark.plans.bases import sales

    rows = sales(spark, data)
    model = price.fit_price(rows)
    weights = price.coefficient_table(model, rows)
    total = price.breakdown_total(price.price_breakdown(rows, weights, ["order_id"]), ["order_id"])
    gap = total.join(model.transform(rows).select("order_id", "predicted_price"), "order_id").agg(
        F.max(F.abs(F.col("estimated_price") - F.col("predicted_price")))
    )
    assert gap.first()[0] < 1e-6
    assert price.price_metrics(model, rows).first().mae > 0


def test_price_levels_are_joined(spark):
    """A row looks its level up; it doesn't go through all levels by itself."""
    weights = spark.createDataFrame(
        [("base", None, 10.0), ("brand", "a", 1.0), ("brand", None, 0.5), ("region", "a", 2.0), ("ram_gb", None, 0.25)],
        "term string, level string, weight double",
    )
    specs = spark.createDataFrame(
        [(1, "a", "a", 4.0), (2, None, None, None), (3, "new", "b", 8.0)], "order_id int, brand string, region string, ram_gb double"
    )
    got = price.estimated_price(specs, weights, ["order_id"], ["ram_gb"], ["brand", "region"])
    assert {r.order_id: r.estimated_price for r in got.collect()} == {1: 14.0, 2: 10.5, 3: 12.0}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "map_from_entries" not in plan

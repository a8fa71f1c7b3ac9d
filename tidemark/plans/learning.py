"""Model queries: splits, metrics, fits, calibration, scoring, explanations.

Fitted models are kept under the fingerprint of their input, so queries that score
or explain do not fit again.  Models have their full sizes, the defaults of ``learn.models``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml import Pipeline
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.learn import deploy, explain, metrics, models, prepare, price, scenarios, search, split
from tidemark.operators import panel, profile
from tidemark.plans import bases
from tidemark.plans.bases import Query, publish, registrar
from tidemark.schemas import LABEL, NUMERIC_FEATURES, SNAPSHOT_FEATURES, SNAPSHOT_NUMERIC, STATIC_CATEGORIES
from tidemark.session import fingerprint, fresh_path, measured, shared_folder, staged

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)
KEYS = ["company_id", "month_index"]
FEATURES_VERSION = "1"  # to be raised when features or preparation change their meaning
RECORD_COLUMNS = ["length", "spaces", "periods", "marks", "zeros", "toxic"]


def _parts(spark, folder) -> DataFrame:
    """Feature rows with their split and both kinds of weight, written once."""

    def build() -> DataFrame:
        rows = split.entity_split(bases.features(spark, folder))
        return split.with_positive_weight(
            split.with_balanced_weight(rows, LABEL, "balanced"), LABEL, "ratio"
        )

    return staged(spark, folder, "split_features", build)


def part(spark, folder, name: str) -> DataFrame:
    return _parts(spark, folder).where(F.col("split") == name)


_fitted: dict[tuple[str, str, str], object] = {}


def fitted(spark, folder, name: str, make: Callable):
    """A model of this session and folder, fitted on first use."""
    key = (spark.sparkContext.applicationId, f"{folder}#{fingerprint(spark, folder)}", name)
    if key not in _fitted:
        _fitted[key] = make()
    return _fitted[key]


def model(spark, folder, name: str):
    """A classifier fitted on the training part; kept in the shared folder under its
    input and settings, so that a later session on the same files doesn't fit it again."""
    train = part(spark, folder, "train")
    makers = {
        "LogisticRegression": lambda: (models.logistic(train.count()), NUMERIC_FEATURES, "balanced"),
        "RandomForest": lambda: (models.random_forest(), NUMERIC_FEATURES, "balanced"),
        "BoostedDepth5": lambda: (models.boosted(), NUMERIC_FEATURES, "ratio"),
        "BoostedDepth6": lambda: (models.boosted_deep(), NUMERIC_FEATURES, "ratio"),
        "Snapshot": lambda: (models.boosted_snapshot(), SNAPSHOT_NUMERIC, "ratio"),
    }

    def make():
        classifier, numeric, weight = makers[name]()
        settings = sorted(f"{p.name}={v}" for p, v in classifier.extractParamMap().items())
        own = hashlib.md5("|".join([FEATURES_VERSION, *numeric, *STATIC_CATEGORIES, weight, *settings]).encode()).hexdigest()
        path = f"{shared_folder(spark)}/models/{fingerprint(spark, folder)}-{name}-{own}"
        return models.keep_model(spark, path, lambda: models.fit(train, classifier, numeric, weight=weight))

    return fitted(spark, folder, name, make)


def calibrated(spark, folder, name: str = "RandomForest") -> models.Calibrated:
    return fitted(
        spark,
        folder,
        f"{name}_calibrated",
        lambda: models.calibrate(model(spark, folder, name), part(spark, folder, "validation")),
    )


def _evaluated(spark, folder, name: str) -> DataFrame:
    scored = models.score(model(spark, folder, name), part(spark, folder, "validation"))
    return metrics.evaluate(scored, "risk_score", LABEL, name)


# --- splits and preparation -------------------------------------------------------


@query
def ml_entity_split(spark, folder):
    rows = _parts(spark, folder)
    shared = rows.groupBy("company_id").agg(F.countDistinct("split").alias("n")).where("n > 1")
    return rows.groupBy("split").agg(
        F.countDistinct("company_id").alias("entities"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("entities_in_two_parts", shared.agg(F.count(F.lit(1))).scalar())


@query
def ml_row_split(spark, folder):
    return split.row_split(bases.records(spark, folder), "record_id").select("record_id", "split")


@query
def ml_class_weights(spark, folder):
    return split.class_weights(bases.features(spark, folder), LABEL)


@query
def ml_preprocess(spark, folder):
    """Mean and deviation of every slot of the prepared vector."""
    rows = bases.features(spark, folder)
    prepared = Pipeline(stages=prepare.preparation(NUMERIC_FEATURES, STATIC_CATEGORIES)).fit(rows).transform(rows)
    names = prepare.feature_names(prepared, NUMERIC_FEATURES)
    slots = prepared.select(F.posexplode(vector_to_array("features")).alias("slot", "value"))
    labels = F.array(*[F.lit(n) for n in names])
    return slots.groupBy("slot").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")).select(
        F.get(labels, F.col("slot")).alias("feature"), "mean", "std"
    )


@query
def ml_standardize(spark, folder):
    """Fitted on the rows that are not toxic, applied to all rows."""
    rows = bases.records(spark, folder)
    return prepare.standardize(rows.where("toxic = 0"), rows, RECORD_COLUMNS)


# --- fits -------------------------------------------------------------------------


@query
def ml_logistic(spark, folder):
    return _evaluated(spark, folder, "LogisticRegression")


@query
def ml_random_forest(spark, folder):
    return _evaluated(spark, folder, "RandomForest")


@query
def ml_boosted_a(spark, folder):
    return _evaluated(spark, folder, "BoostedDepth5")


@query
def ml_boosted_b(spark, folder):
    return _evaluated(spark, folder, "BoostedDepth6")


@query
def ml_snapshot_model(spark, folder):
    return _evaluated(spark, folder, "Snapshot")


@query
def ml_model_compare(spark, folder):
    """All models on the validation part, best first."""
    return compared(spark, folder).orderBy(F.desc("pr_auc"), "model")


@query
def ml_calibrate(spark, folder):
    """Test metrics before and after calibration on the validation part."""
    test = part(spark, folder, "test")
    raw = models.score(model(spark, folder, "RandomForest"), test)
    mapped = calibrated(spark, folder).score(test)
    return metrics.evaluate(raw, "risk_score", LABEL, "raw").unionByName(
        metrics.evaluate(mapped, "risk_score", LABEL, "calibrated")
    )


@query
def ml_grid_search(spark, folder):
    """Cross-validated accuracy per penalty kind and strength, best first."""
    rows = split.row_split(bases.records(spark, folder), "record_id").where("split = 'train'")
    found = search.grid_search(rows, RECORD_COLUMNS, "outcome", ["record_id"])
    table = spark.createDataFrame(found.table, "elastic_net double, reg_param double, accuracy double")
    return table.orderBy(F.desc("accuracy"), "elastic_net", "reg_param")


@query
def ml_ridge_price(spark, folder):
    rows = bases.sales(spark, folder)
    fit = fitted(spark, folder, "price", lambda: price.fit_price(rows))
    return price.price_metrics(fit, rows)


@query
def ml_price_breakdown(spark, folder):
    """Breakdown with weights taken from plain averages and slopes, so that the
    sums can be checked without a fitted model."""
    rows = bases.sales(spark, folder)
    base = (F.sum("price").cast("double") / F.count("price")).alias("weight")
    whole = rows.agg(base)
    parts = [whole.select(F.lit("base").alias("term"), F.lit(None).cast("string").alias("level"), "weight")]
    for name in price.CATEGORIES:
        means = rows.groupBy(F.col(name).alias("level")).agg(base)
        parts.append(means.select(F.lit(name).alias("term"), "level", (F.col("weight") - whole.scalar()).alias("weight")))
    for name in price.NUMERIC:
        slope = rows.agg(F.regr_slope(F.col("price").cast("double"), F.col(name)).alias("weight"))
        parts.append(slope.select(F.lit(name).alias("term"), F.lit(None).cast("string").alias("level"), "weight"))
    weights = parts[0]
    for more in parts[1:]:
        weights = weights.unionByName(more)
    return publish(price.estimated_price(rows, measured(weights, "price_weights"), ["order_id"]), 3)


@query
def op_model_io(spark, folder):
    """How far the scores and flags of a saved and re-loaded scorer are from the original's."""
    fit = calibrated(spark, folder, "LogisticRegression")
    whole = deploy.scorer(fit.model, fit.curve, [*NUMERIC_FEATURES, *STATIC_CATEGORIES], 0.3)
    path = fresh_path(spark, "model")
    models.save_model(whole, path)
    rows = bases.features(spark, folder)
    before = whole.transform(rows).withColumnsRenamed({"risk_score": "before", "flagged": "flagged_before"}).drop("raw_score")
    both = models.load_model(path).transform(before)
    difference = F.abs(F.col("risk_score") - F.col("before")) + F.abs(F.col("flagged") - F.col("flagged_before"))
    return both.select(*KEYS, difference.alias("difference"))


# --- the chain: compare, choose, calibrate, tune, report --------------------------

CANDIDATES = ["LogisticRegression", "RandomForest", "BoostedDepth5", "BoostedDepth6"]


def compared(spark, folder) -> DataFrame:
    """All models on the validation part, best average precision first.

    They are fitted side by side: a boosted fit is a long row of small jobs, which
    leaves most of a cluster idle.
    """

    def build() -> DataFrame:
        _parts(spark, folder)
        fit = inheritable_thread_target(spark)(lambda name: model(spark, folder, name))
        with ThreadPoolExecutor(len(CANDIDATES)) as pool:
            list(pool.map(fit, CANDIDATES))
        return metrics.compare([_evaluated(spark, folder, name) for name in CANDIDATES])

    return staged(spark, folder, "compared", build)


def chosen(spark, folder) -> str:
    """The name of the model with the best average precision; ties by name."""
    return compared(spark, folder).orderBy(F.desc("pr_auc"), "model").first()["model"]


def chain_scores(spark, folder, name: str) -> DataFrame:
    """Scores of one part by the chosen model, calibrated on the validation part."""
    scorer = calibrated(spark, folder, chosen(spark, folder)).score
    keep = [*KEYS, "founded_year", LABEL, "risk_score"]
    return staged(spark, folder, f"chain_{name}", lambda: scorer(part(spark, folder, name)).select(*keep))


def chain_threshold(spark, folder) -> DataFrame:
    """The threshold of least cost on the validation part."""
    return metrics.cost_threshold(chain_scores(spark, folder, "validation"), "risk_score", LABEL)


@query
def ml_chain_choice(spark, folder):
    """The models in the order of their validation results, and which one is used."""
    best = chosen(spark, folder)
    return compared(spark, folder).withColumn("chosen", (F.col("model") == best).cast("int"))


@query
def ml_chain_threshold(spark, folder):
    return chain_threshold(spark, folder)


@query
def ml_chain_report(spark, folder):
    """Per class on the test part, at the threshold tuned on the validation part."""
    limit = chain_threshold(spark, folder).first()["threshold"]
    return metrics.class_report(chain_scores(spark, folder, "test"), "risk_score", LABEL, limit)


@query
def ml_chain_cohorts(spark, folder):
    return metrics.roc_auc(chain_scores(spark, folder, "test"), "risk_score", LABEL, ["founded_year"])


# --- metrics ----------------------------------------------------------------------


@query
def ml_roc_auc(spark, folder):
    return metrics.roc_auc(bases.rule_scored(spark, folder), "risk_score", LABEL)


@query
def ml_avg_precision(spark, folder):
    return metrics.average_precision(bases.rule_scored(spark, folder), "risk_score", LABEL)


@query
def ml_f1_brier(spark, folder):
    return metrics.f1_brier(bases.rule_scored(spark, folder), "risk_score", LABEL)


@query
def ml_cost_threshold(spark, folder):
    return metrics.cost_threshold(bases.rule_scored(spark, folder), "risk_score", LABEL)


@query
def ml_class_report(spark, folder):
    return metrics.class_report(bases.rule_scored(spark, folder), "risk_score", LABEL, 0.3)


@query
def ml_confusion(spark, folder):
    called = bases.rule_scored(spark, folder).withColumn("called", F.when(F.col("risk_score") >= 0.3, 1).otherwise(0))
    return metrics.confusion(called, "called", LABEL)


@query
def ml_cohort_auc(spark, folder):
    return metrics.roc_auc(bases.rule_scored(spark, folder), "risk_score", LABEL, ["founded_year"])


# --- scoring ----------------------------------------------------------------------


@query
def ml_score_tier(spark, folder):
    scored = scenarios.score_tier(bases.features(spark, folder), calibrated(spark, folder).score)
    return scored.select(*KEYS, "risk_score", "risk_tier")


@query
def ml_portfolio(spark, folder):
    found = scenarios.portfolio(
        bases.features(spark, folder),
        bases.entities(spark, folder),
        calibrated(spark, folder).score,
        at_most={"runway_months_latest": 99.0},
    )
    return found.select("company_id", "sector", "region", "risk_score", "risk_tier", "runway_months_latest", "mrr_latest")


@query
def ml_what_if(spark, folder):
    latest = panel.latest_row(bases.features(spark, folder))
    options = {
        "more runway": {"runway_months_latest": 24.0, "consecutive_low_runway_months": 0.0},
        "less churn": {"churn_rate_latest": 0.02},
        "falling revenue": {"mrr_slope_6m": -50.0, "ltv_cac_ratio_latest": 0.5},
        "people leave": {"attrition_rate_latest": 0.4, "glassdoor_rating_latest": 1.5},
    }
    return scenarios.what_if(latest, options, calibrated(spark, folder).score, scenarios.LEVERS)


@query
def ml_monotonic_check(spark, folder):
    """How many rows were twinned and for how many a longer runway raised the score."""
    rows = bases.features(spark, folder)
    broken = scenarios.direction_violations(
        rows, "runway_months_latest", 1.0, 36.0, lambda df: models.score(model(spark, folder, "Snapshot"), df)
    )
    return rows.agg(F.count(F.lit(1)).alias("twins")).withColumn(
        "violations", broken.agg(F.count(F.lit(1))).scalar()
    )


# --- explanations -----------------------------------------------------------------


@query
def ml_contributions(spark, folder):
    """Shapley contributions of the boosted model for every feature row."""
    fit = model(spark, folder, "BoostedDepth5")
    prepared = fit.transform(bases.features(spark, folder))
    names = prepare.feature_names(prepared, NUMERIC_FEATURES)
    return explain.tree_contributions(prepared, fit.stages[-1], names, KEYS)


def linear_contributions(spark, folder) -> DataFrame:
    """Contributions of one-feature slopes, rounded so that ranks are stable."""
    rows = bases.features(spark, folder)

    def each(value: Callable[[str], Column]) -> Column:
        row = rows.agg(F.struct(*[value(f).alias(f) for f in NUMERIC_FEATURES]).alias("s"))
        return row.scalar()

    weights = each(lambda f: F.regr_slope(F.col(LABEL).cast("double"), F.col(f).cast("double")))
    means = each(lambda f: F.avg(F.col(f).cast("double")))
    long = explain.linear_contributions(rows, weights, means, NUMERIC_FEATURES, KEYS)
    return long.withColumn("contribution", F.round("contribution", 6))


@query
def ml_global_importance(spark, folder):
    return explain.global_importance(linear_contributions(spark, folder))


@query
def op_topk_signed(spark, folder):
    ranked = profile.topk_signed(linear_contributions(spark, folder), KEYS, "contribution", 3)
    return ranked.select(*KEYS, "direction", "place", "feature", "contribution")


def _listed(records: Column) -> Column:
    return F.array_join(F.transform(records, lambda r: r["feature"]), ",")


@query
def ml_local_top(spark, folder):
    tops = explain.local_top(linear_contributions(spark, folder), KEYS)
    return tops.select(
        *KEYS, _listed(F.col("top_risk_drivers")).alias("up"), _listed(F.col("top_protective_factors")).alias("down")
    )


@query
def ml_narrative(spark, folder):
    tops = explain.local_top(linear_contributions(spark, folder), KEYS)
    return explain.narrative(tops, F.col("company_id").cast("string")).select(*KEYS, "narrative")


@query
def fn_json_out(spark, folder):
    tops = explain.local_top(linear_contributions(spark, folder), KEYS)
    told = explain.narrative(tops, F.col("company_id").cast("string"))
    return explain.explanation_json(told, KEYS)


def chain_explained(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Explanations of every feature row and the importance of every feature, by the chosen model."""
    fit = model(spark, folder, chosen(spark, folder))
    prepared = fit.transform(bases.features(spark, folder))
    names = prepare.feature_names(prepared, NUMERIC_FEATURES)
    mean = fit.transform(part(spark, folder, "train")).agg(Summarizer.mean(F.col("features")).alias("m")).first()["m"]
    contributions = explain.Contributions(spark, fit.stages[-1], mean.toArray())
    return fitted(spark, folder, "chain_explained", lambda: explain.explained(prepared, contributions, names, KEYS))


@query
def ml_chain_explained(spark, folder):
    """Drivers, sentence and record of every row by the chosen model, and how far its
    contributions are from adding up to the model's own score."""
    rows, _ = chain_explained(spark, folder)
    told = explain.narrative(rows, F.col("company_id").cast("string"))
    gap = F.abs(F.col("base_value") + F.col("contribution_sum") - F.col("model_score"))
    record = explain.explanation_json(told.drop("contribution_sum", "model_score"), KEYS)
    listed = told.select(
        *KEYS, _listed(F.col("top_risk_drivers")).alias("up"), _listed(F.col("top_protective_factors")).alias("down"), "narrative", gap.alias("gap")
    )
    return listed.join(record, KEYS)


@query
def ml_chain_importance(spark, folder):
    """The 15 features with the largest mean absolute contribution to the chosen model."""
    _, importance = chain_explained(spark, folder)
    return importance.orderBy(F.desc("mean_abs_contribution"), "feature").limit(15)


@query
def ml_snapshot_schema(spark, folder):
    """The snapshot feature set has no history features and no missing values."""
    history = ("slope_", "volatility_", "pct_change_", "consecutive_", "months_since_")
    table = profile.schema_check(bases.features(spark, folder), SNAPSHOT_FEATURES)
    banned = F.lit(False)
    for word in history:
        banned = banned | F.contains(F.col("column"), F.lit(word))
    return table.withColumn("needs_history", banned)

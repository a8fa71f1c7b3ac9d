"""Exact classification metrics on score columns.

Scores are reduced to one row per distinct score first; ranks and prefix sums
then run over ranges of scores (``operators.ordered``), so a score that a third
of all rows share is one row, and no task ever sorts the whole column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio_or_null
from tidemark.operators.ordered import running_totals
from tidemark.session import measured


def score_counts(df: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.col(label) == 1
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*group, F.col(score).alias("score"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )


def _big(count: Column) -> Column:
    return count.cast("decimal(19,0)")


def roc_auc(df: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Rank-sum AUC per group; null where one class is missing."""
    ranked = running_totals(score_counts(df, score, label, group), "score", ["pos", "neg"], group)
    wins = _big(F.col("pos")) * _big(2 * F.col("neg_before") + F.col("neg"))
    pairs = _big(F.max("pos_total")) * _big(F.max("neg_total"))
    return ranked.groupBy(*group).agg(
        ratio_or_null(F.sum(wins), 2 * pairs.cast("double")).alias("roc_auc")
    )


def average_precision(df: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Step-sum average precision over distinct scores, highest first."""
    ranked = running_totals(
        score_counts(df, score, label, group), "score", ["pos", "neg"], group, descending=True
    )
    hits = F.col("pos_before") + F.col("pos")
    flagged = hits + F.col("neg_before") + F.col("neg")
    step = F.col("pos") / F.col("pos_total") * hits / flagged
    return ranked.groupBy(*group).agg(F.sum(F.when(F.col("pos_total") > 0, step)).alias("avg_precision"))


def f1_brier(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    hit, truth = F.col(score) >= threshold, F.col(label) == 1
    return df.agg(
        F.count_if(hit & truth).alias("tp"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
        F.avg((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("brier"),
    ).select(
        F.coalesce(
            F.try_divide(2.0 * F.col("tp"), (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")),
            F.lit(0.0),
        ).alias("f1"),
        "brier",
    )


def cost_threshold(
    df: DataFrame, score: str, label: str, cost_fn: float = 5.0, cost_fp: float = 1.0
) -> DataFrame:
    """The score threshold with the least cost of misses and false alarms.

    A miss costs ``cost_fn`` and a false alarm ``cost_fp``, both per positive; a
    threshold that catches no positive counts as one false alarm per positive.
    The lowest threshold wins a tie.
    """
    ranked = running_totals(
        score_counts(df, score, label), "score", ["pos", "neg"], descending=True
    ).where("pos_total > 0")
    hits = F.col("pos_before") + F.col("pos")
    alarms = F.when(hits > 0, F.col("neg_before") + F.col("neg")).otherwise(F.col("pos_total"))
    cost = (cost_fn * (F.col("pos_total") - hits) + cost_fp * alarms) / F.col("pos_total")
    best = ranked.agg(F.min(F.struct(cost.alias("cost"), F.col("score").alias("threshold"))).alias("best"))
    return best.select("best.threshold", "best.cost")


def confusion(df: DataFrame, predicted: str, label: str, positive: int = 1) -> DataFrame:
    """Confusion cells and the ratios built on them; ``positive`` picks the class."""
    hit, truth = F.col(predicted) == positive, F.col(label) == positive
    cells = df.agg(
        F.count_if(hit & truth).alias("tp"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
        F.count_if(~hit & ~truth).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.withColumns(
        {
            "accuracy": ratio_or_null(tp + tn, tp + fp + fn + tn),
            "precision": ratio_or_null(tp, tp + fp),
            "recall": ratio_or_null(tp, tp + fn),
            "f1": ratio_or_null(2 * tp, 2 * tp + fp + fn),
        }
    )


def class_report(
    df: DataFrame, score: str, label: str, threshold: float, names: Sequence[str] = ("Healthy", "At-Risk")
) -> DataFrame:
    """Per-class precision, recall, F1 and support at a threshold, plus the
    macro and the support-weighted average, from one pass over the rows.
    Undefined ratios count as 0."""
    hit, truth = F.col(score) >= threshold, F.col(label) == 1
    cells = df.agg(
        F.count_if(hit & truth).alias("tp"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
        F.count_if(~hit & ~truth).alias("tn"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(ratio_or_null(top, bottom), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    wrong = fp + fn
    lines = [
        F.struct(
            F.lit(name).alias("class"),
            ratio(right, right + called_wrongly).alias("precision"),
            ratio(right, right + missed).alias("recall"),
            ratio(2 * right, 2 * right + wrong).alias("f1"),
            (right + missed).alias("support"),
        )
        for name, right, called_wrongly, missed in ((names[0], tn, fn, fp), (names[1], tp, fp, fn))
    ]
    pair = cells.select(lines[0].alias("a"), lines[1].alias("b"))
    ratios = ("precision", "recall", "f1")
    support = F.col("a.support") + F.col("b.support")
    macro = [((F.col(f"a.{r}") + F.col(f"b.{r}")) / 2).alias(r) for r in ratios]
    weighted = [
        ratio(F.col(f"a.{r}") * F.col("a.support") + F.col(f"b.{r}") * F.col("b.support"), support).alias(r)
        for r in ratios
    ]
    averages = [
        F.struct(F.lit(name).alias("class"), *values, support.alias("support"))
        for name, values in (("macro avg", macro), ("weighted avg", weighted))
    ]
    return pair.select(F.inline(F.array("a", "b", *averages)))


def evaluate(df: DataFrame, score: str, label: str, model: str) -> DataFrame:
    """The four headline metrics of one model, four decimals.

    The scores are written once: each metric looks at them again, and the model
    should not run again for it.
    """
    df = measured(df.select(score, label), "scores")
    parts = {
        "roc_auc": roc_auc(df, score, label).scalar(),
        "pr_auc": average_precision(df, score, label).scalar(),
    }
    return f1_brier(df, score, label).select(
        F.lit(model).alias("model"),
        *[F.round(value, 4).alias(name) for name, value in parts.items()],
        F.round("f1", 4).alias("f1_at_0_5"),
        F.round("brier", 4).alias("brier_score"),
    )


def compare(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("pr_auc"), "model")

"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier over plain text measures gives every document its own
evidence.  One grouped aggregation sums that evidence per host and path.  Paths
are shrunk toward their host, hosts toward the whole: the strength of each prior
comes from how far the groups differ beyond what their documents' spread
explains, so a sparse site tells little and a large one speaks for itself.  The
score of a document joins its own evidence with the posterior of its path, from
which the document itself is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts, stored, whole
from tidemark.operators.ordered import running_totals

LOSS = 10.0        # a good document rejected costs so many poor ones kept
RIDGE = 1e-2
EDGE = 1e-6


def measures(text: Column) -> dict[str, Column]:
    """Plain measures of a text; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    size = F.char_length(text)
    chars = F.greatest(size, F.lit(1))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    per_word = F.greatest(words, F.lit(1))
    distinct = F.size(F.array_distinct(F.split(text, r"[\x20\x09-\x0D]+"))) / per_word

    def share(pattern: str, of: Column) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / of

    def single(mark: str, of: Column) -> Column:
        return (size - F.char_length(F.replace(text, F.lit(mark), F.lit("")))) / of

    return {
        "upper": share(r"\p{Lu}", chars),
        "shouts": single("!", per_word),
        "bars": single("|", per_word),
        "symbol_runs": share(r"[#%&*$]{3}", per_word),
        "distinct": distinct,
        "word_size": size / per_word,
        "words": F.log1p(words.cast("double")),
        "digits": share("[0-9]", chars),
        "stops": share("[.,]", per_word),
        "line_size": F.log1p(size / (single("\n", F.lit(1)) + 1)),
        "distinct_words": distinct * F.log1p(words.cast("double")),
        "signs": share(r"[^\p{L}\p{N}\s.,]", chars),
        "glued": share(r"[.,]\p{L}", per_word),
    }


@dataclass(frozen=True)
class Classifier:
    """Logistic weights over standardized measures."""

    names: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float

    def chance(self, values: dict[str, Column]) -> Column:
        margin = F.lit(self.bias)
        for name, mean, scale, weight in zip(self.names, self.mean, self.scale, self.weights, strict=True):
            margin = margin + (values[name] - mean) * (weight / scale)
        return F.least(F.greatest(1 / (1 + F.exp(-margin)), F.lit(EDGE)), F.lit(1 - EDGE))


def _totals(rows: DataFrame, cells: list[Column]) -> np.ndarray:
    """The sums of ``cells`` over all rows, in one job; without rows, zeros."""
    return np.array([v or 0.0 for v in rows.agg(F.array(*[F.sum(c) for c in cells]).alias("t")).first()["t"]], float)


def _newton_sums(weights: np.ndarray, mean: np.ndarray, scale: np.ndarray):
    """Adds up a task's part of a Newton step, the gradient beside the curvature."""

    def run(batches):
        import pyarrow as pa

        sums = np.zeros((len(weights), len(weights) + 1))
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            a = np.c_[np.ones(batch.num_rows), (np.stack(columns[1:], axis=1) - mean) / scale]
            p = 1 / (1 + np.exp(-np.clip(a @ weights, -30, 30)))
            sums[:, 0] += a.T @ (p - columns[0])
            sums[:, 1:] += (a * (p * (1 - p))[:, None]).T @ a
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    return run


def fit(rows: DataFrame, names: list[str], label: str = "_label") -> Classifier:
    """Newton steps on the ridge logistic loss; without both classes, the base rate alone.

    Every step is one pass over all ``rows``, in which a task adds up its gradient and
    curvature; the driver gets one small row per task.
    """
    width = len(names)
    y, m = F.col(label).cast("double"), [F.col(f"_m_{n}") for n in names]
    n, good, *means = _totals(rows, [F.lit(1.0), y, *m])
    if good in (0, n):
        return Classifier(tuple(names), (0.0,) * width, (1.0,) * width, (0.0,) * width, 0.0)
    mean = np.array(means) / n
    spread = _totals(rows, [(c - float(v)) * (c - float(v)) for c, v in zip(m, mean, strict=True)])
    scale = np.sqrt(spread / n) + 1e-9
    w = np.zeros(width + 1)
    inputs = rows.select(y.alias("_y"), *m)
    for _ in range(50):
        found = inputs.mapInArrow(_newton_sums(w, mean, scale), "sums array<double>").collect()
        sums = sum(np.array(r["sums"]).reshape(width + 1, width + 2) for r in found)
        step = np.linalg.solve(sums[:, 1:] + RIDGE * np.eye(width + 1), sums[:, 0] + RIDGE * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(tuple(names), *(tuple(map(float, v)) for v in (mean, scale, w[1:])), float(w[0]))


def cut_off(scores: np.ndarray, good: np.ndarray, loss: float = LOSS) -> float:
    """The score below which documents go: least loss, the middle of the best interval."""
    if len(good) == 0 or good.min() == good.max():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order].astype(bool)
    edges = np.flatnonzero(np.r_[True, s[1:] > s[:-1]])  # a cut lies before the first of equal scores
    lost = np.r_[0, np.cumsum(g)][edges] * loss
    kept = (~g).sum() - np.r_[0, np.cumsum(~g)][edges]
    at = edges[np.argmin(lost + kept)]
    return float(s[0] - 1 if at == 0 else (s[at - 1] + s[at]) / 2)


def least_loss(rows: DataFrame, score: str = "_score", good: str = "_label", loss: float = LOSS) -> float:
    """``cut_off`` of a table of any size: distinct scores are counted and ranked by ranges."""
    hit = F.col(good) == 1
    counts = rows.groupBy(F.col(score).alias("s")).agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    ranked = running_totals(counts, "s", ["pos", "neg"])
    lost = F.col("pos_before") * float(loss) + F.col("neg_total") - F.col("neg_before")
    best = ranked.where("pos_total > 0 AND neg_total > 0").agg(F.min(F.struct(lost.alias("lost"), "s")).alias("best")).first()["best"]
    if best is None:
        return -np.inf
    below = counts.where(F.col("s") < best["s"]).agg(F.max("s")).first()[0]
    return float(best["s"] - 1 if below is None else (below + best["s"]) / 2)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _key(column: str | None) -> Column:
    if column is None:
        return F.lit("")
    return F.coalesce(F.concat(F.lit("a"), F.col(column).cast("string")), F.lit("b"))


def _strength(spread: float, within: float) -> float:
    return float(min(max(within / max(spread, 1e-12), 1.0), 1e6))


def posteriors(evidence: DataFrame) -> tuple[DataFrame, float, float, float]:
    """Sums per host and path, the overall mean and the two prior strengths.

    ``evidence`` has _host, _path and _chance.  The strengths come from one row
    of moments: spread between groups less what the spread within explains.
    """
    paths = stored(
        evidence.groupBy("_host", "_path").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("_chance").alias("_s"), F.sum(F.col("_chance") ** 2).alias("_q")
        ),
        "quality_paths",
    )
    hosts = paths.groupBy("_host").agg(F.sum("_n").alias("_host_n"), F.sum("_s").alias("_host_s"))
    both = stored(paths.join(hosts, "_host"), "quality_groups")
    one = hosts.agg(
        F.sum("_host_n").alias("n"), F.sum("_host_s").alias("s"), F.count(F.lit(1)).alias("groups"),
        F.sum(F.col("_host_s") ** 2 / F.col("_host_n")).alias("between"), F.sum(F.col("_host_n") ** 2).alias("n2"),
    ).first()
    two = both.agg(
        F.sum("_q").alias("q"), F.count(F.lit(1)).alias("groups"), F.sum(F.col("_s") ** 2 / F.col("_n")).alias("between"),
        F.sum(F.col("_n") ** 2 / F.col("_host_n")).alias("n2"),
    ).first()
    if not one["n"]:
        return both, 0.5, 1.0, 1.0
    n, mean = one["n"], min(max(one["s"] / one["n"], EDGE), 1 - EDGE)
    within = max((two["q"] - two["between"]) / max(n - two["groups"], 1), 1e-9)
    host = (one["between"] - n * mean * mean - (one["groups"] - 1) * within) / max(n - one["n2"] / n, 1)
    path = (two["between"] - one["between"] - (two["groups"] - one["groups"]) * within) / max(n - two["n2"], 1)
    return both, float(mean), _strength(host, within), _strength(path, within)


def score(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str | None = "lang",
    label: str = "quality",
    label_key: str = "doc_id",
) -> DataFrame:
    """``df`` with quality_evidence, quality_host, quality_path, quality_score and quality_keep.

    Evidence and posteriors are chances of good quality, the score is a log odds
    and keep says whether it reaches the cut-off.  All labelled rows are used:
    four fifths of them (by hash of the key) fit the weights, one fifth sets the
    cut-off.  A null text counts as empty; null
    hosts and paths are groups of their own; labels that are null, of other
    values than 0 and 1 or of unknown keys are ignored; without both classes
    everything is kept.  Repeated rows each count.  Columns of these names are
    replaced, others kept; an empty table gives an empty result.
    """
    columns = measures(F.col(text))
    names = list(columns)
    rows = stored(
        df.select(
            F.col(key).alias("_key"), _key(host).alias("_host"), _key(path).alias("_path"), *[c.alias(f"_m_{n}") for n, c in columns.items()]
        ),
        "quality_measures",
    )
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(label_key).alias("_key"), F.col(label).cast("int").alias("_label"))
    part = F.pmod(F.xxhash64(F.lit(7), "_key"), F.lit(5)).alias("_part")
    chosen = stored(
        rows.join(known, "_key").select("_host", "_path", "_label", part, *[f"_m_{n}" for n in names]), "quality_labelled"
    )
    model = fit(chosen.where("_part <> 0"), names)
    stored_measures = {n: F.col(f"_m_{n}") for n in names}
    groups, mean, host_strength, path_strength = posteriors(
        rows.select("_host", "_path", model.chance(stored_measures).alias("_chance"))
    )

    def scored(frame: DataFrame) -> DataFrame:
        p = F.col("_chance")
        of_host = (F.col("_host_s") - p + host_strength * mean) / (F.col("_host_n") - 1 + host_strength)
        of_path = (F.col("_s") - p + path_strength * F.col("_of_host")) / (F.col("_n") - 1 + path_strength)
        bounded = F.least(F.greatest(F.col("_of_path"), F.lit(EDGE)), F.lit(1 - EDGE))
        return (
            frame.join(groups.select("_host", "_path", "_n", "_s", "_host_n", "_host_s"), ["_host", "_path"])
            .withColumn("_of_host", of_host)
            .withColumn("_of_path", of_path)
            .withColumn("_score", _logit(p) + _logit(bounded) - float(np.log(mean / (1 - mean))))
        )

    checked = scored(
        chosen.select("_host", "_path", "_label", "_part", model.chance(stored_measures).alias("_chance"))
    ).select("_score", "_label", "_part")
    own = checked.where("_part = 0")
    if own.agg(F.countDistinct("_label")).first()[0] < 2:
        own = checked
    limit = least_loss(stored(own, "quality_checked"))
    made = {
        "quality_evidence": F.col("_chance"), "quality_host": F.col("_of_host"), "quality_path": F.col("_of_path"),
        "quality_score": F.col("_score"), "quality_keep": F.col("_score") >= F.lit(limit),
    }
    kept = df.drop(*made)
    frame = df.select(
        whole(kept), _key(host).alias("_host"), _key(path).alias("_path"), model.chance(measures(F.col(text))).alias("_chance")
    )
    return scored(frame).select(*parts(kept), *[c.alias(n) for n, c in made.items()])


def keep_good(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", path: str | None = "lang", **settings
) -> DataFrame:
    """The rows of ``df`` that the classifier keeps, with the columns they had."""
    roles = {"key": key, "text": text, "host": host, "path": path}
    held = df.select(whole(df), *[F.col(c).alias(f"_{r}") for r, c in roles.items() if c])
    scored = score(held, labels, **{r: f"_{r}" if c else None for r, c in roles.items()}, **settings)
    return scored.where("quality_keep").select(*parts(df))

"""Cross-validated grid of logistic models, all fitted in the same passes over the rows.

Every setting on every fold is a problem of its own, but all of them need the same
thing from a row: what it adds to the problem's loss, gradient and curvature at the
problem's current weights.  One pass gives these sums for all problems at once: a
batch's rows are standardized once and multiplied with the weights of all problems, each
task adds up its Arrow batches and gives one row per problem, a grouped aggregation
adds the tasks up, and the driver takes a Newton step per problem.  Penalties on sizes
are dealt with in the step (coordinate descent on the quadratic model until the signs of
the weights are those of its minimum).  A step that
made its problem worse is halved.  Problems that have settled leave the passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.learn.split import draw
from tidemark.session import measured

PASSES = 60
SETTLED = 1e-7


@dataclass
class Problem:
    """One setting on the rows outside one fold (``fold`` -1: on all rows)."""

    fold: int
    ratio: float       # share of the penalty on sizes
    strength: float    # penalty on the mean loss
    weights: np.ndarray  # intercept first, of standardized columns
    value: float = np.inf
    step: np.ndarray = field(default_factory=lambda: np.zeros(0))
    settled: bool = False

    def penalty(self, weights: np.ndarray) -> float:
        own = weights[1:]
        return self.strength * (self.ratio * np.abs(own).sum() + (1 - self.ratio) / 2 * own @ own)

    def trial(self) -> np.ndarray:
        return self.weights + self.step if len(self.step) else self.weights

    def learn(self, count: float, loss: float, gradient: np.ndarray, curvature: np.ndarray) -> None:
        """Take in the sums at the trial weights: accept them and look ahead, or halve the step."""
        tried = self.trial()
        value = loss / count + self.penalty(tried)
        if value > self.value + 1e-12 * abs(self.value):
            self.step = self.step / 2
            self.settled = np.abs(self.step).max() < SETTLED
            return
        self.weights, self.value = tried, value
        self.step = newton_step(tried, gradient / count, curvature / count, self.strength, self.ratio)
        self.settled = np.abs(self.step).max() < SETTLED


def newton_step(weights: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, strength: float, ratio: float) -> np.ndarray:
    """The step to the minimum of the quadratic model plus penalty; the intercept has none."""
    free = np.zeros(len(weights), bool)
    free[0] = True
    ridge = np.where(free, 0.0, strength * (1 - ratio))
    slope = gradient + ridge * weights
    bend = curvature + np.diag(ridge)
    bend[np.diag_indices_from(bend)] += 1e-12
    if not strength * ratio:
        return -np.linalg.lstsq(bend, slope, rcond=None)[0]
    lasso = np.where(free, 0.0, strength * ratio)
    usable = np.diag(bend) > 2e-12
    pulled = slope - bend @ weights
    new = weights.copy()
    for turn in range(10_000):
        moved = 0.0
        for j in np.flatnonzero(usable):
            pull = bend[j, j] * new[j] - (pulled[j] + bend[j] @ new)
            value = np.sign(pull) * max(abs(pull) - lasso[j], 0.0) / bend[j, j]
            moved = max(moved, abs(value - new[j]))
            new[j] = value
        if moved < SETTLED / 100:
            break
        if turn % 5 == 4:
            exact = _minimum_with_signs(new, bend, pulled, lasso, usable)
            if exact is not None:
                return exact - weights
    return new - weights


def _minimum_with_signs(new: np.ndarray, bend: np.ndarray, pulled: np.ndarray, lasso: np.ndarray, usable: np.ndarray) -> np.ndarray | None:
    """The minimum if its weights have the signs of ``new``, else nothing.

    With the signs known it is a linear system; columns that go together make coordinate
    descent crawl, though its signs are right after a few turns.
    """
    on = usable & ((new != 0) | (lasso == 0))
    exact = new.copy()
    exact[on] = 0.0
    right = -(pulled + lasso * np.sign(new) + bend @ exact)[on]
    exact[on] = np.linalg.lstsq(bend[np.ix_(on, on)], right, rcond=None)[0]
    slope = pulled + bend @ exact
    slack = SETTLED / 100
    same = np.all((np.sign(exact) == np.sign(new))[on & (lasso > 0)])
    flat = np.all(np.abs(slope + lasso * np.sign(exact))[on] <= slack)
    low = np.all(np.abs(slope)[usable & ~on] <= lasso[usable & ~on] + slack)
    return exact if same and flat and low else None


def _summed(rows: DataFrame, work, width: int) -> dict[int, np.ndarray]:
    """Per problem the sum over all tasks of what ``work(features, label, fold)`` gives for a batch."""

    def run(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(batch.num_rows, -1)
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for problem, values in work(x, y, fold):
                sums[problem] = sums.get(problem, 0.0) + values
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["problem", "sums"],
            )

    parts = rows.select("_x", "_y", "_fold").mapInArrow(run, "problem long, sums array<double>")
    total = parts.select("problem", F.posexplode("sums").alias("at", "v")).groupBy("problem", "at").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for row in total.collect():  # problems times sums, whatever the rows
        out.setdefault(row.problem, np.zeros(width))[row.at] = row.v
    return out


def _standards(rows: DataFrame, size: int, folds: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and one over the sample deviation of every column on the rows outside each fold, and on all (-1)."""
    cells = rows.groupBy("_fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(F.get("_x", F.lit(j))) for j in range(size)]).alias("mean"),
        F.array(*[F.var_pop(F.get("_x", F.lit(j))) for j in range(size)]).alias("var"),
    ).collect()
    out = {}
    for fold in [-1, *range(folds)]:
        used = [c for c in cells if c["_fold"] != fold]
        n = np.array([c.n for c in used], float)
        if not n.sum():
            raise ValueError("no rows to fit on")
        means, variances = np.array([c["mean"] for c in used]), np.array([c["var"] for c in used])
        mean = n @ means / n.sum()
        spread = n @ (variances + (means - mean) ** 2) / max(n.sum() - 1, 1)
        out[fold] = mean, np.where(spread > 0, 1 / np.sqrt(np.where(spread > 0, spread, 1)), 0.0)
    return out


def _column_map(base: tuple[np.ndarray, np.ndarray], own: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What makes the columns standardized by ``own``, intercept first, out of those standardized by ``base``."""
    (base_mean, base_scale), (mean, scale) = base, own
    varies = base_scale > 0
    out = np.diag(np.concatenate(([1.0], np.where(varies, scale / np.where(varies, base_scale, 1), 0.0))))
    out[0, 1:] = (base_mean - mean) * scale
    return out


@dataclass
class Search:
    """``table`` has (elastic_net, reg_param, accuracy); ``fits`` the weights of every setting on all rows."""

    table: list[tuple[float, float, float]]
    fits: list[np.ndarray]
    passes: int


def grid_search(
    train: DataFrame,
    numeric: Sequence[str],
    label: str,
    keys: Sequence[str],
    folds: int = 10,
    strengths: Sequence[float] = tuple(10.0**e for e in range(-3, 4)),
    ratios: Sequence[float] = (0.0, 1.0),
    seed: int = 42,
) -> Search:
    """Cross-validated accuracy of logistic models over penalty kind and strength.

    ``strengths`` are inverse penalties on the summed loss, ``ratios`` the share of the
    penalty on sizes (0: squares only, 1: sizes only).  The fold of a row follows from
    its keys.  Columns are standardized on the rows a model is fitted on; a missing
    number fails the search.
    """
    cells = [F.coalesce(F.col(c).cast("double"), F.raise_error(F.lit(f"{c} has a missing number")).cast("double")) for c in numeric]
    rows = measured(
        train.select(F.array(*cells).alias("_x"), F.col(label).cast("double").alias("_y"), F.floor(draw(*keys, seed=seed) * folds).cast("int").alias("_fold")),
        "search_rows",
    )
    size, total = len(numeric), rows.count()
    standards = _standards(rows, size, folds)
    settings = [(r, 1.0 / (s * max(total, 1))) for r in ratios for s in strengths]
    problems = [Problem(f, r, s, np.zeros(size + 1)) for f in [-1, *range(folds)] for r, s in settings]
    # all problems look at the same columns; what they see of them is a linear map per fold
    mean, scale = standards[-1]
    maps = {f: _column_map(standards[-1], own) for f, own in standards.items()}
    first, second = np.triu_indices(size + 1)
    width = 2 + (size + 1) + len(first)

    def columns(x):
        return np.column_stack((np.ones(len(x)), (x - mean) * scale))

    passes = 0
    while passes < PASSES and not all(p.settled for p in problems):
        at = [k for k, p in enumerate(problems) if not p.settled]
        folds_of = np.array([problems[k].fold for k in at])
        weights = np.column_stack([maps[problems[k].fold] @ problems[k].trial() for k in at])

        def derivatives(x, y, fold, at=at, folds_of=folds_of, weights=weights):
            z, own = columns(x), y[:, None]
            used = fold[:, None] != folds_of
            logits = z @ weights
            small = np.exp(-np.abs(logits))
            chance = np.where(logits >= 0, 1.0, small) / (1 + small)
            losses = np.where(used, np.log1p(small) + np.maximum(logits, 0) - own * logits, 0).sum(axis=0)
            slopes = z.T @ np.where(used, chance - own, 0)
            bends = (z[:, first] * z[:, second]).T @ np.where(used, chance * (1 - chance), 0)
            yield from zip(at, np.vstack((used.sum(axis=0), losses, slopes, bends)).T)

        for k, sums in _summed(rows, derivatives, width).items():
            if sums[0]:
                own, bend = maps[problems[k].fold], np.empty((size + 1, size + 1))
                bend[first, second] = bend[second, first] = sums[size + 3 :]
                problems[k].learn(sums[0], sums[1], own.T @ sums[2 : size + 3], own.T @ bend @ own)
        passes += 1

    every = np.array([p.fold for p in problems])
    final = np.column_stack([maps[p.fold] @ p.weights for p in problems])

    def hits(x, y, fold):
        held = fold[:, None] == every
        right = held & ((columns(x) @ final > 0) == (y == 1)[:, None])
        for k in np.flatnonzero(held.any(axis=0)):
            yield k, np.array([held[:, k].sum(), right[:, k].sum()], float)

    found = _summed(rows, hits, 2)
    table = []
    for ratio, strength in settings:
        shares = [found[k][1] / found[k][0] for k, p in enumerate(problems) if (p.ratio, p.strength) == (ratio, strength) and k in found]
        table.append((ratio, strength, float(np.mean(shares)) if shares else None))
    return Search(table, [p.weights for p in problems if p.fold == -1], passes)

"""Boosted trees with the trees of Spark's ``GBTClassifier``, without its small jobs.

Spark grows every level of every tree in a job of its own and walks through the rows
one by one.  Here rows are binned once, at the edges that Spark finds, into one byte
per feature; a level is a few counts over whole columns.  Up to ``LOCAL`` bytes one
task fits all rounds; beyond that a level is one job over the kept chunks of rows,
which sends back sums per node, feature and bin.

Samples of rows, subsets of features, the order of nodes and the choice among splits
are Spark's: its generators are followed number by number, so the model is the one
that ``GBTClassifier`` fits on the same partitions, up to the rounding of sums.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import fresh_path

LOCAL = 1 << 24    # bytes of binned rows that one task takes through all rounds
EXACT = 1 << 20    # bytes up to which every node is counted, as Spark does; beyond, one child is its parent less the other
CHUNK = 1 << 17    # rows of a chunk
APART = 16         # chunks whose sums are added one after the other, as Spark adds its partitions'
REBUILT = 32       # rounds after which scores are made anew from the trees, so that lineage stays short
_WORD = (1 << 64) - 1
_INT = (1 << 32) - 1

# --- Spark's generators -----------------------------------------------------------


def _murmur(data: bytes, seed: int) -> int:
    """Scala's MurmurHash3.bytesHash of whole words."""
    h = seed
    for at in range(0, len(data), 4):
        k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & _INT
        k = ((k << 15 | k >> 17) & _INT) * 0x1B873593 & _INT
        h ^= k
        h = ((h << 13 | h >> 19) & _INT) * 5 + 0xE6546B64 & _INT
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & _INT
    h = (h ^ h >> 13) * 0xC2B2AE35 & _INT
    return h ^ h >> 16


def _first_state(seed: int) -> int:
    """The state that XORShiftRandom makes of a seed."""
    data = (seed & _WORD).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(s):
    s = s ^ (s << np.uint64(21))
    s = s ^ (s >> np.uint64(35))
    return s ^ (s << np.uint64(4))


LINE = 7  # 2 ** LINE steps are taken one by one, on as many lines of states as are needed
_jumps: list[np.ndarray] = []  # table k: by byte and its value, what 2 ** k steps make of it


def _jump(states: np.ndarray, power: int) -> np.ndarray:
    """The states 2 ** power steps later; a step is linear in the bits."""
    while len(_jumps) <= power:
        bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
        images = _step(bits) if not _jumps else _jump(_jump(bits, len(_jumps) - 1), len(_jumps) - 1)
        table = np.zeros((8, 256), np.uint64)
        for bit in range(8):
            table ^= np.where(np.arange(256)[None, :] >> bit & 1, images.reshape(8, 8)[:, bit][:, None], np.uint64(0))
        _jumps.append(table)
    table = _jumps[power]
    out = np.zeros_like(states)
    for byte in range(8):
        out ^= table[byte][(states >> np.uint64(8 * byte) & np.uint64(255)).astype(np.intp)]
    return out


def uniforms(seed: int, start: int, count: int) -> np.ndarray:
    """Numbers ``start`` and on of XORShiftRandom(seed).nextDouble."""
    states = np.array([_first_state(seed)], np.uint64)
    for power in range((2 * start).bit_length()):
        if 2 * start >> power & 1:
            states = _jump(states, power)
    lines, power = _step(states), LINE
    while len(lines) << LINE < 2 * count:
        lines, power = np.concatenate((lines, _jump(lines, power))), power + 1
    taken = [lines]
    for _ in range((1 << LINE) - 1):
        taken.append(_step(taken[-1]))
    states = np.stack(taken, axis=1).ravel()
    high, low = states[: 2 * count : 2], states[1 : 2 * count : 2]
    whole = ((high & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (low & np.uint64((1 << 27) - 1))
    return whole.astype(np.float64) * 2.0**-53


class _Seeds:
    """java.util.Random.nextLong."""

    def __init__(self, seed: int) -> None:
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _int(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        word = self.state >> 16
        return word - (1 << 32) if word >> 31 else word

    def next(self) -> int:
        high = self._int()
        return (high << 32) + self._int()


def subset(features: int, count: int, seed: int) -> np.ndarray:
    """SamplingUtils.reservoirSampleAndCount over the features."""
    held, state = list(range(count)), _first_state(seed)
    for item in range(count, features):
        pair = []
        for bits in (26, 27):
            state ^= state << 21 & _WORD
            state ^= state >> 35
            state ^= state << 4 & _WORD
            pair.append(state & ((1 << bits) - 1))
        place = int(((pair[0] << 27) + pair[1]) * 2.0**-53 * (item + 1))
        if place < count:
            held[place] = item
    return np.array(held)


# --- one tree ---------------------------------------------------------------------


class Plan:
    """What all rounds share: the edges and kinds of the features and the settings."""

    def __init__(self, cuts: list[np.ndarray], arity: dict[int, int], per_node: int, settings: dict) -> None:
        self.cuts, self.arity, self.per_node = cuts, arity, per_node
        self.depth, self.rounds, self.rate = settings["maxDepth"], settings["maxIter"], settings["stepSize"]
        self.share, self.seed = settings["subsamplingRate"], settings["seed"]
        self.least, self.least_gain, self.least_weight = settings["minInstancesPerNode"], settings["minInfoGain"], settings["leastWeight"]
        self.splits = np.array([arity[f] - 1 if f in arity else len(c) for f, c in enumerate(cuts)])
        self.bins = int(self.splits.max(initial=0)) + 1
        self.kinds = np.array(sorted(arity), np.intp)
        self.exact = True

    def binned(self, x: np.ndarray) -> np.ndarray:
        """One row per feature; few values fit a byte."""
        small = np.uint8 if self.bins <= 256 else np.int32
        return np.stack([
            (x[:, f].astype(np.int64) if f in self.arity else np.searchsorted(c, x[:, f])).astype(small)
            for f, c in enumerate(self.cuts)
        ]) if len(x) else np.empty((len(self.cuts), 0), small)


class Chunk:
    """Consecutive rows of a partition, their scores so far and, during a round, their places in the tree."""

    def __init__(self, part: int, start: int, bins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        self.part, self.start, self.bins, self.label, self.weight = part, start, bins, label, weight
        self.score = np.zeros(len(label))

    def begin(self, plan: Plan, turn: int) -> None:
        n = len(self.label)
        self.place = np.ones(n, np.int64)
        if plan.share < 1:
            self.drawn = np.flatnonzero(uniforms(plan.seed + turn + self.part + 1, self.start, n) < plan.share)
        else:
            self.drawn = np.arange(n)
        label = self.label[self.drawn]
        aim = 4.0 * label / (1.0 + np.exp(2.0 * label * self.score[self.drawn])) if turn else label
        weight = self.weight[self.drawn]
        self.stats = weight, weight * aim, weight * aim * aim

    def end(self) -> None:
        del self.place, self.drawn, self.stats

    def sums(self, plan: Plan, nodes: list[int], features: list[int]) -> np.ndarray:
        """(node, feature, bin, [weight, sum, squares, rows]) of the drawn rows; features that aren't asked for have zeros."""
        slots = np.full(1 << (max(nodes).bit_length()), -1, np.int64)
        slots[nodes] = np.arange(len(nodes))
        slot = slots[self.place[self.drawn]]
        active = np.flatnonzero(slot >= 0)
        rows, base = self.drawn[active], slot[active] * plan.bins
        stats = [s[active] for s in self.stats]
        cells = len(nodes) * plan.bins
        out = np.zeros((len(plan.cuts), 4, cells))
        for f in features:
            key = base + self.bins[f].take(rows)
            for i, values in enumerate(stats):
                out[f, i] = np.bincount(key, values, cells)
            out[f, 3] = np.bincount(key, minlength=cells)
        return out.reshape(-1, 4, len(nodes), plan.bins).transpose(2, 0, 3, 1)

    def move(self, splits: dict[int, tuple]) -> None:
        """Rows of split nodes go on to a child; ``splits`` has (feature, last bin or None, left categories) by node."""
        if not splits:
            return
        size = max(splits) + 1
        feature = np.zeros(size, np.intp)
        lefts = np.zeros((size, 1 + max(max((s[1] or 0), *s[2], 0) for s in splits.values())), bool)
        known = np.zeros(size, bool)
        for node, (f, last, categories) in splits.items():
            known[node], feature[node] = True, f
            if last is None:
                lefts[node, [int(c) for c in categories]] = True
            else:
                lefts[node, : last + 1] = True
        rows = np.flatnonzero(known[np.minimum(self.place, size - 1)] & (self.place < size))
        place = self.place[rows]
        value = self.bins[feature[place], rows].astype(np.int64)
        left = (value < lefts.shape[1]) & lefts[place, np.minimum(value, lefts.shape[1] - 1)]
        self.place[rows] = 2 * place + np.where(left, 0, 1)

    def add(self, tree: list[dict], rate: float) -> None:
        """The tree's predictions for all rows, drawn or not."""
        n = len(self.label)
        self.place = np.ones(n, np.int64)
        for splits in tree["levels"]:
            self.move(splits)
        value = np.zeros(max(tree["values"]) + 1)
        value[list(tree["values"])] = list(tree["values"].values())
        self.score = self.score + rate * value[self.place]
        del self.place


def _impurity(stats: np.ndarray) -> np.ndarray:
    weight = stats[..., 0]
    held = np.where(weight == 0, 1.0, weight)
    return np.where(weight == 0, 0.0, (stats[..., 2] - stats[..., 1] * stats[..., 1] / held) / held)


def _best(plan: Plan, sums: np.ndarray, parents: list, subsets: list[np.ndarray]) -> list[dict]:
    """The best split of every node; the first of equals in the order of its features."""
    order = np.broadcast_to(np.arange(plan.bins), (*sums.shape[:2], plan.bins))
    if len(plan.kinds):
        order = order.copy()
        kinds = sums[:, plan.kinds]
        weight = kinds[..., 0]
        centre = np.where(weight != 0, kinds[..., 1] / np.where(weight != 0, weight, 1.0), np.finfo(float).max)
        centre[np.broadcast_to(np.arange(plan.bins) > plan.splits[plan.kinds][:, None], centre.shape)] = np.inf
        order[:, plan.kinds] = np.argsort(centre, axis=-1, kind="stable")
        sums[:, plan.kinds] = np.take_along_axis(kinds, order[:, plan.kinds][..., None], axis=2)
    left = np.cumsum(sums, axis=2)
    total = np.take_along_axis(left, np.broadcast_to(plan.splits[None, :, None, None], (len(left), left.shape[1], 1, 4)), axis=2)
    left = left[:, :, : max(plan.bins - 1, 1)]
    right = total - left
    valid = (np.arange(left.shape[2]) < plan.splits[:, None])[None] & (np.minimum(left[..., 3], right[..., 3]) >= plan.least)
    valid &= np.minimum(left[..., 0], right[..., 0]) >= plan.least_weight
    for i, parent in enumerate(parents):
        if parent is None:
            first = next((f for f in subsets[i] if plan.splits[f]), None)
            parents[i] = sums[i, 0].sum(axis=0) if first is None else left[i, first, 0] + right[i, first, 0]
    impurity = np.array([_impurity(p) for p in parents])
    whole = left[..., 0] + right[..., 0]
    whole = np.where(whole == 0, 1.0, whole)
    gain = impurity[:, None, None] - left[..., 0] / whole * _impurity(left) - right[..., 0] / whole * _impurity(right)
    gain = np.where(valid & (gain >= plan.least_gain), gain, -np.inf)
    cut = gain.argmax(axis=2)
    tops = np.take_along_axis(gain, cut[..., None], axis=2)[..., 0]
    found = []
    for i, features in enumerate(subsets):
        f = int(features[tops[i, features].argmax()])
        at = int(cut[i, f])
        found.append({
            "gain": float(tops[i, f]), "impurity": float(impurity[i]), "stats": parents[i], "feature": f, "cut": at,
            "left": left[i, f, at], "right": right[i, f, at], "categories": order[i, f, : at + 1].tolist() if f in plan.arity else None,
        })
    return found


def grow(plan: Plan, turn: int, sums: Callable[[list[int], list[dict], np.ndarray], np.ndarray]) -> dict:
    """One tree, level by level.  ``sums(nodes, levels, features)`` gives the sums of a level's nodes after the splits so far."""
    seeds, stack = _Seeds(plan.seed + turn), [1]
    known: dict[int, dict] = {}
    parents: dict[int, np.ndarray | None] = {1: None}
    levels: list[dict] = []
    everything = np.arange(len(plan.cuts))
    usable = np.flatnonzero(plan.splits)
    counted: dict[int, np.ndarray] = {}

    def of(nodes: list[int], subsets: list[np.ndarray]) -> np.ndarray:
        """Sums of the nodes; of two children the one with fewer rows is counted, unless ``exact``."""
        if plan.exact:
            wanted = np.intersect1d(usable, np.concatenate(subsets))
            return sums(nodes, levels, wanted if len(wanted) else everything[:1])
        kept = [n for n in nodes if n ^ 1 not in nodes or (parents[n][3], n) < (parents[n ^ 1][3], n ^ 1)] if nodes != [1] else nodes
        new = dict(zip(kept, sums(kept, levels, usable if len(usable) else everything[:1]), strict=True))
        for n in nodes:
            if n not in new:
                new[n] = counted[n >> 1] - new[n ^ 1]
        counted.clear()
        counted.update(new)
        return np.stack([new[n] for n in nodes])

    while stack:
        nodes, stack = stack, []
        subsets = [
            subset(len(plan.cuts), plan.per_node, seeds.next()) if plan.per_node < len(plan.cuts) else everything for _ in nodes
        ]
        splits = {}
        for node, best in zip(nodes, _best(plan, of(nodes, subsets), [parents[n] for n in nodes], subsets), strict=True):
            known[node] = best
            level = node.bit_length() - 1
            if best["gain"] <= 0 or level == plan.depth:
                best["leaf"] = True
                continue
            best["leaf"] = False
            splits[node] = (best["feature"], None if best["categories"] else best["cut"], best["categories"] or [])
            for child, side in ((2 * node, "left"), (2 * node + 1, "right")):
                parents[child] = best[side]
                impurity = float(_impurity(best[side]))
                if level + 1 == plan.depth or abs(impurity) < 2.0**-52:
                    known[child] = {"leaf": True, "gain": 0.0, "impurity": impurity, "stats": best[side]}
                else:
                    stack.insert(0, child)
        levels.append(splits)
    values = {n: _value(k["stats"]) for n, k in known.items() if k["leaf"]}
    return {"levels": levels, "nodes": known, "values": values}


def _value(stats: np.ndarray) -> float:
    return float(stats[1] / stats[0]) if stats[0] else 0.0


def saved_nodes(plan: Plan, number: int, tree: dict) -> list[tuple]:
    """The tree's nodes as Spark saves them, numbered from the root to the left; leaves of one value are joined."""
    known, kept = tree["nodes"], {}

    def prune(node: int) -> float | None:
        """The value if the node is a leaf."""
        if known[node]["leaf"]:
            return _value(known[node]["stats"])
        left, right = prune(2 * node), prune(2 * node + 1)
        if left is not None and left == right:
            kept[node] = True
            return left
        return None

    prune(1)
    rows: list = []

    def write(node: int) -> int:
        k, own = known[node], len(rows)
        stats = [float(v) for v in k["stats"][:3]]
        rows.append(None)
        if k["leaf"] or node in kept:
            impurity = -1.0 if k["gain"] == -np.inf else k["impurity"]
            value = tree["values"].get(node)
            if value is None:  # joined: the value of its leaves
                at = 2 * node
                while at not in tree["values"]:
                    at = 2 * at
                value = tree["values"][at]
            rows[own] = (number, (own, value, impurity, stats, int(k["stats"][3]), -1.0, -1, -1, (-1, [], -1)))
            return own
        left, right = write(2 * node), write(2 * node + 1)
        f = k["feature"]
        edge = [float(c) for c in k["categories"]] if k["categories"] else [float(plan.cuts[f][k["cut"]])]
        split = (f, edge, plan.arity.get(f, -1))
        rows[own] = (number, (own, _value(k["stats"]), k["impurity"], stats, int(k["stats"][3]), k["gain"], left, right, split))
        return own

    write(1)
    return rows


# --- all rounds -------------------------------------------------------------------

NODES = T.StructType([
    T.StructField("treeID", T.IntegerType()),
    T.StructField("nodeData", T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("prediction", T.DoubleType()), T.StructField("impurity", T.DoubleType()),
        T.StructField("impurityStats", T.ArrayType(T.DoubleType())), T.StructField("rawCount", T.LongType()),
        T.StructField("gain", T.DoubleType()), T.StructField("leftChild", T.IntegerType()), T.StructField("rightChild", T.IntegerType()),
        T.StructField("split", T.StructType([
            T.StructField("featureIndex", T.IntegerType()), T.StructField("leftCategoriesOrThreshold", T.ArrayType(T.DoubleType())),
            T.StructField("numCategories", T.IntegerType()),
        ])),
    ])),
])
BINNED = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("bins", T.BinaryType()), T.StructField("label", T.BinaryType()), T.StructField("weight", T.BinaryType()),
])


def _added(parts: list[np.ndarray]) -> np.ndarray:
    total = parts[0].copy()
    for more in parts[1:]:
        total += more
    return total


def _rate(plan: Plan, turn: int) -> float:
    return plan.rate if turn else 1.0


def boosted_here(plan: Plan, chunks: list[Chunk]) -> Iterator[dict]:
    """The trees of all rounds over chunks in memory."""
    for turn in range(plan.rounds):
        for chunk in chunks:
            chunk.begin(plan, turn)

        def sums(nodes, levels, features):
            for chunk in chunks:
                if levels:
                    chunk.move(levels[-1])
            return _added([chunk.sums(plan, nodes, features) for chunk in chunks])

        tree = grow(plan, turn, sums)
        for chunk in chunks:
            chunk.end()
            chunk.add(tree, _rate(plan, turn))
        yield tree


def boosted_over(plan: Plan, chunks) -> Iterator[dict]:
    """The same over an RDD of chunks; a level is one job that sends back one array of sums per partition."""
    first = chunks.persist(StorageLevel.MEMORY_AND_DISK)
    sent = first.context.broadcast(plan)
    before, held, trees = None, first, []
    for turn in range(plan.rounds):

        def sums(nodes, levels, features, held=held, turn=turn):
            def run(own):
                parts = []
                for chunk in own:
                    chunk.begin(sent.value, turn)
                    for splits in levels:
                        chunk.move(splits)
                    part = chunk.sums(sent.value, nodes, features)
                    parts[:] = [part] if not parts else [parts[0] + part]
                return parts

            return _added(held.mapPartitions(run).collect())

        tree = grow(plan, turn, sums)
        trees.append({"levels": tree["levels"], "values": tree["values"]})
        rebuilt = len(trees) % REBUILT == 0
        new = [(t, _rate(plan, i)) for i, t in enumerate(trees)] if rebuilt else [(trees[-1], _rate(plan, turn))]

        def added(chunk, new=new):
            for tree_, rate in new:
                chunk.add(tree_, rate)
            return chunk

        following = (first if rebuilt else held).map(added).persist(StorageLevel.MEMORY_AND_DISK)
        if before is not None and before is not first:
            before.unpersist()  # what is held now has been read once, so it is there
        before, held = held, following
        yield tree
    for kept in (before, held, first):
        kept.unpersist()
    sent.unpersist()


def _chunk(plan_features: int, row) -> Chunk:
    bins = np.frombuffer(row[3], np.uint8 if len(row[3]) == plan_features * row[2] else np.int32)
    return Chunk(row[0], row[1], bins.reshape(plan_features, -1), np.frombuffer(row[4]), np.frombuffer(row[5]))


def _joined(chunks: list[Chunk]) -> list[Chunk]:
    """The chunks of a partition as one, and few partitions apart.

    With many the sums are taken over neighbours together, which rounds otherwise; the
    draws of a neighbour follow its own partition, so rows keep them in ``pieces``.
    """
    chunks = sorted(chunks, key=lambda c: (c.part, c.start))
    groups: dict[int, list[Chunk]] = {}
    for chunk in chunks:
        groups.setdefault(chunk.part, []).append(chunk)

    def one(several: list[Chunk]) -> Chunk:
        if len(several) == 1:
            return several[0]
        made = Pieces(
            several[0].part, several[0].start, np.concatenate([c.bins for c in several], axis=1),
            np.concatenate([c.label for c in several]), np.concatenate([c.weight for c in several]),
        )
        made.pieces = [(c.part, c.start, len(c.label)) for c in several]
        return made

    wholes = [one(own) for own in groups.values()]
    if len(wholes) <= APART:
        return wholes
    every = [c for own in groups.values() for c in own]
    size = -(-len(every) // APART)
    return [one(every[at : at + size]) for at in range(0, len(every), size)]


class Pieces(Chunk):
    """Chunks taken together; each keeps the draws of its place in its partition."""

    pieces: list[tuple[int, int, int]]

    def begin(self, plan: Plan, turn: int) -> None:
        super().begin(plan, turn) if plan.share >= 1 else self._begin(plan, turn)

    def _begin(self, plan: Plan, turn: int) -> None:
        u = np.concatenate([uniforms(plan.seed + turn + part + 1, start, n) for part, start, n in self.pieces])
        self.place = np.ones(len(self.label), np.int64)
        self.drawn = np.flatnonzero(u < plan.share)
        label, weight = self.label[self.drawn], self.weight[self.drawn]
        aim = 4.0 * label / (1.0 + np.exp(2.0 * label * self.score[self.drawn])) if turn else label
        self.stats = weight, weight * aim, weight * aim * aim


def _rounds_here(binned: DataFrame, plan: Plan) -> DataFrame:
    """Nodes of all trees, fitted in one task."""
    features = len(plan.cuts)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        rows = [tuple(row.values()) for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        for number, tree in enumerate(boosted_here(plan, _joined([_chunk(features, row) for row in rows]))):
            names, node_names = NODES.names, NODES["nodeData"].dataType.names
            split_names = NODES["nodeData"].dataType["split"].dataType.names
            made = [
                dict(zip(names, (n, dict(zip(node_names, (*d[:-1], dict(zip(split_names, d[-1])))))), strict=True))
                for n, d in saved_nodes(plan, number, tree)
            ]
            yield pa.RecordBatch.from_pylist(made, schema=to_arrow_schema(NODES))

    return binned.coalesce(1).mapInArrow(run, NODES)


def _object(package, name: str):
    """A Scala object; not all of its methods have static twins."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


class BoostedClassifier(GBTClassifier):
    """``GBTClassifier`` by whole columns; settings, trees and the fitted model are Spark's."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        if (self.isDefined(self.validationIndicatorCol) and self.getOrDefault(self.validationIndicatorCol)) or self.getLossType() != "logistic":
            return super()._fit(dataset)
        spark = dataset.sparkSession
        plan = self._plan(spark, dataset)
        if plan is None:
            return super()._fit(dataset)
        binned, size = self._binned(dataset, plan)
        plan.exact = size <= EXACT
        path = fresh_path(spark, "boosted")
        try:
            if size <= LOCAL:
                nodes = _rounds_here(binned, plan)
            else:
                features, cores = len(plan.cuts), spark.sparkContext.defaultParallelism
                chunks = binned.rdd.map(lambda row: _chunk(features, row))
                if chunks.getNumPartitions() > cores:
                    chunks = chunks.coalesce(cores)
                rows = [row for number, tree in enumerate(boosted_over(plan, chunks)) for row in saved_nodes(plan, number, tree)]
                nodes = spark.createDataFrame(rows, NODES)
            nodes.write.parquet(f"{path}/data")
        finally:
            binned.unpersist()
        self._describe(spark, path, plan)
        return GBTClassificationModel.load(path)

    def _plan(self, spark: SparkSession, dataset: DataFrame) -> Plan | None:
        """Edges of the bins and kinds of the features, as Spark finds them."""
        self._transfer_params_to_java()
        jvm, own = spark.sparkContext._jvm, self._java_obj
        rows = _object(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(own, dataset._jdf, jvm.scala.Some(2))
        column = dataset._jdf.schema().apply(self.getFeaturesCol())
        kinds = _object(jvm.org.apache.spark.ml.util, "MetadataUtils").getCategoricalFeatures(column)
        algo = jvm.org.apache.spark.mllib.tree.configuration.Algo.Classification()
        strategy = own.getOldBoostingStrategy(kinds, algo).treeStrategy()
        trees = jvm.org.apache.spark.ml.tree.impl
        described = _object(trees, "DecisionTreeMetadata").buildMetadata(rows, strategy, 1, self.getFeatureSubsetStrategy())
        splits = _object(trees, "RandomForest").findSplits(rows, described, self.getSeed())
        features = described.numFeatures()
        arity = {f: described.featureArity().apply(f) for f in range(features) if described.isCategorical(f)}
        if any(described.isUnordered(f) for f in arity):
            return None
        cuts = [np.array([] if f in arity else [s.threshold() for s in splits[f]]) for f in range(features)]
        settings = {p: self.getOrDefault(p) for p in (
            "maxDepth", "maxIter", "stepSize", "subsamplingRate", "seed", "minInstancesPerNode", "minInfoGain"
        )}
        settings["leastWeight"] = described.minWeightPerNode()
        return Plan(cuts, arity, described.numFeaturesPerNode(), settings)

    def _binned(self, dataset: DataFrame, plan: Plan) -> tuple[DataFrame, int]:
        """Chunks of binned rows, kept until the model is fitted, and their bytes."""
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) and self.getWeightCol() else F.lit(1.0)
        columns = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), (2 * F.col(self.getLabelCol()).cast("double") - 1).alias("y"), weight.alias("w")
        )

        def run(batches):
            import pyarrow as pa

            part, start = TaskContext.get().partitionId(), 0
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
                for at in range(0, n, CHUNK):
                    held = slice(at, at + CHUNK)
                    row = {"part": part, "start": start + at, "rows": len(y[held]), "bins": plan.binned(x[held]).tobytes(),
                           "label": y[held].tobytes(), "weight": w[held].tobytes()}
                    yield pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, schema=fields)
                start += n

        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(BINNED)
        binned = columns.mapInArrow(run, BINNED).persist(StorageLevel.MEMORY_AND_DISK)
        return binned, binned.agg(F.sum(F.length("bins"))).first()[0] or 0

    def _describe(self, spark: SparkSession, path: str, plan: Plan) -> None:
        """The files beside the nodes from which Spark loads the model."""

        def described(kind: str, own: str, skipped: tuple[str, ...], **more) -> str:
            named = {
                key: {p.name: v for p, v in values.items() if p.name not in skipped}
                for key, values in (("paramMap", self._paramMap), ("defaultParamMap", self._defaultParamMap))
            }
            head = {"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": own}
            return json.dumps({**head, **named, **more})

        ensemble = ("lossType", "maxIter", "stepSize", "subsamplingRate", "featureSubsetStrategy", "validationTol",
                    "validationIndicatorCol", "rawPredictionCol", "probabilityCol", "thresholds")
        whole = described(
            "org.apache.spark.ml.classification.GBTClassificationModel", self.uid, (), numFeatures=len(plan.cuts), numTrees=plan.rounds
        )
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        tree = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
        trees = [(i, described(tree, f"dtr_{uuid.uuid4().hex[:12]}", ensemble), _rate(plan, i)) for i in range(plan.rounds)]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")

"""Forests of limited depth for many lanes at once: the folds of a validation in one pass, or one fitted forest.

A lane is a forest that leaves out the rows of one part and is scored on them. Rows are binned once for all lanes. How
often a tree draws a row is a Poisson draw by the row's hashed key. Nodes with many rows are split level by level: each
task sums its rows by (node, feature, bin), and the sums of a node meet in one small group. The drawn rows of a node with
few rows go to one task, which grows it to the lane's depth. Sums are of whole numbers and features are tried by a hash of
the node, so the same rows give the same trees whatever their partitions, and at whatever level a node is handed over.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.plans import forest
from perigee.plans.boosting import MAX_BINS, UNIT, Block, Lane, _binned, block_of, blocks_of, mixed, quantiles, scores_of
from perigee.plans.forest import Tree, poisson_marks

#: Rows up to which one task grows a node (some 100 bytes each; a level more of large nodes reads all rows again), and
#: rows of a partition.
GROW_ROWS, PART_ROWS = 5_000_000, 20_000
#: Nodes whose sums a task holds before it sends them.
HELD_NODES = 10_000
#: Even quantiles of the rows that cuts are chosen from.
QUANTILES = 10_000
# The functions travel with the plan, as those of boosting do.
for _module in (sys.modules[__name__], forest):
    cloudpickle.register_pickle_by_value(_module)

_NODES = "i int, tree int, node long, feature int, cut int, value double, gain double, n array<double>, values array<double>"
_GROWN = "i int, tree int, node binary, feature binary, cut binary, value binary, gain binary"
_TYPES = (np.int64, np.int16, np.float64, np.float64, np.float64)

#: Number, feature, cut, value and gain of nodes.
Nodes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Plan:
    """What all tasks of a fit know. Nodes are numbered as in a heap: node i has children 2i + 1 and 2i + 2."""

    lanes: list[Lane]
    weights: list[tuple[float, float]]
    loss: str
    features: int
    bins: int
    per_node: int
    seed: int
    marks: np.ndarray

    def number(self, i: int, tree: int) -> int:
        return (self.seed * 1_000_003 + self.lanes[i].number) * 100_003 + tree + 1

    def target(self, label: np.ndarray) -> np.ndarray:
        """Labels as whole numbers."""
        return np.rint(label * UNIT) if self.loss == "squared" else label.astype(np.uint8)

    def drawn(self, block: Block, i: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that a tree draws, and how often."""
        w = np.searchsorted(self.marks, mixed(block.key, self.number(i, tree)) >> np.uint64(32), "right")
        rows = np.flatnonzero((w > 0) & (block.part != self.lanes[i].held))
        return rows, w[rows].astype(np.uint8)

    def tried(self, i: int, tree: int, nodes: np.ndarray) -> np.ndarray:
        """Whether a feature is tried at a node: per_node of them, by a hash of the node."""
        place = nodes.astype(np.uint64) * np.uint64(self.features) + np.arange(self.features, dtype=np.uint64)[:, None]
        lots = mixed(place, self.number(i, tree) + 50_000)
        return lots.argsort(axis=0, kind="stable").argsort(axis=0) < self.per_node

    def weighed(self, i: int, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight and weighted label sum of rows with these numbers of draws and target sums."""
        if self.loss == "squared":
            return n, s / UNIT
        zero, one = self.weights[i]
        return zero * (n - s) + one * s, one * s

    def mean(self, i: int, n: np.ndarray, s: np.ndarray) -> np.ndarray:
        weight, total = self.weighed(i, n, s)
        return np.divide(total, weight, out=np.zeros_like(total), where=weight > 0)

    def cut(self, i: int, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gain and bin of each node's best cut, from draws and target sums by node and bin of one feature."""
        left_n, left_s = n.cumsum(axis=1), s.cumsum(axis=1)
        (lw, lt), (rw, rt) = self.weighed(i, left_n, left_s), self.weighed(i, left_n[:, -1:] - left_n, left_s[:, -1:] - left_s)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where((left_n > 0) & (left_n < left_n[:, -1:]), lt**2 / lw + rt**2 / rw, -np.inf)
        at = gain.argmax(axis=1)
        return gain[np.arange(len(at)), at], at

    def splits(self, i: int, tried: np.ndarray, n: np.ndarray, s: np.ndarray, sums: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature (-1: leaf), cut and gain (of squared error) of nodes with n draws and target sums s: the least squared error wins (Gini, for
        classes), the first of equal gains. sums: draws and target sums by node and bin, feature by feature."""
        best, feature, cut = np.full(len(n), -np.inf), np.full(len(n), -1, np.int16), np.zeros(len(n))
        for f, found in enumerate(sums):
            gain, at = self.cut(i, *found)
            wins = tried[f] & (gain > best)
            best[wins], feature[wins], cut[wins] = gain[wins], f, at[wins]
        weight, total = self.weighed(i, n, s)
        whole = np.divide(total**2, weight, out=np.zeros_like(total), where=weight > 0)
        feature[~(best - whole > 1e-12 * whole)] = -1
        return feature, np.where(feature >= 0, cut, 0.0), np.where(feature >= 0, best - whole, 0.0)


def grow(plan: Plan, i: int, tree: int, root: int, columns: np.ndarray, target: np.ndarray, w: np.ndarray) -> Nodes:
    """Grow a node to the lane's depth from its drawn rows (bins feature by feature). All nodes of a level are handled at
    once: number, feature, cut, value and gain of each."""
    depth, out = plan.lanes[i].depth, []
    ids, node = np.array([root]), np.zeros(len(w), np.int64)
    w = w.astype(np.float64)
    weighted = w * target
    for level in range((root + 1).bit_length() - 1, depth + 1):
        n, s = (np.bincount(node, x, minlength=len(ids)) for x in (w, weighted))
        feature, cut, gain = np.full(len(ids), -1, np.int16), np.zeros(len(ids)), np.zeros(len(ids))
        if level < depth:
            tried = plan.tried(i, tree, ids)
            feature, cut, gain = plan.splits(i, tried, n, s, (_by_bin(plan, x, node, w, weighted, t) for x, t in zip(columns, tried, strict=True)))
        out.append((ids, feature, cut, plan.mean(i, n, s), gain))
        split = feature >= 0
        if not split.any():
            break
        stays = split[node]
        if not stays.all():
            columns, w, weighted, node = columns[:, stays], w[stays], weighted[stays], node[stays]
        right = columns[feature[node], np.arange(len(node))] > cut[node]
        node = (2 * (split.cumsum() - 1))[node] + right
        ids = (2 * ids[split][:, None] + [1, 2]).ravel()
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _by_bin(plan: Plan, column: np.ndarray, node: np.ndarray, w: np.ndarray, weighted: np.ndarray, tried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draws and target sums by node and bin of one feature, where it is tried."""
    if not tried.all():
        rows = np.flatnonzero(tried[node])
        column, node, w, weighted = column[rows], node[rows], w[rows], weighted[rows]
    place, shape = node * plan.bins + column, (len(tried), plan.bins)
    return tuple(np.bincount(place, x, minlength=shape[0] * shape[1]).reshape(shape) for x in (w, weighted))


def _last(nodes: Nodes) -> Nodes:
    """Nodes in the order of their numbers; the later of equal numbers counts."""
    ids, first = np.unique(nodes[0][::-1], return_index=True)
    return ids, *(x[::-1][first] for x in nodes[1:])


def linked(nodes: Nodes) -> Tree:
    """Nodes of a tree as a Tree over bins; the later of equal numbers counts."""
    ids, feature, cut, value, _ = _last(nodes)
    return Tree(feature, cut, np.where(feature >= 0, np.searchsorted(ids, 2 * ids + 1), 0), value)


class Growing:
    """The trees that the driver has heard of: nodes by lane and tree."""

    def __init__(self, plan: Plan, kept: list[tuple[int, float]]):
        self.plan = plan
        root = [np.zeros(1, t) for t in _TYPES]
        self.found: dict[tuple[int, int], list[Nodes]] = {}
        for i, lane in enumerate(plan.lanes):
            first = (root[0], root[1] - 1, root[2], plan.mean(i, np.array([float(kept[i][0])]), np.array([kept[i][1]])), root[4])
            for t in range(lane.rounds):
                self.found[i, t] = [tuple(x.astype(y) for x, y in zip(first, _TYPES, strict=True))]

    def add(self, i: int, tree: int, *nodes: Iterable) -> None:
        self.found[i, tree].append(tuple(np.asarray(x, t) for x, t in zip(nodes, _TYPES, strict=True)))

    def nodes(self, i: int, tree: int) -> Nodes:
        return tuple(np.concatenate(x) for x in zip(*self.found[i, tree], strict=True))

    def tree(self, i: int, tree: int) -> Tree:
        return linked(self.nodes(i, tree))

    def places(self, i: int, tree: int) -> Tree:
        """The tree with the numbers of its nodes as their values."""
        ids, feature, cut, _, gain = self.nodes(i, tree)
        return linked((ids, feature, cut, ids.astype(np.float64), gain))

    def importance(self, i: int, features: int) -> np.ndarray:
        """Share of each feature in the gains of a tree, averaged over the lane's trees that were split."""
        shares = np.zeros(features)
        for t in range(self.plan.lanes[i].rounds):
            _, feature, _, _, gain = _last(self.nodes(i, t))
            gains = np.bincount(feature[feature >= 0], gain[feature >= 0], minlength=features)
            shares += gains / (gains.sum() or 1.0)
        return shares / (shares.sum() or 1.0)


def cuts_between(values: np.ndarray, bins: int) -> list[float]:
    """Cuts of at most this many bins, as MLlib takes them from its sample: between all values where they are few, else
    one each time that another share of the values is passed. A frequent value passes several shares; the cuts that it
    leaves over go to the values after it."""
    found, counts = np.unique(values, return_counts=True)
    between = forest._between(found[:-1], found[1:])
    if len(found) <= bins:
        return between.tolist()
    upto, share, wanted, cuts = counts.cumsum(), len(values) / bins, 1, []
    for i, cut in enumerate(between.tolist()):
        if abs(upto[i] - wanted * share) < abs(upto[i + 1] - wanted * share) and wanted < bins:
            cuts.append(cut)
            wanted += 1
    return cuts


def forest_cuts(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Cuts of each feature from even quantiles of all rows."""
    probs = [i / QUANTILES for i in range(QUANTILES + 1)]
    return [cuts_between(np.array(q, np.float64), bins) for q in quantiles(df, features, probs)]


def _each(features: int, of):
    """Arrow function that calls of(block) for every block of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from of(block_of(*r, features) for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
    return run


def _by_tree(nodes: list[tuple[int, int, int]]) -> dict[tuple[int, int], np.ndarray]:
    out: dict[tuple[int, int], list[int]] = {}
    for i, tree, node in nodes:
        out.setdefault((i, tree), []).append(node)
    return {k: np.sort(np.array(v)) for k, v in out.items()}


def _met(at: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each wanted node that rows are at, with these rows."""
    order = np.argsort(at, kind="stable")
    begin, end = (np.searchsorted(at[order], wanted, side) for side in ("left", "right"))
    yield from ((int(x), order[b:e]) for x, b, e in zip(wanted, begin, end, strict=True) if b < e)


def _split_large(blocks: DataFrame, plan: Plan, growing: Growing, large: list[tuple[int, int, int]]) -> list:
    """Splits of large nodes of one level, with draws and values of their children."""
    wanted = _by_tree(large)
    sent = blocks.sparkSession.sparkContext.broadcast({k: (v, growing.places(*k).packed()) for k, v in wanted.items()})

    def rows_of(total: dict) -> pa.RecordBatch:
        keys = zip(*total, strict=True)
        cells = zip(*((n.tobytes(), s.tobytes()) for n, s in total.values()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip((*keys, *cells), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                          names=["i", "tree", "node", "n", "s"])

    def sums(found: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        trees = {k: (v, Tree.unpacked(*t)) for k, (v, t) in sent.value.items()}
        total: dict = {}
        one = np.ones(1, bool)
        for block in found:
            target = plan.target(block.label).astype(np.float64)
            for (i, t), (nodes, tree) in trees.items():
                rows, w = plan.drawn(block, i, t)
                for node, here in _met(tree.predict(block.bins[rows]), nodes):
                    r, ww = rows[here], w[here].astype(np.float64)
                    at = np.zeros(len(r), np.int64)
                    cells = [np.concatenate(x) for x in zip(*(_by_bin(plan, c[r], at, ww, ww * target[r], one) for c in block.columns), strict=True)]
                    old = total.get((i, t, node))
                    total[i, t, node] = cells if old is None else [a + b for a, b in zip(old, cells, strict=True)]
                if len(total) >= HELD_NODES:
                    yield rows_of(total)
                    total = {}
        if total:
            yield rows_of(total)

    def choose(key, group):  # Spark reads the annotations of such functions, so it has none
        i, t, node = (k.as_py() for k in key)
        n, s = (sum(np.frombuffer(x.as_py()) for x in group.column(c)).reshape(plan.features, 1, plan.bins) for c in ("n", "s"))
        whole = n[0].sum(axis=1), s[0].sum(axis=1)
        feature, cut, gain = plan.splits(i, plan.tried(i, t, np.array([node])), *whole, zip(n, s, strict=True))
        f, upto = int(feature[0]), int(cut[0]) + 1
        below = [(x[f, 0, :upto].sum(), x[f, 0, upto:].sum()) for x in (n, s)] if f >= 0 else [(), ()]
        row = (i, t, node, f, int(cut[0]), float(plan.mean(i, *whole)[0]), float(gain[0]), list(map(float, below[0])), plan.mean(i, *map(np.array, below)).tolist() if f >= 0 else [])
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        names = ["i", "tree", "node", "feature", "cut", "value", "gain", "n", "values"]
        return pa.table({c: pa.array([x], k) for c, x, k in zip(names, row, kinds, strict=True)})

    counted = blocks.mapInArrow(_each(plan.features, sums), "i int, tree int, node long, n binary, s binary")
    return counted.groupBy("i", "tree", "node").applyInArrow(choose, _NODES).collect()


def _grown(blocks: DataFrame, plan: Plan, growing: Growing, small: list[tuple[int, int, int]]) -> list:
    """Subtrees of small nodes, each grown by one task from the rows it drew."""
    wanted = _by_tree(small)
    sent = blocks.sparkSession.sparkContext.broadcast({k: (v, growing.places(*k).packed()) for k, v in wanted.items()})
    names, kinds = ["i", "tree", "node", "bins", "target", "w"], (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def deal(found: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        trees = {k: (v, Tree.unpacked(*t)) for k, (v, t) in sent.value.items()}
        for block in found:
            target = plan.target(block.label)
            for (i, t), (nodes, tree) in trees.items():
                rows, w = plan.drawn(block, i, t)
                met = [(i, t, node, block.bins[rows[here]].tobytes(), target[rows[here]].tobytes(), w[here].tobytes())
                       for node, here in _met(tree.predict(block.bins[rows]), nodes)]
                if met:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*met, strict=True), kinds, strict=True)], names=names)

    def finish(key, group):
        i, t, node = (k.as_py() for k in key)
        bins, target, w = (np.frombuffer(b"".join(group.column(c).to_pylist()), k) for c, k in zip(
            names[3:], (np.uint8, np.float64 if plan.loss == "squared" else np.uint8, np.uint8), strict=True))
        columns = np.ascontiguousarray(bins.reshape(-1, plan.features).T)
        nodes = grow(plan, i, t, node, columns, target, w)
        return pa.table({c: pa.array([x], k) for c, x, k in zip(
            ["i", "tree", "node", "feature", "cut", "value", "gain"], (i, t, *(x.astype(k).tobytes() for x, k in zip(nodes, _TYPES, strict=True))),
            (pa.int32(), pa.int32(), *[pa.binary()] * 5), strict=True)})

    dealt = blocks.mapInArrow(_each(plan.features, deal), "i int, tree int, node long, bins binary, target binary, w binary")
    return dealt.repartition(len(small), "i", "tree", "node").groupBy("i", "tree", "node").applyInArrow(finish, _GROWN).collect()


def _held_scores(blocks: DataFrame, plan: Plan, trees: list[list[Tree]]) -> np.ndarray:
    """Sums over the rows that each lane leaves out (see boosting)."""
    sent = blocks.sparkSession.sparkContext.broadcast([[t.packed() for t in lane] for lane in trees])

    def held(found: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        grown = [[Tree.unpacked(*t) for t in lane] for lane in sent.value]
        for block in found:
            for i, lane in enumerate(plan.lanes):
                left = block.part == lane.held
                mean = sum(t.predict(block.bins[left]) for t in grown[i]) / lane.rounds
                margin = mean if plan.loss == "squared" else mean - 0.5
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([scores_of(block.label[left], margin, plan.loss)], pa.list_(pa.float64()))], names=["i", "s"])

    found = blocks.mapInArrow(_each(plan.features, held), "i long, s array<double>").select("i", F.posexplode("s").alias("d", "x"))
    scores = np.zeros((len(plan.lanes), 4))
    for i, d, x in found.groupBy("i", "d").agg(F.sum("x")).collect():
        scores[i, d] = x
    return scores


@dataclass
class Forests:
    """Fitted lanes by number: trees over bins, and sums over the rows that the lane leaves out."""

    trees: dict[int, list[Tree]]
    scores: dict[int, list[float]]
    importances: dict[int, list[float]]
    features: list[str]
    cuts: list[list[float]]
    loss: str

    def model(self, number: int) -> Bagged:
        return Bagged(tuple(self.features), tuple(map(tuple, self.cuts)), self.loss, tuple(self.importances[number]), tuple(tuple(t.packed()) for t in self.trees[number]))


@dataclass(frozen=True)
class Bagged:
    """A fitted lane: trees over bins, each as bytes."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    loss: str
    importances: tuple[float, ...]
    trees: tuple[tuple[bytes, bytes, bytes, bytes], ...]

    def mean(self, columns: list[np.ndarray]) -> np.ndarray:
        bins = _binned(columns, [list(c) for c in self.cuts])
        return sum(Tree.unpacked(*t).predict(bins) for t in self.trees) / len(self.trees)


class BaggedModel(Model, DefaultParamsWritable, DefaultParamsReadable):
    """A fitted forest as the last stage of a pipeline, over a vector column `features`. Adds prediction, and for classes
    probability (the mean of the trees' shares)."""

    def __init__(self, fitted: Bagged | None = None):
        super().__init__()
        self.fitted_forest = Param(self, "fitted_forest", "features, cuts, importances and trees of the forest")
        if fitted:
            told = {"features": list(fitted.features), "cuts": [list(c) for c in fitted.cuts], "loss": fitted.loss, "importances": list(fitted.importances)}
            self._set(fitted_forest=told | {"trees": [[base64.b64encode(b).decode() for b in t] for t in fitted.trees]})

    def fitted(self) -> Bagged:
        x = self.getOrDefault(self.fitted_forest)
        return Bagged(tuple(x["features"]), tuple(map(tuple, x["cuts"])), x["loss"], tuple(x["importances"]),
                      tuple(tuple(base64.b64decode(b) for b in t) for t in x["trees"]))

    @property
    def featureImportances(self) -> DenseVector:  # as MLlib's forests name it
        return DenseVector(self.fitted().importances)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = self.fitted()

        @F.pandas_udf("double")
        def mean(x: pd.Series) -> pd.Series:
            return pd.Series(forest.mean(list(np.stack(x.to_numpy()).T)) if len(x) else [], dtype="float64")

        found = mean(vector_to_array("features"))
        if forest.loss == "squared":
            return dataset.withColumn("prediction", found)
        p = F.col("_mean")
        return dataset.withColumn("_mean", found).withColumns({
            "prediction": (p > 0.5).cast("double"), "probability": array_to_vector(F.array(F.lit(1.0) - p, p))}).drop("_mean")


def fit_forests(
    df: DataFrame, features: list[str], lanes: list[Lane], loss: str = "squared", part: str = "part", key: str = "row_key",
    bins: int = MAX_BINS, per_node: int | None = None, seed: int = 42, grow_rows: int = GROW_ROWS
) -> Forests:
    """Fit and score a forest of `rounds` trees for each lane on df (features, label, part, key). loss: squared, or
    logistic with labels 0 and 1, whose classes get balanced weights. Each split tries per_node features, else all.

    Cuts come from all rows, held ones too, without their labels. Missing or NaN values are errors.
    """
    columns = [F.col(c).cast("double") for c in (*features, "label")]
    missing = reduce(lambda x, y: x | y, [c.isNull() | F.isnan(c) for c in columns])
    counts = df.groupBy(part).agg(F.count(F.lit(1)), F.sum(F.col("label").cast("double")), F.count_if(missing)).collect()
    if any(r[3] for r in counts):
        raise ValueError(f"{sum(r[3] for r in counts)} rows have missing or NaN features or labels")
    rows = df.repartition(max(1, -(-sum(r[1] for r in counts) // PART_ROWS)))
    cuts = forest_cuts(rows, features, bins)
    blocks = blocks_of(rows, features, cuts, part, key)
    kept = [tuple(sum(r[c] for r in counts if r[0] != x.held) for c in (1, 2)) for x in lanes]
    weights = []
    for n, ones in kept:
        present = max(1, (ones > 0) + (n > ones))
        weights.append((n / (present * (n - ones)) if n > ones else 1.0, n / (present * ones) if ones > 0 else 1.0))
    plan = Plan(lanes, weights, loss, len(features), bins, per_node or len(features), seed, np.array(poisson_marks(), np.uint64))
    growing = Growing(plan, [(n, total * UNIT if loss == "squared" else total) for n, total in kept])
    roots = [(i, t, 0) for i, x in enumerate(lanes) for t in range(x.rounds)]
    large, small = ([r for r in roots if (kept[r[0]][0] > grow_rows) == is_large] for is_large in (True, False))
    while large:
        found, large = _split_large(blocks, plan, growing, large), []
        for i, t, node, feature, cut, value, gain, n, values in found:
            below = [2 * node + 1, 2 * node + 2][: len(n)]
            growing.add(i, t, [node, *below], [feature, *[-1] * len(n)], [cut, *[0] * len(n)], [value, *values], [gain, *[0] * len(n)])
            for child, rows_there in zip(below, n, strict=True):
                if (child + 1).bit_length() - 1 < lanes[i].depth:
                    (large if rows_there > grow_rows else small).append((i, t, child))
    if small:
        for i, t, *nodes in _grown(blocks, plan, growing, small):
            growing.add(i, t, *(np.frombuffer(x, k) for x, k in zip(nodes, _TYPES, strict=True)))
    trees = [[growing.tree(i, t) for t in range(x.rounds)] for i, x in enumerate(lanes)]
    scores = _held_scores(blocks, plan, trees) if any(r[0] == x.held for r in counts for x in lanes) else np.zeros((len(lanes), 4))
    return Forests({x.number: trees[i] for i, x in enumerate(lanes)}, {x.number: scores[i].tolist() for i, x in enumerate(lanes)},
                   {x.number: growing.importance(i, len(features)).tolist() for i, x in enumerate(lanes)}, features, cuts, loss)

"""Gradient boosting of many lanes at once: the trials of a search or the folds of a validation in one pass.

A lane is one fit with its own parameters that leaves out the rows of one part and is scored on them. Rows are binned
once. Every level of every lane's tree is one aggregation by (lane, node, feature, bin); a tree's splits come back as
one row per node, which lanes, rounds and depth bound and rows don't. Gradients are fixed-point numbers, so their sums
are exact and the same rows give the same trees whatever their partitions.

Where the binned rows are counted to be small, they are sent to all tasks and each lane is one task. It runs the same
functions on the same exact sums, so the trees are the same; only the many small jobs go.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.session import stable

#: Bins of a feature, and steps of a gradient's unit.
MAX_BINS, UNIT = 64, float(1 << 24)
#: Bytes of binned rows up to which lanes are dealt instead of rows.
LOCAL_BYTES = 64 << 20
#: Sums of a level, and of it from all tasks, up to which its splits are found in the driver.
DRIVER_CELLS, SENT_CELLS = 200_000, 2_000_000
#: Values of a feature that a task tells of where it has more.
RANKED_VALUES = 200_000
#: Rounds between two saved copies of the margins.
SAVE_EVERY = 10
# The functions travel with the plan: executors that score need numpy, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FITS = "lane int, init double, scores array<double>, feature binary, cut binary, value binary"


@dataclass(frozen=True)
class Lane:
    """Parameters of one fit. Rows of part `held` are not fitted; the lane is scored on them."""

    number: int
    rounds: int
    depth: int
    rate: float
    least_split: int = 2
    subsample: float = 1.0
    held: int = 1

    @property
    def nodes(self) -> int:
        return (2 << self.depth) - 1


@dataclass
class Block:
    """Binned rows: hashed key, bins (row by row), label, part."""

    key: np.ndarray
    bins: np.ndarray
    label: np.ndarray
    part: np.ndarray

    @cached_property
    def columns(self) -> np.ndarray:
        """Bins feature by feature."""
        return np.ascontiguousarray(self.bins.T)

    @staticmethod
    def joined(blocks: Sequence[Block]) -> Block:
        return Block(*(np.concatenate([getattr(b, f) for b in blocks]) for f in ("key", "bins", "label", "part")))


class Trees:
    """Trees of one lane as heaps: node i has children 2i + 1 (bin at most the cut) and 2i + 2; feature -1 is a leaf."""

    def __init__(self, lane: Lane):
        self.feature = np.full((lane.rounds, lane.nodes), -1, np.int8)
        self.cut = np.zeros((lane.rounds, lane.nodes), np.uint8)
        self.value = np.zeros((lane.rounds, lane.nodes))

    def only(self, number: int) -> Trees:
        """One tree of these, as number 0."""
        one = object.__new__(Trees)
        one.feature, one.cut, one.value = (x[number : number + 1].copy() for x in (self.feature, self.cut, self.value))
        return one

    def step(self, number: int, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where rows at these nodes of tree `number` go next; rows at leaves stay."""
        feature = self.feature[number][at]
        place = np.arange(0, bins.size, max(bins.shape[1], 1)) + np.maximum(feature, 0)
        right = bins.ravel()[place] > self.cut[number][at]
        return np.where(feature >= 0, 2 * at + 1 + right, at)

    def node(self, number: int, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of tree `number` that rows have come to after so many levels."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            at = self.step(number, bins, at)
        return at


def mixed(key: np.ndarray, number: int) -> np.ndarray:
    """Hashes of keys for the number-th draw; the high bits are the good ones."""
    x = key ^ np.uint64((0x9E3779B97F4A7C15 * number) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


def _drawn(key: np.ndarray, lane: Lane, number: int) -> np.ndarray:
    """Rows of a round's subsample, by key: the same on any cluster."""
    if lane.subsample >= 1.0:
        return np.ones(len(key), bool)
    x = mixed(key, lane.number * 100_003 + number + 1)
    return (x >> np.uint64(11)).astype(np.float64) < lane.subsample * (1 << 53)


def _gradients(label: np.ndarray, margin: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """Negative gradient and curvature of the loss as fixed-point numbers."""
    if loss == "squared":
        return np.rint((label - margin) * UNIT), np.full(len(label), UNIT)
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((label - p) * UNIT), np.rint(p * (1.0 - p) * UNIT)


class Round:
    """The rows of a block that one round of a lane draws, with the gradients of the block."""

    def __init__(self, block: Block, lane: Lane, number: int, margin: np.ndarray, loss: str, bins: int):
        self.rows = np.flatnonzero((block.part != lane.held) & _drawn(block.key, lane, number))
        self.columns, self.count = block.columns, bins
        self.plain = loss == "squared"  # its curvature is one unit a row
        self.weights = _gradients(block.label, margin, loss)[: 1 if self.plain else 2]

    def histogram(self, node: np.ndarray, level: int, wanted: np.ndarray | None = None) -> np.ndarray:
        """Rows, gradients and curvatures (exact integers) of a level's nodes by feature and bin; node: where all rows
        of the block are; wanted: the nodes to sum, else all."""
        width, rows = 1 << level, self.rows
        at = (node if len(rows) == len(node) else node[rows]) - (width - 1)
        here = at >= 0  # the others have come to a leaf above
        if wanted is not None:
            here &= wanted[at]
        if not here.all():
            rows, at = rows[here], at[here]
        base, whole = at * self.count, len(rows) == len(node)
        weights = [None, *(w if whole else w[rows] for w in self.weights)]
        out = np.empty((3, width, len(self.columns), self.count), np.int64)
        for f, column in enumerate(self.columns):
            place = base + (column if whole else column[rows])
            for i, weight in enumerate(weights):
                out[i, :, f] = np.bincount(place, weight, minlength=width * self.count).reshape(width, self.count)
        if self.plain:
            out[2] = out[0] * int(UNIT)
        return out

    def below(self, node: np.ndarray, level: int, above: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """histogram of a level from that above and its splits: the smaller child is summed, the other is the rest."""
        wanted = smaller(above, feature, cut)
        return with_rest(self.histogram(node, level, wanted), wanted, above)


def smaller(above: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Whether a node of a level is the child with fewer rows of a split above."""
    split = np.flatnonzero(feature >= 0)
    rows = above[0, split, feature[split]]
    left = (rows * (np.arange(rows.shape[1]) <= cut[split, None])).sum(axis=1)
    wanted = np.zeros(2 * len(feature), bool)
    wanted[2 * split + (left > rows.sum(axis=1) - left)] = True
    return wanted


def with_rest(sums: np.ndarray, wanted: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Sums of a level's wanted nodes, completed by their siblings: what is left of the node above."""
    small = np.flatnonzero(wanted)
    sums[:, small ^ 1] = above[:, small >> 1] - sums[:, small]
    return sums


def leaf_sums(above: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Rows, gradients and curvatures of the last level's nodes, as one bin, from the histogram above and its splits."""
    split = np.flatnonzero(feature >= 0)
    cells = above[:, split, feature[split]]
    left = (cells * (np.arange(cells.shape[2]) <= cut[split, None])).sum(axis=2)
    out = np.zeros((3, 2 * len(feature), 1, 1), np.int64)
    out[:, 2 * split, 0, 0], out[:, 2 * split + 1, 0, 0] = left, cells.sum(axis=2) - left
    return out


def best_splits(sums: np.ndarray, lane: Lane, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1: leaf), cut and value of each node; the first of equal gains wins."""
    n, g, h = sums.astype(np.float64)
    n, g, h = n, g / UNIT, h / UNIT
    total, grad, curve = n[:, 0].sum(axis=1), g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)
    value = np.divide(grad, curve, out=np.zeros_like(grad), where=curve > 0)
    feature, cut = np.full(len(total), -1, np.int8), np.zeros(len(total), np.uint8)
    if not last:
        left, left_g = n.cumsum(axis=2)[:, :, :-1], g.cumsum(axis=2)[:, :, :-1]
        right, right_g = total[:, None, None] - left, grad[:, None, None] - left_g
        gain = np.where((left > 0) & (right > 0), left_g**2 / np.maximum(left, 1) + right_g**2 / np.maximum(right, 1), -np.inf)
        gain = gain.reshape(len(total), -1) - (grad**2 / np.maximum(total, 1))[:, None]
        top = gain.argmax(axis=1)
        split = (total >= lane.least_split) & (gain[np.arange(len(top)), top] > 1e-9)
        feature = np.where(split, top // (n.shape[2] - 1), -1).astype(np.int8)
        cut = np.where(split, top % (n.shape[2] - 1), 0).astype(np.uint8)
    return feature, cut, value


def _first_margin(rows: int, label_sum: int, loss: str) -> float:
    mean = label_sum / UNIT / max(rows, 1)
    if loss == "squared":
        return mean
    mean = min(max(mean, 1e-9), 1 - 1e-9)
    return float(np.log(mean / (1 - mean)))


def scores_of(label: np.ndarray, margin: np.ndarray, loss: str) -> np.ndarray:
    """Sums over held rows: rows, squared errors, labels, squared labels; or counts of tn, fp, fn, tp."""
    if loss == "squared":
        return np.array([len(label), ((label - margin) ** 2).sum(), label.sum(), (label**2).sum()])
    return np.bincount(2 * label.astype(int) + (margin > 0), minlength=4).astype(np.float64)


def grow(block: Block, lane: Lane, loss: str, bins: int) -> tuple[float, np.ndarray, Trees]:
    """One lane on rows that are all here: first margin, scores, trees."""
    fitted = block.part != lane.held
    init = _first_margin(int(fitted.sum()), int(np.rint(block.label[fitted] * UNIT).sum()), loss)
    margin, trees = np.full(len(block.key), init), Trees(lane)
    for number in range(lane.rounds):
        drawn = Round(block, lane, number, margin, loss, bins)
        node = np.zeros(len(block.key), np.int64)
        for level in range(lane.depth + 1):
            if not level:
                sums = drawn.histogram(node, 0)
            elif level < lane.depth:
                sums = drawn.below(node, level, sums, trees.feature[number, here], trees.cut[number, here])
            else:
                sums = leaf_sums(sums, trees.feature[number, here], trees.cut[number, here])
            here = slice((1 << level) - 1, (2 << level) - 1)
            trees.feature[number, here], trees.cut[number, here], trees.value[number, here] = best_splits(sums, lane, level == lane.depth)
            if (trees.feature[number, here] < 0).all():
                break
            node = trees.step(number, block.bins, node)
        margin += lane.rate * trees.value[number][node]
    return init, scores_of(block.label[~fitted], margin[~fitted], loss), trees


def _at_ranks(values: np.ndarray, weights: np.ndarray, probs: list[float]) -> list[float]:
    """Values at which these shares of the weight are reached."""
    order = np.argsort(values, kind="stable")
    upto = weights[order].cumsum()
    at = np.searchsorted(upto, np.array(probs) * upto[-1] * (1 - 1e-12))
    return values[order[np.minimum(at, len(values) - 1)]].tolist()


def quantiles(df: DataFrame, features: list[str], probs: list[float]) -> list[list[float]]:
    """Quantiles of each feature, none where it has no value. Tasks sort their values, which meet in a task for each
    feature: all of them, or RANKED_VALUES at even ranks, which moves a quantile by at most such a share of the rows."""
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[] for _ in features]
        for b in batches:
            for x, c in zip(held, b.columns, strict=True):
                x.append(c.drop_null().to_numpy(zero_copy_only=False))
        for i, x in enumerate(held):
            x = np.sort(np.concatenate([np.empty(0), *x]))
            told = x if len(x) <= RANKED_VALUES else x[((np.arange(RANKED_VALUES) + 0.5) * (len(x) / RANKED_VALUES)).astype(np.int64)]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([told.tobytes()], pa.binary()), pa.array([len(x) / len(told)])], names=["f", "x", "w"])

    def choose(key, group):  # Spark reads the annotations of such functions, so it has none
        values = [np.frombuffer(x.as_py()) for x in group.column("x")]
        weights = np.repeat(group.column("w").to_numpy(), [len(x) for x in values])
        return pa.table({"f": [key[0].as_py()], "q": pa.array([_at_ranks(np.concatenate(values), weights, probs)], pa.list_(pa.float64()))})

    told = rows.mapInArrow(ranked, "f long, x binary, w double").groupBy("f")
    found = {r["f"]: r["q"] for r in told.applyInArrow(choose, "f long, q array<double>").collect()}
    return [found.get(i, []) for i in range(len(features))]


def bin_cuts(df: DataFrame, features: list[str], bins: int = MAX_BINS) -> list[list[float]]:
    """Upper ends of each feature's bins but the last: distinct quantiles of the rows."""
    return [sorted(set(q)) for q in quantiles(df, features, [i / bins for i in range(1, bins)])]


def _binned(columns: list[np.ndarray], cuts: list[list[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(np.array(c, np.float64), x, "left") for c, x in zip(cuts, columns, strict=True)], axis=1).astype(np.uint8)


def blocks_of(df: DataFrame, features: list[str], cuts: list[list[float]], part: str, key: str) -> DataFrame:
    """Saved table of blocks: key, bins, label, part as bytes."""
    rows = df.select(*[F.col(c).cast("double") for c in features], F.col("label").cast("double"), F.xxhash64(key).alias("key"), F.col(part).cast("int").alias("part"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = [c.to_numpy(zero_copy_only=False) for c in b.columns]
                parts = [x[-2].view(np.uint64), _binned(x[: len(features)], cuts), x[-3].astype(np.float64), x[-1].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["key", "bins", "label", "part"])

    return stable(rows.mapInArrow(pack, "key binary, bins binary, label binary, part binary"))


def block_of(key: bytes, bins: bytes, label: bytes, part: bytes, features: int) -> Block:
    return Block(np.frombuffer(key, np.uint64), np.frombuffer(bins, np.uint8).reshape(-1, features), np.frombuffer(label), np.frombuffer(part, np.int32))


def _fit_row(lane: Lane, init: float, scores: np.ndarray, trees: Trees) -> tuple:
    return lane.number, init, scores.tolist(), trees.feature.tobytes(), trees.cut.tobytes(), trees.value.tobytes()


def _fit_batch(row: tuple) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.float64(), pa.list_(pa.float64()), *[pa.binary()] * 3)
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=["lane", "init", "scores", "feature", "cut", "value"])


def _dealt_lanes(blocks: DataFrame, lanes: list[Lane], features: int, loss: str, bins: int) -> DataFrame:
    """Each lane a task, the longest first, over the binned rows sent to all of them (counted to be below LOCAL_BYTES)."""
    spark = blocks.sparkSession
    lanes = sorted(lanes, key=lambda x: -x.rounds * (x.depth + 1))
    shared = spark.sparkContext.broadcast([tuple(r) for r in blocks.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block.joined([block_of(*r, features) for r in shared.value])
        for b in batches:
            for i in b.column(0).to_pylist():
                yield _fit_batch(_fit_row(lanes[i], *grow(block, lanes[i], loss, bins)))

    return stable(spark.range(0, len(lanes), 1, len(lanes)).mapInArrow(run, _FITS))


def _dealt_rows(blocks: DataFrame, lanes: list[Lane], features: int, loss: str, bins: int) -> DataFrame:
    """Rows stay where they are; each level of all lanes is one aggregation."""
    spark = blocks.sparkSession
    trees = [Trees(x) for x in lanes]

    def each(of):
        """Arrow function that calls of(block, margins) for every block of a task."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from of((*r[:4], block_of(*r[:4], features), np.frombuffer(r[4]).reshape(len(lanes), -1) if len(r) > 4 else None)
                          for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
        return run

    def label_sums(rows) -> Iterator[pa.RecordBatch]:
        for *_, block, _ in rows:
            for x in lanes:
                y = block.label[block.part != x.held]
                yield pa.RecordBatch.from_arrays([pa.array([x.number]), pa.array([len(y)]), pa.array([int(np.rint(y * UNIT).sum())])], names=["lane", "n", "y"])

    found = blocks.mapInArrow(each(label_sums), "lane long, n long, y long").groupBy("lane").agg(F.sum("n"), F.sum(F.col("y").cast("decimal(38,0)"))).collect()
    init = {i: _first_margin(n, int(y), loss) for i, n, y in found}
    state_schema = "key binary, bins binary, label binary, part binary, margin binary"

    def states(rows, margins) -> Iterator[pa.RecordBatch]:
        for *raw, block, old in rows:
            new = margins(block, old)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (*raw, new.tobytes())], names=["key", "bins", "label", "part", "margin"])

    state = stable(blocks.mapInArrow(each(lambda rows: states(rows, lambda b, _: np.array([np.full(len(b.key), init[x.number]) for x in lanes]))), state_schema))
    tasks = state.rdd.getNumPartitions()
    before: list[DataFrame] = []
    for number in range(max(x.rounds for x in lanes)):
        growing = [(i, x) for i, x in enumerate(lanes) if number < x.rounds]
        held_sums: dict[int, np.ndarray] = {}  # of the level above
        for level in range(max(x.depth for _, x in growing) + 1):
            above, here = slice((1 << level >> 1) - 1, (1 << level) - 1), slice((1 << level) - 1, (2 << level) - 1)
            open_ = [(i, x) for i, x in growing if level <= x.depth and (not level or (trees[i].feature[number, above] >= 0).any())]
            for i, x in open_:
                if level == x.depth and i in held_sums:
                    found = best_splits(leaf_sums(held_sums[i], trees[i].feature[number, above], trees[i].cut[number, above]), x, True)
                    trees[i].feature[number, here], trees[i].cut[number, here], trees[i].value[number, here] = found
            open_ = [(i, x) for i, x in open_ if level < x.depth or i not in held_sums]
            if not open_:
                continue
            wanted = {i: smaller(held_sums[i], trees[i].feature[number, above], trees[i].cut[number, above]) if i in held_sums else np.ones(1 << level, bool) for i, _ in open_}
            cells = sum(int(w.sum()) for w in wanted.values()) * features * bins

            now = {i: trees[i].only(number) for i, _ in open_}

            def histograms(rows, open_=open_, wanted=wanted, level=level, number=number, now=now) -> dict[int, np.ndarray]:
                total = {i: np.zeros((3, int(wanted[i].sum()), features, bins), np.int64) for i, _ in open_}
                for *_, block, margin in rows:
                    for i, x in open_:
                        drawn = Round(block, x, number, margin[i], loss, bins)
                        total[i] += drawn.histogram(now[i].node(0, block.bins, level), level, wanted[i])[:, wanted[i]]
                return total

            if cells <= DRIVER_CELLS and cells * tasks <= SENT_CELLS:
                def sent(rows, histograms=histograms) -> Iterator[pa.RecordBatch]:
                    total = histograms(rows)
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(t.tobytes() for t in total.values())], pa.binary())], names=["sums"])

                found = state.mapInArrow(each(sent), "sums binary").collect()
                told = sum((np.frombuffer(r["sums"], np.int64) for r in found), np.zeros(3 * cells, np.int64))
                place, sums_now = 0, {}
                for i, x in open_:
                    size = 3 * int(wanted[i].sum()) * features * bins
                    full = np.zeros((3, 1 << level, features, bins), np.int64)
                    full[:, wanted[i]] = told[place : place + size].reshape(3, -1, features, bins)
                    place += size
                    sums_now[i] = with_rest(full, wanted[i], held_sums[i]) if i in held_sums else full
                    trees[i].feature[number, here], trees[i].cut[number, here], trees[i].value[number, here] = best_splits(sums_now[i], x, level == x.depth)
                held_sums = sums_now
                continue
            wanted = {i: np.ones(1 << level, bool) for i, _ in open_}
            held_sums = {}

            def sums(rows, open_=open_, histograms=histograms, wanted=wanted) -> Iterator[pa.RecordBatch]:
                for i, t in histograms(rows, wanted=wanted).items():
                    at = np.nonzero(t[0])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(at[0]), i), *at, t[0][at], t[1][at], t[2][at])],
                                                     names=["i", "node", "feature", "bin", "n", "g", "h"])

            last = level  # of this level, as the function is sent before the next begins

            def choose(key, group):  # Spark reads the annotations of such functions, so it has none
                i, node = (k.as_py() for k in key)
                one = np.zeros((3, 1, features, bins), np.int64)
                for j, c in enumerate(("n", "g", "h")):
                    one[j, 0, group.column("feature").to_numpy(), group.column("bin").to_numpy()] = group.column(c).to_numpy()
                feature, cut, value = best_splits(one, lanes[i], last == lanes[i].depth)
                return pa.table({"i": [i], "node": [node], "feature": [int(feature[0])], "cut": [int(cut[0])], "value": [float(value[0])]})

            counted = state.mapInArrow(each(sums), "i long, node long, feature long, bin long, n long, g long, h long")
            counted = counted.groupBy("i", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "g", "h")])
            for i, node, feature, cut, value in counted.groupBy("i", "node").applyInArrow(choose, "i long, node long, feature long, cut long, value double").collect():
                at = (1 << level) - 1 + node
                trees[i].feature[number, at], trees[i].cut[number, at], trees[i].value[number, at] = feature, cut, value

        now = {i: trees[i].only(number) for i, _ in growing}

        def advanced(block: Block, old: np.ndarray, growing=growing, now=now) -> np.ndarray:
            new = old.copy()
            for i, x in growing:
                new[i] += x.rate * now[i].value[0][now[i].node(0, block.bins, x.depth)]
            return new

        for s in before:  # the sums above have computed the margins that followed
            s.unpersist()
        after = state.mapInArrow(each(lambda rows, advanced=advanced: states(rows, advanced)), state_schema)
        if number % SAVE_EVERY == SAVE_EVERY - 1:
            after = stable(after)
            state.unpersist()
            before = []
        else:
            after, before = after.persist(StorageLevel.MEMORY_AND_DISK), [state]
        state = after

    def held(rows) -> Iterator[pa.RecordBatch]:
        for *_, block, margin in rows:
            for i, x in enumerate(lanes):
                left = block.part == x.held
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([scores_of(block.label[left], margin[i][left], loss)], pa.list_(pa.float64()))], names=["i", "s"])

    parts = state.mapInArrow(each(held), "i long, s array<double>").select("i", F.posexplode("s").alias("d", "x")).groupBy("i", "d").agg(F.sum("x")).collect()
    scores = np.zeros((len(lanes), 4))
    for i, d, x in parts:
        scores[i, d] = x
    for s in (*before, state):
        s.unpersist()
    return spark.createDataFrame([_fit_row(x, init[x.number], scores[i], trees[i]) for i, x in enumerate(lanes)], _FITS)


def rmse(scores: Sequence[float]) -> float:
    return float(np.sqrt(scores[1] / scores[0])) if scores[0] else float("nan")


def r2(scores: Sequence[float]) -> float:
    n, errors, total, squares = scores
    spread = squares - total * total / n if n else 0.0
    return 1.0 - errors / spread if spread > 0 else float("nan")


def f1_weighted(scores: Sequence[float]) -> float:
    """F1 of both classes, weighted by their rows."""
    tn, fp, fn, tp = scores
    one, zero = (2 * x / (2 * x + fp + fn) if 2 * x + fp + fn else 0.0 for x in (tp, tn))
    rows = tn + fp + fn + tp
    return ((tp + fn) * one + (tn + fp) * zero) / rows if rows else float("nan")


@dataclass(frozen=True)
class Boosted:
    """A fitted lane. transform adds prediction, and for the logistic loss score (probability of label 1)."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    lane: Lane
    loss: str
    init: float
    feature: bytes
    cut: bytes
    value: bytes

    def margin(self, bins: np.ndarray) -> np.ndarray:
        trees = Trees(self.lane)
        shape = trees.value.shape
        trees.feature, trees.cut, trees.value = (np.frombuffer(b, t).reshape(shape) for b, t in (
            (self.feature, np.int8), (self.cut, np.uint8), (self.value, np.float64)))
        margin = np.full(len(bins), self.init)
        for number in range(self.lane.rounds):
            margin += self.lane.rate * trees.value[number][trees.node(number, bins, self.lane.depth)]
        return margin

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import DoubleType, StructType

        schema = StructType([*df.schema.fields]).add("prediction", DoubleType())
        schema = schema.add("score", DoubleType()) if self.loss != "squared" else schema
        arrow, fitted = to_arrow_schema(schema), self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bins = _binned([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in fitted.features], [list(c) for c in fitted.cuts])
                margin = fitted.margin(bins)
                more = [margin] if fitted.loss == "squared" else [(margin > 0).astype(np.float64), 1.0 / (1.0 + np.exp(-margin))]
                yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, more)], schema=arrow)

        return df.mapInArrow(run, schema)


class BoostedModel(Model, DefaultParamsWritable, DefaultParamsReadable):
    """A fitted lane as the last stage of a pipeline, over a vector column `features`. Adds prediction, and for the
    logistic loss probability."""

    def __init__(self, fitted: Boosted | None = None):
        super().__init__()
        self.fitted_lane = Param(self, "fitted_lane", "fields of the lane, the cuts and the trees")
        if fitted:
            told = {"features": list(fitted.features), "cuts": [list(c) for c in fitted.cuts], "lane": dict(fitted.lane.__dict__), "loss": fitted.loss, "init": fitted.init}
            self._set(fitted_lane=told | {c: base64.b64encode(getattr(fitted, c)).decode() for c in ("feature", "cut", "value")})

    def fitted(self) -> Boosted:
        x = self.getOrDefault(self.fitted_lane)
        return Boosted(tuple(x["features"]), tuple(map(tuple, x["cuts"])), Lane(**x["lane"]), x["loss"], x["init"],
                       *(base64.b64decode(x[c]) for c in ("feature", "cut", "value")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        boosted = self.fitted()

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            return pd.Series(boosted.margin(_binned(list(np.stack(x.to_numpy()).T), [list(c) for c in boosted.cuts])))

        found = margin(vector_to_array("features"))
        if boosted.loss == "squared":
            return dataset.withColumn("prediction", found)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        return dataset.withColumn("_margin", found).withColumns({
            "prediction": (p > 0.5).cast("double"), "probability": array_to_vector(F.array(F.lit(1.0) - p, p))}).drop("_margin")


@dataclass
class Fits:
    """Result of fit_lanes: a table with a row per lane (first margin, scores on the held rows, trees)."""

    table: DataFrame
    lanes: list[Lane]
    features: list[str]
    cuts: list[list[float]]
    loss: str

    def scores(self) -> dict[int, list[float]]:
        return {r["lane"]: r["scores"] for r in self.table.select("lane", "scores").collect()}

    def model(self, number: int) -> Boosted:
        row = self.table.where(F.col("lane") == number).first()
        lane = next(x for x in self.lanes if x.number == number)
        return Boosted(tuple(self.features), tuple(map(tuple, self.cuts)), lane, self.loss, row["init"], bytes(row["feature"]), bytes(row["cut"]), bytes(row["value"]))


def fit_lanes(
    df: DataFrame, features: list[str], lanes: list[Lane], loss: str = "squared", part: str = "part", key: str = "row_key",
    bins: int = MAX_BINS, local_bytes: int = LOCAL_BYTES
) -> Fits:
    """Fit all lanes on df (features, label, part, key). loss: squared, or logistic with labels 0 and 1.

    Cuts come from all rows, held ones too, without their labels. Lanes whose fitted rows are none predict 0 (or even
    odds); a level ends where no node can be split.
    """
    cuts = bin_cuts(df, features, bins)
    blocks = blocks_of(df, features, cuts, part, key)
    size = blocks.agg(F.sum(sum((F.octet_length(c) for c in ("key", "bins", "label", "part")), F.lit(0)))).first()[0] or 0
    deal = _dealt_lanes if 0 < size <= local_bytes else _dealt_rows
    return Fits(deal(blocks, lanes, len(features), loss, bins), lanes, features, cuts, loss)

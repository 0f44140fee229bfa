"""Random forests without a depth limit.

A tree's row weights are Poisson draws by a hash of the row's key. Nodes with many drawn rows are split level by level
from histograms over their own quantiles: aggregations by (tree, node, feature, bin) over all rows. A node with few
rows goes to one task, which grows it to the end: a leaf has equal labels or equal features. A finished tree is
therefore the same plan at every size, and a forest is a table: split nodes, leaves and grown subtrees.

Features that are missing (NULL or NaN) count as less than all others. Rows without a label are left out of a fit.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.columns import hash_text, hash_word
from perigee.session import stable

#: Drawn rows up to which one task grows a node, and scored rows of a subtree in one task.
GROW_ROWS = 400_000
#: Rows of all trees in one task that grows nodes, on the average.
GROWN_ROWS = 50_000
#: Quantiles of a large node that may become cuts.
NODE_BINS = 64
#: Rows of all trees in one partition when a fit begins, and node tables up to which rows meet them by broadcast.
SPREAD_ROWS, BROADCAST_NODES = 250_000, 20_000
_SUBTREE = "tree int, node string, feature binary, cut binary, child binary, value binary"
_SPLITS = "level int, tree int, node string, feature int, cut double"
_LEAVES = "tree int, node string, value double"


def poisson_marks(mean: float = 1.0) -> list[int]:
    """Marks on 32-bit numbers: as many as a uniform number reaches is its Poisson draw."""
    marks, share, total = [], math.exp(-mean), 0.0
    while (mark := math.floor((total := total + share) * 2**32)) < 2**32 - 1 and len(marks) < 16:
        marks.append(mark)
        share *= mean / len(marks)
    return marks


def _bag_number(key: str, tree: Column, seed: int) -> Column:
    return hash_word(hash_text(f"{seed}:bag", tree, key), 0)


def bag_weight(key: str, tree: Column, seed: int) -> Column:
    """How often a tree draws a row; the same on any cluster."""
    u = _bag_number(key, tree, seed)
    return reduce(lambda a, m: a + (u >= F.lit(m)).cast("int"), poisson_marks(), F.lit(0))


def with_drawn(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows that their tree draws, with the weight w. The condition hashes a row once, not once for every mark."""
    tree = F.col("tree")
    return df.where(_bag_number(key, tree, seed) >= F.lit(poisson_marks()[0])).withColumn("w", bag_weight(key, tree, seed))


def _met(nodes: DataFrame) -> DataFrame:
    """A saved table of nodes, to be sent to all tasks where it is counted to be small: few nodes hold most rows."""
    return F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes


def _value(name: str) -> Column:
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(None)), F.lit(float("-inf")))


def _spread(rows: DataFrame, features: list[str], trees: int, *more: str) -> DataFrame:
    """One row per row and tree, at the root: features x0, x1, ..."""
    return rows.select(*more, *[_value(f).alias(f"x{i}") for i, f in enumerate(features)],
                       F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit("").alias("node"))


def _dealt(rows: DataFrame, trees: int) -> DataFrame:
    """Rows in partitions by the work they make, not by the few files they come from."""
    return rows.repartition(max(1, math.ceil(rows.count() * trees / SPREAD_ROWS)))


def _bin(x: Column, cuts: Column) -> Column:
    """How many of the increasing cuts (at most NODE_BINS) a value is above: by halving, not one by one."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(NODE_BINS.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, s: n + F.when(x > F.get(cuts, n + s - 1), s).otherwise(0))


def _rng(seed: int, tree: int, node: str) -> np.random.Generator:
    return np.random.default_rng([seed, tree, zlib.crc32(node.encode())])


@dataclass
class Tree:
    """Nodes of a subtree from its root on; a split's children are `child` and the next, a leaf's feature is -1."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray

    def packed(self) -> list[bytes]:
        return [self.feature.astype(np.int16).tobytes(), self.cut.astype(np.float64).tobytes(),
                self.child.astype(np.int64).tobytes(), self.value.astype(np.float64).tobytes()]

    @staticmethod
    def unpacked(feature: bytes, cut: bytes, child: bytes, value: bytes) -> Tree:
        return Tree(np.frombuffer(feature, np.int16), np.frombuffer(cut), np.frombuffer(child, np.int64), np.frombuffer(value))

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while len(moving):
            here = at[moving]
            at[moving] = self.child[here] + (x[moving, self.feature[here]] > self.cut[here])
            moving = moving[self.feature[at[moving]] >= 0]
        return self.value[at]


def _between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Middle of two neighbours, never reaching the upper one."""
    with np.errstate(all="ignore"):
        middle = low + (high - low) / 2
    return np.where((middle >= low) & (middle < high), middle, low)


def grow_to_end(x: np.ndarray, y: np.ndarray, w: np.ndarray, per_node: int, rng: np.random.Generator) -> Tree:
    """Split until all labels or all features of a node are equal. All nodes of a level are handled at once.

    Of the features that vary inside a node, `per_node` are drawn; the split with the least squared error (Gini, for
    labels 0 and 1) wins.
    """
    n, width = x.shape
    ids = np.zeros(n, np.int64)  # node of each row inside the level
    orders = [np.argsort(x[:, f], kind="stable") for f in range(width)]  # by node, then feature
    out: list[list[np.ndarray]] = [[], [], [], []]
    nodes, base = 1, 0
    while nodes:
        counts = np.bincount(ids[orders[0]], minlength=nodes)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        node = np.repeat(np.arange(nodes), counts)
        labels, weights = y[orders[0]], w[orders[0]]
        lowest, highest = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
        total, weight = np.add.reduceat(labels * weights, starts), np.add.reduceat(weights, starts)
        varies = np.stack([x[o[starts], f] < x[o[starts + counts - 1], f] for f, o in enumerate(orders)])
        lots = np.where(varies, rng.random((width, nodes)), np.inf)
        drawn = varies & (lots.argsort(axis=0).argsort(axis=0) < per_node)
        best, feature, cut = np.full(nodes, -np.inf), np.full(nodes, -1), np.zeros(nodes)
        for f, o in enumerate(orders):
            values, ws = x[o, f], w[o]
            left_w, left = np.cumsum(ws), np.cumsum(ws * y[o])
            left_w, left = left_w - (left_w[starts] - ws[starts])[node], left - (left[starts] - (ws * y[o])[starts])[node]
            last = np.append((node[:-1] != node[1:]) | (values[:-1] >= values[1:]), True)
            rest_w, rest = np.maximum(weight[node] - left_w, 1e-300), total[node] - left
            gain = np.where(last, -np.inf, left**2 / left_w + rest**2 / rest_w)
            top = np.maximum.reduceat(gain, starts)
            # the first of gains that only rounding tells apart
            slack = 1e-9 * np.where(np.isfinite(top), np.abs(top), 0.0)
            at = np.flatnonzero(~last & (gain >= (top - slack)[node]))
            found, first = np.unique(node[at], return_index=True)
            place = at[first]
            wins = drawn[f, found] & (lowest[found] < highest[found]) & (top[found] > best[found] + slack[found])
            found, place = found[wins], place[wins]
            best[found], feature[found] = top[found], f
            cut[found] = _between(values[place], values[place + 1])
        split = feature >= 0
        child = np.where(split, base + nodes + 2 * (np.cumsum(split) - 1), 0)
        value = np.where(lowest == highest, lowest, total / weight)
        for kept, part in zip(out, (feature, cut, child, value), strict=True):
            kept.append(part)
        rows = np.flatnonzero(np.isin(np.arange(n), orders[0]))
        rows = rows[split[ids[rows]]]
        here = ids[rows]
        stays = np.zeros(n, bool)
        stays[rows] = True
        ids[rows] = child[here] - (base + nodes) + (x[rows, feature[here]] > cut[here])
        orders = [o[stays[o]] for o in orders]
        orders = [o[np.argsort(ids[o], kind="stable")] for o in orders]
        base, nodes = base + nodes, 2 * int(split.sum())
    return Tree(*[np.concatenate(parts) for parts in out])


@dataclass
class Forest:
    """A fitted forest as tables: splits and leaves of large nodes, grown subtrees of the others."""

    features: list[str]
    trees: int
    levels: int
    splits: DataFrame
    leaves: DataFrame
    subtrees: DataFrame
    task_rows: int = GROW_ROWS

    def tree_predictions(self, rows: DataFrame, key: str, *more: str) -> DataFrame:
        """Prediction of every tree for every row: key, further columns, tree, prediction. Keys need not be unique.

        Rows meet subtrees in groups of bounded size: a subtree is repeated once for every `task_rows` rows.
        """
        held = list(dict.fromkeys([key, *more]))
        dealt = _dealt(rows.select(*self.features, F.struct(*held).alias("_row")), self.trees)
        at = _spread(dealt, self.features, self.trees, "_row")
        for level in range(self.levels):
            here = _met(self.splits.where(F.col("level") == level).drop("level"))
            x = F.array(*[F.col(f"x{i}") for i in range(len(self.features))])
            side = F.when(F.get(x, F.col("feature")) > F.col("cut"), "1").otherwise("0")
            at = at.join(here, ["tree", "node"], "left").withColumn(
                "node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.concat("node", side))).drop("feature", "cut")
        at = stable(at)
        done = at.join(self.leaves, ["tree", "node"]).select("_row.*", "tree", F.col("value").alias("prediction"))
        sizes = at.groupBy("tree", "node").count().select(
            "tree", "node", F.ceil(F.col("count") / F.lit(self.task_rows)).cast("int").alias("chunks"))
        names = [f"x{i}" for i in range(len(self.features))]
        placed = at.join(sizes, ["tree", "node"]).join(self.subtrees.select("tree", "node"), ["tree", "node"], "left_semi").withColumn(
            "chunk", F.pmod(F.xxhash64(F.to_json("_row"), *names), F.col("chunks")).cast("int"))
        parts = self.subtrees.join(sizes, ["tree", "node"]).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        kinds = {f.name: f.dataType for f in rows.select(*held).schema}
        schema = ", ".join([*[f"`{c}` {t.simpleString()}" for c, t in kinds.items()], "tree int", "prediction double"])

        def apply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = left[[f"_h{i}" for i in range(len(held))]].set_axis(held, axis=1)
            if not len(left):
                return out.assign(tree=pd.Series([], dtype="int32"), prediction=pd.Series([], dtype="float64"))
            one = right.iloc[0]
            tree = Tree.unpacked(one["feature"], one["cut"], one["child"], one["value"])
            return out.assign(tree=left["tree"], prediction=tree.predict(left[names].to_numpy(np.float64)))

        cells = [F.col(f"_row.`{c}`").alias(f"_h{i}") for i, c in enumerate(held)]
        group = ["tree", "node", "chunk"]
        grown = placed.select(*group, *names, *cells).groupBy(*group).cogroup(parts.groupBy(*group)).applyInPandas(apply, schema)
        return grown.unionByName(done)

    def predict(self, rows: DataFrame, key: str, *more: str) -> DataFrame:
        """Mean over the trees for each row, by a unique key: a value, or the probability of class 1."""
        held = list(dict.fromkeys([key, *more]))
        return self.tree_predictions(rows, key, *more).groupBy(*held).agg(F.avg("prediction").alias("prediction"))

    def save(self, path: str) -> None:
        """Write the tables below a path; the note with the feature names is written last."""
        for name in ("splits", "leaves", "subtrees"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        note = [(self.features, self.trees, self.levels, self.task_rows)]
        self.splits.sparkSession.createDataFrame(note, "features array<string>, trees int, levels int, task_rows int").write.mode(
            "overwrite").parquet(f"{path}/note")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        note = spark.read.parquet(f"{path}/note").first()
        tables = [spark.read.schema(s).parquet(f"{path}/{n}") for n, s in (("splits", _SPLITS), ("leaves", _LEAVES), ("subtrees", _SUBTREE))]
        return Forest(note["features"], note["trees"], note["levels"], *tables, note["task_rows"])


def _large_splits(at: DataFrame, large: DataFrame, width: int, per_node: int, seed: int) -> DataFrame:
    """Best split of each large node: tree, node, feature, cut. Every node here has a feature that varies.

    Cuts are a node's own quantiles and its least value, so that both sides of every cut hold rows.
    """
    probs = [i / NODE_BINS for i in range(1, NODE_BINS)]
    lot = [F.md5(F.concat_ws(":", F.lit(f"{seed}:{i}"), "tree", "node")) for i in range(width)]
    drawn = F.slice(F.array_sort(F.filter(F.array(*[
        F.when(F.col(f"lo{i}") < F.col(f"hi{i}"), F.struct(lot[i].alias("lot"), F.lit(i).alias("f"))) for i in range(width)
    ]), lambda s: s.isNotNull())), 1, per_node)
    nodes = large.select("tree", "node", drawn.alias("drawn"), *[f"lo{i}" for i in range(width)], *[f"hi{i}" for i in range(width)])
    inside = at.join(_met(large.select("tree", "node")), ["tree", "node"], "left_semi")
    quantiles = inside.groupBy("tree", "node").agg(*[F.percentile_approx(f"x{i}", probs, 10_000).alias(f"q{i}") for i in range(width)])

    def cuts_of(f: Column) -> Column:
        """Increasing cuts of a drawn feature, all below its largest value."""
        found = F.lit(None).cast("array<double>")
        for i in range(width):
            found = F.when(f == i, F.expr(f"array_sort(array_distinct(filter(concat(array(lo{i}), q{i}), c -> c < hi{i})))")).otherwise(found)
        return found

    cuts = stable(nodes.join(quantiles, ["tree", "node"]).select("tree", "node", F.transform(
        "drawn", lambda d: F.struct(d["f"].alias("f"), cuts_of(d["f"]).alias("cuts"))).alias("drawn")))
    x = F.array(*[F.col(f"x{i}") for i in range(width)])
    binned = inside.join(_met(cuts), ["tree", "node"]).select("tree", "node", "w", "y", x.alias("x"), F.explode("drawn").alias("d")).select(
        "tree", "node", "w", "y", "d.f", _bin(F.get("x", F.col("d.f")), F.col("d.cuts")).alias("bin"))
    sums = binned.groupBy("tree", "node", "f", "bin").agg(F.sum("w").cast("double").alias("w"), F.sum(F.col("w") * F.col("y")).alias("s"))
    # at most NODE_BINS + 1 bins of a drawn feature and node; the last one isn't a left side
    of = "PARTITION BY tree, node, f ORDER BY bin"
    run = sums.selectExpr(
        "tree", "node", "f", "bin", f"sum(w) OVER ({of}) AS lw", f"sum(s) OVER ({of}) AS ls",
        "sum(w) OVER (PARTITION BY tree, node, f) AS tw", "sum(s) OVER (PARTITION BY tree, node, f) AS ts").where("lw < tw")
    gain = F.col("ls") ** 2 / F.col("lw") + (F.col("ts") - F.col("ls")) ** 2 / (F.col("tw") - F.col("lw"))
    best = run.groupBy("tree", "node").agg(F.max(F.struct(gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("bin")).alias("bin"))).alias("b"))
    chosen = best.select("tree", "node", (-F.col("b.f")).alias("feature"), (-F.col("b.bin")).alias("bin"))
    mine = F.get(F.filter("drawn", lambda d: d["f"] == F.col("feature")), F.lit(0))
    return chosen.join(cuts, ["tree", "node"]).select("tree", "node", F.col("feature").cast("int").alias("feature"),
                                                      F.get(mine["cuts"], F.col("bin")).alias("cut"))


def fit_forest(
    rows: DataFrame, features: list[str], label: str, key: str, trees: int, per_node: int, seed: int = 42,
    grow_rows: int = GROW_ROWS,
) -> Forest:
    """Fit on all rows. `per_node` features are tried at a split: all for values, the root of their number for classes.

    Each level of large nodes costs a few jobs; rows of finished nodes take no part in later levels.
    """
    spark, width = rows.sparkSession, len(features)
    xs = [f"x{i}" for i in range(width)]
    labelled = rows.where(F.col(label).isNotNull()).select(
        *features, F.col(label).cast("double").alias("_y"), F.col(key).cast("string").alias("_key"))
    at = _spread(_dealt(labelled, trees), features, trees, F.col("_y").alias("y"), F.col("_key").alias("k"))
    at = stable(with_drawn(at, "k", seed))
    splits, leaves, level = [], [], 0
    while True:
        large = stable(at.groupBy("tree", "node").agg(
            F.count(F.lit(1)).alias("n"), F.min("y").alias("y0"), F.max("y").alias("y1"),
            (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("value"),
            *[f(x).alias(f"{n}{i}") for i, x in enumerate(xs) for f, n in ((F.min, "lo"), (F.max, "hi"))],
        ).where(F.col("n") > F.lit(grow_rows)))
        if large.isEmpty():
            break
        varies = reduce(lambda a, i: a | (F.col(f"lo{i}") < F.col(f"hi{i}")), range(width), F.lit(False))
        divides = (F.col("y0") < F.col("y1")) & varies
        found = stable(_large_splits(at, large.where(divides), width, per_node, seed))
        finished = stable(large.where(~divides).select("tree", "node", F.when(F.col("y0") == F.col("y1"), F.col("y0")).otherwise(F.col("value")).alias("value")))
        splits.append(found.select(F.lit(level).alias("level"), "tree", "node", "feature", "cut"))
        leaves.append(finished)
        side = F.when(F.get(F.array(*xs), F.col("feature")) > F.col("cut"), "1").otherwise("0")
        at = stable(
            at.join(_met(finished.select("tree", "node")), ["tree", "node"], "left_anti").join(_met(found), ["tree", "node"], "left")
            .withColumn("node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.concat("node", side)))
            .drop("feature", "cut"))
        level += 1

    def grow(group: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("k", kind="stable") if part["k"].is_unique else part.sort_values(["k", "y", *xs], kind="stable")
        tree, node = int(group[0]), group[1]
        grown = grow_to_end(part[xs].to_numpy(np.float64), part["y"].to_numpy(np.float64), part["w"].to_numpy(np.float64),
                            per_node, _rng(seed, tree, node))
        return pd.DataFrame([(tree, node, *grown.packed())], columns=["tree", "node", "feature", "cut", "child", "value"])

    # by the rows to grow from, not by their bytes: a node is minutes of work
    at = at.repartition(max(1, math.ceil(at.count() / GROWN_ROWS)), "tree", "node")
    subtrees = stable(at.groupBy("tree", "node").applyInPandas(grow, _SUBTREE))
    none = [spark.createDataFrame([], s) for s in (_SPLITS, _LEAVES)]
    return Forest(features, trees, level, stable(reduce(DataFrame.unionByName, splits, none[0])),
                  stable(reduce(DataFrame.unionByName, leaves, none[1])), subtrees, grow_rows)


def bag_check(forest: Forest, rows: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """What the fully grown trees say of the rows they drew: per tree the rows, draws and sum of predictions over the
    draws. Where no two rows have equal features, each prediction is the row's own label."""
    drawn = with_drawn(forest.tree_predictions(rows, key, label), key, seed)
    return drawn.groupBy("tree").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("w").cast("long").alias("draws"),
        F.round(F.sum(F.col("w") * F.col("prediction")), 6).alias("prediction_sum"),
        F.sum(F.when(F.abs(F.col("prediction") - F.col(label)) > 1e-9, 1).otherwise(0)).cast("long").alias("different"))

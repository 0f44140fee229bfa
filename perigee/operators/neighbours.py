"""Exact k-nearest-neighbour self-join without comparing all pairs.

1. Equal feature vectors are folded into one vector with its k+1 smallest row keys, so copies never
   meet each other pairwise.
2. Vectors are cut into leaves of bounded size: per level one feature, cut at quantiles inside each
   node that is still too large.
3. Each leaf finds its own neighbours. The k-th distance found bounds how far a vector has to look.
4. A vector visits only the other leaves whose bounding box lies within that distance, found by
   walking down the box tree with equi-joins on the node number.
5. The candidates of all visited leaves are merged per vector.

The tables of cuts and boxes are broadcast where their rows are counted and few, else joined by node number.
Leaf work is numpy over one leaf at a time.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.operators.joins import salted_join
from perigee.session import stable

LEAF_ROWS = 2_000
FANOUT = 64
BROADCAST_NODES = 100_000  # larger tables of cuts and boxes are joined by node number
MAX_DEPTH = 8  # node numbers stay exact as doubles
VISITS_PER_TASK, LEAVES_PER_TASK = 20_000, 4
DISTANCE_CELLS = 2_000_000
SLACK = 1.0 + 1e-9

# The leaf functions travel with the plan: executors need numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HIT = "vid long, d2 double, other long, other_x array<double>, other_members array<long>"
_OWN = "vid long, leaf long, x array<double>, members array<long>, reach double, hits array<struct<d2: double, other: long, other_x: array<double>, other_members: array<long>>>"


def distinct_vectors(points: DataFrame, key: str, features: list[str], keep: int) -> DataFrame:
    """One row per distinct vector: vid (smallest key), x, and its ``keep`` smallest keys."""
    same = W.partitionBy(*features)
    return (
        points.select(key, *features)
        .withColumn("_n", F.row_number().over(same.orderBy(key)))
        .where(F.col("_n") <= keep)
        .withColumn("members", F.sort_array(F.collect_list(key).over(same)))
        .where(F.col("_n") == 1)
        .select(
            F.col(key).alias("vid"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"), "members")
    )


def _split_order(vectors: DataFrame, width: int) -> list[int]:
    """Feature positions, widest deviation first."""
    row = vectors.agg(*[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(width)]).first()
    return sorted(range(width), key=lambda i: -(row[i] or 0.0))


def _few(nodes: DataFrame, rows: int) -> DataFrame:
    """A table of tree nodes, to be broadcast if it has few rows."""
    return F.broadcast(nodes) if rows <= BROADCAST_NODES else nodes


def _grow_leaves(vectors: DataFrame, width: int, leaf_rows: int) -> tuple[DataFrame, int]:
    """Add ``leaf``; a node's parent is leaf div FANOUT. Returns the table and the tree depth.

    Features are cut in turn, again and again, until every leaf holds at most ``leaf_rows`` vectors; vectors are
    distinct, so some feature can always cut. MAX_DEPTH levels are enough for more vectors than a long can number.
    """
    tree, depth = vectors.withColumn("leaf", F.lit(0).cast("long")), 0
    fractions = [i / FANOUT for i in range(1, FANOUT)]
    order = _split_order(vectors, width)
    uncut, grown = 0, True
    while uncut < len(order) and depth < MAX_DEPTH:
        if grown and tree.groupBy("leaf").count().where(F.col("count") > leaf_rows).isEmpty():
            break
        position = order[0]
        order = [*order[1:], position]
        value = F.col("x")[position]
        parts = F.least(F.lit(FANOUT), F.ceil(F.col("rows") / leaf_rows)).cast("int")
        nodes = (
            tree.groupBy("leaf")
            .agg(F.count(F.lit(1)).alias("rows"), F.percentile_approx(value, fractions, 1000).alias("fine"),
                 F.min(value).alias("lo"), F.max(value).alias("hi"))
            .where((F.col("rows") > leaf_rows) & (F.col("lo") < F.col("hi")))
        )
        # the largest value never is a cut, so that a cut always leaves something on its right
        cuts = stable(nodes.select(
            "leaf",
            F.transform(F.array_distinct(F.transform(
                F.sequence(F.lit(1), parts - 1),
                lambda i: F.element_at("fine", F.floor(i * FANOUT / parts).cast("int")),
            )), lambda c: F.when(c < F.col("hi"), c).otherwise(F.col("lo"))).alias("cuts"),
        ))
        n_cuts = cuts.count()
        if not n_cuts:
            uncut, grown = uncut + 1, False
            continue
        uncut, grown = 0, True
        child = F.coalesce(F.size(F.filter("cuts", lambda c: c < value)), F.lit(0))
        tree = stable(
            tree.join(_few(cuts, n_cuts), "leaf", "left")
            .withColumn("leaf", F.col("leaf") * FANOUT + child)
            .drop("cuts")
        )
        depth += 1
    return tree, depth


def _nearest(
    qid: np.ndarray, qx: np.ndarray, reach: np.ndarray, vid: np.ndarray, x: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (query, point) and squared distance of up to k nearest points within reach, by (distance, vid)."""
    out_q, out_p, out_d = [], [], []
    step = max(1, DISTANCE_CELLS // max(len(vid), 1))
    for start in range(0, len(qid), step):
        part = slice(start, start + step)
        d2 = np.zeros((len(qid[part]), len(vid)))
        for j in range(x.shape[1]):
            d2 += (qx[part, j, None] - x[None, :, j]) ** 2
        d2[qid[part, None] == vid[None, :]] = np.inf
        limit = reach[part].copy()
        if len(vid) > k:
            limit = np.minimum(limit, np.partition(d2, k - 1, axis=1)[:, k - 1])
        q, p = np.nonzero((d2 <= limit[:, None]) & np.isfinite(d2))
        order = np.lexsort((vid[p], d2[q, p], q))
        q, p = q[order], p[order]
        first = np.searchsorted(q, q)
        best = np.arange(len(q)) - first < k
        out_q.append(q[best] + start)
        out_p.append(p[best])
        out_d.append(d2[q[best], p[best]])
    if not out_q:
        empty = np.array([], dtype=np.int64)
        return empty, empty, np.array([])
    return np.concatenate(out_q), np.concatenate(out_p), np.concatenate(out_d)


def _own_leaf(k: int):
    def search(leaf: pd.DataFrame) -> pd.DataFrame:
        vid, x = leaf["vid"].to_numpy(), np.stack(leaf["x"].to_numpy())
        q, p, d2 = _nearest(vid, x, np.full(len(vid), np.inf), vid, x, k)
        ends = np.searchsorted(q, np.arange(len(vid) + 1))
        hits, reach = [], []
        for i in range(len(vid)):
            span = range(ends[i], ends[i + 1])
            hits.append([
                {"d2": d2[j], "other": vid[p[j]], "other_x": x[p[j]], "other_members": leaf["members"].iat[p[j]]}
                for j in span
            ])
            reach.append(d2[ends[i + 1] - 1] if len(span) == k else np.inf)
        return leaf.assign(reach=reach, hits=hits)[["vid", "leaf", "x", "members", "reach", "hits"]]

    return search


def _visited_leaf(k: int):
    def search(visitors: pd.DataFrame, leaf: pd.DataFrame) -> pd.DataFrame:
        if visitors.empty or leaf.empty:
            return pd.DataFrame({"vid": [], "d2": [], "other": [], "other_x": [], "other_members": []})
        vid, x = leaf["vid"].to_numpy(), np.stack(leaf["x"].to_numpy())
        qid, qx = visitors["vid"].to_numpy(), np.stack(visitors["x"].to_numpy())
        q, p, d2 = _nearest(qid, qx, visitors["reach"].to_numpy() * SLACK, vid, x, k)
        return pd.DataFrame({
            "vid": qid[q], "d2": d2, "other": vid[p],
            "other_x": leaf["x"].to_numpy()[p], "other_members": leaf["members"].to_numpy()[p],
        })

    return search


def _boxes(tree: DataFrame, width: int) -> DataFrame:
    return tree.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.min(F.col("x")[i]) for i in range(width)]).alias("lo"),
        F.array(*[F.max(F.col("x")[i]) for i in range(width)]).alias("hi"),
    )


def _near(box: Column, x: Column, width: int) -> Column:
    """Squared distance from a point to the nearest point of a box."""
    gaps = [F.greatest(box["lo"][i] - x[i], x[i] - box["hi"][i], F.lit(0.0)) for i in range(width)]
    return sum((g * g for g in gaps), F.lit(0.0))


def _far_bound(boxes: DataFrame, width: int, depth: int, k: int) -> DataFrame:
    """Per leaf, the box of its smallest ancestor that holds more than k vectors.

    The farthest corner of that box bounds the k-th distance where the leaf itself is too small.
    """
    node = F.col("leaf")
    choices_lo, choices_hi = [], []
    for _ in range(depth + 1):
        w = W.partitionBy(node)
        enough = F.sum("rows").over(w) > k
        lo = F.array(*[F.min(F.col("lo")[i]).over(w) for i in range(width)])
        hi = F.array(*[F.max(F.col("hi")[i]).over(w) for i in range(width)])
        choices_lo.append(F.when(enough, lo))
        choices_hi.append(F.when(enough, hi))
        node = F.floor(node / FANOUT).cast("long")
    return boxes.select(
        "leaf", F.coalesce(*choices_lo).alias("far_lo"), F.coalesce(*choices_hi).alias("far_hi")
    )


def _visits(own: DataFrame, boxes: DataFrame, leaves: int, width: int, depth: int, k: int) -> DataFrame:
    """(vector, other leaf) pairs whose box is within the vector's reach."""
    x = F.col("x")
    corner = [F.greatest(F.abs(x[i] - F.col("far_lo")[i]), F.abs(x[i] - F.col("far_hi")[i])) for i in range(width)]
    farthest = sum((c * c for c in corner), F.lit(0.0))
    walk = (
        own.select("vid", "x", "reach", "leaf")
        .join(_few(_far_bound(boxes, width, depth, k), leaves), "leaf", "left")
        .withColumn("reach", F.least("reach", F.coalesce(farthest * SLACK, F.lit(float("inf")))))
        .drop("far_lo", "far_hi")
        .withColumnRenamed("leaf", "home")
        .withColumn("node", F.lit(0).cast("long"))
    )
    for level in range(depth):
        at_level = F.floor(F.col("leaf") / FANOUT ** (depth - level - 1)).cast("long")
        children = (
            boxes.groupBy(at_level.alias("child")).agg(
                F.array(*[F.min(F.col("lo")[i]) for i in range(width)]).alias("lo"),
                F.array(*[F.max(F.col("hi")[i]) for i in range(width)]).alias("hi"),
            )
            .groupBy(F.floor(F.col("child") / FANOUT).cast("long").alias("node"))
            .agg(F.collect_list(F.struct("child", "lo", "hi")).alias("children"))
        )
        # the distance test runs inside the array filter: as a join condition it makes the generated
        # method too large to be compiled
        walk = (
            walk.join(_few(children, min(FANOUT**level, leaves)), "node")
            .withColumn("c", F.explode(F.filter(
                "children", lambda c: _near(c, F.col("x"), width) <= F.col("reach") * SLACK
            )))
            .withColumn("node", F.col("c.child"))
            .drop("children", "c")
        )
    return walk.where(F.col("node") != F.col("home")).select("vid", "x", "reach", F.col("node").alias("leaf"))


def _visit_leaves(visits: DataFrame, tree: DataFrame, leaves: int, k: int) -> DataFrame:
    """Search every visited leaf. A leaf with many visitors is repeated over several tasks."""
    load = visits.groupBy("leaf").agg(
        F.ceil(F.count(F.lit(1)) / VISITS_PER_TASK).cast("int").alias("salts")
    )
    visitors = visits.join(_few(load, leaves), "leaf").withColumn(
        "salt", F.pmod(F.xxhash64("vid"), F.col("salts")).cast("int")
    ).drop("salts")
    searched = tree.join(_few(load, leaves), "leaf").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    ).select("leaf", "salt", "vid", "x", "members")
    return (
        visitors.groupBy("leaf", "salt")
        .cogroup(searched.groupBy("leaf", "salt"))
        .applyInPandas(_visited_leaf(k), _HIT)
    )


def nearest_vectors(vectors: DataFrame, width: int, k: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Per vector: x, members and ``near``, the (squared distance, key, vector) of its k+1 nearest rows.

    The list includes the vector's own rows at distance zero.
    """
    tree, depth = _grow_leaves(vectors, width, leaf_rows)
    # by the leaves to search, not by their bytes
    tasks = max(1, -(-tree.count() // (LEAVES_PER_TASK * leaf_rows)))
    own = tree.repartition(tasks, "leaf").groupBy("leaf").applyInPandas(_own_leaf(k), _OWN)
    if depth:
        own = stable(own)
        boxes = stable(_boxes(tree, width))
        leaves = boxes.count()
        visits = stable(_visits(own, boxes, leaves, width, depth, k))
        elsewhere = _visit_leaves(visits, tree, leaves, k)
        found = (
            own.select("vid", F.explode("hits").alias("h")).select("vid", "h.*")
            .unionByName(elsewhere)
            .withColumn("_n", F.row_number().over(W.partitionBy("vid").orderBy("d2", "other")))
            .where(F.col("_n") <= k)  # each task keeps k per vector before the shuffle
            .groupBy("vid")
            .agg(F.sort_array(F.collect_list(F.struct("d2", "other", "other_x", "other_members"))).alias("hits"))
        )
        own = own.drop("hits").join(found, "vid", "left")
    itself = F.transform("members", lambda m: F.struct(
        F.lit(0.0).alias("d2"), m.alias("key"), F.col("x").alias("x")))
    others = F.flatten(F.transform(
        F.coalesce("hits", F.expr("array()")) if depth else F.col("hits"),
        lambda h: F.transform(h["other_members"], lambda m: F.struct(
            h["d2"].alias("d2"), m.alias("key"), h["other_x"].alias("x"))),
    ))
    return own.select(
        "vid", "x", "members", F.slice(F.sort_array(F.concat(itself, others)), 1, k + 1).alias("near")
    )


def nearest_neighbours(
    points: DataFrame,
    key: str,
    features: list[str],
    k: int = 5,
    leaf_rows: int = LEAF_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per row: its vector ``x`` and ``neighbours``, up to k (squared distance, key, vector), nearest first.

    Ties are broken by the smaller key. Fewer than k come back only where the table has fewer rows.
    ``keep`` names further columns to carry along. The points are read several times: pass a
    checkpointed table.
    """
    keep = keep or []
    points = points.select(key, *keep, *[F.col(c).cast("double").alias(c) for c in features])
    if not points.where(F.greatest(*[F.col(c).isNull().cast("int") for c in features], F.lit(0)) == 1).isEmpty():
        raise ValueError("features must not be NULL: such rows have no neighbours")
    vectors = stable(distinct_vectors(points, key, features, k + 1))
    near = nearest_vectors(vectors, len(features), k, leaf_rows)
    lists = near.select(*[F.col("x")[i].alias(c) for i, c in enumerate(features)], "x", "near")
    rows = salted_join(points, lists, features, F.col(key), "inner")
    without_itself = F.filter("near", lambda n: n["key"] != F.col(key))
    return rows.select(key, *keep, "x", F.slice(without_itself, 1, k).alias("neighbours"))


def neighbour_pairs(neighbours: DataFrame, key: str) -> DataFrame:
    """One row per (row, rank): the neighbour's key and its distance."""
    return neighbours.select(key, F.posexplode("neighbours").alias("_pos", "n")).select(
        key,
        (F.col("_pos") + 1).alias("rank"),
        F.col("n.key").alias("neighbour"),
        F.sqrt("n.d2").alias("distance"),
    )

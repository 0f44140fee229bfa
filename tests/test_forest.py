import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.plans import forest as f

FEATURES = ["a", "b", "c"]


def points(n, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[:, 2] = rng.integers(0, 4, n)  # few values
    y = np.sin(3 * x[:, 0]) + x[:, 1] * (x[:, 2] > 1) + 0.1 * rng.normal(size=n)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = points(1500)
    rows = [(str(i), *map(float, v), float(t), int(t > 0.4)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_key string, a double, b double, c double, y double, z int").repartition(5).persist()


def plain(x, y, w):
    """The same splits by recursion over one node at a time."""
    if y.min() == y.max():
        return float(y[0])
    best = None
    for j in range(x.shape[1]):
        for v in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= v
            s, t = (w * y)[left].sum(), (w * y)[~left].sum()
            gain = s * s / w[left].sum() + t * t / w[~left].sum()
            if best is None or gain > best[0] * (1 + 1e-9):
                best = gain, j, v
    if best is None:
        return float((w * y).sum() / w.sum())
    _, j, v = best
    upper = x[x[:, j] > v, j].min()
    left = x[:, j] <= v
    return j, v + (upper - v) / 2, plain(x[left], y[left], w[left]), plain(x[~left], y[~left], w[~left])


def follow(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


def test_levels_at_once_equal_recursion():
    for n, seed in ((1, 1), (2, 2), (60, 3), (150, 4)):
        x, y = points(n, seed)
        w = np.random.default_rng(seed).integers(1, 4, n).astype(float)
        tree = f.grow_to_end(x, y, w, 3, np.random.default_rng(0))
        fresh, _ = points(200, seed + 50)
        want = plain(x, y, w)
        assert tree.predict(fresh).tolist() == [follow(want, r) for r in fresh]
        assert np.array_equal(tree.predict(x), y)


def test_equal_features_missing_values_and_long_chains():
    rng = np.random.default_rng(0)
    x = np.array([[0.0], [0.0], [1.0], [-np.inf], [np.inf]])
    tree = f.grow_to_end(x, np.array([1.0, 3.0, 5.0, 7.0, 9.0]), np.array([1.0, 3.0, 1.0, 1.0, 1.0]), 1, rng)
    assert tree.predict(x).tolist() == [2.5, 2.5, 5.0, 7.0, 9.0]
    # labels that grow so fast that each split takes one row off: as deep as the rows
    n = 300
    x, y = np.arange(n, dtype=float)[:, None], 2.0 ** np.arange(n)
    tree = f.grow_to_end(x, y, np.ones(n), 1, rng)
    assert np.array_equal(tree.predict(x), y) and len(tree.feature) == 2 * n - 1


@pytest.mark.parametrize("grow_rows", [100_000, 150])
def test_trees_are_grown_to_the_end(table, grow_rows):
    """Each tree gives the label of every row it drew, whether nodes are split over all rows or in one task."""
    forest = f.fit_forest(table, FEATURES, "y", "row_key", 4, 3, grow_rows=grow_rows)
    assert (forest.levels > 2) == (grow_rows == 150)
    got = f.bag_check(forest, table, "y", "row_key").collect()
    want = table.select("row_key", "y", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("tree"))
    want = want.withColumn("w", f.bag_weight("row_key", F.col("tree"), 42)).where("w > 0").groupBy("tree").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("w").alias("draws"), F.sum(F.col("w") * F.col("y")).alias("total")).collect()
    assert {r["tree"]: (r["rows"], r["draws"], 0) for r in want} == {r["tree"]: (r["rows"], r["draws"], r["different"]) for r in got}
    for a, b in zip(sorted(got), sorted(want)):
        assert a["prediction_sum"] == pytest.approx(b["total"], abs=1e-5)
        assert a["draws"] == pytest.approx(1500, rel=0.1) and a["rows"] == pytest.approx(1500 * (1 - np.exp(-1)), rel=0.1)


def test_a_forest_predicts_unseen_rows_and_is_saved(spark, table, tmp_path):
    x, y = points(800, 99)
    rows = [(str(i), *map(float, v), float(t), int(t > 0.4)) for i, (v, t) in enumerate(zip(x, y))]
    fresh = spark.createDataFrame(rows, table.schema)
    forest = f.fit_forest(table, FEATURES, "z", "row_key", 15, 1, grow_rows=400)
    forest.save(str(tmp_path / "forest"))
    loaded = f.Forest.load(spark, str(tmp_path / "forest"))
    got = {r["row_key"]: r["prediction"] for r in loaded.predict(fresh, "row_key").collect()}
    assert got == {r["row_key"]: r["prediction"] for r in forest.predict(fresh.repartition(3), "row_key").collect()}
    p = np.array([got[str(i)] for i in range(800)])
    assert ((p > 0.5) == (y > 0.4)).mean() > 0.85 and p.min() >= 0 and p.max() <= 1


def test_partitions_do_not_change_the_trees(table):
    first, again = (f.fit_forest(t, FEATURES, "y", "row_key", 2, 2, grow_rows=10_000) for t in (table, table.repartition(11)))
    assert first.subtrees.exceptAll(again.subtrees).isEmpty()


def test_empty_constant_and_repeated_rows(spark):
    schema = "row_key string, a double, y double"
    empty = f.fit_forest(spark.createDataFrame([], schema), ["a"], "y", "row_key", 2, 1)
    one = spark.createDataFrame([("0", 1.0, 2.0)], schema)
    assert empty.tree_predictions(one, "row_key").count() == 0
    same = spark.createDataFrame([(str(i % 20), 1.0, float(i % 2)) for i in range(60)] + [("x", None, None)], schema)
    forest = f.fit_forest(same, ["a"], "y", "row_key", 3, 1, grow_rows=10)
    assert forest.levels == 1 and forest.subtrees.isEmpty()  # large and not divisible: leaves
    got = forest.predict(one.unionByName(spark.createDataFrame([("n", None, None)], schema)), "row_key").collect()
    assert {r["row_key"] for r in got} == {"0", "n"} and all(0 < r["prediction"] < 1 for r in got)


def test_rows_are_dealt_by_their_work_and_hashed_once(table, monkeypatch):
    monkeypatch.setattr(f, "SPREAD_ROWS", 1000)
    one = table.coalesce(1)
    assert f._dealt(one, 4).rdd.getNumPartitions() == 6
    rows = one.withColumn("tree", F.lit(2))
    drawn = f.with_drawn(rows, "row_key", 42)
    want = rows.withColumn("w", f.bag_weight("row_key", F.col("tree"), 42)).where("w > 0")
    assert drawn.exceptAll(want).isEmpty() and want.exceptAll(drawn).isEmpty() and not want.isEmpty()


def test_joined_and_sent_nodes_give_the_same_trees(table, monkeypatch):
    found = []
    for nodes in (20_000, -1):
        monkeypatch.setattr(f, "BROADCAST_NODES", nodes)
        forest = f.fit_forest(table, FEATURES, "y", "row_key", 2, 2, grow_rows=400)
        found.append(sorted(map(tuple, forest.subtrees.collect())) + sorted(map(tuple, forest.splits.collect())))
    assert found[0] == found[1]


def test_bins_are_found_by_halving(spark):
    """As many cuts as a value is above, for every number of cuts and values at, between and outside the cuts."""
    rows = spark.createDataFrame([(x / 2, [float(c) for c in range(n)]) for n in range(f.NODE_BINS + 1) for x in (-1, 0, 1, n - 1, 2 * n - 2, 2 * n)], "x double, cuts array<double>")
    wrong = rows.where(f._bin(F.col("x"), F.col("cuts")) != F.size(F.filter("cuts", lambda c: c < F.col("x"))))
    assert wrong.isEmpty() and rows.select(F.max(f._bin(F.col("x"), F.col("cuts")))).first()[0] == f.NODE_BINS

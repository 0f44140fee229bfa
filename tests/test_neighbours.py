import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.functions.columns import with_features
from perigee.operators import balance
from perigee.operators import neighbours as nb
from perigee.operators.splits import stratified_split
from perigee.schema import CLF_FEATURES


def brute(ids, x, k):
    out = {}
    for i, row in enumerate(x):
        d2 = np.zeros(len(x))
        for j in range(x.shape[1]):
            d2 += (row[j] - x[:, j]) ** 2
        order = np.lexsort((ids, d2))
        out[ids[i]] = [(ids[j], d2[j]) for j in order if j != i][:k]
    return out


def compare(spark, ids, x, k, leaf_rows):
    names = [f"f{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame(
        [(int(i), *map(float, row)) for i, row in zip(ids, x)], ["id", *names]).repartition(3)
    got = {
        r["id"]: [(n["key"], n["d2"]) for n in r["neighbours"]]
        for r in nb.nearest_neighbours(df, "id", names, k, leaf_rows).collect()
    }
    want = brute(ids, x, k)
    assert got.keys() == want.keys()
    for i in want:
        assert [n for n, _ in got[i]] == [n for n, _ in want[i]], i
        assert [d for _, d in got[i]] == pytest.approx([d for _, d in want[i]])


def test_one_leaf(spark):
    rng = np.random.default_rng(0)
    compare(spark, np.arange(60), rng.normal(size=(60, 3)), 5, 1000)


def test_fewer_rows_than_neighbours(spark):
    compare(spark, np.arange(3), np.array([[0.0, 1.0], [2.0, 1.0], [0.5, 0.5]]), 5, 1000)


def test_tree_with_copies_clusters_and_outliers(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([
        np.tile([[1.0, 2.0, 3.0]], (150, 1)),                 # a third of the rows are the same vector
        rng.normal(0, 1e-3, (150, 3)),                        # a tight cluster
        rng.normal(0, 5, (120, 3)),
        rng.integers(0, 3, (25, 3)).astype(float),            # lattice ties
        np.array([[1e6, 0.0, 0.0], [0.0, -1e6, 5.0]]),        # far outliers
    ])
    ids = rng.permutation(len(x))
    compare(spark, ids, x, 5, 20)


def test_ties_in_the_widest_feature(spark):
    rng = np.random.default_rng(2)
    x = np.stack([np.repeat([0.0, 100.0], 100), rng.random(200), rng.random(200)], axis=1)
    compare(spark, np.arange(200), x, 4, 12)


def test_crowded_leaf_is_repeated_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(nb, "VISITS_PER_TASK", 7)
    rng = np.random.default_rng(4)
    compare(spark, np.arange(180), rng.random((180, 2)), 5, 15)


@pytest.fixture(scope="module")
def train(approaches):
    return with_features(stratified_split(approaches)).where("split = 'train'").persist()


@pytest.mark.parametrize("scale_first", [False, True])
def test_smote_evens_classes_between_parents(train, scale_first):
    grown = balance.smote(train, CLF_FEATURES, scale_first=scale_first)
    counts = {r["hazardous"]: r["count"] for r in grown.groupBy("hazardous").count().collect()}
    assert counts[0] == counts[1]
    assert grown.select("row_key").distinct().count() == grown.count()
    new = balance.synthetic_rows(train, CLF_FEATURES, scale_first=scale_first).toPandas()
    parents = train.select("approach_id", *CLF_FEATURES).toPandas().set_index("approach_id")
    a, b = parents.loc[new["base_key"]].to_numpy(), parents.loc[new["neighbour_key"]].to_numpy()
    mine = new[CLF_FEATURES].to_numpy()
    assert (mine >= np.minimum(a, b) - 1e-9).all() and (mine <= np.maximum(a, b) + 1e-9).all()
    per_base = new.groupby("base_key").size()
    assert per_base.max() - per_base.min() <= 1 and len(per_base) == train.where("hazardous").count()


def test_smote_grows_whichever_class_is_smaller(train):
    turned = train.withColumn("hazardous", ~F.col("hazardous"))
    plain = {r["hazardous"]: r["count"] for r in balance.smote(train, CLF_FEATURES).groupBy("hazardous").count().collect()}
    counts = {r["hazardous"]: r["count"] for r in balance.smote(turned, CLF_FEATURES).groupBy("hazardous").count().collect()}
    assert counts == plain and counts[0] == counts[1]


def test_smote_of_very_few_rows(spark):
    rows = spark.range(3503).select(F.col("id").alias("approach_id"), (F.col("id") < 3).alias("hazardous"), F.sqrt("id").alias("f"))
    new = balance.synthetic_rows(rows, ["f"], k=2)
    assert new.count() == new.select("row_key").distinct().count() == 3500 - 3
    assert {r["copy"] for r in new.groupBy("base_key").agg(F.max("copy").alias("copy")).collect()} <= {1165, 1166}


def test_class_weights(approaches):
    rows = {r["label"]: r for r in balance.class_weights(approaches).collect()}
    n = rows[0]["rows"] + rows[1]["rows"]
    for label in (0, 1):
        assert rows[label]["weight"] == pytest.approx(n / (2 * rows[label]["rows"]))


def test_one_varying_feature_gives_small_leaves(spark):
    n = 5000
    df = spark.range(n).select(F.col("id").alias("vid"), F.array(F.lit(1.0), F.sqrt("id"), F.lit(2.0)).alias("x"), F.array("id").alias("members"))
    tree, depth = nb._grow_leaves(df, 3, 20)
    sizes = [r["count"] for r in tree.groupBy("leaf").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 20 and depth >= 2
    rng = np.random.default_rng(7)
    x = np.zeros((400, 3))
    x[:, 1] = rng.normal(size=400)
    compare(spark, np.arange(400), x, 5, 16)


def test_missing_features_are_refused(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "id long, f double")
    with pytest.raises(ValueError, match="NULL"):
        nb.nearest_neighbours(df, "id", ["f"], 1)

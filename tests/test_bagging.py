"""Forests of many lanes against a plain single-machine tree, and whatever partitions and node sizes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.plans import bagging, training
from perigee.plans.bagging import Plan, fit_forests
from perigee.plans.boosting import Block, Lane, f1_weighted, r2
from perigee.plans.forest import poisson_marks

LANES = [Lane(f, 4, 5, 0.25, held=f) for f in range(3)]
COLUMNS = ["a", "b", "c", "d"]


def label_of(loss):
    return F.col("y") if loss == "squared" else (F.col("y") > 1.5).cast("double")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4)).clip(-2.5, 2.5).round(1)
    y = x[:, 0] ** 2 + x[:, 1] * (x[:, 2] > 0) + rng.normal(0, 0.2, 3000)
    rows = [(f"k{i}", *map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "row_key string, a double, b double, c double, d double, y double, part int").persist()


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_trees_do_not_depend_on_partitions_and_node_sizes(table, monkeypatch, loss):
    df, found = table.withColumn("label", label_of(loss)), []
    for part_rows, grow_rows, held in ((10_000, 10_000, 10_000), (500, 150, 10_000), (300, 1, 2)):
        monkeypatch.setattr(bagging, "PART_ROWS", part_rows)
        monkeypatch.setattr(bagging, "HELD_NODES", held)
        found.append(fit_forests(df, COLUMNS, LANES, loss, per_node=2, grow_rows=grow_rows))
    for other in found[1:]:
        for number, trees in found[0].trees.items():
            for tree, same in zip(trees, other.trees[number], strict=True):
                assert tree.packed() == same.packed()
            assert other.scores[number] == pytest.approx(found[0].scores[number])
    measure = r2 if loss == "squared" else f1_weighted
    assert all(measure(s) > 0.6 for s in found[0].scores.values())


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_a_tree_is_that_of_plain_recursion(loss):
    """Over all bins, one cut after the other: least squared error, or least weighted Gini impurity."""
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 8, (400, 3)).astype(np.uint8)
    y = bins[:, 0] + 2.0 * (bins[:, 1] > 3) + rng.integers(0, 3, 400)
    y = y if loss == "squared" else (y > 6).astype(float)
    weights = (0.7, 1.9)
    plan = Plan([Lane(0, 1, 4, 1.0, held=1)], [weights], loss, 3, 8, 3, 7, np.array(poisson_marks(), np.uint64))
    block = Block(rng.integers(0, 2**63, 400).astype(np.uint64), bins, y, (np.arange(400) % 5 == 0).astype(np.int32))
    rows, w = plan.drawn(block, 0, 0)
    assert (block.part[rows] == 0).all() and 0.5 < len(rows) / 320 < 0.75 and 0.8 < w.sum() / 320 < 1.2
    tree = bagging.linked(bagging.grow(plan, 0, 0, 0, np.ascontiguousarray(bins[rows].T), plan.target(y)[rows], w))
    mass, expected = w * (np.where(y[rows] == 1, weights[1], weights[0]) if loss == "logistic" else 1.0), np.zeros(len(rows))

    def error(at):
        mean = np.average(y[rows[at]], weights=mass[at])
        return (mass[at] * (y[rows[at]] - mean) ** 2).sum()

    def split(at, level):
        expected[at] = np.average(y[rows[at]], weights=mass[at])
        best = error(at) - 1e-9, None
        for f in range(3) if level < 4 else ():
            for cut in range(8):
                low = bins[rows[at], f] <= cut
                if 0 < low.sum() < len(at) and (e := error(at[low]) + error(at[~low])) < best[0] - 1e-9:
                    best = e, low
        if best[1] is not None:
            split(at[best[1]], level + 1)
            split(at[~best[1]], level + 1)

    split(np.arange(len(rows)), 0)
    assert tree.predict(bins[rows]) == pytest.approx(expected)


def test_cuts_are_between_values_and_none_is_left_over():
    few = np.repeat([1.0, 2.0, 4.0], [1, 997, 2])
    assert bagging.cuts_between(few, 64) == [1.5, 3.0] and bagging.cuts_between(few[:1], 64) == []
    even = bagging.cuts_between(np.arange(10_000.0), 64)
    assert len(even) == 63 and np.diff(even) == pytest.approx(np.full(62, 156.25), abs=1.01)
    # one frequent value passes most shares, the rare ones after it are told apart
    frequent = np.concatenate([np.zeros(9_000), np.arange(1.0, 101.0)])
    assert bagging.cuts_between(frequent, 64)[:3] == [0.5, 1.5, 2.5] and len(bagging.cuts_between(frequent, 64)) <= 63


def test_features_are_tried_by_node():
    plan = Plan([Lane(0, 1, 4, 1.0), Lane(1, 1, 4, 1.0)], [(1.0, 1.0)] * 2, "logistic", 7, 64, 3, 42, np.array(poisson_marks(), np.uint64))
    tried = plan.tried(0, 0, np.arange(7000))
    assert (tried.sum(axis=0) == 3).all() and tried.mean(axis=1) == pytest.approx(np.full(7, 3 / 7), abs=0.03)
    assert (tried[:, 5:6] == plan.tried(0, 0, np.array([5]))).all() and (tried != plan.tried(1, 0, np.arange(7000))).any()


def test_missing_values_are_errors(table):
    with pytest.raises(ValueError, match="2 rows have missing"):
        fit_forests(table.withColumn("label", F.when(~F.col("row_key").isin("k1", "k2"), F.col("y"))), COLUMNS, LANES)


@pytest.mark.parametrize("task, name", [("clf", "RandomForestClassifier"), ("reg", "RandomForestRegressor")])
def test_folds_of_forests_are_fitted_in_one_pass(table, monkeypatch, task, name):
    """No fit for each fold; scores near those of MLlib's forests on the same folds."""
    names = [*(training.features_of(task))]
    df = table.withColumn("label", label_of("squared" if task == "reg" else "logistic")).withColumns(
        {c: F.col(COLUMNS[i]) if i < 4 else F.col("a") for i, c in enumerate(names)})
    settings = training.Settings(cv_forest_trees=10, forest_depth=6)
    alone = training.cross_validate(task, df, [name], settings, k=3, resample=lambda kept, left_out: (kept, left_out))
    plain = {r["fold"]: r["score"] for r in alone.collect()}

    def one_by_one(*_):
        raise AssertionError("a fold was fitted by itself")

    monkeypatch.setattr(training, "fit", one_by_one)
    lanes = {r["fold"]: r["score"] for r in training.cross_validate(task, df, [name], settings, k=3).collect()}
    assert lanes.keys() == plain.keys() and all(abs(lanes[f] - plain[f]) < 0.03 for f in lanes)


@pytest.mark.parametrize("task, name", [("clf", "RandomForestClassifier"), ("reg", "RandomForestRegressor")])
def test_baseline_forests_are_lanes_as_good_as_those_of_mllib(table, tmp_path, task, name):
    """Metrics near those of MLlib's forest of the same settings; importances name the same features; saved and loaded."""
    names = training.features_of(task)
    df = table.withColumn("label", label_of("squared" if task == "reg" else "logistic")).withColumns(
        {c: F.col(COLUMNS[i]) if i < 4 else F.lit(1.0) for i, c in enumerate(names)})
    settings = training.Settings(forest_trees=10, forest_depth=6)
    model, weighted = training.fit(name, task, df, settings), training.training_rows(df, task)
    plain = training.estimator(name, 3000, settings).fit(weighted)
    metric = "f1_weighted" if task == "clf" else "r2"
    scores = [training.evaluate(m, df, task)[metric] for m in (model, plain)]
    assert type(model.stages[-1]).__name__ == "BaggedModel" and abs(scores[0] - scores[1]) < 0.03
    mine, theirs = (m.stages[-1].featureImportances.toArray() for m in (model, plain))
    assert mine.sum() == pytest.approx(1) and np.abs(mine - theirs).max() < 0.1 and (mine[4:] == 0).all()
    model.write().overwrite().save(str(tmp_path / "m"))
    again = training.predictions(training.PipelineModel.load(str(tmp_path / "m")), df, task)
    assert again.exceptAll(training.predictions(model, df, task)).isEmpty()

"""Boosting of many lanes against a plain single-machine boosting, and between its two ways of dealing the work."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from perigee.operators.metrics import classification_metrics, regression_metrics
from perigee.operators.splits import kfold
from perigee.plans import boosting, tuning
from perigee.plans.boosting import Block, Lane, Round, Trees, best_splits, bin_cuts, f1_weighted, fit_lanes, grow, r2, rmse
from perigee.plans.training import Settings, cross_validate
from perigee.schema import REG_FEATURES

LANES = [Lane(0, 4, 3, 0.3, 2, 0.8), Lane(1, 2, 2, 0.1, 20), Lane(2, 5, 1, 0.2, 5, 0.6), Lane(3, 1, 4, 1.0, 400)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = x[:, 0] ** 2 + x[:, 1] + rng.normal(0, 0.1, 600)
    rows = [(i, *map(float, r), float(v), int(i % 5 == 0)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "row_key long, a double, b double, c double, label double, part int").persist()


def plain_boosting(x, y, cuts, rounds, depth, rate, least, loss="squared"):
    """Margins after boosting with recursive trees over the cuts, one candidate after the other."""
    margin = np.full(len(y), y.mean() if loss == "squared" else np.log(y.mean() / (1 - y.mean())))

    def tree(rows, target, curve, level):
        best = None
        if level < depth and len(rows) >= least:
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    low = x[rows, f] <= cut
                    if 0 < low.sum() < len(rows):
                        error = sum(((target[r] - target[r].mean()) ** 2).sum() for r in (rows[low], rows[~low]))
                        if best is None or error < best[0] - 1e-9:
                            best = error, f, cut
            if best and best[0] >= ((target[rows] - target[rows].mean()) ** 2).sum() - 1e-9:
                best = None
        if best is None:
            step[rows] = target[rows].sum() / curve[rows].sum()
        else:
            low = x[rows, best[1]] <= best[2]
            tree(rows[low], target, curve, level + 1)
            tree(rows[~low], target, curve, level + 1)

    for _ in range(rounds):
        step = np.zeros(len(y))
        p = 1 / (1 + np.exp(-margin))
        tree(np.arange(len(y)), *((y - margin, np.ones(len(y))) if loss == "squared" else (y - p, p * (1 - p))), 0)
        margin = margin + rate * step
    return margin


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_margins_are_those_of_plain_boosting(spark, table, loss):
    df = table if loss == "squared" else table.withColumn("label", (F.col("label") > 1).cast("double"))
    model = fit_lanes(df, ["a", "b", "c"], [Lane(0, 6, 3, 0.3, 10, held=9)], loss, bins=12).model(0)
    rows = model.transform(df).orderBy("row_key").collect()
    x, y = np.array([(r["a"], r["b"], r["c"]) for r in rows]), np.array([r["label"] for r in rows])
    want = plain_boosting(x, y, bin_cuts(df, ["a", "b", "c"], 12), 6, 3, 0.3, 10, loss)
    got = np.array([r["prediction"] if loss == "squared" else np.log(r["score"] / (1 - r["score"])) for r in rows])
    assert np.abs(got - want).max() < 1e-5


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_dealt_rows_and_dealt_lanes_give_the_same_trees(table, loss):
    df = table if loss == "squared" else table.withColumn("label", (F.col("label") > 1).cast("double"))
    lanes = fit_lanes(df.repartition(2), ["a", "b", "c"], LANES, loss, bins=16)
    rows = fit_lanes(df.repartition(5), ["a", "b", "c"], LANES, loss, bins=16, local_bytes=0)
    assert [lanes.model(i) for i in range(4)] == [rows.model(i) for i in range(4)]
    for i, s in lanes.scores().items():
        assert rows.scores()[i] == pytest.approx(s)
    assert np.frombuffer(lanes.model(3).feature, np.int8)[0] >= 0
    assert (np.frombuffer(lanes.model(3).feature, np.int8)[1:3] == -1).any()  # of 480 rows, 400 are on one side at most


def test_scores_are_those_of_the_held_rows(table):
    fits = fit_lanes(table, ["a", "b", "c"], LANES[:1], bins=16)
    told = regression_metrics(fits.model(0).transform(table.where("part = 1"))).first()
    assert rmse(fits.scores()[0]) == pytest.approx(told["rmse_log"]) and r2(fits.scores()[0]) == pytest.approx(told["r2"])
    df = table.withColumn("label", (F.col("label") > 1).cast("double"))
    fits = fit_lanes(df, ["a", "b", "c"], LANES[:1], "logistic", bins=16)
    pred = fits.model(0).transform(df.where("part = 1")).select(F.col("label").cast("int"), F.col("prediction").cast("int"), "score")
    assert f1_weighted(fits.scores()[0]) == pytest.approx(classification_metrics(pred).first()["f1_weighted"])


def test_least_split_and_subsample():
    rng = np.random.default_rng(1)
    block = Block(rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(0, 32, (5000, 4)).astype(np.uint8), rng.normal(size=5000), np.zeros(5000, np.int32))
    lane = Lane(0, 3, 6, 0.5, 300, 0.7)
    init, _, trees = grow(block, lane, "squared", 32)
    assert init == pytest.approx(block.label.mean(), abs=1e-6)
    for number in range(3):
        for level in range(6):
            node = trees.node(number, block.bins, level)
            for i in np.unique(node):
                if trees.feature[number, i] >= 0 and i >= (1 << level) - 1:
                    assert (node == i).sum() >= 300  # a subsample of at least 300 rows was there
    other = grow(block, Lane(0, 3, 6, 0.5, 300, 1.0), "squared", 32)[2]
    assert (other.cut != trees.cut).any()
    assert isinstance(trees, Trees)


def test_constant_empty_and_tiny_tables(spark):
    schema = "row_key long, a double, label double, part int"
    flat = fit_lanes(spark.createDataFrame([(i, 1.0, 2.5, 0) for i in range(5)], schema), ["a"], [Lane(0, 3, 2, 0.5)])
    assert {r["prediction"] for r in flat.model(0).transform(spark.createDataFrame([(9, 7.0, 0.0, 0)], schema)).collect()} == {2.5}
    assert np.isnan(rmse(flat.scores()[0]))
    none = fit_lanes(spark.createDataFrame([(1, 1.0, 2.5, 1)], schema), ["a"], [Lane(0, 1, 1, 0.5)])
    assert none.scores()[0][0] == 1


def test_folds_in_one_pass(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, len(REG_FEATURES)))
    rows = [(f"k{i}", *map(float, r), float(r[0] * 2 + r[1] ** 2)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_key string, " + ", ".join(f"{c} double" for c in REG_FEATURES) + ", label double")
    s = Settings(boosted_trees=8)
    scores = {r["fold"]: r["score"] for r in cross_validate("reg", df, ["GradientBoostingRegressor"], s, k=4).collect()}
    folded = kfold(df, 4, "row_key").persist()
    assert set(scores) == {0, 1, 2, 3}
    for fold in (0, 3):  # each fold alone
        lane = [Lane(fold, 8, s.boosted_depth, s.learning_rate, held=fold)]
        model = fit_lanes(folded, REG_FEATURES, lane, part="fold", bins=s.max_bins).model(fold)
        assert regression_metrics(model.transform(folded.where(F.col("fold") == fold))).first()["r2"] == pytest.approx(scores[fold])


def test_search_finds_and_refits(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, len(REG_FEATURES)))
    rows = [(f"k{i}", *map(float, r), float(r[0] * 2 + r[1] ** 2)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_key string, " + ", ".join(f"{c} double" for c in REG_FEATURES) + ", label double")
    train, val = df.where("row_key < 'k25'"), df.where("row_key >= 'k25'")
    space = [tuning.Param("n_estimators", "int", 3, 12), tuning.Param("max_depth", "int", 1, 4), *tuning.BOOSTED_SPACE[2:]]
    trials, fits = tuning.boosted_search("reg", train, val, space, n=6)
    found = trials.orderBy("trial").collect()
    assert [r["trial"] for r in found] == list(range(6))
    for r in found[:2]:
        model = fits.model(r["trial"])
        assert model.lane.rounds == r["n_estimators"] and model.lane.subsample == r["subsample"]
        assert regression_metrics(model.transform(val)).first()["rmse_log"] == pytest.approx(r["value"])
    best = tuning.best_trial(trials, "reg")
    assert tuning.boosted_refit("reg", df, best).lane.depth == best["max_depth"]


def test_sums_below_a_split_are_those_over_all_rows():
    rng = np.random.default_rng(3)
    block = Block(rng.integers(0, 2**63, 400).astype(np.uint64), rng.integers(0, 8, (400, 3)).astype(np.uint8), rng.normal(size=400), np.zeros(400, np.int32))
    lane, trees, node, sums = Lane(0, 1, 4, 0.1, 30, 0.8), Trees(Lane(0, 1, 4, 0.1)), np.zeros(400, np.int64), None
    for loss in ("squared", "logistic"):
        node[:] = 0
        drawn = Round(block, lane, 0, np.zeros(400), loss, 8)
        for level in range(4):
            whole = drawn.histogram(node, level)
            if level:
                assert np.array_equal(drawn.below(node, level, sums, trees.feature[0, here], trees.cut[0, here]), whole)
            sums, here = whole, slice((1 << level) - 1, (2 << level) - 1)
            trees.feature[0, here], trees.cut[0, here], trees.value[0, here] = best_splits(sums, lane, False)
            node = trees.step(0, block.bins, node)


def test_splits_found_in_the_driver_or_in_tasks_are_the_same(table, monkeypatch):
    found = []
    for cells in (10**6, 0):
        monkeypatch.setattr(boosting, "DRIVER_CELLS", cells)
        rows = fit_lanes(table, ["a", "b", "c"], LANES[:2], bins=12, local_bytes=0).table.orderBy("lane").collect()
        found.append([(r["lane"], bytes(r["feature"]), bytes(r["cut"]), r["init"]) for r in rows])
    assert found[0] == found[1]


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_a_boosted_model_in_a_pipeline_is_saved(table, tmp_path, loss):
    df = table if loss == "squared" else table.withColumn("label", (F.col("label") > 1).cast("double"))
    fitted = fit_lanes(df, ["a", "b", "c"], [Lane(0, 4, 3, 0.3, held=9)], loss, bins=12).model(0)
    model = PipelineModel([VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), boosting.BoostedModel(fitted)])
    model.write().overwrite().save(str(tmp_path / "m"))
    want = sorted(fitted.transform(df).select("row_key", "prediction").collect())
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        assert sorted(m.transform(df).select("row_key", "prediction").collect()) == want


@pytest.mark.parametrize("cells", [0, 900, 10**9])
def test_sums_sent_and_sums_grouped_give_the_same_trees(table, monkeypatch, cells):
    """Levels in groups, the first ones sent to the driver, or all: each lane's trees are those of one task."""
    lanes = fit_lanes(table, ["a", "b", "c"], LANES, bins=16)
    monkeypatch.setattr(boosting, "DRIVER_CELLS", cells)
    rows = fit_lanes(table.repartition(3), ["a", "b", "c"], LANES, bins=16, local_bytes=0)
    assert [rows.model(i) for i in range(4)] == [lanes.model(i) for i in range(4)]


def test_a_round_has_one_job_per_level_above_the_leaves(spark, table):
    """Values of the last level follow from the splits above, without a pass over the rows."""
    jobs = {}
    for rounds in (1, 5):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "")
        fit_lanes(table, ["a", "b", "c"], [Lane(0, rounds, 3, 0.3)], bins=16, local_bytes=0)
        jobs[rounds] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{rounds}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[5] - jobs[1] == 4 * 3


def test_each_feature_has_quantiles_of_its_own(spark):
    rows = spark.createDataFrame([(float(i), None if i % 2 else float(-i), None) for i in range(100)], "a double, b double, c double")
    assert boosting.quantiles(rows.repartition(7), ["a", "b", "c"], [0.1, 0.5]) == [[9.0, 49.0], [-90.0, -50.0], []]


def test_quantiles_of_many_values_are_near(spark, monkeypatch):
    """A task that has more values than it may tell of moves a quantile by at most such a share of the rows."""
    monkeypatch.setattr(boosting, "RANKED_VALUES", 100)
    rows = spark.range(20_000).selectExpr("cast(id * 7919 % 20000 AS double) AS a").repartition(6)
    found = boosting.quantiles(rows, ["a"], [i / 10 for i in range(1, 10)])[0]
    assert np.abs(np.array(found) - np.arange(1, 10) * 2000).max() <= 200

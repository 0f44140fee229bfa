import json

import pytest
from pyspark.sql import functions as F

from perigee.operators.metrics import cv_summary
from perigee.plans import card, export, training, tuning
from perigee.plans.preprocess import prepare
from perigee.plans.scoring import Scorer, score_valid
from perigee.schema import CLF_FEATURES, REG_FEATURES, SCORING_INPUTS
from perigee.session import fresh_path
from perigee.sources.tables import long_metrics

SMALL = training.Settings(
    forest_trees=5, cv_forest_trees=3, forest_depth=4, boosted_trees=3, max_iter=20, fourier_terms=20, kernel_iter=5)
SMOKE = (0.12, 0.27, 48000.0, 22.1, 14500000.0)


@pytest.fixture(scope="module")
def prepared(spark, approaches):
    return prepare(approaches, fresh_path(spark, "splits"))


@pytest.fixture(scope="module")
def trained(prepared):
    return {t: training.train_and_score(t, prepared.load(t, "train"), prepared.load(t, "val"), SMALL) for t in ("clf", "reg")}


@pytest.fixture(scope="module")
def scorer(prepared, trained):
    return Scorer.build(
        trained["clf"].models["RandomForestClassifier"], trained["reg"].models["LinearRegression"],
        prepared.scaler_clf, prepared.scaler_reg)


def test_split_store(prepared, approaches):
    clf = prepared.load("clf", "train")
    counts = {r["label"]: r["count"] for r in clf.groupBy("label").count().collect()}
    assert counts[0.0] == counts[1.0]
    moments = clf.agg(*[F.avg(c).alias(f"m_{c}") for c in CLF_FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in CLF_FEATURES]).first()
    for c in CLF_FEATURES:
        assert moments[f"m_{c}"] == pytest.approx(0, abs=1e-9) and moments[f"s_{c}"] == pytest.approx(1)
    reg = prepared.load("reg", ["train", "val", "test"])
    assert reg.count() == approaches.count() == reg.select("approach_id").distinct().count()
    assert reg.where("log_miss_distance is not null").isEmpty()
    held = prepared.load("clf", ["val", "test"])
    assert held.where("synthetic").isEmpty()
    same = held.select("approach_id", "split").exceptAll(reg.select("approach_id", "split"))
    assert same.isEmpty()


def test_partition_folders_are_pruned(prepared):
    plan = prepared.load("reg", "val")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan.split("PartitionFilters")[1][:200]


@pytest.mark.parametrize("name, overrides", [("RandomForestRegressor", None), ("GradientBoostingRegressor", {"subsamplingRate": 0.5})])
def test_fit_does_not_depend_on_partitions(prepared, monkeypatch, name, overrides):
    monkeypatch.setattr(training, "ROWS_PER_CORE", 100)
    rows, found = prepared.load("reg", "train"), []
    for parts in (2, 8):
        model = training.fit(name, "reg", rows.repartition(parts), SMALL, overrides)
        found.append({r["row_key"]: r["prediction"] for r in training.predictions(model, rows, "reg").collect()})
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_partitions_of_a_fit_are_few(prepared):
    assert [training.fit_partitions(n) for n in (0, 9_000, 100_000, 4_200_000, 7_500_000, 100_000_000)] == [1, 1, 10, 24, 24, 50]
    with training.cached_rows(prepared.load("reg", "train"), "reg") as (rows, n):
        assert rows.rdd.getNumPartitions() == training.fit_partitions(n)


def test_boosted_baselines_are_lanes(trained):
    for task, name in (("clf", "GradientBoostingClassifier"), ("reg", "GradientBoostingRegressor")):
        assert type(trained[task].models[name].stages[-1]).__name__ == "BoostedModel"


def test_baselines(trained):
    for task, names in (("clf", training.CLASSIFIERS), ("reg", training.REGRESSORS)):
        assert [m["model"] for m in trained[task].metrics] == names
    assert all(m["f1_weighted"] > 0.7 and 0.5 < m["auc_roc"] <= 1 for m in trained["clf"].metrics)


def test_kernel_machine_uses_margins(prepared):
    model = training.fit(training.KERNEL_CLASSIFIER, "clf", prepared.load("clf", "train"), SMALL)
    assert training.evaluate(model, prepared.load("clf", "val"), "clf")["auc_roc"] > 0.6


def test_cross_validation_with_oversampled_and_plain_folds(prepared):
    train = prepared.load("clf", "train")
    scores = training.cross_validate("clf", train, ["LogisticRegression"], SMALL, k=3)
    assert scores.count() == 3 and cv_summary(scores).first()["cv_mean"] > 0.6
    inside = training.cross_validate(
        "clf", train.where(~F.col("synthetic")), ["LogisticRegression"], SMALL, k=2,
        resample=training.oversample_inside())
    assert inside.count() == 2 and cv_summary(inside).first()["cv_mean"] > 0.6


def test_search_space_draws(spark):
    draws = tuning.sample_params(spark, tuning.BOOSTED_SPACE).toPandas()
    assert len(draws) == 50
    for p in tuning.BOOSTED_SPACE:
        assert draws[p.name].between(p.low, p.high).all() and draws[p.name].nunique() > 5
    assert draws.equals(tuning.sample_params(spark, tuning.BOOSTED_SPACE).toPandas())
    forest = tuning.sample_params(spark, tuning.FOREST_SPACE).toPandas()
    assert set(forest["max_features"]) == {"sqrt", "log2"}


def test_tuning_refits_boosted_models_and_copies_others(prepared, trained):
    train, val = prepared.load("reg", "train"), prepared.load("reg", "val")
    baseline = trained["reg"].models["LinearRegression"]
    kept = tuning.tune("LinearRegression", "reg", baseline, train, val, SMALL)
    assert kept.model is baseline and kept.params == {}
    space = [tuning.Param("n_estimators", "int", 2, 3), tuning.Param("max_depth", "int", 2, 3), *tuning.BOOSTED_SPACE[2:]]
    tuned = tuning.tune(
        "GradientBoostingRegressor", "reg", baseline, train, val, SMALL, {"GradientBoostingRegressor": space}, n=2)
    best = tuned.trials.agg(F.min("value")).first()[0]
    picked = tuned.trials.where(F.col("value") == best).first()
    assert tuned.params["n_estimators"] == picked["n_estimators"] and tuned.params["random_state"] == 42


def test_scorer_on_the_smoke_row_and_bad_rows(spark, scorer, tmp_path):
    schema = ", ".join(f"{c} double" for c in SCORING_INPUTS)
    df = spark.createDataFrame([SMOKE, (0.0, *SMOKE[1:]), (0.5, 0.2, *SMOKE[2:])], schema)
    scored, refused = score_valid(scorer, df)
    row = scored.first()
    assert scored.count() == 1 and refused.count() == 2
    assert 0 <= row["hazardous_probability"] <= 1 and row["miss_distance_km"] > 0
    assert row["hazardous_predicted"] == (row["hazardous_probability"] > 0.5)
    scorer.save(str(tmp_path / "m"))
    assert Scorer.load(str(tmp_path / "m")).score(df.limit(1)).first() == scorer.score(df.limit(1)).first()


def test_scorer_agrees_with_the_split_store(prepared, trained, scorer, approaches):
    """Raw rows through the scorer give the same probability as the stored, scaled rows."""
    model = trained["clf"].models["RandomForestClassifier"]
    stored = training.predictions(model, prepared.load("clf", "test"), "clf").select("approach_id", F.round("score", 4).alias("p"))
    both = scorer.score(approaches).join(stored, "approach_id")
    assert both.count() == stored.count()
    assert both.where(F.abs(F.col("p") - F.col("hazardous_probability")) > 1e-3).isEmpty()


def test_export_is_complete_and_scores_the_smoke_row(spark, trained, scorer):
    root = fresh_path(spark, "artifacts")
    made = card.model_card(
        spark, ("RandomForestClassifier", scorer.classifier, {}, trained["clf"].metrics[1]),
        ("LinearRegression", scorer.regressor, {}, trained["reg"].metrics[0]), "2024-01-01T00:00:00")
    rows = long_metrics(trained["clf"].table(spark), "clf", "val", training.CLF_METRICS)
    export.export_models(scorer, made, rows, root)
    export.verify_artifacts(spark, root)
    with pytest.raises(FileNotFoundError, match="scaler"):
        export.verify_artifacts(spark, root, ["classifier", "scaler"])
    row = export.smoke_test(spark, root).first()
    assert 0 <= row["hazardous_probability"] <= 1 and row["miss_distance_km"] > 0


def test_importance_and_card(spark, trained):
    forest = trained["clf"].models["RandomForestClassifier"]
    rows = training.feature_importance(forest, "clf", spark).collect()
    assert {r["feature"] for r in rows} == set(CLF_FEATURES) and sum(r["importance"] for r in rows) == pytest.approx(1)
    clf_test, reg_test = trained["clf"].metrics[1], trained["reg"].metrics[0]
    made = card.model_card(
        spark, ("RandomForestClassifier", forest, {}, clf_test),
        ("LinearRegression", trained["reg"].models["LinearRegression"], {"seed": 42}, reg_test), "2024-01-01T00:00:00")
    text = json.loads(card.card_json(made).first()["card"])
    assert text["features"]["reg_features"] == REG_FEATURES and text["regressor"]["hyperparams"] == {"seed": "42"}
    assert card.metric_summary(made).count() == 5


def test_predictions_of_a_single_file_are_dealt(spark, prepared, trained, monkeypatch):
    """Rows that one task reads are predicted by as many tasks as their number asks for, with the same results."""
    model, rows = trained["reg"].models["RandomForestRegressor"], prepared.load("reg", "train").coalesce(1)
    plain = training.predictions(model, rows, "reg")
    monkeypatch.setattr(training, "ROWS_PER_CORE", 100)
    dealt = training.predictions(model, rows, "reg")
    assert plain.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() == training.fit_partitions(rows.count()) > 1
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


def test_preparation_spreads_rows_by_their_number(spark, monkeypatch):
    from perigee.plans import preprocess

    rows = spark.range(1000).coalesce(1)
    assert preprocess.dealt(rows, 1000).rdd.getNumPartitions() == 1
    monkeypatch.setattr(preprocess, "PART_ROWS", 250)
    many = preprocess.dealt(rows, 1000)
    assert many.rdd.getNumPartitions() == 4 and many.exceptAll(rows).isEmpty() and many.count() == 1000

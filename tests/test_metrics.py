import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from perigee.operators import metrics as m
from perigee.operators import ranking


@pytest.fixture(scope="module")
def pred(spark):
    rng = np.random.default_rng(5)
    label = rng.random(800) < 0.2
    score = np.round(np.clip(label * 0.3 + rng.random(800) * 0.7, 0, 1), 2)
    rows = [(int(y), float(s), int(s > 0.5)) for y, s in zip(label, score)]
    return spark.createDataFrame(rows, "label int, score double, prediction int").repartition(3).persist()


def test_auc_with_ties(pred):
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0)
    want = evaluator.evaluate(pred.withColumn("y", F.col("label").cast("double")))
    assert m.auc_roc(pred).first()["auc_roc"] == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_is_missing(pred):
    assert m.auc_roc(pred.where("label = 1")).first()["auc_roc"] is None


def by_hand(y, p):
    out = {}
    for c in (0, 1):
        tp, fp, fn = ((y == c) & (p == c)).sum(), ((y != c) & (p == c)).sum(), ((y == c) & (p != c)).sum()
        precision, recall = tp / max(tp + fp, 1), tp / max(tp + fn, 1)
        out[c] = (precision, recall, 2 * tp / max(2 * tp + fp + fn, 1), (y == c).sum())
    return out


def test_classification_scores(pred):
    data = pred.toPandas()
    y, p = data["label"].to_numpy(), data["prediction"].to_numpy()
    hand = by_hand(y, p)
    got = m.classification_metrics(pred).first()
    assert got["accuracy"] == pytest.approx((y == p).mean())
    for i, name in enumerate(("precision_weighted", "recall_weighted", "f1_weighted")):
        assert got[name] == pytest.approx(sum(hand[c][i] * hand[c][3] for c in hand) / len(y))
    report = {r["class"]: r for r in m.classification_report(pred).collect()}
    assert list(report) == ["Safe", "Hazardous", "accuracy", "macro avg", "weighted avg"]
    assert report["Hazardous"]["f1"] == pytest.approx(hand[1][2])
    assert report["macro avg"]["recall"] == pytest.approx((hand[0][1] + hand[1][1]) / 2)
    assert report["Safe"]["support"] == hand[0][3]


def test_zero_division_counts_as_zero(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    got = m.classification_metrics(df).first()
    assert got["precision_weighted"] == pytest.approx(0.25)


def test_curves(pred):
    data = pred.toPandas()
    y, s = data["label"].to_numpy(), data["score"].to_numpy()
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in m.roc_curve(pred).collect()}
    assert roc[float("inf")] == (0.0, 0.0)
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in m.precision_recall_curve(pred).collect()}
    assert pr[None] == (1.0, 0.0)
    for t in np.unique(s):
        hit = s >= t
        assert roc[t] == pytest.approx((hit[y == 0].mean(), hit[y == 1].mean()))
        assert pr[t] == pytest.approx((y[hit].mean(), hit[y == 1].mean()))


def test_dropped_points_do_not_change_the_area(pred):
    full, corners = (
        m.roc_curve(pred, d).orderBy(F.desc("threshold")).toPandas() for d in (False, True))
    assert 2 < len(corners) < len(full)
    area = [np.trapezoid(c["tpr"], c["fpr"]) for c in (full, corners)]
    assert area[0] == pytest.approx(area[1])
    assert area[0] == pytest.approx(m.auc_roc(pred).first()["auc_roc"])


def test_regression_metrics(spark):
    rng = np.random.default_rng(6)
    y = rng.normal(16, 1, 500)
    p = y + rng.normal(0, 0.5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    got = m.regression_metrics(df).first()
    assert got["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["rmse_log"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got["mae_log"] == pytest.approx(np.abs(y - p).mean())
    assert got["rmse_km"] == pytest.approx(np.sqrt(((np.expm1(y) - np.expm1(p)) ** 2).mean()))


def test_ranking_keeps_listing_order_on_ties(spark):
    table = spark.createDataFrame(
        [("clf", 0, "a", 0.8, 0.9), ("clf", 1, "b", 0.9, 0.9), ("clf", 2, "c", 0.9, 0.7)],
        "task string, position int, model string, f1_weighted double, auc_roc double")
    ranked = {r["model"]: r["rank"] for r in ranking.rank_models(table, F.col("f1_weighted")).collect()}
    assert ranked == {"b": 1, "c": 2, "a": 3}
    assert ranking.select_best(table, ranking.selection_score()).first()["model"] == "b"
    assert {r["model"] for r in ranking.top_models(table, F.col("f1_weighted")).collect()} == {"b", "c"}


def test_cv_summary_uses_population_deviation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "model string, score double")
    row = m.cv_summary(df).first()
    assert (row["cv_mean"], row["cv_std"]) == (2.0, 1.0)


def test_r2_of_a_constant_label(spark):
    from perigee.operators.metrics import regression_metrics

    rows = [("right", 2.0, 2.0), ("right", 2.0, 2.0), ("wrong", 2.0, 2.5), ("wrong", 2.0, 2.0)]
    got = regression_metrics(spark.createDataFrame(rows, "model string, label double, prediction double"), ["model"])
    assert {r["model"]: r["r2"] for r in got.collect()} == {"right": 1.0, "wrong": 0.0}


def test_describe_leaves_nan_out(spark):
    from perigee.operators.stats import describe

    got = describe(spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double"), ["x"]).first()
    assert (got["count"], got["mean"], got["min"], got["p50"], got["max"]) == (2, 2.0, 1.0, 2.0, 3.0)


def test_areas_and_corners_from_many_ranges(pred, monkeypatch):
    """Several models in one pass, with ranges of a few scores, give what each gives alone."""
    from perigee.operators import ordering

    both = pred.withColumn("model", F.lit("a")).unionByName(pred.withColumns({"model": F.lit("b"), "score": -F.col("score")}))
    alone = m.auc_roc(pred).first()["auc_roc"]
    corners = sorted(map(tuple, m.roc_curve(pred, True).collect()))
    sums = ordering.running_sums
    monkeypatch.setattr(m, "running_sums", lambda *a, **k: sums(*a, **k, bucket_rows=20, section=2))
    areas = {r["model"]: r["auc_roc"] for r in m.auc_roc(both, ["model"]).collect()}
    assert areas == pytest.approx({"a": alone, "b": 1 - alone})
    assert sorted(map(tuple, m.roc_curve(pred, True).collect())) == corners

"""Model card and flat metric summary."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.schema import CLF_FEATURES, REG_FEATURES

CARD_SCHEMA = (
    "trained_at string, "
    "classifier struct<model: string, selected_from: string, hyperparams: map<string, string>, "
    "test_f1_weighted: double, test_auc_roc: double, test_accuracy: double>, "
    "regressor struct<model: string, selected_from: string, hyperparams: map<string, string>, "
    "test_r2: double, test_rmse_log: double, test_rmse_km: double>, "
    "features struct<clf_features: array<string>, reg_features: array<string>>, "
    "stages array<string>"
)

STAGES = ["preprocess", "features", "training", "selection", "tuning", "export"]


def model_name(model: PipelineModel) -> str:
    return type(model.stages[-1]).__name__


def model_card(
    spark: SparkSession,
    clf: tuple[str, PipelineModel, dict, dict],
    reg: tuple[str, PipelineModel, dict, dict],
    trained_at: str,
) -> DataFrame:
    """One nested row from (selected name, model, parameters, test metrics) of both heads."""
    clf_name, clf_model, clf_params, clf_test = clf
    reg_name, reg_model, reg_params, reg_test = reg
    row = (
        trained_at,
        (model_name(clf_model), clf_name, {k: str(v) for k, v in clf_params.items()},
         clf_test["f1_weighted"], clf_test["auc_roc"], clf_test["accuracy"]),
        (model_name(reg_model), reg_name, {k: str(v) for k, v in reg_params.items()},
         reg_test["r2"], reg_test["rmse_log"], reg_test["rmse_km"]),
        (CLF_FEATURES, REG_FEATURES),
        STAGES,
    )
    return spark.createDataFrame([row], CARD_SCHEMA)


def card_json(card: DataFrame) -> DataFrame:
    return card.select(F.to_json(F.struct(*card.columns)).alias("card"))


def metric_summary(card: DataFrame) -> DataFrame:
    """task, metric, value rows of a card."""
    entries = [
        ("Classification", "F1 (weighted)", "classifier.test_f1_weighted"),
        ("Classification", "AUC-ROC", "classifier.test_auc_roc"),
        ("Regression", "R2", "regressor.test_r2"),
        ("Regression", "RMSE (log)", "regressor.test_rmse_log"),
        ("Regression", "RMSE (km)", "regressor.test_rmse_km"),
    ]
    return card.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("task"), F.lit(m).alias("metric"), F.col(c).alias("value")) for t, m, c in entries
    ])).alias("m")).select("m.*")

"""Scoring whole tables: raw inputs to hazard class, probability and miss distance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.operators.quality import accepted, quarantine, validate_inputs
from perigee.operators.scaling import Scaler
from perigee.schema import CLF_FEATURES, REG_FEATURES

_FEATURE_SQL = """
SELECT *, log1p(diameter_avg) AS log_diameter_avg, log1p(diameter_ratio) AS log_diameter_ratio,
       log1p(relative_velocity) AS log_relative_velocity, log1p(miss_distance) AS log_miss_distance
FROM (
  SELECT *, (est_diameter_min + est_diameter_max) / 2 AS diameter_avg,
         try_divide(est_diameter_max, est_diameter_min) AS diameter_ratio
  FROM __THIS__)
"""


def _select(replaced: dict[str, str], kept: list[str]) -> str:
    parts = [f"{sql} AS `{c}`" for c, sql in replaced.items()] + [f"`{c}`" for c in kept]
    return f"SELECT {', '.join(parts)} FROM __THIS__"


def scoring_model(scaler: Scaler, model: PipelineModel, features: list[str]) -> PipelineModel:
    """One saved unit from raw inputs to prediction: engineer, scale, assemble, predict."""
    engineer = SQLTransformer(statement=_FEATURE_SQL)
    scale = SQLTransformer(statement=_select(scaler.sql_expressions(), ["_row"]))
    return PipelineModel(stages=[engineer, scale, *model.stages])


@dataclass(frozen=True)
class Scorer:
    classifier: PipelineModel
    regressor: PipelineModel

    @staticmethod
    def build(clf: PipelineModel, reg: PipelineModel, scaler_clf: Scaler, scaler_reg: Scaler) -> Scorer:
        return Scorer(
            scoring_model(scaler_clf, clf, CLF_FEATURES), scoring_model(scaler_reg, reg, REG_FEATURES)
        )

    def save(self, path: str) -> None:
        self.classifier.write().overwrite().save(f"{path}/classifier")
        self.regressor.write().overwrite().save(f"{path}/regressor")

    @staticmethod
    def load(path: str) -> Scorer:
        return Scorer(PipelineModel.load(f"{path}/classifier"), PipelineModel.load(f"{path}/regressor"))

    def score(self, df: DataFrame) -> DataFrame:
        """Input columns plus hazardous_predicted, hazardous_probability (4 places), miss_distance_km (2 places).

        The row travels through both models as one column, so nothing has to be joined back.
        """
        out = self.classifier.transform(df.withColumn("_row", F.struct(*df.columns)))
        score = "probability" if "probability" in out.columns else "rawPrediction"
        scored = out.select(
            "_row",
            (F.col("prediction") == 1).alias("hazardous_predicted"),
            F.round(vector_to_array(score)[1], 4).alias("hazardous_probability"),
        )
        carried = scored.select("_row.*", F.struct("_row", "hazardous_predicted", "hazardous_probability").alias("_row"))
        distance = self.regressor.transform(carried)
        return distance.select(
            "_row._row.*",
            "_row.hazardous_predicted",
            "_row.hazardous_probability",
            F.round(F.expm1("prediction"), 2).alias("miss_distance_km"),
        )


def score_valid(scorer: Scorer, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scored rows, refused rows with their errors)."""
    checked = validate_inputs(df)
    return scorer.score(accepted(checked)), quarantine(checked)

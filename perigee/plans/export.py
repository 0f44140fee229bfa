"""Exporting a trained pair of models: save, verify that everything is there, score one known row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators.quality import check_manifest, check_scores, require
from perigee.plans.card import card_json
from perigee.plans.scoring import Scorer
from perigee.schema import SCORING_INPUTS

# Artifact folders, and the input of the smoke test in the order of SCORING_INPUTS.
REQUIRED = ["classifier", "regressor", "model_card", "metrics"]
SMOKE_INPUT = (0.12, 0.27, 48000.0, 22.1, 14500000.0)


def export_models(scorer: Scorer, card: DataFrame, metrics: DataFrame, root: str) -> None:
    """Write both scoring models, the card (one JSON line) and the metric rows under ``root``."""
    scorer.save(root)
    card_json(card).coalesce(1).write.mode("overwrite").text(f"{root}/model_card")
    metrics.write.mode("overwrite").json(f"{root}/metrics")


def artifact_names(spark: SparkSession, root: str) -> DataFrame:
    """Folders with files directly under ``root``; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    below = F.substring_index("path", f"/{root.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    return files.select(F.substring_index(below, "/", 1).alias("name")).distinct()


def verify_artifacts(spark: SparkSession, root: str, required: list[str] | None = None) -> None:
    wanted = spark.createDataFrame([(n,) for n in required or REQUIRED], "name string")
    missing = sorted(r["name"] for r in check_manifest(wanted, artifact_names(spark, root)).collect())
    if missing:
        raise FileNotFoundError(f"missing artifacts under {root}: {missing}")


def smoke_test(spark: SparkSession, root: str) -> DataFrame:
    """Reload the saved models and score the known row; its score and distance must be in range."""
    row = spark.createDataFrame([SMOKE_INPUT], ", ".join(f"{c} double" for c in SCORING_INPUTS))
    scored = Scorer.load(root).score(row)
    require(check_scores(scored))
    return scored

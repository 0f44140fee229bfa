"""Fixed scoring rules: prediction tables that every engine can rebuild, to check the metric operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions.columns import with_features

# Rule name, score expression, decision threshold.
CLASS_RULES = [
    ("size", "least(1e0, floor(est_diameter_min * 500) / 250e0)", 0.16),
    ("magnitude", "floor((33.2 - absolute_magnitude) * 10) / 240e0", 0.6),
    ("speed", "floor(relative_velocity / 2400e0) / 100e0", 0.5),
]
# Rule name, predicted log distance.
DISTANCE_RULES = [
    ("flat", "17.0 + 0.0 * diameter_avg"),
    ("linear", "16.5 + 0.05 * log_relative_velocity + 0.4 * log_diameter_avg"),
]


def class_rule(df: DataFrame, name: str = "size") -> DataFrame:
    """approach_id, label, score and prediction of one rule."""
    _, score, threshold = next(r for r in CLASS_RULES if r[0] == name)
    return df.select(
        "approach_id",
        F.col("hazardous").cast("int").alias("label"),
        F.expr(score).cast("double").alias("score"),
    ).withColumn("prediction", (F.col("score") > F.lit(threshold)).cast("int"))


def class_rules(df: DataFrame, *keep: str) -> DataFrame:
    """All rules side by side, one row per approach and rule, from one scan."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("model"),
                 F.expr(score).cast("double").alias("score"), F.lit(threshold).alias("threshold"))
        for i, (name, score, threshold) in enumerate(CLASS_RULES)
    ]
    return df.select(
        "approach_id", *keep, F.col("hazardous").cast("int").alias("label"), F.explode(F.array(*entries)).alias("r")
    ).select(
        "approach_id", *keep, "label", "r.position", "r.model", "r.score",
        (F.col("r.score") > F.col("r.threshold")).cast("int").alias("prediction"),
    )


def distance_rules(df: DataFrame) -> DataFrame:
    """approach_id, position, model, label and prediction of the distance rules."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("model"), F.expr(e).cast("double").alias("prediction"))
        for i, (name, e) in enumerate(DISTANCE_RULES)
    ]
    return with_features(df).select(
        "approach_id", F.col("log_miss_distance").alias("label"), F.explode(F.array(*entries)).alias("r")
    ).select("approach_id", "r.position", "r.model", "label", "r.prediction")

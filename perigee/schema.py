"""Table schemas and feature lists."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("est_diameter_min", T.DoubleType(), False),
    T.StructField("est_diameter_max", T.DoubleType(), False),
    T.StructField("relative_velocity", T.DoubleType(), False),
    T.StructField("miss_distance", T.DoubleType(), False),
    T.StructField("orbiting_body", T.StringType(), False),
    T.StructField("sentry_object", T.BooleanType(), False),
    T.StructField("absolute_magnitude", T.DoubleType(), False),
    T.StructField("hazardous", T.BooleanType(), False),
])

RAW_COLUMNS = RAW_SCHEMA.fieldNames()

# Column groups of the data model.
NUMERIC_COLUMNS = [
    "est_diameter_min",
    "est_diameter_max",
    "relative_velocity",
    "miss_distance",
    "absolute_magnitude",
]
NON_PREDICTIVE = ["id", "name", "orbiting_body", "sentry_object"]
SUPERSEDED = ["est_diameter_min", "est_diameter_max", "relative_velocity", "miss_distance"]
ENGINEERED = [
    "diameter_avg",
    "diameter_ratio",
    "log_diameter_avg",
    "log_diameter_ratio",
    "log_relative_velocity",
    "log_miss_distance",
]
CLF_FEATURES = [
    "log_diameter_avg",
    "log_diameter_ratio",
    "log_relative_velocity",
    "log_miss_distance",
    "absolute_magnitude",
    "diameter_avg",
    "diameter_ratio",
]
REG_FEATURES = [
    "log_diameter_avg",
    "log_diameter_ratio",
    "log_relative_velocity",
    "absolute_magnitude",
    "diameter_avg",
    "diameter_ratio",
]
CLF_TARGET = "hazardous"
REG_TARGET = "log_miss_distance"
SCORING_INPUTS = [
    "est_diameter_min",
    "est_diameter_max",
    "relative_velocity",
    "absolute_magnitude",
    "miss_distance",
]
CLASS_NAMES = ["Safe", "Hazardous"]

FEATURE_ROW_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), False) for c in ENGINEERED]
    + [
        T.StructField("absolute_magnitude", T.DoubleType(), False),
        T.StructField("hazardous", T.IntegerType(), False),
        T.StructField("sourceNeoId", T.LongType(), True),
    ]
)

"""Reading approach tables: CSV, Parquet and the adapter over the driver's event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.columns import parse_bool
from perigee.schema import RAW_COLUMNS, RAW_SCHEMA


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", extra: T.StructType | None = None) -> DataFrame:
    """Approach table with its declared types; a malformed CSV row or value stops the job.

    CSV columns are found by their trimmed, lower-case names, in whatever order they stand; missing, doubled and
    unknown names are errors, and so is a file whose header differs from the first one's. ``extra`` names columns
    beyond the standard ten. Boolean columns arrive as text and go through parse_bool.
    """
    if fmt != "csv":
        return normalize_columns(spark.read.format(fmt).load(path))
    fields = list(RAW_SCHEMA) + (list(extra) if extra else [])
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    found = [c.strip().lower() for c in header]
    wanted = [f.name for f in fields]
    if sorted(found) != sorted(wanted):
        raise ValueError(f"columns must be {sorted(wanted)}, found {sorted(found)}")
    text = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType(), True) for c in header]))
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
        .toDF(*found)
    )
    return text.select(*[_typed(f).alias(f.name) for f in fields])


def _typed(field: T.StructField) -> Column:
    """A text column as its declared type; text that isn't of the type is an error, not NULL."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return value
    if isinstance(field.dataType, T.BooleanType):
        return parse_bool(field.name)
    typed = F.trim(value).try_cast(field.dataType)
    wrong = F.raise_error(F.concat(F.lit(f"{field.name}: "), value)).cast(field.dataType)
    return F.when(value.isNotNull() & typed.isNull(), wrong).otherwise(typed)


def approaches_from_events(events: DataFrame) -> DataFrame:
    """Approach-shaped view over an event table: unique approach_id, repeating object id."""
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int")
    value = F.col("value")
    low = F.lit(0.0006) + value / F.lit(1000.0)
    user = F.col("user_id")
    letter = F.substring(F.lit("ABCDEFGHJKLMNOPQRSTUVWXY"), (user % 24 + 1).cast("int"), F.lit(1))
    second = F.substring(F.lit("PQRSTUVWXY"), (user % 10 + 1).cast("int"), F.lit(1))
    return events.select(
        F.col("event_id").alias("approach_id"),
        (F.lit(2000000) + user).alias("id"),
        F.concat(
            F.lit("("), (F.lit(2000) + user % 25).cast("string"), F.lit(" "),
            letter, second, user.cast("string"), F.lit(")"),
        ).alias("name"),
        F.col("ts").alias("approach_ts"),
        low.alias("est_diameter_min"),
        (low * (F.lit(2.0) + k / F.lit(100.0))).alias("est_diameter_max"),
        (F.lit(203.0) + F.lit(475.0) * ((F.col("event_id") * 7919) % 500)).alias("relative_velocity"),
        (F.lit(6745.0) + F.lit(74800.0) * ((F.col("event_id") * 104729) % 1000)).alias("miss_distance"),
        F.lit("Earth").alias("orbiting_body"),
        F.lit(False).alias("sentry_object"),
        (F.lit(33.2) - F.lit(24.0) * value / (value + F.lit(50.0))).alias("absolute_magnitude"),
        (((value > 80) & (k >= 50)) | (F.col("event_id") % 97 == 0)).alias("hazardous"),
    )


def load_approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approaches_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def raw_view(approaches: DataFrame) -> DataFrame:
    """The ten stored columns in their declared order."""
    return approaches.select(*RAW_COLUMNS)

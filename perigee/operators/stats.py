"""Summary statistics over approach tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.operators.ordering import exact_quantiles
from perigee.operators.quality import per_column


def dataset_stats(df: DataFrame) -> DataFrame:
    """The eleven headline numbers, from one aggregation pass."""
    def mean(column: str, digits: int):
        return F.round(F.avg(column), digits)

    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("hazardous")).alias("hazardous_count"),
        F.count_if(~F.col("hazardous")).alias("safe_count"),
        F.round(F.avg(F.col("hazardous").cast("int")) * 100, 2).alias("hazardous_percentage"),
        mean("relative_velocity", 2).alias("velocity_avg_kmph"),
        F.round(F.max("relative_velocity"), 2).alias("velocity_max_kmph"),
        mean("miss_distance", 2).alias("miss_distance_avg_km"),
        F.round(F.min("miss_distance"), 2).alias("miss_distance_min_km"),
        mean("est_diameter_min", 6).alias("diameter_min_avg_km"),
        mean("est_diameter_max", 6).alias("diameter_max_avg_km"),
        mean("absolute_magnitude", 3).alias("absolute_magnitude_avg"),
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max per numeric column; NULL and NaN are left out of all."""
    real = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c, t in df.dtypes if c in columns and t in ("double", "float")}
    df = df.select(*columns).withColumns(real) if real else df
    fields = {"count": "long", "mean": "double", "std": "double", "min": "double", "max": "double"}
    aggregates = []
    for c in columns:
        aggregates += [
            F.count(c).alias(f"count__{c}"),
            F.avg(c).alias(f"mean__{c}"),
            F.stddev_samp(c).alias(f"std__{c}"),
            F.min(c).alias(f"min__{c}"),
            F.max(c).alias(f"max__{c}"),
        ]
    moments = per_column(df.agg(*aggregates), columns, fields)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return moments.join(F.broadcast(quartiles), "column").select(
        "column", "count", "mean", "std", "min",
        F.col("q1").alias("p25"), F.col("q2").alias("p50"), F.col("q3").alias("p75"), "max",
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def class_balance(df: DataFrame, by: str | None = None, label: str = "hazardous") -> DataFrame:
    """Rows, positives and positive share, per group."""
    flag = F.col(label).cast("int")
    return df.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(flag).cast("long").alias("positives"),
        F.avg(flag).alias("positive_share"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Position, type and non-null count of every column, from one scan."""
    row = df.agg(*[F.count(c).alias(f"non_null__{c}") for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    places = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)])
    return per_column(row, df.columns, {"non_null": "long"}).select(
        places[F.col("column")].cast("long").alias("position"),
        "column",
        types[F.col("column")].alias("dtype"),
        "non_null",
    )


def batch_summary(scored: DataFrame) -> DataFrame:
    """Totals of a scored batch."""
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("hazardous")).alias("hazardous"),
        F.count_if(~F.col("hazardous")).alias("safe"),
    )

"""Data-quality gates. Each check is one aggregation pass that returns a small report table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class QualityError(ValueError):
    """A gate was not met."""


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def per_column(row: DataFrame, columns: list[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row aggregate with columns "<field>__<column>" into one row per column."""
    items = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{field}__{c}").cast(dtype).alias(field) for field, dtype in fields.items()],
        )
        for c in columns
    ]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def expect_shape(df: DataFrame, rows: int, columns: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        ((F.col("row_count") == rows) & F.lit(len(df.columns) == columns)).alias("ok"),
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, from one scan."""
    columns = columns or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in columns])
    return per_column(row, columns, {"nulls": "long"})


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break each condition, all conditions in one scan."""
    row = df.agg(*[F.count_if(broken).alias(f"violations__{name}") for name, broken in checks.items()])
    return per_column(row, list(checks), {"violations": "long"}).withColumn("ok", F.col("violations") == 0)


def not_positive(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) <= 0)


def not_finite(column: str) -> Column:
    c = F.col(column).cast("double")
    return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))


def expect_positive(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows at or below zero (or missing) per column."""
    return violations(df, {c: not_positive(c) for c in columns})


def expect_finite(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL, NaN or infinite values per numeric column."""
    return violations(df, {c: not_finite(c) for c in columns or _numeric(df)})


def require(report: DataFrame) -> None:
    """Raise when any row of a check report is not ok. Reports have one row per checked column."""
    failed = [row.asDict() for row in report.where(~F.col("ok")).collect()]
    if failed:
        raise QualityError(f"quality gate failed: {failed}")


# Messages of the input rules, in the order they are checked.
def input_rules(strict: bool = False) -> list[tuple[str, Column]]:
    positive = ["est_diameter_min", "est_diameter_max", "relative_velocity", "miss_distance"]
    rules = [(f"{c} must be greater than 0", F.col(c).isNull() | F.isnan(c) | (F.col(c) <= 0)) for c in positive]
    rules.append(("absolute_magnitude must be a number",
                  F.col("absolute_magnitude").isNull() | F.isnan("absolute_magnitude")))
    if strict:  # the batch form asks for it
        rules.append(("absolute_magnitude must be greater than 0", F.col("absolute_magnitude") <= 0))
    rules.append((
        "est_diameter_max must be greater than or equal to est_diameter_min",
        F.col("est_diameter_max") < F.col("est_diameter_min"),
    ))
    return rules


def validate_inputs(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``errors``: every rule the row breaks, empty for an accepted row. ``strict`` wants a positive magnitude too."""
    found = F.array(*[F.when(broken, F.lit(message)) for message, broken in input_rules(strict)])
    return df.withColumn("errors", F.filter(found, lambda e: e.isNotNull()))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") == 0).drop("errors")


def quarantine(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") > 0)


def check_manifest(required: DataFrame, present: DataFrame, key: str = "name") -> DataFrame:
    """Required names that are not present."""
    return required.join(present.select(key).distinct(), key, "left_anti")


def check_scores(scored: DataFrame) -> DataFrame:
    """Scores outside [0, 1] and non-positive predicted distances over every scored row."""
    p, km = F.col("hazardous_probability"), F.col("miss_distance_km")
    return scored.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(p.isNull() | ~p.between(0.0, 1.0)).alias("bad_probability"),
        F.count_if(km.isNull() | (km <= 0)).alias("bad_distance"),
    ).withColumn("ok", (F.col("bad_probability") == 0) & (F.col("bad_distance") == 0))



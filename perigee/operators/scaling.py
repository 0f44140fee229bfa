"""Standard scaling with the population deviation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.operators.quality import per_column

STATE_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
])


def scaler_table(df: DataFrame, features: list[str]) -> DataFrame:
    """Mean and population deviation per feature, from one pass."""
    row = df.agg(*[
        e for c in features for e in (F.avg(c).alias(f"mean__{c}"), F.stddev_pop(c).alias(f"std__{c}"))
    ])
    return per_column(row, features, {"mean": "double", "std": "double"})


@dataclass(frozen=True)
class Scaler:
    """Fitted state: two numbers per feature. A constant feature scales to zero."""

    features: list[str]
    means: dict[str, float]
    stds: dict[str, float]

    def scaled(self, feature: str) -> Column:
        return (F.col(feature) - F.lit(self.means[feature])) / F.lit(self.stds[feature] or 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.scaled(c) for c in self.features})

    def sql_expressions(self) -> dict[str, str]:
        """The same scaling as SQL text, for a saved MLlib stage."""
        return {c: f"(`{c}` - ({self.means[c]!r}D)) / ({(self.stds[c] or 1.0)!r}D)" for c in self.features}

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(c, self.means[c], self.stds[c]) for c in self.features]
        spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str, features: list[str]) -> Scaler:
        rows = {r["column"]: r for r in spark.read.schema(STATE_SCHEMA).json(path).collect()}
        return Scaler(features, {c: rows[c]["mean"] for c in features}, {c: rows[c]["std"] for c in features})


def fit_scaler(train: DataFrame, features: list[str]) -> Scaler:
    return fit_scalers(train, {"all": (features, F.lit(True))})["all"]


def fit_scalers(df: DataFrame, wanted: dict[str, tuple[list[str], Column]]) -> dict[str, Scaler]:
    """Several scalers from one scan: name to (features, condition on the rows that count)."""
    aggregates = []
    for name, (features, rows) in wanted.items():
        for c in features:
            value = F.when(rows, F.col(c))
            aggregates += [F.avg(value).alias(f"{name}__mean__{c}"), F.stddev_pop(value).alias(f"{name}__std__{c}")]
    row = df.agg(*aggregates).first()
    return {
        name: Scaler(
            features,
            {c: row[f"{name}__mean__{c}"] for c in features},
            {c: row[f"{name}__std__{c}"] for c in features},
        )
        for name, (features, _) in wanted.items()
    }

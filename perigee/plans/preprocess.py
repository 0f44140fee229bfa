"""From raw approaches to the split store: gate, features, split, balance, scale, write."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.columns import flag_to_int, with_features
from perigee.operators.balance import synthetic_training_rows, with_synthetic
from perigee.operators.browse import drop_non_predictive, drop_superseded
from perigee.operators.quality import not_finite, not_positive, require, violations
from perigee.operators.scaling import Scaler, fit_scalers
from perigee.operators.splits import SEED, stratified_split
from perigee.schema import CLF_FEATURES, CLF_TARGET, ENGINEERED, RAW_COLUMNS, REG_FEATURES, REG_TARGET
from perigee.session import stable
from perigee.sources.tables import load_splits, write_splits

#: Rows of a partition of the modelling table up to MOST_PARTS of them, and rows that these then grow to.
PART_ROWS, MOST_PARTS, LARGE_PART = 25_000, 96, 1_000_000
SPLIT_COLUMNS = ["task", "split", "row_key", "approach_id", "synthetic", "label", *CLF_FEATURES]


@dataclass(frozen=True)
class Prepared:
    """The written split store and the two fitted scalers."""

    spark: SparkSession
    path: str
    scaler_clf: Scaler
    scaler_reg: Scaler

    def load(self, task: str, split: str | list[str]) -> DataFrame:
        return load_splits(self.spark, self.path, task, split)


def check_table(approaches: DataFrame) -> None:
    """Stop on missing values, non-positive minimum diameters or features that are not finite."""
    checks = {c: F.col(c).isNull() for c in RAW_COLUMNS}
    checks["est_diameter_min"] = not_positive("est_diameter_min")
    checks |= {c: not_finite(c) for c in [*ENGINEERED, "absolute_magnitude"]}
    require(violations(with_features(approaches), checks))


def modelling_table(approaches: DataFrame) -> DataFrame:
    """approach_id, the engineered features and the 0/1 label."""
    engineered = drop_superseded(drop_non_predictive(with_features(approaches)))
    return engineered.withColumn(CLF_TARGET, flag_to_int(CLF_TARGET)).select(
        "approach_id", *ENGINEERED, "absolute_magnitude", CLF_TARGET
    )


def feature_view(df: DataFrame, task: str, *keys: str) -> DataFrame:
    """Keys, the task's features in model order, and its target."""
    if task == "clf":
        return df.select(*keys, *CLF_FEATURES, CLF_TARGET)
    return df.select(*keys, *REG_FEATURES, REG_TARGET)


def _store_row(task: str, scaler: Scaler, label: str) -> Column:
    """One row of the split store; regression rows leave their target out of the features."""
    skip = {REG_TARGET} if task == "reg" else set()
    features = [
        (F.lit(None).cast("double") if c in skip else scaler.scaled(c)).alias(c) for c in CLF_FEATURES
    ]
    return F.struct(
        F.lit(task).alias("task"), "split", "row_key", "approach_id", "synthetic",
        F.col(label).cast("double").alias("label"), *features,
    )


def _store_rows(df: DataFrame, *rows: Column) -> DataFrame:
    """Several store rows per input row from one scan."""
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*").select(*SPLIT_COLUMNS)


def dealt(table: DataFrame, rows: int) -> DataFrame:
    """A saved copy in partitions by the number of rows: a small file of many rows is read by few tasks."""
    return stable(table.repartition(max(1, min(math.ceil(rows / PART_ROWS), MOST_PARTS), math.ceil(rows / LARGE_PART))))


def prepare(approaches: DataFrame, path: str, seed: int = SEED, k: int = 5, scale_first: bool = False) -> Prepared:
    """Run the whole preparation and write the split store to ``path``.

    Balancing happens before scaling and only on the classification training rows; validation and
    test rows are scaled with the training state.
    """
    check_table(approaches)
    # read for the cuts, the balance, the scalers and the store
    table = dealt(modelling_table(approaches), approaches.count())
    split = stratified_split(table, CLF_TARGET, seed=seed).withColumns({
        "row_key": F.col("approach_id").cast("string"), "synthetic": F.lit(False),
    })
    train = split.where(F.col("split") == "train")
    new = synthetic_training_rows(train, CLF_FEATURES, CLF_TARGET, k=k, seed=seed, scale_first=scale_first)
    scalers = fit_scalers(with_synthetic(train, new, CLF_FEATURES, CLF_TARGET, "approach_id"), {
        "clf": (CLF_FEATURES, F.lit(True)),
        "reg": (REG_FEATURES, ~F.col("synthetic")),
    })
    scaler_clf, scaler_reg = scalers["clf"], scalers["reg"]
    clf_row = _store_row("clf", scaler_clf, CLF_TARGET)
    reg_row = _store_row("reg", scaler_reg, REG_TARGET)
    new = new.withColumns({"split": F.lit("train"), "approach_id": F.lit(None).cast(split.schema["approach_id"].dataType)})
    store = _store_rows(split, clf_row, reg_row).unionByName(_store_rows(new, clf_row))
    write_splits(store, path)
    spark = approaches.sparkSession
    scaler_clf.save(spark, f"{path}-scaler-clf")
    scaler_reg.save(spark, f"{path}-scaler-reg")
    return Prepared(spark, path, scaler_clf, scaler_reg)

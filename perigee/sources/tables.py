"""Written tables: feature store, split store, metric files."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.columns import flag_to_int, with_features
from perigee.schema import ENGINEERED, FEATURE_ROW_SCHEMA


def feature_rows(approaches: DataFrame, key: str | None = None) -> DataFrame:
    """One feature-store row per approach, pointing at its object; with key, that column comes first as the row's key."""
    return with_features(approaches).select(
        *([key] if key else []),
        *ENGINEERED,
        "absolute_magnitude",
        flag_to_int("hazardous").alias("hazardous"),
        F.col("id").alias("sourceNeoId"),
    )


_LEDGER = "batch string, rows long"


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """Batches that were committed, one row each."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ledger")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{path}/ledger")


def append_features(df: DataFrame, path: str, batch: str) -> bool:
    """Add a batch of rows to the feature store once, whatever its name; False if it was there already.

    Rows go to the batch's own folder, over what an interrupted attempt may have left there. One ledger row, a single
    file, is the commit: readers see the batches of the ledger only. A batch has one writer at a time.
    """
    spark = df.sparkSession
    if not _ledger(spark, path).where(F.col("batch") == batch).isEmpty():
        return False
    place = f"{path}/data/batch={_folder(batch)}"
    df.write.mode("overwrite").parquet(place)
    rows = spark.read.schema(df.schema).parquet(place).count()
    spark.createDataFrame([(batch, rows)], _LEDGER).coalesce(1).write.mode("append").parquet(f"{path}/ledger")
    return True


def _folder(batch: str) -> str:
    """A folder name for any batch name."""
    return hashlib.sha256(batch.encode()).hexdigest()


def read_features(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all committed batches."""
    committed = _ledger(spark, path)
    if committed.isEmpty():
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.StringType())])).parquet(f"{path}/data")
    return stored.join(committed.select(F.sha2("batch", 256).alias("batch")), "batch", "left_semi").drop("batch")


def create_table_if_missing(
    spark: SparkSession, table: str, schema: T.StructType = FEATURE_ROW_SCHEMA, location: str | None = None
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{place}")


def write_splits(df: DataFrame, path: str) -> None:
    """One partition folder per task and split, features and label side by side.

    The rebalance step turns the few rows each task holds per folder into files of the advisory
    partition size, and cuts large folders into several; the store is read once per model fit.
    """
    df = df.hint("rebalance", "task", "split")
    df.write.mode("overwrite").partitionBy("task", "split").parquet(path)


def load_splits(spark: SparkSession, path: str, task: str | None = None, split: str | list[str] | None = None) -> DataFrame:
    """Read back; the task and split conditions prune whole folders."""
    df = spark.read.parquet(path)
    if task is not None:
        df = df.where(F.col("task") == task)
    if split is not None:
        names = [split] if isinstance(split, str) else list(split)
        df = df.where(F.col("split").isin(names))
    return df


METRIC_SCHEMA = T.StructType([
    T.StructField("task", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("split", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.select(*METRIC_SCHEMA.fieldNames()).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).json(path)


def long_metrics(df: DataFrame, task: str | Column, split: str, metrics: list[str], model: str = "model") -> DataFrame:
    """Wide metric rows (one per model) to task/model/split/metric/value rows."""
    return df.select(
        (F.lit(task) if isinstance(task, str) else task).alias("task"),
        F.col(model).alias("model"),
        F.lit(split).alias("split"),
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
        ])).alias("m"),
    ).select("task", "model", "split", "m.metric", "m.value")

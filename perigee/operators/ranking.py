"""Choosing models from metric tables (one row per model)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rank_models(metrics: DataFrame, by: Column, order: str = "position", task: str = "task") -> DataFrame:
    """Best first within a task; ties keep the order in which the models were listed."""
    best = W.partitionBy(task).orderBy(by.desc_nulls_last(), F.col(order))
    return metrics.withColumn("rank", F.row_number().over(best))


def top_models(metrics: DataFrame, by: Column, n: int = 2, order: str = "position", task: str = "task") -> DataFrame:
    return rank_models(metrics, by, order, task).where(F.col("rank") <= n)


def selection_score(f1: str = "f1_weighted", auc: str = "auc_roc") -> Column:
    """Mean of weighted F1 and AUC, the test-set criterion for classifiers."""
    return (F.col(f1) + F.col(auc)) / 2


def select_best(metrics: DataFrame, by: Column, order: str = "position", task: str = "task") -> DataFrame:
    return top_models(metrics, by, 1, order, task).drop("rank")

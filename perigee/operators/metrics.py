"""Evaluation metrics as aggregations over a prediction table.

Labels and predictions are 0/1. ``by`` names grouping columns (a model name, a fold) so that many
prediction sets are measured in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.operators.ordering import running_sums
from perigee.schema import CLASS_NAMES


def _ratio(numerator: Column, denominator: Column) -> Column:
    """Zero where the denominator is zero."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def confusion_matrix(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    return pred.groupBy(*(by or []), "label", "prediction").agg(F.count(F.lit(1)).alias("count"))


def normalised_confusion(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of each true class; the window runs over the few confusion rows."""
    row = W.partitionBy(*(by or []), "label")
    return confusion_matrix(pred, by).withColumn("share", F.col("count") / F.sum("count").over(row))


def _cells(pred: DataFrame, by: list[str]) -> DataFrame:
    y, p = F.col("label"), F.col("prediction")
    return pred.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _per_class() -> list[dict[str, Column]]:
    """Precision, recall, F1 and support of class 0 and class 1 from the four cells."""
    out = []
    for hit, wrong, missed in (("tn", "fn", "fp"), ("tp", "fp", "fn")):
        t, f, m = F.col(hit), F.col(wrong), F.col(missed)
        out.append({
            "precision": _ratio(t, t + f),
            "recall": _ratio(t, t + m),
            "f1": _ratio(2 * t, 2 * t + f + m),
            "support": t + m,
        })
    return out


def classification_metrics(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    by = by or []
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    classes = _per_class()

    def weighted(name: str) -> Column:
        return sum((c[name] * c["support"] for c in classes), F.lit(0.0)) / n

    return _cells(pred, by).select(
        *by,
        ((F.col("tn") + F.col("tp")) / n).alias("accuracy"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
    )


def classification_report(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per class, then accuracy, macro and weighted averages."""
    by = by or []
    fields = ("precision", "recall", "f1")
    classes = _per_class()
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("class"),
                 *[c[f].alias(f) for f in fields], c["support"].alias("support"))
        for i, (name, c) in enumerate(zip(CLASS_NAMES, classes))
    ]
    none = F.lit(None).cast("double")
    rows.append(F.struct(F.lit(2).alias("position"), F.lit("accuracy").alias("class"),
                         none.alias("precision"), none.alias("recall"),
                         ((F.col("tn") + F.col("tp")) / n).alias("f1"), n.alias("support")))
    rows.append(F.struct(F.lit(3).alias("position"), F.lit("macro avg").alias("class"),
                         *[((classes[0][f] + classes[1][f]) / 2).alias(f) for f in fields], n.alias("support")))
    rows.append(F.struct(F.lit(4).alias("position"), F.lit("weighted avg").alias("class"),
                         *[(sum((c[f] * c["support"] for c in classes), F.lit(0.0)) / n).alias(f) for f in fields],
                         n.alias("support")))
    return _cells(pred, by).select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def score_groups(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Positives and negatives per distinct score."""
    return pred.groupBy(*(by or []), "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def auc_roc(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half. All prediction sets of ``by`` take the same two passes."""
    by = by or []
    steps = running_sums(score_groups(pred, by), "score", {"neg_upto": "neg", "pos_upto": "pos"}, by)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below = F.col("neg_upto").cast("double") - neg
    return steps.groupBy(*by).agg(
        F.sum(pos * (below + neg / 2)).alias("wins"),
        F.max("pos_upto").cast("double").alias("p"),
        F.max("neg_upto").cast("double").alias("n"),
    ).select(*by, F.try_divide(F.col("wins"), F.col("p") * F.col("n")).alias("auc_roc"))


def _descending_steps(pred: DataFrame) -> DataFrame:
    return running_sums(score_groups(pred), "score", {"tps": "pos", "fps": "neg"}, descending=True)


def _class_totals(pred: DataFrame) -> DataFrame:
    return pred.agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")
    )


def roc_curve(pred: DataFrame, drop_intermediate: bool = False) -> DataFrame:
    """False and true positive rate at every distinct score, from an infinite threshold down.

    ``drop_intermediate`` leaves out points on a straight line between their neighbours.
    """
    steps = _descending_steps(pred)
    totals = _class_totals(pred)
    positives = totals.select("positives").scalar()
    negatives = totals.select("negatives").scalar()
    if drop_intermediate:
        steps = _turning_points(steps)
    points = steps.select(
        F.try_divide(F.col("fps").cast("double"), negatives).alias("fpr"),
        F.try_divide(F.col("tps").cast("double"), positives).alias("tpr"),
        F.col("score").cast("double").alias("threshold"),
    )
    start = pred.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return start.unionByName(points)


def _turning_points(steps: DataFrame) -> DataFrame:
    """Keep the first and last step and every step whose successor has other counts.

    A step's successor is the one whose sums start where its own end, so the two meet in a join.
    """
    here = F.struct("pos", "neg")
    following = steps.where(F.col("pos") + F.col("neg") > 0).select(
        (F.col("tps") - F.col("pos")).alias("tps"), (F.col("fps") - F.col("neg")).alias("fps"), here.alias("_next"))
    first = (F.col("tps") == F.col("pos")) & (F.col("fps") == F.col("neg"))
    return steps.join(following, ["tps", "fps"], "left").where(first | F.col("_next").isNull() | (F.col("_next") != here))


def precision_recall_curve(pred: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, plus the end point (1, 0) without a threshold."""
    steps = _descending_steps(pred)
    positives = _class_totals(pred).select("positives").scalar()
    tps = F.col("tps").cast("double")
    points = steps.select(
        (tps / (F.col("tps") + F.col("fps"))).alias("precision"),
        F.when(positives == 0, F.lit(1.0)).otherwise(F.try_divide(tps, positives)).alias("recall"),
        F.col("score").cast("double").alias("threshold"),
    )
    end = pred.sparkSession.range(1).select(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(end)


def regression_metrics(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """R2, RMSE and MAE in log space and RMSE in kilometres, from one pass.

    The total sum of squares is the population variance times the row count, so no second pass
    over the mean is needed. For a constant label R2 is 1 where every prediction is right, else 0.
    """
    by = by or []
    y, p = F.col("label"), F.col("prediction")
    km = F.expm1(y) - F.expm1(p)
    return pred.groupBy(*by).agg(
        F.avg((y - p) * (y - p)).alias("mse"),
        F.var_pop(y).alias("spread"),
        F.avg(F.abs(y - p)).alias("mae_log"),
        F.avg(km * km).alias("mse_km"),
    ).select(
        *by,
        F.when(F.col("spread") > 0, 1 - F.try_divide(F.col("mse"), F.col("spread")))
        .when(F.col("mse") == 0, 1.0).when(F.col("mse").isNotNull(), 0.0).alias("r2"),
        F.sqrt("mse").alias("rmse_log"),
        "mae_log",
        F.sqrt("mse_km").alias("rmse_km"),
    )


def cv_summary(fold_scores: DataFrame, by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Mean and population deviation of the fold scores."""
    return fold_scores.groupBy(*(by or ["model"])).agg(
        F.round(F.avg("score"), digits).alias("cv_mean"),
        F.round(F.stddev_pop("score"), digits).alias("cv_std"),
    )


def residuals(pred: DataFrame) -> DataFrame:
    return pred.withColumn("residual", F.col("label") - F.col("prediction"))


def predicted_vs_actual_km(pred: DataFrame) -> DataFrame:
    """Actual and predicted distance in millions of kilometres."""
    return pred.withColumns({
        "actual_mkm": F.expm1("label") / 1e6,
        "predicted_mkm": F.expm1("prediction") / 1e6,
    })


def binned_2d(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Counts on a fixed grid: the table behind a scatter plot of any number of rows."""
    return df.groupBy(
        F.floor(F.col(x) / x_width).alias("x_bin"), F.floor(F.col(y) / y_width).alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("count"))

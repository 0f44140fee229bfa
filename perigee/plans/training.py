"""Baseline models, evaluation and cross-validation on MLlib."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators.balance import synthetic_training_rows, weight_column, with_synthetic
from perigee.operators.metrics import auc_roc, classification_metrics, regression_metrics
from perigee.operators.splits import SEED, kfold, stratified_kfold
from perigee.plans.bagging import BaggedModel, fit_forests
from perigee.plans.boosting import BoostedModel, Lane, f1_weighted, fit_lanes, r2
from perigee.schema import CLF_FEATURES, REG_FEATURES

CLASSIFIERS = ["LogisticRegression", "RandomForestClassifier", "GradientBoostingClassifier"]
REGRESSORS = ["LinearRegression", "RandomForestRegressor", "GradientBoostingRegressor"]
KERNEL_CLASSIFIER = "SVC"
CLF_METRICS = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "auc_roc"]
REG_METRICS = ["r2", "rmse_log", "mae_log", "rmse_km"]
#: Rows of a partition up to MOST_PARTITIONS of them; then that many partitions grow to LARGE_PARTITION rows before
#: there are more. Every pass of a fit costs a task per partition, and each forest task sends the sums of all open nodes.
ROWS_PER_CORE = 10_000
MOST_PARTITIONS = 24
LARGE_PARTITION = 2_000_000


def features_of(task: str) -> list[str]:
    return CLF_FEATURES if task == "clf" else REG_FEATURES


def models_of(task: str) -> list[str]:
    return CLASSIFIERS if task == "clf" else REGRESSORS


@dataclass(frozen=True)
class Settings:
    """Sizes of the baseline models. Trees are cut at MLlib's histogram bins and at ``forest_depth``."""

    forest_trees: int = 20
    cv_forest_trees: int = 50
    forest_depth: int = 12
    boosted_trees: int = 100
    boosted_depth: int = 3
    learning_rate: float = 0.1
    max_bins: int = 64
    max_iter: int = 1000
    fourier_terms: int = 100
    kernel_iter: int = 100
    seed: int = SEED


def fourier_stage(features: list[str], terms: int, seed: int) -> tuple[SQLTransformer, list[str]]:
    """Random Fourier features of the RBF kernel with gamma = 1 / features, for unit-variance inputs.

    A linear machine on these columns approximates the kernel machine and trains as a distributed
    sum over rows.
    """
    rng = np.random.default_rng(seed)
    gamma = 1.0 / len(features)
    directions = rng.normal(0.0, math.sqrt(2 * gamma), (terms, len(features)))
    offsets = rng.uniform(0.0, 2 * math.pi, terms)
    scale = math.sqrt(2.0 / terms)
    names = [f"rff_{i}" for i in range(terms)]
    columns = []
    for name, row, offset in zip(names, directions.tolist(), offsets.tolist()):
        inner = " + ".join(f"({w!r}D) * `{c}`" for w, c in zip(row, features))
        columns.append(f"({scale!r}D) * cos({inner} + ({offset!r}D)) AS {name}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__"), names


def estimator(name: str, rows: int, settings: Settings, overrides: dict | None = None) -> Estimator:
    """Assembler plus model. ``rows`` fixes the ridge strength of the logistic model."""
    s = settings
    tree = {"maxBins": s.max_bins, "seed": s.seed, "checkpointInterval": 10}
    forest = {**tree, "numTrees": s.forest_trees, "maxDepth": s.forest_depth}
    boosted = {**tree, "maxIter": s.boosted_trees, "maxDepth": s.boosted_depth, "stepSize": s.learning_rate}
    features = CLF_FEATURES if name in (*CLASSIFIERS, KERNEL_CLASSIFIER) else REG_FEATURES
    before, columns = [], features
    if name == "LogisticRegression":
        model = LogisticRegression(maxIter=s.max_iter, weightCol="weight", regParam=1.0 / max(rows, 1),
                                   standardization=False)
    elif name == "RandomForestClassifier":
        model = RandomForestClassifier(weightCol="weight", featureSubsetStrategy="sqrt", **forest)
    elif name == "GradientBoostingClassifier":
        model = GBTClassifier(featureSubsetStrategy="all", **boosted)
    elif name == KERNEL_CLASSIFIER:
        stage, columns = fourier_stage(features, s.fourier_terms, s.seed)
        before = [stage]
        model = LinearSVC(weightCol="weight", maxIter=s.kernel_iter, regParam=1.0 / max(rows, 1), standardization=False)
    elif name == "LinearRegression":
        model = LinearRegression(solver="normal")
    elif name == "RandomForestRegressor":
        model = RandomForestRegressor(featureSubsetStrategy="all", **forest)
    elif name == "GradientBoostingRegressor":
        model = GBTRegressor(featureSubsetStrategy="all", **boosted)
    else:
        raise ValueError(f"unknown model {name}")
    if overrides:
        model = model.copy({model.getParam(k): v for k, v in overrides.items()})
    return Pipeline(stages=[*before, VectorAssembler(inputCols=list(columns), outputCol="features"), model])


def training_rows(df: DataFrame, task: str, *more: str) -> DataFrame:
    """Features, label and (for classifiers) the balanced class weight, and more columns."""
    if task == "reg":
        return df.select(*REG_FEATURES, "label", *more)
    return df.select(*CLF_FEATURES, "label", weight_column(df, "label").alias("weight"), *more)


def fit_partitions(n: int) -> int:
    """Partitions of n training rows, by their number alone."""
    return max(1, min(math.ceil(n / ROWS_PER_CORE), MOST_PARTITIONS), math.ceil(n / LARGE_PARTITION))


@contextmanager
def cached_rows(df: DataFrame, task: str) -> Iterator[tuple[DataFrame, int]]:
    """Training rows held in memory or on disk for the passes of a fit, and their number.

    MLlib draws bags and subsamples by partition and place, so rows are dealt by key into a number of partitions that
    follows from the row count alone, and sorted there: the same rows give the same draws on any cluster. Forests draw
    by row_key, which is kept.
    """
    key = [c for c in ("row_key",) if c in df.columns]
    rows, n = training_rows(df, task, *key), df.count()
    plain = [c for c in rows.columns if c not in key]
    rows = rows.repartition(fit_partitions(n), *(key or plain)).sortWithinPartitions(*key, *plain)
    rows = rows.select(*plain, *key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows, n
    finally:
        rows.unpersist()


def fit(name: str, task: str, train: DataFrame, settings: Settings, overrides: dict | None = None) -> PipelineModel:
    with cached_rows(train, task) as (rows, n):
        return fit_rows(name, rows, n, settings, overrides)


def fit_rows(name: str, rows: DataFrame, n: int, settings: Settings, overrides: dict | None = None) -> PipelineModel:
    """Fit on training rows. Boosted models and forests with the sizes of the settings are fitted as one lane: a round or
    level of MLlib costs jobs over the rows as objects, a lane sums binned rows as arrays."""
    if overrides or not name.startswith(("GradientBoosting", "RandomForest")):
        return estimator(name, n, settings, overrides).fit(rows)
    s, task = settings, "clf" if name in CLASSIFIERS else "reg"
    features, loss = features_of(task), "logistic" if task == "clf" else "squared"
    if name.startswith("RandomForest"):
        lane = Lane(0, s.forest_trees, s.forest_depth, 1.0 / s.forest_trees)
        key = F.col("row_key") if "row_key" in rows.columns else F.xxhash64(*rows.columns)  # equal rows are drawn alike
        rows = rows.withColumns({"part": F.lit(0), "row_key": key})
        model = BaggedModel(fit_forests(rows, features, [lane], loss, bins=s.max_bins, per_node=per_node(task), seed=s.seed).model(0))
    else:
        lane = Lane(0, s.boosted_trees, s.boosted_depth, s.learning_rate)
        # every round draws all rows, so their keys tell nothing
        rows = rows.withColumns({"part": F.lit(0), "row_key": F.lit(0)})
        model = BoostedModel(fit_lanes(rows, features, [lane], loss, bins=s.max_bins).model(0))
    return PipelineModel([VectorAssembler(inputCols=features, outputCol="features"), model])


def per_node(task: str) -> int:
    """Features that a forest tries at a split: all for values, the root of their number for classes."""
    return math.ceil(math.sqrt(len(CLF_FEATURES))) if task == "clf" else len(REG_FEATURES)


def predictions(model: PipelineModel, df: DataFrame, task: str) -> DataFrame:
    """label, prediction and score (probability of class 1, or the margin where the model has none).

    A split is few files, read by few tasks, so its rows are dealt by their number.
    """
    parts = fit_partitions(df.count())
    out = model.transform(df.repartition(parts) if parts > 1 else df)
    keep = [c for c in ("row_key", "approach_id", "split") if c in df.columns]
    if task == "reg":
        return out.select(*keep, "label", "prediction")
    score = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(
        *keep,
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array(score)[1].alias("score"),
    )


def evaluate(model: PipelineModel, df: DataFrame, task: str) -> dict[str, float]:
    """Metrics of one model, rounded as they are published."""
    if task == "reg":
        row = regression_metrics(predictions(model, df, task)).first().asDict()
        return {m: round(row[m], 2 if m == "rmse_km" else 4) for m in REG_METRICS}
    pred = predictions(model, df, task).select("label", "prediction", "score")
    pred = pred.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        row = {**classification_metrics(pred).first().asDict(), **auc_roc(pred).first().asDict()}
    finally:
        pred.unpersist()
    return {m: round(row[m], 4) for m in CLF_METRICS}


@dataclass
class Trained:
    """Fitted models of one task and their validation metrics, in listing order."""

    task: str
    models: dict[str, PipelineModel] = field(default_factory=dict)
    metrics: list[dict] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        return metrics_table(spark, self.task, self.metrics)


def metrics_table(spark: SparkSession, task: str, rows: list[dict]) -> DataFrame:
    """One row per model; ``position`` is the listing order that breaks ties."""
    names = CLF_METRICS if task == "clf" else REG_METRICS
    schema = "task string, position int, model string, " + ", ".join(f"{m} double" for m in names)
    data = [(task, i, r["model"], *[r[m] for m in names]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def train_and_score(task: str, train: DataFrame, val: DataFrame, settings: Settings, names: list[str] | None = None) -> Trained:
    """Fit every baseline, measure it on the validation rows and time the fit."""
    result = Trained(task)
    with cached_rows(train, task) as (rows, n):
        for name in names or models_of(task):
            began = time.perf_counter()
            model = fit_rows(name, rows, n, settings)
            seconds = round(time.perf_counter() - began, 2)
            result.models[name] = model
            result.metrics.append({"model": name, **evaluate(model, val, task), "train_time_s": seconds})
    return result


def evaluate_all(trained: Trained, test: DataFrame) -> list[dict]:
    """Test metrics of every fitted model."""
    return [{"model": name, **evaluate(model, test, trained.task)} for name, model in trained.models.items()]


def run_together(spark: SparkSession, jobs: list[Callable], parallelism: int) -> list:
    """Run independent driver-side fits at once so that small Spark jobs overlap."""
    pool = ThreadPool(max(1, min(parallelism, len(jobs))))
    try:
        return pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs)
    finally:
        pool.close()


def cross_validate(
    task: str,
    train: DataFrame,
    names: list[str],
    settings: Settings,
    k: int = 5,
    key: str = "row_key",
    parallelism: int = 4,
    resample: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """model, fold, score: weighted F1 or R2 on each left-out fold.

    Folds are drawn from the rows given, so from oversampled rows if ``train`` is oversampled.
    ``resample`` maps (kept rows, left-out rows) to what is fitted and scored, which allows
    oversampling inside the fold instead.
    """
    spark = train.sparkSession
    settings = Settings(**{**settings.__dict__, "forest_trees": settings.cv_forest_trees})
    folded = stratified_kfold(train, k, "label", key) if task == "clf" else kfold(train, k, key)
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)

    def score(name: str, fold: int) -> tuple[str, int, float]:
        kept, left_out = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        if resample:
            kept, left_out = resample(kept, left_out)
        model = fit(name, task, kept, settings)
        pred = predictions(model, left_out, task)
        if task == "clf":
            return name, fold, classification_metrics(pred).first()["f1_weighted"]
        return name, fold, regression_metrics(pred).first()["r2"]

    def lanes(name: str) -> list[tuple[str, int, float]]:
        """All folds in one pass: a fold is the part of the rows that its lane leaves out."""
        s, features, measure = settings, features_of(task), f1_weighted if task == "clf" else r2
        loss = "logistic" if task == "clf" else "squared"
        if name.startswith("GradientBoosting"):
            fitted = [Lane(f, s.boosted_trees, s.boosted_depth, s.learning_rate, held=f) for f in range(k)]
            scores = fit_lanes(folded, features, fitted, loss, "fold", key, s.max_bins).scores()
        else:
            fitted = [Lane(f, s.forest_trees, s.forest_depth, 1.0 / s.forest_trees, held=f) for f in range(k)]
            scores = fit_forests(folded, features, fitted, loss, "fold", key, s.max_bins, per_node(task), s.seed).scores
        return [(name, f, measure(x)) for f, x in sorted(scores.items())]

    at_once = [n for n in names if n.startswith(("GradientBoosting", "RandomForest")) and not resample]
    jobs = [lambda n=n: lanes(n) for n in at_once]
    jobs += [lambda n=n, f=f: [score(n, f)] for n in names if n not in at_once for f in range(k)]
    try:
        rows = [r for found in run_together(spark, jobs, parallelism) for r in found]
    finally:
        folded.unpersist()
    return spark.createDataFrame(rows, "model string, fold int, score double")


def oversample_inside(k: int = 5, seed: int = SEED) -> Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """A ``resample`` step: grow the kept rows of each fold, score real left-out rows only."""
    def resample(kept: DataFrame, left_out: DataFrame) -> tuple[DataFrame, DataFrame]:
        real = kept.where(~F.col("synthetic"))
        new = synthetic_training_rows(real, CLF_FEATURES, "label", "approach_id", k, seed)
        grown = with_synthetic(real, new, CLF_FEATURES, "label", "approach_id")
        return grown, left_out.where(~F.col("synthetic"))

    return resample


def feature_importance(model: PipelineModel, task: str, spark: SparkSession) -> DataFrame:
    """Importance of each feature in a tree model, largest first."""
    tree = model.stages[-1]
    values = tree.featureImportances.toArray().tolist()
    rows = list(zip(features_of(task), values))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

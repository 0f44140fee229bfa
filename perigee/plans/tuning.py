"""Seeded random search over model parameters and the final refit."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.columns import hash_text, hash_uniform
from perigee.operators.splits import SEED
from perigee.plans.boosting import Boosted, Fits, Lane, f1_weighted, fit_lanes, rmse
from perigee.plans.training import Settings, evaluate, features_of, fit, run_together


@dataclass(frozen=True)
class Param:
    """One dimension of a search space: int, float, log (log-uniform float) or choice."""

    name: str
    kind: str
    low: float = 0.0
    high: float = 1.0
    choices: tuple[str, ...] = ()

    def column(self, u: Column) -> Column:
        if self.kind == "int":
            return (F.lit(int(self.low)) + F.floor(u * F.lit(int(self.high - self.low + 1)))).cast("int")
        if self.kind == "float":
            return F.lit(self.low) + u * F.lit(self.high - self.low)
        if self.kind == "log":
            low, high = math.log(self.low), math.log(self.high)
            return F.exp(F.lit(low) + u * F.lit(high - low))
        options = F.array(*[F.lit(c) for c in self.choices])
        return options[F.floor(u * F.lit(len(self.choices))).cast("int")]


# Search spaces and which baselines may be tuned.
BOOSTED_SPACE = [
    Param("n_estimators", "int", 100, 500),
    Param("max_depth", "int", 3, 8),
    Param("learning_rate", "log", 1e-3, 0.3),
    Param("min_samples_split", "int", 2, 20),
    Param("subsample", "float", 0.6, 1.0),
]
FOREST_SPACE = [
    Param("n_estimators", "int", 100, 500),
    Param("max_depth", "int", 3, 20),
    Param("min_samples_split", "int", 2, 20),
    Param("min_samples_leaf", "int", 1, 10),
    Param("max_features", "choice", choices=("sqrt", "log2")),
]
TRIALS = 50
TUNABLE = {
    "GradientBoostingClassifier": BOOSTED_SPACE,
    "GradientBoostingRegressor": BOOSTED_SPACE,
}
FOREST_TUNABLE = {
    "RandomForestClassifier": FOREST_SPACE,
    "RandomForestRegressor": FOREST_SPACE,
}


def sample_params(spark: SparkSession, space: list[Param], n: int = TRIALS, seed: int = SEED) -> DataFrame:
    """``n`` seeded draws, one column per parameter."""
    draws = spark.range(n).withColumnRenamed("id", "trial")
    return draws.select("trial", *[
        p.column(hash_uniform(hash_text(f"{seed}:{p.name}", "trial"), 0)).alias(p.name) for p in space
    ])


def mllib_params(name: str, params: dict) -> dict:
    """Search parameters in MLlib terms.

    MLlib has no minimum rows to split; half of it, as the minimum rows of a child, is the nearest.
    """
    per_child = max(1, math.ceil(params.get("min_samples_split", 2) / 2))
    per_child = max(per_child, params.get("min_samples_leaf", 1))
    out = {"maxDepth": int(params["max_depth"]), "minInstancesPerNode": int(per_child)}
    if name.startswith("GradientBoosting"):
        out |= {"maxIter": int(params["n_estimators"]), "stepSize": float(params["learning_rate"]),
                "subsamplingRate": float(params["subsample"])}
    else:
        out |= {"numTrees": int(params["n_estimators"]), "featureSubsetStrategy": params["max_features"]}
    return out


@dataclass
class Tuned:
    """Result of a search: the refitted model, its parameters, and every trial."""

    name: str
    model: PipelineModel
    params: dict
    trials: DataFrame | None = None


def hyper_search(
    name: str,
    task: str,
    train: DataFrame,
    val: DataFrame,
    settings: Settings,
    space: list[Param],
    n: int = TRIALS,
    seed: int = SEED,
    parallelism: int = 4,
) -> DataFrame:
    """One row per trial with its parameters and validation value (weighted F1, or RMSE in log space)."""
    spark = train.sparkSession
    draws = sample_params(spark, space, n, seed)
    value = "f1_weighted" if task == "clf" else "rmse_log"

    def run(params: dict) -> tuple[int, float]:
        model = fit(name, task, train, settings, mllib_params(name, params))
        return params["trial"], evaluate(model, val, task)[value]

    jobs = [lambda p=row.asDict(): run(p) for row in draws.collect()]
    scores = spark.createDataFrame(run_together(spark, jobs, parallelism), "trial long, value double")
    return draws.join(F.broadcast(scores), "trial")


def boosted_lane(number: int, params: dict, held: int = 1) -> Lane:
    return Lane(number, int(params["n_estimators"]), int(params["max_depth"]), float(params["learning_rate"]),
                int(params["min_samples_split"]), float(params["subsample"]), held)


def _part(df: DataFrame, task: str, part: int) -> DataFrame:
    return df.select(*features_of(task), "label", "row_key", F.lit(part).alias("part"))


def boosted_search(
    task: str, train: DataFrame, val: DataFrame, space: list[Param] | None = None, n: int = TRIALS, seed: int = SEED
) -> tuple[DataFrame, Fits]:
    """hyper_search for boosted models, all trials in one pass over the binned rows; and the fitted trials."""
    spark = train.sparkSession
    draws = sample_params(spark, space or BOOSTED_SPACE, n, seed)
    lanes = [boosted_lane(r["trial"], r.asDict()) for r in draws.orderBy("trial").collect()]
    rows = _part(train, task, 0).unionByName(_part(val, task, 1))
    fits = fit_lanes(rows, features_of(task), lanes, "logistic" if task == "clf" else "squared")
    value = f1_weighted if task == "clf" else rmse
    scores = spark.createDataFrame([(i, value(s)) for i, s in fits.scores().items()], "trial long, value double")
    return draws.join(F.broadcast(scores), "trial"), fits


def boosted_refit(task: str, rows: DataFrame, params: dict) -> Boosted:
    """One boosted model of these parameters on all rows."""
    fits = fit_lanes(_part(rows, task, 0), features_of(task), [boosted_lane(0, params)], "logistic" if task == "clf" else "squared")
    return fits.model(0)


def best_trial(trials: DataFrame, task: str) -> dict:
    order = F.desc("value") if task == "clf" else F.asc("value")
    row = trials.orderBy(order, "trial").first().asDict()
    return {k: v for k, v in row.items() if k not in ("trial", "value")}


def refit_on_trainval(name: str, task: str, train: DataFrame, val: DataFrame, settings: Settings, params: dict) -> PipelineModel:
    return fit(name, task, train.unionByName(val), settings, mllib_params(name, params))


def tune(
    name: str,
    task: str,
    baseline: PipelineModel,
    train: DataFrame,
    val: DataFrame,
    settings: Settings,
    tunable: dict[str, list[Param]] | None = None,
    n: int = TRIALS,
    parallelism: int = 4,
) -> Tuned:
    """Search and refit on train plus validation; a model outside ``tunable`` is taken over unchanged."""
    tunable = TUNABLE if tunable is None else tunable
    if name not in tunable:
        return Tuned(name, baseline, {})
    trials = hyper_search(name, task, train, val, settings, tunable[name], n, settings.seed, parallelism)
    trials = trials.persist()
    params = best_trial(trials, task)
    model = refit_on_trainval(name, task, train, val, settings, params)
    return Tuned(name, model, {**params, "random_state": settings.seed}, trials)

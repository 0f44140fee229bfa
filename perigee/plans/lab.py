"""Shared state of the registered model queries: one preparation and one fit per model and session."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from perigee.operators.ranking import select_best, selection_score
from perigee.plans.preprocess import Prepared, prepare
from perigee.plans.scoring import Scorer
from perigee.plans.training import (
    REGRESSORS,
    Settings,
    Trained,
    evaluate_all,
    fit,
    metrics_table,
    train_and_score,
)
from perigee.plans.boosting import Fits
from perigee.plans.tuning import boosted_search
from perigee.session import fresh_path, stable
from perigee.sources.approaches import load_approaches


@dataclass
class Lab:
    spark: SparkSession
    sf_dir: str
    settings: Settings = field(default_factory=Settings)
    _models: dict[str, PipelineModel] = field(default_factory=dict)

    @cached_property
    def approaches(self) -> DataFrame:
        return load_approaches(self.spark, self.sf_dir)

    @cached_property
    def prepared(self) -> Prepared:
        return prepare(self.approaches, fresh_path(self.spark, "splits"))

    def rows(self, task: str, split: str | list[str]) -> DataFrame:
        return self.prepared.load(task, split)

    def model(self, name: str) -> PipelineModel:
        if name not in self._models:
            task = "reg" if name in REGRESSORS else "clf"
            self._models[name] = fit(name, task, self.rows(task, "train"), self.settings)
        return self._models[name]

    @cached_property
    def classifiers(self) -> Trained:
        return self._train("clf")

    @cached_property
    def regressors(self) -> Trained:
        return self._train("reg")

    def _train(self, task: str) -> Trained:
        trained = train_and_score(task, self.rows(task, "train"), self.rows(task, "val"), self.settings)
        self._models.update(trained.models)
        return trained

    def trained(self, task: str) -> Trained:
        return self.classifiers if task == "clf" else self.regressors

    @cached_property
    def test_metrics(self) -> dict[str, list[dict]]:
        return {t: evaluate_all(self.trained(t), self.rows(t, "test")) for t in ("clf", "reg")}

    def test_table(self, task: str) -> DataFrame:
        return metrics_table(self.spark, task, self.test_metrics[task])

    def best(self, task: str) -> str:
        table = self.test_table(task)
        return select_best(table, selection_score() if task == "clf" else table["r2"]).first()["model"]

    @cached_property
    def search(self) -> tuple[DataFrame, Fits]:
        """Every trial of the boosted regressor over the whole space, and the fitted trials."""
        trials, fits = boosted_search("reg", self.rows("reg", "train"), self.rows("reg", "val"), seed=self.settings.seed)
        return stable(trials), fits

    @cached_property
    def scorer(self) -> Scorer:
        p = self.prepared
        return Scorer.build(
            self.model(self.best("clf")), self.model(self.best("reg")), p.scaler_clf, p.scaler_reg
        )


_LABS: dict[tuple[str, str], Lab] = {}


def lab(spark: SparkSession, sf_dir: str) -> Lab:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LABS:
        _LABS[key] = Lab(spark, sf_dir)
    return _LABS[key]

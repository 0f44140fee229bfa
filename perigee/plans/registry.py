"""Every registered query: (session, table folder) to DataFrame, over whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.columns import (
    flag_to_int,
    humanise,
    log_to_km,
    parse_bool,
    probability_band,
    with_features,
)
from perigee.operators import balance, browse, joins, metrics, neighbours, objects, quality, ranking, scaling, splits, stats
from perigee.plans import card, checks, forest, rules, training, tuning
from perigee.plans.lab import lab
from perigee.plans.preprocess import feature_view, modelling_table
from perigee.plans.scoring import Scorer
from perigee.schema import CLF_FEATURES, ENGINEERED, NUMERIC_COLUMNS, RAW_COLUMNS, REG_FEATURES
from perigee.session import fresh_path, stable
from perigee.sources import approaches as src
from perigee.sources import tables
from perigee.streaming.scoring import score_stream
from perigee.streaming.upsert import upsert_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 9, only: list[str] | None = None) -> DataFrame:
    """Double columns rounded, so that two engines agree on the last digits."""
    names = [c for c, t in df.dtypes if t == "double" and (only is None or c in only)]
    return df.withColumns({c: F.round(c, digits) for c in names})


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_features(src.load_approaches(spark, sf_dir))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_split(modelling_table(src.load_approaches(spark, sf_dir)))


def _minority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rare = _split(spark, sf_dir).where((F.col("split") == "train") & (F.col("hazardous") == 1))
    return stable(rare.select("approach_id", *CLF_FEATURES))


# --- sources and sinks -------------------------------------------------------


@query
def src1_read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with padded headers and text flags, written and read back with the declared types."""
    raw = src.raw_view(src.load_approaches(spark, sf_dir))
    text = raw.withColumns({c: F.initcap(F.col(c).cast("string")) for c in ("sentry_object", "hazardous")})
    path = fresh_path(spark, "raw-csv")
    text = text.select(*reversed(text.columns))  # read_raw goes by name
    text.toDF(*[f" {c.upper()} " for c in text.columns]).write.option("header", True).csv(path)
    return src.read_raw(spark, path)


@query
def src2_normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = src.raw_view(src.load_approaches(spark, sf_dir))
    return src.normalize_columns(raw.toDF(*[f"  {c.title()} " for c in raw.columns]))


@query
def src3_parse_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("est_diameter_min")
    text = (
        F.when(d > 0.08, "TRUE").when(d > 0.05, "False").when(d > 0.03, "yes").when(d > 0.02, "1")
        .when(d > 0.01, "true").otherwise("t")
    )
    return src.load_approaches(spark, sf_dir).select("approach_id", text.alias("text")).withColumn(
        "flag", parse_bool("text"))


@query
def src4_flag_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = src.load_approaches(spark, sf_dir)
    return a.select(
        "approach_id", flag_to_int("hazardous").alias("hazardous"),
        flag_to_int(F.upper(F.col("sentry_object").cast("string"))).alias("sentry"),
    )


@query
def snk1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe approaches are loaded first, hazardous ones arrive as the second batch."""
    a = src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS)
    loaded = objects.last_per_key(browse.safe(a), "approach_id")
    return objects.upsert(loaded, browse.hazardous(a), "approach_id")


@query
def snk2_append_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = src.load_approaches(spark, sf_dir)
    path = fresh_path(spark, "features")
    safe, hazardous = (tables.feature_rows(part, "approach_id") for part in (browse.safe(a), browse.hazardous(a)))
    for name, rows in (("safe", safe), ("hazardous", hazardous), ("safe", safe)):  # a batch that comes again adds nothing
        tables.append_features(rows, path, name)
    return rounded(tables.read_features(spark, path, safe.schema))


@query
def snk3_create_table_if_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "feature-table")
    name = "features_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        tables.create_table_if_missing(spark, name, location=path)
    tables.feature_rows(src.load_approaches(spark, sf_dir)).write.insertInto(name)
    return spark.table(name).groupBy("sourceNeoId", "hazardous").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("diameter_avg"), 9).alias("diameter_sum"))


def _split_store(spark: SparkSession, sf_dir: str) -> str:
    """Unscaled split rows of both tasks, written in the store's layout."""
    split = _split(spark, sf_dir)
    both = reduce(DataFrame.unionByName, [
        split.select(F.lit(task).alias("task"), "split", "approach_id", F.col(label).cast("double").alias("label"),
                     *REG_FEATURES)
        for task, label in (("clf", "hazardous"), ("reg", "log_miss_distance"))
    ])
    path = fresh_path(spark, "split-store")
    tables.write_splits(both, path)
    return path


@query
def snk4_write_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = tables.load_splits(spark, _split_store(spark, sf_dir))
    return rounded(store.groupBy("task", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("label").alias("label_mean"), F.sum("approach_id").alias("id_sum")))


@query
def src5_load_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tables.load_splits(spark, _split_store(spark, sf_dir), "reg", ["val", "test"]))


@query
def snk6_metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = rules.class_rules(src.load_approaches(spark, sf_dir))
    wide = rounded(metrics.classification_metrics(pred, ["model"]))
    path = fresh_path(spark, "metrics")
    tables.write_metrics(
        tables.long_metrics(wide, "clf", "all", ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted"]), path)
    return tables.read_metrics(spark, path)


# --- projections, filters, quality -------------------------------------------


@query
def prj1_drop_non_predictive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.drop_non_predictive(src.raw_view(src.load_approaches(spark, sf_dir)))


@query
def prj2_drop_superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    engineered = with_features(browse.drop_non_predictive(src.raw_view(src.load_approaches(spark, sf_dir))))
    return rounded(browse.drop_superseded(engineered))


@query
def prj3_feature_view_clf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_view(modelling_table(src.load_approaches(spark, sf_dir)), "clf", "approach_id"))


@query
def prj3_feature_view_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_view(modelling_table(src.load_approaches(spark, sf_dir)), "reg", "approach_id"))


@query
def prj4_card_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.card_view(src.load_approaches(spark, sf_dir))


@query
def flt1_hazardous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.hazardous(src.load_approaches(spark, sf_dir)).select("approach_id", *RAW_COLUMNS)


@query
def flt2_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.safe(src.load_approaches(spark, sf_dir)).select("approach_id", *RAW_COLUMNS)


@query
def flt3_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.by_id(src.load_approaches(spark, sf_dir), 2000007).select("approach_id", *RAW_COLUMNS)


@query
def flt3_by_many_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First approach of every object that was ever hazardous."""
    a = src.load_approaches(spark, sf_dir)
    return browse.first_of_each(a, browse.hazardous(a)).select("approach_id", *RAW_COLUMNS)


@query
def flt4_search_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.search_name(src.load_approaches(spark, sf_dir), " 201[0-4] .q ").select("approach_id", "id", "name")


@query
def flt4_search_name_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.search_name(src.load_approaches(spark, sf_dir), "(2003 d", literal=True).select(
        "approach_id", "id", "name")


@query
def dq1_expect_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()  # one approach per event
    return quality.expect_shape(src.raw_view(src.load_approaches(spark, sf_dir)), events, 10)


@query
def dq2_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(src.raw_view(src.load_approaches(spark, sf_dir)))


@query
def dq3_expect_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_positive(src.load_approaches(spark, sf_dir), ["est_diameter_min"])


@query
def dq4_expect_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finite check on the features of shifted diameters, where some ratios have a zero divisor."""
    shifted = src.load_approaches(spark, sf_dir).withColumn(
        "est_diameter_min", F.greatest(F.col("est_diameter_min") - 0.01, F.lit(0.0)))
    return quality.expect_finite(with_features(shifted), [*ENGINEERED, "absolute_magnitude"])


@query
def dq5_validate_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifted inputs that break every rule somewhere; accepted rows have no errors."""
    shifted = src.load_approaches(spark, sf_dir).withColumns({
        "est_diameter_min": F.col("est_diameter_min") - 0.01,
        "est_diameter_max": F.col("est_diameter_max") - 0.05,
        "relative_velocity": F.when(F.col("approach_id") % 41 != 0, F.col("relative_velocity") - 20000.0),
        "miss_distance": F.when(F.col("approach_id") % 43 == 0, float("nan")).otherwise(F.col("miss_distance") - 1000000.0),
        "absolute_magnitude": F.when(F.col("approach_id") % 53 == 0, float("nan")).when(
            F.col("approach_id") % 47 != 0, F.col("absolute_magnitude") - 20.0),
    })
    checked = quality.validate_inputs(shifted, strict=True)
    return checked.select(
        "approach_id", F.concat_ws("; ", "errors").alias("errors"), (F.size("errors") == 0).alias("accepted"))


@query
def dq6_check_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names on file without a hazardous approach far out."""
    a = src.load_approaches(spark, sf_dir)
    present = browse.hazardous(a).where(F.col("miss_distance") > 60000000.0)
    return quality.check_manifest(a.select("name").distinct(), present)


@query
def dq7_check_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = rules.class_rule(src.load_approaches(spark, sf_dir))
    scored = pred.select(F.col("score").alias("hazardous_probability"), (F.col("score") - 0.1).alias("miss_distance_km"))
    return quality.check_scores(scored)


# --- joins -------------------------------------------------------------------


def _linked_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Feature rows whose source is missing for large objects, and an object table without far ones."""
    a = src.load_approaches(spark, sf_dir)
    linked = a.select(
        "approach_id",
        F.when(F.col("est_diameter_min") <= 0.1, F.col("id")).alias("sourceNeoId"),
        "absolute_magnitude",
    )
    held = objects.last_per_key(a, "approach_id").where(F.col("miss_distance") < 60000000.0)
    return linked, held


@query
def jn1_features_with_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked, held = _linked_features(spark, sf_dir)
    return joins.features_with_source(linked, held, F.col("approach_id"))


@query
def jn1_orphan_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked, held = _linked_features(spark, sf_dir)
    return joins.orphan_features(linked, held, F.col("approach_id"))


@query
def jn2_align_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression rows matched to the split found on the classification label."""
    table = modelling_table(src.load_approaches(spark, sf_dir))
    split = splits.stratified_split(table).select("approach_id", "split")
    return rounded(joins.align_rows(feature_view(table, "reg", "approach_id"), split))


@query
def jn3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.nearest_neighbours(_minority(spark, sf_dir), "approach_id", CLF_FEATURES)
    return rounded(neighbours.neighbour_pairs(found, "approach_id"))


@query
def jn4_new_and_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per object id of the whole table: is it already in the table of near, hazardous objects?"""
    a = src.load_approaches(spark, sf_dir)
    target = browse.hazardous(a).where(F.col("miss_distance") < 5000000.0).select("id").distinct()
    objects_seen = a.groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    new = objects_seen.join(target, "id", "left_anti").withColumn("state", F.lit("new"))
    known = objects_seen.join(target, "id", "left_semi").withColumn("state", F.lit("known"))
    return new.unionByName(known)


@query
def jn5_attach_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs and prediction in one row: scoring keeps the input columns."""
    a = src.load_approaches(spark, sf_dir)
    score = next(e for n, e, _ in rules.CLASS_RULES if n == "size")
    return a.select("approach_id", *NUMERIC_COLUMNS).withColumn(
        "hazardous_probability", F.expr(score).cast("double")
    ).withColumn("hazardous", F.col("hazardous_probability") > 0.16)


# --- aggregations ------------------------------------------------------------


@query
def agg1_dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dataset_stats(src.load_approaches(spark, sf_dir))


@query
def agg2_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.describe(src.load_approaches(spark, sf_dir), NUMERIC_COLUMNS), 5)


@query
def agg2_describe_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.describe(_features(spark, sf_dir), CLF_FEATURES), 5)


@query
def agg3_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.value_counts(src.load_approaches(spark, sf_dir), "name")


@query
def agg3_value_counts_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.value_counts(src.load_approaches(spark, sf_dir), "orbiting_body")


@query
def agg4_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.class_balance(_split(spark, sf_dir), "split"))


@query
def agg5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.profile(src.raw_view(src.load_approaches(spark, sf_dir)))


@query
def agg6_fit_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    return rounded(scaling.scaler_table(train, CLF_FEATURES))


@query
def agg7_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(rules.class_rules(src.load_approaches(spark, sf_dir)), ["model"])


@query
def agg8_normalised_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.normalised_confusion(rules.class_rules(src.load_approaches(spark, sf_dir)), ["model"]))


@query
def agg9_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = rules.class_rules(src.load_approaches(spark, sf_dir))
    return rounded(metrics.classification_metrics(pred, ["model"]).select("model", "accuracy"))


@query
def agg10_weighted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.classification_metrics(rules.class_rules(src.load_approaches(spark, sf_dir)), ["model"]))


@query
def agg11_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.classification_report(rules.class_rules(src.load_approaches(spark, sf_dir)), ["model"])
    return rounded(report.drop("position"))


@query
def agg12_auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.auc_roc(rules.class_rule(src.load_approaches(spark, sf_dir))))


@query
def agg13_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.regression_metrics(rules.distance_rules(src.load_approaches(spark, sf_dir)), ["model"])
    return rounded(found.drop("rmse_km"))


@query
def agg14_rmse_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.regression_metrics(rules.distance_rules(src.load_approaches(spark, sf_dir)), ["model"])
    return found.select("model", F.round("rmse_km", 2).alias("rmse_km"))


@query
def agg15_cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold scores of the fixed rules on stratified folds."""
    folds = splits.stratified_kfold(src.load_approaches(spark, sf_dir))
    scores = metrics.classification_metrics(rules.class_rules(folds, "fold"), ["model", "fold"])
    return metrics.cv_summary(scores.withColumnRenamed("f1_weighted", "score"))


@query
def agg16_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rules.class_rule(src.load_approaches(spark, sf_dir)).withColumn("hazardous", F.col("prediction") == 1)
    return stats.batch_summary(scored)


# --- windows, curves, ranking -------------------------------------------------


@query
def win1_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_curve(rules.class_rule(src.load_approaches(spark, sf_dir))), 9, ["fpr", "tpr"])


@query
def win1_roc_curve_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = rules.class_rule(src.load_approaches(spark, sf_dir))
    return rounded(metrics.roc_curve(pred, drop_intermediate=True), 9, ["fpr", "tpr"])


@query
def win2_precision_recall_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.precision_recall_curve(rules.class_rule(src.load_approaches(spark, sf_dir))))


def _rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows of the fixed rules, classification and distance rules in one table."""
    a = src.load_approaches(spark, sf_dir)
    measured = metrics.classification_metrics(rules.class_rules(a), ["position", "model"])
    areas = metrics.auc_roc(rules.class_rules(a), ["model"])
    clf = measured.join(F.broadcast(areas), "model").select(
        F.lit("clf").alias("task"), "position", "model", "f1_weighted", "auc_roc")
    reg = metrics.regression_metrics(rules.distance_rules(a), ["position", "model"]).select(
        F.lit("reg").alias("task"), "position", "model", "r2")
    return rounded(clf.unionByName(reg, allowMissingColumns=True), 4)


@query
def win3_rank_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_models(_rule_scores(spark, sf_dir), F.coalesce("f1_weighted", "r2"))


@query
def win4_select_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.select_best(_rule_scores(spark, sf_dir), F.coalesce(ranking.selection_score(), F.col("r2")))


@query
def win5_top2_for_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_models(_rule_scores(spark, sf_dir), F.coalesce("f1_weighted", "r2"), 2)


@query
def win6_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.residuals(rules.distance_rules(src.load_approaches(spark, sf_dir))).drop("position"))


@query
def win6_residual_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.residuals(rules.distance_rules(src.load_approaches(spark, sf_dir)))
    return metrics.binned_2d(found.where(F.col("model") == "linear"), "prediction", "residual", 0.07, 0.23)


@query
def win7_predicted_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.predicted_vs_actual_km(rules.distance_rules(src.load_approaches(spark, sf_dir)))
    return rounded(found.select("approach_id", "model", "actual_mkm", "predicted_mkm"))


# --- sort, limit, paging --------------------------------------------------------


@query
def lim1_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.page(src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS), 50, 150)


@query
def lim1_page_hazardous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = browse.hazardous(src.load_approaches(spark, sf_dir)).select("approach_id", *RAW_COLUMNS)
    return browse.page(rows, 100, 20)


@query
def lim1_far_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS)
    return browse.page(rows, 100, 700)


@query
def lim1_page_by_repeating_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page in the order of object ids, which repeat; approach ids break the ties."""
    rows = src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS)
    return browse.page(rows, 50, 333, key="id", tie="approach_id")


@query
def lim1_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.page_after(src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS), 420, 100)


@query
def lim1_page_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = browse.page_envelope(src.load_approaches(spark, sf_dir), 30, 60)
    ids = F.transform("data", lambda r: r["approach_id"].cast("string"))
    return one.select("total", "offset", "limit", "count", F.concat_ws(",", ids).alias("ids"))


@query
def lim2_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.head(src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS))


@query
def lim2_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.tail(src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS))


@query
def lim3_top_hazardous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.top_hazardous(src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS))


@query
def lim4_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.search(src.load_approaches(spark, sf_dir).select("approach_id", "id", "name"), "2010 .p")


@query
def lim4_search_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search with more matches than its limit and one without any, as one row each."""
    rows = src.load_approaches(spark, sf_dir).select("approach_id", "id", "name")
    found = [browse.search_envelope(rows, q, 5) for q in ("2010 .p", "no such name")]
    both = found[0].unionByName(found[1])
    return both.select("query", "total", "count", F.concat_ws(",", F.transform("data", lambda r: r["approach_id"].cast("string"))).alias("ids"))


# --- set operations --------------------------------------------------------------


@query
def set1_train_and_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split(spark, sf_dir)
    train, val = (split.where(F.col("split") == s) for s in ("train", "val"))
    return rounded(train.unionByName(val).select("approach_id", "split", *CLF_FEATURES, "hazardous"))


@query
def set2_originals_and_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    grown = balance.smote(train, CLF_FEATURES)
    return grown.groupBy("hazardous", "synthetic").agg(
        F.count(F.lit(1)).alias("rows"), F.count("approach_id").alias("with_source"))


# --- scalar functions --------------------------------------------------------------


@query
def fn1_diameter_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_features(spark, sf_dir).select("approach_id", "diameter_avg"), 9)


@query
def fn2_diameter_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_features(spark, sf_dir).select("approach_id", "diameter_ratio"), 9)


@query
def fn3_log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_features(spark, sf_dir).select("approach_id", *[c for c in ENGINEERED if c.startswith("log_")]))


@query
def fn4_log_to_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(
        "approach_id", F.round(log_to_km("log_miss_distance"), 2).alias("km"))


@query
def fn5_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split(spark, sf_dir)
    scaler = scaling.fit_scaler(split.where(F.col("split") == "train"), CLF_FEATURES)
    return rounded(scaler.transform(split).select("approach_id", "split", *CLF_FEATURES), 6)


@query
def fn6_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(
        "approach_id", F.round("absolute_magnitude", 3).alias("magnitude_3"),
        F.round("log_relative_velocity", 4).alias("velocity_4"), F.round("log_miss_distance", 2).alias("distance_2"))


@query
def fn7_humanise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.load_approaches(spark, sf_dir).select(
        "approach_id", humanise("relative_velocity").alias("velocity"), humanise("miss_distance").alias("distance"))


@query
def fn8_probability_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = rules.class_rule(src.load_approaches(spark, sf_dir), "magnitude")
    return pred.select("approach_id", "score", probability_band("score").alias("band"))


# --- sampling, splitting, balancing --------------------------------------------------


@query
def spl1_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_split(src.load_approaches(spark, sf_dir)).select("approach_id", "hazardous", "split")


@query
def spl2_stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_kfold(src.load_approaches(spark, sf_dir)).select("approach_id", "hazardous", "fold")


@query
def spl3_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.kfold(src.load_approaches(spark, sf_dir)).select("approach_id", "fold")


@query
def bal1_smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    return rounded(balance.synthetic_rows(train, CLF_FEATURES))


@query
def bal2_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(balance.class_weights(src.load_approaches(spark, sf_dir)))


# --- models ---------------------------------------------------------------------------


def _classifier(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fitted classifier over all validation rows."""
    state = lab(spark, sf_dir)
    return checks.classifier_holds(state.model(name), state.rows("clf", "val"), name)


def _regressor(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fitted regressor over all rows it was fitted on."""
    state = lab(spark, sf_dir)
    return checks.regressor_holds(state.model(name), state.rows("reg", "train"), name)


def _published(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """Published metrics of all six baselines next to those recomputed from their predictions."""
    state = lab(spark, sf_dir)
    told = {t: state.trained(t).metrics if split == "val" else state.test_metrics[t] for t in ("clf", "reg")}
    return reduce(DataFrame.unionByName, [
        checks.published_difference(state.model(m["model"]), state.rows(t, split), t, m) for t in told for m in told[t]])


@query
def ml8_train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation metrics of all six baselines, recomputed."""
    return _published(spark, sf_dir, "val")


@query
def ml1_logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classifier(spark, sf_dir, "LogisticRegression")


@query
def ml2_random_forest_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classifier(spark, sf_dir, "RandomForestClassifier")


def _full_forest(spark: SparkSession, sf_dir: str, task: str) -> DataFrame:
    """What the trees of a forest without a depth limit say of all the training rows they drew. Copies made for balance
    take no part, as their keys name no approach."""
    state = lab(spark, sf_dir)
    rows = state.rows(task, "train").where(~F.col("synthetic"))
    names = training.features_of(task)
    per_node = math.isqrt(len(names)) if task == "clf" else len(names)
    grown = forest.fit_forest(rows, names, "label", "row_key", state.settings.forest_trees, per_node, state.settings.seed)
    return forest.bag_check(grown, rows, "label", "row_key", state.settings.seed)


@query
def ml2_forest_to_the_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of a forest classifier, grown until all leaves are pure."""
    return _full_forest(spark, sf_dir, "clf")


@query
def ml6_forest_to_the_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of a forest regressor, grown until all labels of a leaf are equal."""
    return _full_forest(spark, sf_dir, "reg")


@query
def ml3_boosted_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classifier(spark, sf_dir, "GradientBoostingClassifier")


@query
def ml4_kernel_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classifier(spark, sf_dir, training.KERNEL_CLASSIFIER)


@query
def ml5_linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal equations of the linear fit over all rows it was fitted on."""
    state = lab(spark, sf_dir)
    return checks.least_squares_holds(state.model("LinearRegression"), state.rows("reg", "train"))


@query
def ml6_random_forest_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressor(spark, sf_dir, "RandomForestRegressor")


@query
def ml7_boosted_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressor(spark, sf_dir, "GradientBoostingRegressor")


@query
def ml9_cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five folds of the two best models of each task: what was fitted, and whether all scores are possible ones."""
    state = lab(spark, sf_dir)

    def folds(task: str, metric: str) -> DataFrame:
        table = state.trained(task).table(spark)
        names = [r["model"] for r in ranking.top_models(table, F.col(metric), 2).orderBy("rank").collect()]
        scores = training.cross_validate(task, state.rows(task, "train"), names, state.settings)
        rows = state.rows(task, "train").count()
        return scores.agg(
            F.lit(task).alias("task"), F.count_distinct("model").alias("models"), F.count(F.lit(1)).alias("fits"),
            F.lit(rows).cast("long").alias("rows"), F.bool_and((F.col("score") <= 1.0) & ~F.isnan("score")).alias("possible"))

    state.rows("clf", "train")  # both tasks read one store
    clf, reg = training.run_together(spark, [lambda: folds("clf", "f1_weighted"), lambda: folds("reg", "r2")], 2)
    return clf.unionByName(reg)


@query
def ml10_hyper_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trials of the search over boosted regressors: parameters inside their ranges, and how far the best trial's
    value is from that of its trees applied anew to the validation rows, which is least."""
    state = lab(spark, sf_dir)
    trials, fits = state.search
    val = state.rows("reg", "val")
    inside = reduce(lambda x, y: x & y, [F.col(p.name).between(p.low, p.high) for p in tuning.BOOSTED_SPACE])
    best = trials.orderBy("value", "trial").first()
    again = metrics.regression_metrics(training.predictions(fits.model(best["trial"]), val, "reg")).first()["rmse_log"]
    baseline = val.agg(F.stddev_pop("label")).first()[0]
    return trials.agg(
        F.count(F.lit(1)).alias("trials"), F.lit(val.count()).cast("long").alias("rows"), F.bool_and(inside).alias("inside"),
        F.round(F.abs(F.lit(again) - F.min("value")), 9).alias("difference"), (F.min("value") < F.lit(baseline)).alias("beats_mean"))


@query
def ml11_refit_on_trainval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of the search, refitted on train plus validation, over all rows it was fitted on."""
    state = lab(spark, sf_dir)
    rows = state.rows("reg", ["train", "val"])
    model = tuning.boosted_refit("reg", rows, tuning.best_trial(state.search[0], "reg"))
    return checks.regressor_holds(model, rows, "GradientBoostingRegressor")


@query
def ml12_evaluate_on_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test metrics of all six baselines, recomputed."""
    return _published(spark, sf_dir, "test")


@query
def ml13_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = lab(spark, sf_dir)
    table = training.feature_importance(state.model("RandomForestClassifier"), "clf", spark)
    return table.agg(F.count_distinct("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
                     F.bool_and(F.col("importance") >= 0).alias("nonnegative"))


def _card(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = lab(spark, sf_dir)
    picked = {}
    for task in ("clf", "reg"):
        name = state.best(task)
        tested = next(r for r in state.test_metrics[task] if r["model"] == name)
        picked[task] = (name, state.model(name), {"random_state": state.settings.seed}, tested)
    return card.model_card(spark, picked["clf"], picked["reg"], "2024-01-01T00:00:00")


@query
def ml14_model_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card's JSON read back: selected names and metrics as in the test table."""
    state = lab(spark, sf_dir)
    made = _card(spark, sf_dir)
    back = card.card_json(made).select(F.from_json("card", made.schema).alias("c")).select("c.*")
    told = {t: next(r for r in state.test_metrics[t] if r["model"] == state.best(t)) for t in ("clf", "reg")}
    text = card.card_json(made).select(*[F.contains("card", F.lit(told[t]["model"])).alias(t) for t in told]).first()
    return back.select(
        F.lit(bool(text["clf"] and text["reg"])).alias("names"),
        (F.col("classifier.test_f1_weighted") == F.lit(told["clf"]["f1_weighted"])).alias("classifier_metric"),
        (F.col("regressor.test_rmse_log") == F.lit(told["reg"]["rmse_log"])).alias("regressor_metric"))


@query
def ml14_metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card's metrics by name, and how far each is from the test table."""
    state = lab(spark, sf_dir)
    told = {t: next(r for r in state.test_metrics[t] if r["model"] == state.best(t)) for t in ("clf", "reg")}
    value = F.create_map(*[x for name, v in (
        ("F1 (weighted)", told["clf"]["f1_weighted"]), ("AUC-ROC", told["clf"]["auc_roc"]), ("R2", told["reg"]["r2"]),
        ("RMSE (log)", told["reg"]["rmse_log"]), ("RMSE (km)", told["reg"]["rmse_km"])) for x in (F.lit(name), F.lit(float(v)))])
    return card.metric_summary(_card(spark, sf_dir)).select("task", "metric", F.abs(F.col("value") - value[F.col("metric")]).alias("difference"))


@query
def ml15_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both heads over every approach."""
    state = lab(spark, sf_dir)
    return checks.scores_hold(state.scorer.score(state.approaches))


@query
def dq7_check_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = lab(spark, sf_dir)
    return quality.check_scores(state.scorer.score(state.approaches))


@query
def snk5_save_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all approaches from the saved and reloaded models, next to those of the models in memory."""
    state = lab(spark, sf_dir)
    path = fresh_path(spark, "models")
    state.scorer.save(path)
    return checks.scores_hold(Scorer.load(path).score(state.approaches), state.scorer.score(state.approaches))


# --- streams --------------------------------------------------------------------------


@query
def str1_score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approaches arriving as files, some with a diameter of 0: scored rows as in the batch, refused rows counted."""
    state = lab(spark, sf_dir)
    a = src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS).withColumn(
        "est_diameter_min", F.when(F.col("approach_id") % 50 == 0, 0.0).otherwise(F.col("est_diameter_min")))
    path, out, refused = (fresh_path(spark, f"stream-{n}") for n in ("landed", "scored", "refused"))
    a.repartitionByRange(4, "approach_id").write.parquet(path)
    score_stream(spark, path, a.schema, state.scorer, out, refused, fresh_path(spark, "stream-state"), max_files=2).awaitTermination()
    valid = a.where(F.col("est_diameter_min") > 0)
    held = checks.scores_hold(spark.read.parquet(out), state.scorer.score(valid))
    return held.withColumn("refused", F.lit(spark.read.parquet(refused).count()).cast("long"))


@query
def str2_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approaches in several batches of two streams; the table ends with the last approach of each object."""
    a = src.load_approaches(spark, sf_dir).select("approach_id", *RAW_COLUMNS)
    middle = a.agg(F.percentile_approx("approach_id", 0.5)).first()[0]
    root = fresh_path(spark, "stream-objects")
    for part in (a.where(F.col("approach_id") <= F.lit(middle)), a.where(F.col("approach_id") > F.lit(middle))):
        for file in range(2):  # files land one after the other, so batches keep their order
            path = fresh_path(spark, "landed")
            cut = part.agg(F.percentile_approx("approach_id", 0.5)).first()[0]
            part.where(F.col("approach_id") <= F.lit(cut) if file == 0 else F.col("approach_id") > F.lit(cut)).write.parquet(path)
            upsert_stream(spark, path, a.schema, root, "approach_id", fresh_path(spark, "stream-state")).awaitTermination()
    return objects.read_snapshot(spark, root, objects.latest_version(spark, root))

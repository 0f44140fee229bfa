"""Headline queries and pipeline stages at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perigee.operators.ranking import top_models  # noqa: E402
from perigee.plans import training  # noqa: E402
from perigee.plans.lab import Lab  # noqa: E402
from perigee.plans.registry import QUERIES  # noqa: E402
from perigee.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

PLAIN = [
    "src1_read_raw",
    "snk1_upsert",
    "snk2_append_features",
    "dq2_null_counts",
    "dq5_validate_inputs",
    "jn1_features_with_source",
    "jn3_nearest_neighbours",
    "agg1_dataset_stats",
    "agg2_describe",
    "agg11_classification_report",
    "agg12_auc_roc",
    "win1_roc_curve",
    "lim1_far_page",
    "lim4_search",
    "spl1_stratified_split",
    "spl2_stratified_kfold",
    "bal1_smote",
    "str2_upsert_stream",
]


def main() -> None:
    spark = build_session("perigee-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, job):
        began = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    timed("warm_up", lambda: drain(QUERIES["agg1_dataset_stats"](spark, SF_DIR)))
    for name in PLAIN:
        timed(name, lambda n=name: drain(QUERIES[n](spark, SF_DIR)))

    lab = Lab(spark, SF_DIR, training.Settings())
    timed("stage_preprocess", lambda: lab.prepared)
    clf = timed("stage_train_classifiers", lambda: lab.trained("clf"))
    reg = timed("stage_train_regressors", lambda: lab.trained("reg"))

    def cross_validate():
        for task, trained, metric in (("clf", clf, "f1_weighted"), ("reg", reg, "r2")):
            table = trained.table(spark)
            names = [r["model"] for r in top_models(table, table[metric], 2).orderBy("rank").collect()]
            training.cross_validate(task, lab.rows(task, "train"), names, lab.settings).collect()

    if os.environ.get("BENCH_CV", "1") == "1":
        timed("stage_cross_validation", cross_validate)
    if os.environ.get("BENCH_SEARCH", "1") == "1":  # its own stage, beside the total of earlier rounds
        timed("stage_search_50_trials", lambda: lab.search)
    timed("stage_test_evaluation", lambda: lab.test_metrics)
    timed("stage_score_all_rows", lambda: drain(lab.scorer.score(lab.approaches)))
    total = round(sum(v for k, v in seconds.items() if k not in ("warm_up", "stage_search_50_trials")), 3)
    print(json.dumps({
        "metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
        "quality": {"clf": lab.test_metrics["clf"], "reg": lab.test_metrics["reg"]},
    }))


if __name__ == "__main__":
    main()

"""The registered queries in portable SQL, for a side-by-side check on the same tables."""

from __future__ import annotations

from perigee.plans.forest import poisson_marks
from perigee.plans.training import CLASSIFIERS, REGRESSORS, Settings
from perigee.plans.rules import CLASS_RULES, DISTANCE_RULES
from perigee.plans.tuning import TRIALS
from perigee.schema import CLASS_NAMES, CLF_FEATURES, ENGINEERED, NUMERIC_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, REG_FEATURES

NEO = """neo AS (
SELECT event_id AS approach_id, 2000000 + user_id AS id,
  concat('(', cast(2000 + user_id % 25 AS varchar(10)), ' ',
         substr('ABCDEFGHJKLMNOPQRSTUVWXY', cast(user_id % 24 + 1 AS int), 1),
         substr('PQRSTUVWXY', cast(user_id % 10 + 1 AS int), 1), cast(user_id AS varchar(10)), ')') AS name,
  ts AS approach_ts,
  0.0006 + value/1000.0 AS est_diameter_min,
  (0.0006 + value/1000.0) * (2.0 + k/100.0) AS est_diameter_max,
  cast(203.0 + 475.0 * ((event_id * 7919) % 500) AS double) AS relative_velocity,
  cast(6745.0 + 74800.0 * ((event_id * 104729) % 1000) AS double) AS miss_distance,
  'Earth' AS orbiting_body, false AS sentry_object,
  33.2 - 24.0 * value / (value + 50.0) AS absolute_magnitude,
  (value > 80 AND k >= 50) OR event_id % 97 = 0 AS hazardous
FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM events) e)"""

FEAT = """feat AS (
SELECT *, (est_diameter_min + est_diameter_max) / 2 AS diameter_avg,
  est_diameter_max / est_diameter_min AS diameter_ratio,
  ln(1 + (est_diameter_min + est_diameter_max) / 2) AS log_diameter_avg,
  ln(1 + est_diameter_max / est_diameter_min) AS log_diameter_ratio,
  ln(1 + relative_velocity) AS log_relative_velocity,
  ln(1 + miss_distance) AS log_miss_distance
FROM neo)"""

SPLIT = """split AS (
SELECT *, CASE WHEN rn <= (n * 70) // 100 THEN 'train' WHEN rn <= (n * 85) // 100 THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY hazardous ORDER BY md5(concat('42:', cast(approach_id AS varchar))), approach_id) AS rn,
             count(*) OVER (PARTITION BY hazardous) AS n FROM feat) x)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


RAW = ", ".join(RAW_COLUMNS)
NEO_ = _with(NEO)
FEAT_ = _with(NEO, FEAT)
SPLIT_ = _with(NEO, FEAT, SPLIT)


def _round(columns: list[str], digits: int = 9) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def _fold(by: str) -> str:
    order = "ORDER BY md5(concat('42:fold:', cast(approach_id AS varchar))), approach_id"
    cuts = " + ".join(f"CASE WHEN rn > (n * {i}) // 5 THEN 1 ELSE 0 END" for i in range(1, 5))
    return (
        f"fold AS (SELECT *, cast({cuts} AS int) AS fold FROM (SELECT *, row_number() OVER ({by} {order}) AS rn, "
        f"count(*) OVER ({by}) AS n FROM neo) x)"
    )


def _rules(source: str = "neo", keep: str = "") -> str:
    parts = [
        f"SELECT approach_id, {keep} cast(hazardous AS int) AS label, {i} AS position, '{name}' AS model, "
        f"cast({score} AS double) AS score, cast(({score}) > {threshold} AS int) AS prediction FROM {source}"
        for i, (name, score, threshold) in enumerate(CLASS_RULES)
    ]
    return "pred AS (" + "\nUNION ALL ".join(parts) + ")"


def _rule(name: str = "size") -> str:
    _, score, threshold = next(r for r in CLASS_RULES if r[0] == name)
    return (
        f"pred AS (SELECT approach_id, cast(hazardous AS int) AS label, cast({score} AS double) AS score, "
        f"cast(({score}) > {threshold} AS int) AS prediction FROM neo)"
    )


def _distances() -> str:
    parts = [
        f"SELECT approach_id, {i} AS position, '{name}' AS model, log_miss_distance AS label, "
        f"cast({e} AS double) AS prediction FROM feat"
        for i, (name, e) in enumerate(DISTANCE_RULES)
    ]
    return "dist AS (" + "\nUNION ALL ".join(parts) + ")"


def _cells(by: str) -> str:
    return (
        f"cells AS (SELECT {by}, count(*) AS n, count(*) FILTER (label = 0 AND prediction = 0) AS tn, "
        "count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn, "
        f"count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM pred GROUP BY {by})"
    )


def _scores(by: str) -> str:
    """Per-class precision, recall, F1 and their weighted forms."""
    def ratio(a: str, b: str) -> str:
        return f"CASE WHEN {b} = 0 THEN 0.0 ELSE cast({a} AS double) / ({b}) END"

    return _cells(by) + ", scores AS (SELECT *, " + ", ".join([
        f"{ratio('tn', '(tn + fn)')} AS p0", f"{ratio('tp', '(tp + fp)')} AS p1",
        f"{ratio('tn', '(tn + fp)')} AS r0", f"{ratio('tp', '(tp + fn)')} AS r1",
        f"{ratio('2 * tn', '(2 * tn + fn + fp)')} AS f0", f"{ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1",
        "tn + fp AS s0", "tp + fn AS s1",
    ]) + " FROM cells)"


_WEIGHTED = (
    "cast(tn + tp AS double) / n AS accuracy, (p0 * s0 + p1 * s1) / n AS precision_weighted, "
    "(r0 * s0 + r1 * s1) / n AS recall_weighted, (f0 * s0 + f1 * s1) / n AS f1_weighted"
)
_STEPS = """steps AS (
SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps, pos, neg,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n, row_number() OVER (ORDER BY score DESC) AS place,
  lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg
FROM (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM pred GROUP BY score) g)"""
_AUC = (
    "SELECT sum(pos * (n - fps + neg / 2.0)) / (max(p) * max(n)) AS auc_roc FROM steps"
)
_REG = (
    "SELECT position, model, 1 - avg((label - prediction) ** 2) / var_pop(label) AS r2, "
    "sqrt(avg((label - prediction) ** 2)) AS rmse_log, avg(abs(label - prediction)) AS mae_log, "
    "sqrt(avg(((exp(label) - 1) - (exp(prediction) - 1)) ** 2)) AS rmse_km FROM dist GROUP BY position, model"
)
_MINORITY = "m AS (SELECT approach_id, " + ", ".join(CLF_FEATURES) + " FROM split WHERE split = 'train' AND hazardous)"
_NEAREST = (
    "nn AS (SELECT * FROM (SELECT a.approach_id AS base, b.approach_id AS neighbour, d2, "
    "row_number() OVER (PARTITION BY a.approach_id ORDER BY d2, b.approach_id) AS rank, "
    + ", ".join(f"a.{c} AS a_{c}, b.{c} AS b_{c}" for c in CLF_FEATURES)
    + " FROM m a JOIN m b ON a.approach_id <> b.approach_id, LATERAL (SELECT "
    + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in CLF_FEATURES)
    + " AS d2) d) r WHERE rank <= 5)"
)
_SMOTE = """demand AS (SELECT (neg - pos) // pos AS each_row, (neg - pos) % pos AS extra FROM (
  SELECT count(*) FILTER (hazardous) AS pos, count(*) FILTER (NOT hazardous) AS neg FROM split WHERE split = 'train') c),
base AS (SELECT approach_id, each_row + CASE WHEN rn <= extra THEN 1 ELSE 0 END AS copies FROM (
  SELECT approach_id, row_number() OVER (ORDER BY md5(concat('42:extra:', cast(approach_id AS varchar))), approach_id) AS rn FROM m) o, demand),
copy AS (SELECT approach_id, unnest(range(1, copies + 1)) AS copy FROM base),
drawn AS (SELECT approach_id, copy, md5(concat('42:smote:', cast(approach_id AS varchar), ':', cast(copy AS varchar))) AS d FROM copy),
synthetic AS (SELECT concat(cast(c.approach_id AS varchar), '#', cast(copy AS varchar)) AS row_key, c.approach_id AS base_key,
  nn.neighbour AS neighbour_key, copy, cast('0x' || substr(d, 9, 8) AS bigint) / 4294967296.0 AS u, nn.*
  FROM drawn c JOIN nn ON nn.base = c.approach_id AND nn.rank = cast('0x' || substr(d, 1, 8) AS bigint) % 5 + 1)"""
SMOTE_ = _with(NEO, FEAT, SPLIT, _MINORITY, _NEAREST, _SMOTE)

_LAST = "last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY approach_id DESC) AS rn FROM neo) x WHERE rn = 1)"
_LINKED = (
    _LAST + ", linked AS (SELECT approach_id, CASE WHEN est_diameter_min <= 0.1 THEN id END AS sourceNeoId, absolute_magnitude FROM neo),"
    " held AS (SELECT * FROM last WHERE miss_distance < 60000000.0)"
)
_FEATURE_ROW = _round([*ENGINEERED, "absolute_magnitude"]) + ", cast(hazardous AS int) AS hazardous, id AS sourceNeoId"
_SHIFTED = """shifted AS (SELECT approach_id, est_diameter_min - 0.01 AS lo, est_diameter_max - 0.05 AS hi,
  CASE WHEN approach_id % 41 <> 0 THEN relative_velocity - 20000.0 END AS v,
  CASE WHEN approach_id % 43 = 0 THEN cast('nan' AS double) ELSE miss_distance - 1000000.0 END AS d,
  CASE WHEN approach_id % 53 = 0 THEN cast('nan' AS double) WHEN approach_id % 47 <> 0 THEN absolute_magnitude - 20.0 END AS m FROM neo)"""
_RULE_TABLE = (
    "aucs AS (SELECT model, sum(pos * (tot_n - cum + neg / 2.0)) / (max(tot_p) * max(tot_n)) AS auc_roc FROM ("
    "SELECT model, pos, neg, sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS cum, "
    "sum(pos) OVER (PARTITION BY model) AS tot_p, sum(neg) OVER (PARTITION BY model) AS tot_n FROM ("
    "SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM pred GROUP BY model, score) g) h "
    "GROUP BY model), "
    f"rules AS (SELECT 'clf' AS task, position, s.model, round((f0 * s0 + f1 * s1) / n, 4) AS f1_weighted, round(auc_roc, 4) AS auc_roc, "
    "cast(NULL AS double) AS r2 FROM scores s JOIN aucs USING (model) UNION ALL "
    f"SELECT 'reg', position, model, NULL, NULL, round(r2, 4) FROM ({_REG}) q)"
)
RULES_ = _with(NEO, FEAT, _rules(), _scores("position, model"), _distances(), _RULE_TABLE)


def _describe(source: str, columns: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, "
        f"round(min({c}), 5) AS min, round(quantile_cont({c}, 0.25), 5) AS p25, round(quantile_cont({c}, 0.5), 5) AS p50, "
        f"round(quantile_cont({c}, 0.75), 5) AS p75, round(max({c}), 5) AS max FROM {source}"
        for c in columns
    ]
    return "\nUNION ALL ".join(parts)


def _page(where: str, limit: int, offset: int) -> str:
    return (
        f"SELECT approach_id, {RAW}, total FROM (SELECT *, count(*) OVER () AS total FROM neo WHERE {where}) x "
        f"ORDER BY approach_id LIMIT {limit} OFFSET {offset}"
    )


def _report() -> str:
    rows = [
        f"SELECT model, '{CLASS_NAMES[0]}' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM scores",
        f"SELECT model, '{CLASS_NAMES[1]}', p1, r1, f1, s1 FROM scores",
        "SELECT model, 'accuracy', NULL, NULL, cast(tn + tp AS double) / n, n FROM scores",
        "SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM scores",
        "SELECT model, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM scores",
    ]
    return (
        "SELECT model, class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM ("
        + " UNION ALL ".join(rows) + ") r"
    )


ORACLES: dict[str, str] = {
    "src1_read_raw": f"{NEO_} SELECT {RAW} FROM neo",
    "src2_normalize_columns": f"{NEO_} SELECT {RAW} FROM neo",
    "src3_parse_bool": f"""{NEO_} SELECT approach_id, text,
  CASE WHEN lower(text) = 'true' THEN true WHEN lower(text) = 'false' THEN false END AS flag
FROM (SELECT approach_id, CASE WHEN est_diameter_min > 0.08 THEN 'TRUE' WHEN est_diameter_min > 0.05 THEN 'False'
  WHEN est_diameter_min > 0.03 THEN 'yes' WHEN est_diameter_min > 0.02 THEN '1'
  WHEN est_diameter_min > 0.01 THEN 'true' ELSE 't' END AS text FROM neo) x""",
    "src4_flag_to_int": f"{NEO_} SELECT approach_id, cast(hazardous AS int) AS hazardous, cast(sentry_object AS int) AS sentry FROM neo",
    "snk1_upsert": f"""{NEO_} SELECT approach_id, {RAW} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY hazardous DESC, approach_id DESC) AS rn FROM neo) x WHERE rn = 1""",
    "snk2_append_features": f"{FEAT_} SELECT approach_id, {_FEATURE_ROW} FROM feat",
    "snk3_create_table_if_missing": f"""{FEAT_} SELECT id AS sourceNeoId, cast(hazardous AS int) AS hazardous, count(*) AS rows,
  round(sum(diameter_avg), 9) AS diameter_sum FROM feat GROUP BY ALL""",
    "snk4_write_splits": f"""{SPLIT_} SELECT task, split, count(*) AS rows, round(avg(label), 9) AS label_mean,
  cast(sum(approach_id) AS bigint) AS id_sum FROM (
  SELECT 'clf' AS task, split, approach_id, cast(hazardous AS double) AS label FROM split
  UNION ALL SELECT 'reg', split, approach_id, log_miss_distance FROM split) x GROUP BY task, split""",
    "src5_load_splits": f"""{SPLIT_} SELECT 'reg' AS task, split, approach_id, round(log_miss_distance, 9) AS label,
  {_round(REG_FEATURES)} FROM split WHERE split IN ('val', 'test')""",
    "snk6_metrics_json": f"""{_with(NEO, _rules(), _scores("model"), f"w AS (SELECT model, {_WEIGHTED} FROM scores)")}
SELECT 'clf' AS task, model, 'all' AS split, metric, round(value, 9) AS value FROM (
  UNPIVOT w ON accuracy, precision_weighted, recall_weighted, f1_weighted INTO NAME metric VALUE value) u""",
    "prj1_drop_non_predictive": f"""{NEO_} SELECT est_diameter_min, est_diameter_max, relative_velocity, miss_distance,
  absolute_magnitude, hazardous FROM neo""",
    "prj2_drop_superseded": f"{FEAT_} SELECT hazardous, {_round([*ENGINEERED, 'absolute_magnitude'])} FROM feat",
    "prj3_feature_view_clf": f"{FEAT_} SELECT approach_id, {_round(CLF_FEATURES)}, cast(hazardous AS int) AS hazardous FROM feat",
    "prj3_feature_view_reg": f"{FEAT_} SELECT approach_id, {_round([*REG_FEATURES, 'log_miss_distance'])} FROM feat",
    "prj4_card_view": f"""{NEO_} SELECT id, name, relative_velocity AS velocity, miss_distance AS "missDistance",
  absolute_magnitude AS magnitude FROM neo ORDER BY approach_id LIMIT 5""",
    "flt1_hazardous": f"{NEO_} SELECT approach_id, {RAW} FROM neo WHERE hazardous",
    "flt2_safe": f"{NEO_} SELECT approach_id, {RAW} FROM neo WHERE NOT hazardous",
    "flt3_by_id": f"{NEO_} SELECT approach_id, {RAW} FROM neo WHERE id = 2000007 ORDER BY approach_id LIMIT 1",
    "flt3_by_many_ids": f"""{NEO_} SELECT approach_id, {RAW} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY approach_id) AS rn FROM neo
  WHERE id IN (SELECT id FROM neo WHERE hazardous)) x WHERE rn = 1""",
    "flt4_search_name": f"{NEO_} SELECT approach_id, id, name FROM neo WHERE regexp_matches(name, '201[0-4] .q', 'i')",
    "flt4_search_name_literal": f"{NEO_} SELECT approach_id, id, name FROM neo WHERE contains(lower(name), '(2003 d')",
    "dq1_expect_shape": f"{NEO_} SELECT count(*) AS row_count, cast(10 AS bigint) AS column_count, count(*) = (SELECT count(*) FROM events) AS ok FROM neo",
    "dq2_null_counts": NEO_ + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM neo" for c in RAW_COLUMNS),
    "dq3_expect_positive": f"""{NEO_} SELECT 'est_diameter_min' AS "column", count(*) FILTER (NOT est_diameter_min > 0) AS violations,
  count(*) FILTER (NOT est_diameter_min > 0) = 0 AS ok FROM neo""",
    "dq4_expect_finite": _with(NEO, """s AS (SELECT greatest(est_diameter_min - 0.01, 0.0) AS lo, est_diameter_max AS hi,
  relative_velocity AS v, miss_distance AS d, absolute_magnitude AS m FROM neo)""")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (NOT coalesce(isfinite({e}), false)) AS violations, "
        f"count(*) FILTER (NOT coalesce(isfinite({e}), false)) = 0 AS ok FROM s" for c, e in {
            "diameter_avg": "(lo + hi) / 2", "diameter_ratio": "hi / nullif(lo, 0)", "log_diameter_avg": "ln(1 + (lo + hi) / 2)",
            "log_diameter_ratio": "ln(1 + hi / nullif(lo, 0))", "log_relative_velocity": "ln(1 + v)", "log_miss_distance": "ln(1 + d)",
            "absolute_magnitude": "m"}.items()),
    "dq5_validate_inputs": f"""{_with(NEO, _SHIFTED)} SELECT approach_id, errors, errors = '' AS accepted FROM (
  SELECT approach_id, concat_ws('; ',
    CASE WHEN lo <= 0 THEN 'est_diameter_min must be greater than 0' END,
    CASE WHEN hi <= 0 THEN 'est_diameter_max must be greater than 0' END,
    CASE WHEN v IS NULL OR v <= 0 THEN 'relative_velocity must be greater than 0' END,
    CASE WHEN isnan(d) OR d <= 0 THEN 'miss_distance must be greater than 0' END,
    CASE WHEN m IS NULL OR isnan(m) THEN 'absolute_magnitude must be a number' END,
    CASE WHEN m <= 0 THEN 'absolute_magnitude must be greater than 0' END,
    CASE WHEN hi < lo THEN 'est_diameter_max must be greater than or equal to est_diameter_min' END) AS errors FROM shifted) x""",
    "dq6_check_manifest": f"""{NEO_} SELECT DISTINCT name FROM neo WHERE name NOT IN (
  SELECT name FROM neo WHERE hazardous AND miss_distance > 60000000.0)""",
    "dq7_check_scores": f"""{_with(NEO, _rule())} SELECT count(*) AS rows_checked, count(*) FILTER (score NOT BETWEEN 0 AND 1) AS bad_probability,
  count(*) FILTER (score - 0.1 <= 0) AS bad_distance,
  count(*) FILTER (score NOT BETWEEN 0 AND 1) = 0 AND count(*) FILTER (score - 0.1 <= 0) = 0 AS ok FROM pred""",
    "jn1_features_with_source": f"""{_with(NEO, _LINKED)} SELECT l.sourceNeoId, l.approach_id, l.absolute_magnitude, h.name AS source_name,
  h.orbiting_body AS source_orbiting_body FROM linked l LEFT JOIN held h ON l.sourceNeoId = h.id""",
    "jn1_orphan_features": f"""{_with(NEO, _LINKED)} SELECT sourceNeoId, approach_id, absolute_magnitude FROM linked
WHERE sourceNeoId IS NOT NULL AND sourceNeoId NOT IN (SELECT id FROM held)""",
    "jn2_align_rows": f"{SPLIT_} SELECT approach_id, {_round([*REG_FEATURES, 'log_miss_distance'])}, split FROM split",
    "jn3_nearest_neighbours": f"""{_with(NEO, FEAT, SPLIT, _MINORITY, _NEAREST)} SELECT base AS approach_id, cast(rank AS int) AS rank, neighbour,
  round(sqrt(d2), 9) AS distance FROM nn""",
    "jn4_new_and_known": f"""{_with(NEO, "target AS (SELECT id FROM neo WHERE hazardous AND miss_distance < 5000000.0)")}
SELECT id, count(*) AS rows, CASE WHEN id IN (SELECT id FROM target) THEN 'known' ELSE 'new' END AS state FROM neo GROUP BY id""",
    "jn5_attach_predictions": f"""{_with(NEO, _rule())} SELECT approach_id, {", ".join(NUMERIC_COLUMNS)},
  score AS hazardous_probability, score > 0.16 AS hazardous FROM neo JOIN pred USING (approach_id)""",
    "agg1_dataset_stats": f"""{NEO_} SELECT count(*) AS total_records, count(*) FILTER (hazardous) AS hazardous_count,
  count(*) FILTER (NOT hazardous) AS safe_count, round(avg(cast(hazardous AS int)) * 100, 2) AS hazardous_percentage,
  round(avg(relative_velocity), 2) AS velocity_avg_kmph, round(max(relative_velocity), 2) AS velocity_max_kmph,
  round(avg(miss_distance), 2) AS miss_distance_avg_km, round(min(miss_distance), 2) AS miss_distance_min_km,
  round(avg(est_diameter_min), 6) AS diameter_min_avg_km, round(avg(est_diameter_max), 6) AS diameter_max_avg_km,
  round(avg(absolute_magnitude), 3) AS absolute_magnitude_avg FROM neo""",
    "agg2_describe": NEO_ + _describe("neo", NUMERIC_COLUMNS),
    "agg2_describe_features": FEAT_ + _describe("feat", CLF_FEATURES),
    "agg3_value_counts": f"{NEO_} SELECT name, count(*) AS count FROM neo GROUP BY name",
    "agg3_value_counts_body": f"{NEO_} SELECT orbiting_body, count(*) AS count FROM neo GROUP BY orbiting_body",
    "agg4_class_balance": f"""{SPLIT_} SELECT split, count(*) AS rows, count(*) FILTER (hazardous) AS positives,
  round(avg(cast(hazardous AS int)), 9) AS positive_share FROM split GROUP BY split""",
    "agg5_profile": NEO_ + " UNION ALL ".join(
        f"SELECT cast({i} AS bigint) AS position, '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS dtype, "
        f"count({f.name}) AS non_null FROM neo" for i, f in enumerate(RAW_SCHEMA)),
    "agg6_fit_scaler": SPLIT_ + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 9) AS mean, round(stddev_pop({c}), 9) AS std FROM split WHERE split = 'train'"
        for c in CLF_FEATURES),
    "agg7_confusion_matrix": f"{_with(NEO, _rules())} SELECT model, label, prediction, count(*) AS count FROM pred GROUP BY ALL",
    "agg8_normalised_confusion": f"""{_with(NEO, _rules())} SELECT model, label, prediction, count(*) AS count,
  round(count(*) / sum(count(*)) OVER (PARTITION BY model, label), 9) AS share FROM pred GROUP BY model, label, prediction""",
    "agg9_accuracy": f"""{_with(NEO, _rules())} SELECT model, round(avg(cast(label = prediction AS int)), 9) AS accuracy FROM pred GROUP BY model""",
    "agg10_weighted_scores": f"""{_with(NEO, _rules(), _scores("model"), f"w AS (SELECT model, {_WEIGHTED} FROM scores)")}
SELECT model, {_round(["accuracy", "precision_weighted", "recall_weighted", "f1_weighted"])} FROM w""",
    "agg11_classification_report": _with(NEO, _rules(), _scores("model")) + _report(),
    "agg12_auc_roc": f"{_with(NEO, _rule(), _STEPS)} SELECT round(auc_roc, 9) AS auc_roc FROM ({_AUC}) x",
    "agg13_regression_metrics": f"""{_with(NEO, FEAT, _distances())} SELECT model, {_round(["r2", "rmse_log", "mae_log"])} FROM ({_REG}) x""",
    "agg14_rmse_km": f"{_with(NEO, FEAT, _distances())} SELECT model, round(rmse_km, 2) AS rmse_km FROM ({_REG}) x",
    "agg15_cv_summary": f"""{_with(NEO, _fold("PARTITION BY hazardous"), _rules("fold", "fold,"), _scores("model, fold"))}
SELECT model, round(avg((f0 * s0 + f1 * s1) / n), 4) AS cv_mean, round(stddev_pop((f0 * s0 + f1 * s1) / n), 4) AS cv_std
FROM scores GROUP BY model""",
    "agg16_batch_summary": f"""{_with(NEO, _rule())} SELECT count(*) AS total, count(*) FILTER (prediction = 1) AS hazardous,
  count(*) FILTER (prediction = 0) AS safe FROM pred""",
    "win1_roc_curve": f"""{_with(NEO, _rule(), _STEPS)} SELECT round(fps / n, 9) AS fpr, round(tps / p, 9) AS tpr, score AS threshold FROM steps
UNION ALL SELECT 0.0, 0.0, cast('inf' AS double)""",
    "win1_roc_curve_corners": f"""{_with(NEO, _rule(), _STEPS)} SELECT round(fps / n, 9) AS fpr, round(tps / p, 9) AS tpr, score AS threshold FROM steps
WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT 0.0, 0.0, cast('inf' AS double)""",
    "win2_precision_recall_curve": f"""{_with(NEO, _rule(), _STEPS)} SELECT round(tps / (tps + fps), 9) AS precision, round(tps / p, 9) AS recall,
  round(score, 9) AS threshold FROM steps UNION ALL SELECT 1.0, 0.0, NULL""",
    "win3_rank_models": f"""{RULES_} SELECT task, position, model, f1_weighted, auc_roc, r2,
  cast(row_number() OVER (PARTITION BY task ORDER BY coalesce(f1_weighted, r2) DESC NULLS LAST, position) AS int) AS rank FROM rules""",
    "win4_select_best": f"""{RULES_} SELECT task, position, model, f1_weighted, auc_roc, r2 FROM (SELECT *,
  row_number() OVER (PARTITION BY task ORDER BY coalesce((f1_weighted + auc_roc) / 2, r2) DESC NULLS LAST, position) AS rank FROM rules) x WHERE rank = 1""",
    "win5_top2_for_cv": f"""{RULES_} SELECT task, position, model, f1_weighted, auc_roc, r2, cast(rank AS int) AS rank FROM (SELECT *,
  row_number() OVER (PARTITION BY task ORDER BY coalesce(f1_weighted, r2) DESC NULLS LAST, position) AS rank FROM rules) x WHERE rank <= 2""",
    "win6_residuals": f"""{_with(NEO, FEAT, _distances())} SELECT approach_id, model, round(label, 9) AS label, round(prediction, 9) AS prediction,
  round(label - prediction, 9) AS residual FROM dist""",
    "win6_residual_grid": f"""{_with(NEO, FEAT, _distances())} SELECT cast(floor(prediction / 0.07) AS bigint) AS x_bin,
  cast(floor((label - prediction) / 0.23) AS bigint) AS y_bin, count(*) AS count FROM dist WHERE model = 'linear' GROUP BY ALL""",
    "win7_predicted_vs_actual": f"""{_with(NEO, FEAT, _distances())} SELECT approach_id, model, round((exp(label) - 1) / 1e6, 9) AS actual_mkm,
  round((exp(prediction) - 1) / 1e6, 9) AS predicted_mkm FROM dist""",
    "lim1_page": NEO_ + _page("true", 50, 150),
    "lim1_page_hazardous": NEO_ + _page("hazardous", 100, 20),
    "lim1_far_page": NEO_ + _page("true", 100, 700),
    "lim1_page_by_repeating_key": f"""{NEO_} SELECT approach_id, {RAW}, total FROM (SELECT *, count(*) OVER () AS total FROM neo) x
ORDER BY id, approach_id LIMIT 50 OFFSET 333""",
    "lim1_page_after": f"{NEO_} SELECT approach_id, {RAW} FROM neo WHERE approach_id > 420 ORDER BY approach_id LIMIT 100",
    "lim1_page_envelope": f"""{NEO_} SELECT max(total) AS total, 60 AS "offset", 30 AS "limit", count(*) AS count,
  string_agg(cast(approach_id AS varchar), ',' ORDER BY approach_id) AS ids
FROM (SELECT *, count(*) OVER () AS total FROM neo ORDER BY approach_id LIMIT 30 OFFSET 60) x""",
    "lim2_head": f"{NEO_} SELECT approach_id, {RAW} FROM neo ORDER BY approach_id LIMIT 5",
    "lim2_tail": f"{NEO_} SELECT approach_id, {RAW} FROM neo ORDER BY approach_id DESC LIMIT 5",
    "lim3_top_hazardous": f"{NEO_} SELECT approach_id, {RAW} FROM neo WHERE hazardous ORDER BY approach_id LIMIT 5",
    "lim4_search": f"""{NEO_} SELECT approach_id, id, name, total FROM (SELECT *, count(*) OVER () AS total FROM neo
  WHERE regexp_matches(name, '2010 .p', 'i')) x ORDER BY approach_id LIMIT 50""",
    "lim4_search_envelope": f"""{NEO_} SELECT '2010 .p' AS query, max(total) AS total, count(*) AS count,
  coalesce(string_agg(cast(approach_id AS varchar), ',' ORDER BY approach_id), '') AS ids FROM (SELECT *, count(*) OVER () AS total FROM neo
  WHERE regexp_matches(name, '2010 .p', 'i') ORDER BY approach_id LIMIT 5) x
UNION ALL SELECT 'no such name', count(*), count(*), coalesce(string_agg(name, ','), '') FROM neo WHERE regexp_matches(name, 'no such name', 'i')""",
    "set1_train_and_val": f"""{SPLIT_} SELECT approach_id, split, {_round(CLF_FEATURES)}, cast(hazardous AS int) AS hazardous
FROM split WHERE split IN ('train', 'val')""",
    "set2_originals_and_synthetic": f"""{SMOTE_} SELECT hazardous, synthetic, count(*) AS rows, count(approach_id) AS with_source FROM (
  SELECT cast(hazardous AS int) AS hazardous, false AS synthetic, approach_id FROM split WHERE split = 'train'
  UNION ALL SELECT 1, true, NULL FROM synthetic) x GROUP BY hazardous, synthetic""",
    "fn1_diameter_avg": f"{FEAT_} SELECT approach_id, round(diameter_avg, 9) AS diameter_avg FROM feat",
    "fn2_diameter_ratio": f"{FEAT_} SELECT approach_id, round(diameter_ratio, 9) AS diameter_ratio FROM feat",
    "fn3_log_features": f"{FEAT_} SELECT approach_id, {_round([c for c in ENGINEERED if c.startswith('log_')])} FROM feat",
    "fn4_log_to_km": f"{FEAT_} SELECT approach_id, round(exp(log_miss_distance) - 1, 2) AS km FROM feat",
    "fn5_zscore": _with(NEO, FEAT, SPLIT, "state AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in CLF_FEATURES) + " FROM split WHERE split = 'train')")
    + "SELECT approach_id, split, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in CLF_FEATURES)
    + " FROM split, state",
    "fn6_rounding": f"""{FEAT_} SELECT approach_id, round(absolute_magnitude, 3) AS magnitude_3,
  round(log_relative_velocity, 4) AS velocity_4, round(log_miss_distance, 2) AS distance_2 FROM feat""",
    "fn7_humanise": NEO_ + "SELECT approach_id, " + ", ".join(
        f"CASE WHEN {c} >= 1e6 THEN printf('%.1fM', {c} / 1e6) WHEN {c} >= 1e3 THEN printf('%.1fK', {c} / 1e3) "
        f"ELSE cast(cast({c} AS bigint) AS varchar) END AS {n}"
        for c, n in (("relative_velocity", "velocity"), ("miss_distance", "distance"))) + " FROM neo",
    "fn8_probability_band": f"""{_with(NEO, _rule("magnitude"))} SELECT approach_id, score,
  CASE WHEN floor(score * 100 + 0.5) >= 70 THEN 'high' WHEN floor(score * 100 + 0.5) >= 40 THEN 'medium' ELSE 'low' END AS band FROM pred""",
    "spl1_stratified_split": f"{SPLIT_} SELECT approach_id, hazardous, split FROM split",
    "spl2_stratified_kfold": f"{_with(NEO, _fold('PARTITION BY hazardous'))} SELECT approach_id, hazardous, fold FROM fold",
    "spl3_kfold": f"{_with(NEO, _fold(''))} SELECT approach_id, fold FROM fold",
    "bal1_smote": SMOTE_ + "SELECT row_key, base_key, neighbour_key, cast(copy AS int) AS copy, " + ", ".join(
        f"round(a_{c} + u * (b_{c} - a_{c}), 9) AS {c}" for c in CLF_FEATURES) + " FROM synthetic",
    "bal2_class_weights": f"""{NEO_} SELECT cast(hazardous AS int) AS label, count(*) AS rows,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight FROM neo GROUP BY hazardous""",
    "str2_upsert_stream": f"{_with(NEO, _LAST)} SELECT approach_id, {RAW} FROM last",
    **{name: f"""{SPLIT_} SELECT '{model}' AS model, count(*) AS rows, count(*) FILTER (hazardous) AS positives, true AS in_range,
  true AS consistent, true AS beats_chance FROM split WHERE split = 'val'""" for name, model in (
        ("ml1_logistic_regression", "LogisticRegression"), ("ml2_random_forest_classifier", "RandomForestClassifier"),
        ("ml3_boosted_classifier", "GradientBoostingClassifier"), ("ml4_kernel_classifier", "SVC"))},
    **{name: f"""{SPLIT_} SELECT '{model}' AS model, count(*) AS rows, round(sum(log_miss_distance), 6) AS label_sum, true AS finite,
  true AS beats_mean FROM split WHERE split IN ({splits})""" for name, model, splits in (
        ("ml6_random_forest_regressor", "RandomForestRegressor", "'train'"),
        ("ml7_boosted_regressor", "GradientBoostingRegressor", "'train'"),
        ("ml11_refit_on_trainval", "GradientBoostingRegressor", "'train', 'val'"))},
    "ml5_linear_regression": SPLIT_ + " UNION ALL ".join(
        f"SELECT '{c}' AS term, count(*) AS rows, cast(0 AS double) AS moment FROM split WHERE split = 'train'" for c in ("intercept", *REG_FEATURES)),
    **{name: SPLIT_ + " UNION ALL ".join(
        f"SELECT '{task}' AS task, '{m}' AS model, count(*) AS rows, cast(0 AS double) AS difference FROM split WHERE split = '{split}'"
        for task, models in (("clf", CLASSIFIERS), ("reg", REGRESSORS)) for m in models)
       for name, split in (("ml8_train_and_score", "val"), ("ml12_evaluate_on_test", "test"))},
    "ml9_cross_validate": f"""{SPLIT_} SELECT 'clf' AS task, cast(2 AS bigint) AS models, cast(10 AS bigint) AS fits,
  2 * count(*) FILTER (NOT hazardous) AS rows, true AS possible FROM split WHERE split = 'train'
UNION ALL SELECT 'reg', 2, 10, count(*), true FROM split WHERE split = 'train'""",
    "ml10_hyper_search": f"""{SPLIT_} SELECT cast({TRIALS} AS bigint) AS trials, count(*) AS rows, true AS inside, cast(0 AS double) AS difference,
  true AS beats_mean FROM split WHERE split = 'val'""",
    **{name: f"""{SPLIT_[:-1]},
drawn AS (SELECT tree, {label} AS label, {" + ".join(f"cast(u >= {m} AS int)" for m in poisson_marks())} AS w FROM (
  SELECT *, cast('0x' || substr(md5(concat('42:bag:', cast(tree AS varchar), ':', cast(approach_id AS varchar))), 1, 8) AS bigint) AS u
  FROM split, (SELECT unnest(generate_series(0, {Settings().forest_trees - 1})) AS tree) t WHERE split = 'train') x)
SELECT cast(tree AS int) AS tree, count(*) AS rows, cast(sum(w) AS bigint) AS draws, round(sum(w * cast(label AS double)), 6) AS prediction_sum,
  cast(0 AS bigint) AS different FROM drawn WHERE w > 0 GROUP BY tree""" for name, label in (
        ("ml2_forest_to_the_end", "cast(hazardous AS int)"), ("ml6_forest_to_the_end", "log_miss_distance"))},
    "ml13_feature_importance": f"SELECT cast({len(CLF_FEATURES)} AS bigint) AS features, cast(1 AS double) AS total, true AS nonnegative",
    "ml14_model_card": "SELECT true AS names, true AS classifier_metric, true AS regressor_metric",
    "ml14_metric_summary": " UNION ALL ".join(
        f"SELECT '{t}' AS task, '{m}' AS metric, cast(0 AS double) AS difference" for t, m in (
            ("Classification", "F1 (weighted)"), ("Classification", "AUC-ROC"), ("Regression", "R2"),
            ("Regression", "RMSE (log)"), ("Regression", "RMSE (km)"))),
    **{name: f"""{NEO_} SELECT count(*) AS rows, count(DISTINCT approach_id) AS keys, true AS in_range, true AS consistent,
  true AS positive_distance, true AS same FROM neo""" for name in ("ml15_score", "snk5_save_load_model")},
    "str1_score_stream": f"""{NEO_} SELECT count(*) FILTER (approach_id % 50 <> 0) AS rows, count(DISTINCT approach_id) FILTER (approach_id % 50 <> 0) AS keys,
  true AS in_range, true AS consistent, true AS positive_distance, true AS same, count(*) FILTER (approach_id % 50 = 0) AS refused FROM neo""",
    "dq7_check_model_scores": f"""{NEO_} SELECT count(*) AS rows_checked, cast(0 AS bigint) AS bad_probability,
  cast(0 AS bigint) AS bad_distance, true AS ok FROM neo""",
}

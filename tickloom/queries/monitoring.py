"""Health metrics, the retrain gate, its consumers, remediation and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.plans import alerts, gate, monitor
from tickloom.plans.metrics import latest_metrics
from tickloom.queries import base
from tickloom.queries.base import SQL_METRICS, SQL_SCORED, query, rounded, sql_r6

KEYS = ["symbol"]

_AS_OF = "(SELECT max(ts) FROM events)"
_AGE = "(epoch_us({a}) - epoch_us({b})) / 3600000000.0"


@query(
    "health_metrics",
    f"""WITH {base.SQL_PREDICTIONS}, facts AS (
      SELECT (SELECT count(*) FROM bars) AS raw_rows, (SELECT max(open_time) FROM bars) AS raw_latest, (SELECT count(*) FROM features) AS feature_rows,
             (SELECT count(*) FROM features WHERE target_close_1h IS NULL) AS no_target, (SELECT count(*) FROM predictions) AS pred_rows, (SELECT max(prediction_time) FROM predictions) AS pred_latest),
    rows AS (
      SELECT 'raw_count' AS metric_name, raw_rows::DOUBLE AS v, 'ok' AS status FROM facts
      UNION ALL SELECT 'raw_duplicate_open_time_count', 0, 'ok' FROM facts
      UNION ALL SELECT 'raw_null_open_time_count', 0, 'ok' FROM facts
      UNION ALL SELECT 'raw_freshness_hours', {_AGE.format(a=_AS_OF, b='raw_latest')}, CASE WHEN {_AGE.format(a=_AS_OF, b='raw_latest')} <= 3 THEN 'ok' ELSE 'alert' END FROM facts
      UNION ALL SELECT 'features_count', feature_rows, 'ok' FROM facts
      UNION ALL SELECT 'features_target_close_1h_null_count', no_target, CASE WHEN no_target <= 1 THEN 'ok' ELSE 'alert' END FROM facts
      UNION ALL SELECT 'raw_features_row_count_delta', raw_rows - feature_rows, CASE WHEN abs(raw_rows - feature_rows) <= 120 THEN 'ok' ELSE 'alert' END FROM facts
      UNION ALL SELECT 'prediction_count', pred_rows, 'ok' FROM facts
      UNION ALL SELECT 'prediction_age_hours', {_AGE.format(a=_AS_OF, b='pred_latest')}, CASE WHEN {_AGE.format(a=_AS_OF, b='pred_latest')} <= 3 THEN 'ok' ELSE 'alert' END FROM facts)
    SELECT {_AS_OF} AS metric_time, metric_name, {sql_r6('v', 'metric_value')}, status FROM rows""",
)
def health_metrics(spark, sf):
    """With the warm-up gap of five series allowed for."""
    raw, rows, predictions = base.stored_tables(spark, sf)
    out = monitor.health_metrics(raw, rows, predictions, base.newest_event(spark, sf), KEYS, warmup_rows=5 * 24)
    return rounded(out.select("metric_time", "metric_name", "metric_value", "status"))


_PERF = f"""{SQL_SCORED}, recent AS (SELECT * FROM scored WHERE prediction_time > (SELECT max(prediction_time) FROM scored) - INTERVAL 168 HOUR),
valid AS (SELECT * FROM recent WHERE predicted_close > 1.0),
moves AS (SELECT sign(actual_close - lag(actual_close) OVER w) AS a, sign(predicted_close - lag(predicted_close) OVER w) AS p FROM valid
  WINDOW w AS (PARTITION BY symbol, model_uri ORDER BY feature_open_time)),
facts AS (SELECT count(*) AS n, sqrt(avg((actual_close - predicted_close) ** 2)) AS rmse, avg(abs_error) AS mae, avg(pct_error) AS mape,
  avg(actual_close - predicted_close) AS bias, quantile_disc(abs_error, 0.95) AS p95, (SELECT count(*) FROM recent WHERE predicted_close <= 1.0) AS bad,
  (SELECT avg(CASE WHEN a = p THEN 1.0 ELSE 0.0 END) FROM moves WHERE a IS NOT NULL AND p IS NOT NULL) AS da FROM valid)"""


@query(
    "performance_metrics",
    f"""WITH {_PERF}, rows AS (
      SELECT 'model_drift_joined_prediction_count' AS metric_name, n::DOUBLE AS v, 'ok' AS status FROM facts
      UNION ALL SELECT 'model_drift_invalid_predicted_close_count_24h', bad, 'warn' FROM facts WHERE bad > 0
      UNION ALL SELECT 'model_drift_rmse_24h', rmse, 'ok' FROM facts UNION ALL SELECT 'model_drift_mae_24h', mae, 'ok' FROM facts
      UNION ALL SELECT 'model_drift_mape_24h', mape, CASE WHEN mape >= 0.05 THEN 'alert' WHEN mape >= 0.02 THEN 'warn' ELSE 'ok' END FROM facts
      UNION ALL SELECT 'model_drift_p95_abs_error_24h', p95, 'ok' FROM facts UNION ALL SELECT 'concept_drift_mean_error_bias_24h', bias, 'ok' FROM facts
      UNION ALL SELECT 'model_drift_direction_accuracy_24h', da, CASE WHEN da <= 0.40 THEN 'alert' WHEN da <= 0.45 THEN 'warn' ELSE 'ok' END FROM facts)
    SELECT metric_name, {sql_r6('v', 'metric_value')}, status FROM rows""",
)
def performance_metrics(spark, sf):
    raw, _, predictions = base.stored_tables(spark, sf)
    out = monitor.performance_metrics(
        predictions, raw, KEYS, base.newest_event(spark, sf), min_valid=1.0, series=["symbol", "model_uri"]
    )
    return rounded(out.select("metric_name", "metric_value", "status"))


@query(
    "metrics_latest",
    f"""WITH {SQL_METRICS} SELECT metric_name, metric_time, {sql_r6('metric_value', 'metric_value')}, status, details FROM metrics
    QUALIFY row_number() OVER (PARTITION BY metric_name ORDER BY metric_time DESC) = 1""",
)
def metrics_latest(spark, sf):
    return rounded(latest_metrics(base.metrics_history(spark, sf)))


# The gate runs once per day of the metrics history, for every trigger mode, with and without a champion.
_DRIFT_RX = "^(data_drift|model_drift|prediction_drift|label_drift|concept_drift)_"
_BLOCK_RX = "^(raw_duplicate_open_time_count|raw_null_open_time_count|raw_freshness_hours|features_target_close_1h_null_count|raw_features_row_count_delta|feature_quality_|schema_drift_)"
_VALID_RX = "^(raw_count|raw_duplicate_open_time_count|raw_null_open_time_count|raw_freshness_hours|features_count|features_target_close_1h_null_count|raw_features_row_count_delta|feature_quality_|schema_drift_)"
_DAILY = f"""{SQL_METRICS}, daily AS (SELECT *, date_trunc('day', metric_time)::TIMESTAMP AS day FROM metrics),
latest AS (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY day, metric_name ORDER BY metric_time DESC) = 1)"""
_GATE = f"""{_DAILY}, counts AS (
  SELECT day, count(*) FILTER (status = 'alert') AS alert_count,
    count(*) FILTER (status = 'alert' AND regexp_matches(metric_name, '{_BLOCK_RX}')) AS blocking_alert_count,
    count(*) FILTER (status = 'alert' AND NOT regexp_matches(metric_name, '{_BLOCK_RX}') AND NOT regexp_matches(metric_name, '{_DRIFT_RX}')) AS non_blocking_alert_count,
    count(*) FILTER (status = 'alert' AND regexp_matches(metric_name, '{_DRIFT_RX}')) AS drift_alert_count,
    count(*) FILTER (regexp_matches(metric_name, '{_VALID_RX}')) AS validation_metric_count,
    max(metric_value) FILTER (metric_name = 'raw_freshness_hours') AS raw_freshness_hours
  FROM latest GROUP BY 1)"""
_DECIDE = f"""{_GATE}, cases AS (
  SELECT *, blocking_alert_count = 0 AS unblocked, coalesce(raw_freshness_hours > 60.0, false) AS stale
  FROM counts, (SELECT unnest(['scheduled', 'drift', 'manual']) AS trigger_mode), (SELECT unnest([true, false]) AS champion_exists)),
ruled AS (SELECT *, drift_alert_count > 0 AND unblocked AND validation_metric_count > 0 AS drifted, NOT champion_exists AND unblocked AS first_model,
  trigger_mode = 'manual' AND unblocked AS by_hand, trigger_mode = 'drift' AND validation_metric_count = 0 AS unvalidated FROM cases),
decided AS (SELECT *, CASE WHEN drifted OR first_model OR by_hand THEN true WHEN NOT unblocked OR unvalidated OR stale THEN false ELSE trigger_mode = 'scheduled' END AS should_retrain,
  concat_ws('; ', CASE WHEN NOT unblocked THEN 'latest monitoring has ' || blocking_alert_count || ' blocking alert metrics' END,
    CASE WHEN unvalidated THEN 'missing data/schema/feature quality validation metrics' END,
    CASE WHEN stale THEN 'raw data stale: ' || printf('%.2f', raw_freshness_hours) || 'h > 60.00h' END,
    CASE WHEN drifted THEN 'drift detected: ' || drift_alert_count || ' alert metrics; data/schema/feature quality validation passed' END,
    CASE WHEN first_model THEN 'no Champion exists' END, CASE WHEN by_hand THEN 'trigger_mode=manual' END) AS stated FROM ruled),
decisions AS (SELECT day + INTERVAL 1 DAY AS decision_time, trigger_mode, champion_exists, should_retrain,
  CASE WHEN stated <> '' THEN stated WHEN trigger_mode = 'drift' THEN 'no drift trigger detected' ELSE 'scheduled refresh allowed' END AS reason,
  CASE WHEN should_retrain THEN 'RETRAIN_ALLOWED' WHEN NOT unblocked OR unvalidated OR stale THEN 'NO_RETRAIN_BLOCKED' ELSE 'NO_RETRAIN_NO_TRIGGER' END AS decision_status,
  raw_freshness_hours, alert_count FROM decided)"""

MAX_FRESHNESS = 60.0  # the derived history stores closes as values, so its "hours" are large


def daily_metrics(spark, sf):
    return base.metrics_history(spark, sf).withColumn("day", F.window("metric_time", "1 day")["start"])


@query(
    "gate_counts",
    f"WITH {_GATE} SELECT day, alert_count, blocking_alert_count, non_blocking_alert_count, drift_alert_count, validation_metric_count, {sql_r6('raw_freshness_hours', 'raw_freshness_hours')} FROM counts",
)
def gate_counts(spark, sf):
    return rounded(gate.gate_counts(daily_metrics(spark, sf), by=("day",)))


def decisions(spark, sf):
    """Gate decisions for every day, trigger mode and champion state."""
    counts = gate.gate_counts(daily_metrics(spark, sf), by=("day",))
    cases = counts.withColumn("trigger_mode", F.explode(F.array(*[F.lit(m) for m in ("scheduled", "drift", "manual")])))
    cases = cases.withColumn("champion_exists", F.explode(F.array(F.lit(True), F.lit(False))))
    decided = gate.decide(cases, max_freshness=MAX_FRESHNESS)
    return decided.select(
        (F.col("day") + F.expr("INTERVAL 1 DAY")).alias("decision_time"), "trigger_mode", "champion_exists", "should_retrain", "reason",
        "decision_status", "raw_freshness_hours", "alert_count",
    )


_DECISION_COLUMNS = "decision_time, trigger_mode, champion_exists, should_retrain, reason, decision_status, alert_count"


@query("gate_decision", f"WITH {_DECIDE} SELECT {_DECISION_COLUMNS}, {sql_r6('raw_freshness_hours', 'raw_freshness_hours')} FROM decisions")
def gate_decision(spark, sf):
    return rounded(decisions(spark, sf))


_LAST = "(SELECT max(decision_time) FROM decisions)"


@query(
    "gate_action",
    f"""WITH {_DECIDE} SELECT decision_time, trigger_mode, champion_exists, {sql_r6(_AGE.format(a=_LAST, b='decision_time'), 'decision_age_hours')},
      CASE WHEN {_AGE.format(a=_LAST, b='decision_time')} > 240 THEN 'SKIP_MODEL_REFRESH_STALE_DECISION'
        WHEN trigger_mode <> 'drift' THEN 'SKIP_MODEL_REFRESH_TRIGGER_MODE_MISMATCH'
        WHEN NOT should_retrain AND regexp_matches(reason, 'blocking|stale|missing') THEN 'SKIP_MODEL_REFRESH_BLOCKED'
        WHEN NOT should_retrain THEN 'SKIP_MODEL_REFRESH_NO_RETRAIN_TRIGGER' ELSE 'TRIGGER_MODEL_REFRESH' END AS action FROM decisions""",
)
def gate_action(spark, sf):
    """What the refresh trigger would do with each decision, ten days counting as fresh."""
    rows = decisions(spark, sf)
    as_of = rows.agg(F.max("decision_time")).scalar()
    judged = gate.judge_refresh(rows, as_of, "drift", 240.0)
    return rounded(judged.select("decision_time", "trigger_mode", "champion_exists", "decision_age_hours", "action"))


@query(
    "training_skip",
    f"""WITH {_DECIDE}, newest AS (SELECT * FROM decisions WHERE trigger_mode = 'drift' AND champion_exists ORDER BY decision_time DESC LIMIT 1)
    SELECT decision_time, CASE WHEN {_AGE.format(a=_LAST, b='decision_time')} > 12 THEN 'stale' WHEN NOT should_retrain THEN reason END AS skip_reason FROM newest""",
)
def training_skip(spark, sf):
    rows = decisions(spark, sf)
    as_of = rows.agg(F.max("decision_time")).scalar()
    return gate.training_skip(rows.where((F.col("trigger_mode") == "drift") & F.col("champion_exists")), as_of)


_HAS = "bool_or(status = 'alert' AND metric_name = '{n}')"
_PLAN = f"""{_DAILY}, facts AS (
  SELECT day, count(*) FILTER (status = 'alert') AS alerts, {_HAS.format(n='raw_null_open_time_count')} AS m1, {_HAS.format(n='raw_duplicate_open_time_count')} AS m2,
    string_agg(metric_name, ''', ''' ORDER BY metric_name) FILTER (status = 'alert' AND metric_name LIKE 'schema_drift_%') AS schema_names,
    {_HAS.format(n='raw_freshness_hours')} AS s1,
    {_HAS.format(n='raw_features_row_count_delta')} OR {_HAS.format(n='features_target_close_1h_null_count')} AS s2,
    {_HAS.format(n='prediction_age_hours')} OR bool_or(metric_name = 'prediction_count' AND metric_value = 0) AS s3
  FROM latest GROUP BY 1),
plan AS (SELECT *, concat_ws('; ', CASE WHEN m1 THEN 'raw_null_open_time_count requires landing/parser inspection' END,
    CASE WHEN m2 THEN 'raw_duplicate_open_time_count requires canonical raw table inspection' END,
    CASE WHEN schema_names IS NOT NULL THEN 'schema drift requires manual handling: [''' || schema_names || ''']' END) AS manual,
  concat_ws('+', CASE WHEN s1 THEN 'backfill_raw' END, CASE WHEN s2 THEN 'rebuild_features' END, CASE WHEN s3 THEN 'rerun_prediction' END) AS safe,
  concat_ws(',', CASE WHEN s1 THEN 'fetch,ingest,features' END, CASE WHEN s2 AND NOT s1 THEN 'features' END, CASE WHEN s3 THEN 'predict' END, 'monitor') AS steps FROM facts)"""


@query(
    "remediation_plan",
    f"""WITH {_PLAN} SELECT day,
      CASE WHEN alerts = 0 OR safe = '' THEN 'blocked' WHEN manual <> '' THEN 'attempted' ELSE 'succeeded' END AS status,
      CASE WHEN alerts = 0 THEN 'no data quality alerts to remediate' WHEN safe = '' AND manual <> '' THEN manual WHEN safe = '' THEN 'no auto-remediable data quality alerts found'
        ELSE 'safe_actions=[''' || replace(safe, '+', ''', ''') || ''']' || CASE WHEN manual <> '' THEN '; ' || manual ELSE '' END END AS reason,
      CASE WHEN alerts = 0 THEN 'none' WHEN safe = '' AND manual <> '' THEN 'manual_required' WHEN safe = '' THEN 'none' ELSE safe END AS action_type,
      CASE WHEN alerts = 0 OR safe = '' THEN '' ELSE steps END AS steps FROM plan""",
)
def remediation_plan(spark, sf):
    """One plan per day of the metrics history."""
    plan = gate.remediation_plan(daily_metrics(spark, sf), base.newest_event(spark, sf), by=("day",))
    return plan.select("day", "status", "reason", "action_type", F.concat_ws(",", "steps").alias("steps"))


_RECENT = f"metric_time >= {_AS_OF} - INTERVAL 2 HOUR AND status = 'alert'"
_FRESH = f"fresh AS (SELECT * FROM scored WHERE prediction_time >= {_AS_OF} - INTERVAL 24 HOUR)"
# metrics and predictions both start from bars, so the shared CTE is stated once.
_ALERT_INPUTS = SQL_SCORED + SQL_METRICS[len(base.SQL_BARS):]


@query(
    "alerts_eval",
    f"""WITH {_ALERT_INPUTS}, {_FRESH}, facts AS (
      SELECT 'raw_data_stale' AS alert_name, (SELECT metric_value FROM metrics WHERE metric_name = 'raw_freshness_hours' ORDER BY metric_time DESC LIMIT 1) AS v, 3.0 AS threshold
      UNION ALL SELECT 'monitoring_has_alerts', (SELECT count(*) FROM metrics WHERE {_RECENT}), 0
      UNION ALL SELECT 'no_recent_prediction', (SELECT CASE WHEN max(prediction_time) IS NULL THEN 999999 ELSE trunc({_AGE.format(a=_AS_OF, b='max(prediction_time)')}) END FROM predictions), 3
      UNION ALL SELECT 'high_prediction_error', (SELECT avg(pct_error) FROM fresh), 0.02
      UNION ALL SELECT 'high_prediction_error_guarded', (SELECT CASE WHEN count(*) < 12 THEN 0.0 ELSE coalesce(avg(pct_error), 0.0) END FROM fresh), 0.05
      UNION ALL SELECT 'missing_targets', (SELECT count(*) FROM features WHERE target_close_1h IS NULL), 1
      UNION ALL SELECT 'any_drift_alert', (SELECT count(*) FROM metrics WHERE {_RECENT} AND regexp_matches(metric_name, '^(data_drift|label_drift|prediction_drift|model_drift|concept_drift)_')), 0
      UNION ALL SELECT 'feature_quality_or_schema_alert', (SELECT count(*) FROM metrics WHERE {_RECENT} AND regexp_matches(metric_name, '^(feature_quality|schema_drift)_')), 0
      UNION ALL SELECT 'job_quality_alert', (SELECT count(*) FROM metrics WHERE {_RECENT} AND regexp_matches(metric_name, '^job_quality_')), 0)
    SELECT alert_name, {sql_r6('v', 'value')}, {sql_r6('threshold', 'threshold')}, CASE WHEN v > threshold THEN 'TRIGGERED' ELSE 'OK' END AS state FROM facts""",
)
def alerts_eval(spark, sf):
    """All alerts over the derived metrics history, features and predictions."""
    raw, rows, predictions = base.stored_tables(spark, sf)
    found = alerts.alert_set(base.metrics_history(spark, sf), rows, predictions, raw, base.newest_event(spark, sf), KEYS)
    return rounded(alerts.evaluate(found))


@query(
    "alert_job_trace",
    f"""WITH {SQL_METRICS}, raised AS (SELECT * FROM metrics WHERE metric_time >= {_AS_OF} - INTERVAL 240 HOUR AND status = 'alert' AND regexp_matches(metric_name, '^job_quality_')),
    latest AS (SELECT * FROM raised ORDER BY metric_time DESC, metric_name DESC LIMIT 1)
    SELECT (SELECT count(*) FROM raised) AS job_quality_alert_count, (SELECT metric_time FROM latest) AS latest_alert_time, (SELECT metric_name FROM latest) AS latest_metric_name,
    {sql_r6('(SELECT metric_value FROM latest)', 'latest_metric_value')}, (SELECT details FROM latest) AS latest_trace_details""",
)
def alert_job_trace(spark, sf):
    """Job alerts of the last ten days with the newest of them."""
    as_of = base.newest_event(spark, sf) - F.expr("INTERVAL 238 HOURS")
    return rounded(alerts.job_alert_trace(base.metrics_history(spark, sf), as_of))

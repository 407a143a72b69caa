"""Gate truth table, consumers, remediation, monitors, reports and alerts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.status import threshold_status
from tickloom.plans import alerts, gate, monitor, reports
from tickloom.plans.metrics import latest_metrics, status_counts

NOW = datetime(2025, 1, 10)


def metrics(spark, *rows):
    """rows: (name, value, status[, hours before now])"""
    full = [(NOW - timedelta(hours=r[3] if len(r) > 3 else 0), r[0], float(r[1]) if r[1] is not None else None, r[2], "{}") for r in rows]
    return spark.createDataFrame(full, schemas.METRICS)


def facts(spark, blocking=0, drift=0, validation=5, freshness=1.0):
    row = (blocking + drift, blocking, 0, drift, validation, freshness)
    schema = "alert_count BIGINT, blocking_alert_count BIGINT, non_blocking_alert_count BIGINT, drift_alert_count BIGINT, validation_metric_count BIGINT, raw_freshness_hours DOUBLE"
    return spark.createDataFrame([row], schema)


@pytest.mark.parametrize(
    "value, higher, expected",
    [(None, True, "warn"), (0.1, True, "ok"), (0.25, True, "warn"), (1.0, True, "alert"), (0.5, False, "alert"), (0.9, False, "warn"), (1.1, False, "ok")],
)
def test_threshold_status(spark, value, higher, expected):
    limits = (0.25, 1.0) if higher else (1.0, 0.5)
    df = spark.createDataFrame([(value,)], "v DOUBLE")
    assert df.select(threshold_status(F.col("v"), *limits, higher)).first()[0] == expected


# mode, champion, facts -> retrain, status, part of the reason
CASES = [
    ("scheduled", True, {}, True, "RETRAIN_ALLOWED", "scheduled refresh allowed"),
    ("drift", True, {}, False, "NO_RETRAIN_NO_TRIGGER", "no drift trigger detected"),
    ("manual", True, {}, True, "RETRAIN_ALLOWED", "trigger_mode=manual"),
    ("scheduled", True, {"blocking": 2}, False, "NO_RETRAIN_BLOCKED", "latest monitoring has 2 blocking alert metrics"),
    ("manual", True, {"blocking": 1}, False, "NO_RETRAIN_BLOCKED", "blocking"),
    ("scheduled", False, {"blocking": 1}, False, "NO_RETRAIN_BLOCKED", "blocking"),
    ("drift", True, {"validation": 0}, False, "NO_RETRAIN_BLOCKED", "missing data/schema/feature quality validation metrics"),
    ("scheduled", True, {"validation": 0}, True, "RETRAIN_ALLOWED", "scheduled refresh allowed"),
    ("scheduled", True, {"freshness": 5.0}, False, "NO_RETRAIN_BLOCKED", "raw data stale: 5.00h > 3.00h"),
    ("scheduled", True, {"freshness": None}, True, "RETRAIN_ALLOWED", "scheduled refresh allowed"),
    ("drift", True, {"drift": 3}, True, "RETRAIN_ALLOWED", "drift detected: 3 alert metrics; data/schema/feature quality validation passed"),
    ("drift", True, {"drift": 3, "freshness": 5.0}, True, "RETRAIN_ALLOWED", "raw data stale: 5.00h > 3.00h; drift detected: 3"),
    ("drift", True, {"drift": 3, "blocking": 1}, False, "NO_RETRAIN_BLOCKED", "blocking"),
    ("drift", True, {"drift": 3, "validation": 0}, False, "NO_RETRAIN_BLOCKED", "missing"),
    ("drift", False, {}, True, "RETRAIN_ALLOWED", "no Champion exists"),
    ("manual", True, {"freshness": 9.0}, True, "RETRAIN_ALLOWED", "trigger_mode=manual"),
]


@pytest.mark.parametrize("mode, champion, given, retrain, status, reason", CASES)
def test_gate_truth_table(spark, mode, champion, given, retrain, status, reason):
    got = gate.decide(facts(spark, **given), F.lit(mode), F.lit(champion)).first()
    assert (got.should_retrain, got.decision_status) == (retrain, status)
    assert reason in got.reason


def test_gate_counts_use_the_latest_row_per_metric(spark):
    df = metrics(
        spark, ("raw_freshness_hours", 9, "alert", 5), ("raw_freshness_hours", 1, "ok", 0), ("data_drift_psi_volume", 2, "alert"),
        ("schema_drift_missing_x", 1, "alert"), ("job_quality_success_rate_1", 0, "alert"), ("price_level_drift_psi_close", 1, "warn"),
    )
    got = gate.gate_counts(df).first()
    assert (got.alert_count, got.blocking_alert_count, got.non_blocking_alert_count, got.drift_alert_count) == (3, 1, 1, 1)
    assert (got.validation_metric_count, got.raw_freshness_hours) == (2, 1.0)
    assert status_counts(latest_metrics(df)).first().alert_count == 3


def test_decision_row_layout(spark):
    got = gate.decision_row(None, spark, NOW, "scheduled", False, {"raw": 4}).first()
    assert got.should_retrain and got.raw_freshness_hours == -1.0
    assert (got.raw_table_version, got.features_table_version) == (4, -1)
    assert got.asDict().keys() == set(schemas.struct_of(schemas.DECISIONS).names)


def decisions(spark, *rows):
    return spark.createDataFrame([(NOW - timedelta(hours=h), mode, ok, why) for h, mode, ok, why in rows], "decision_time TIMESTAMP, trigger_mode STRING, should_retrain BOOLEAN, reason STRING")


@pytest.mark.parametrize(
    "rows, action",
    [
        ([], "SKIP_MODEL_REFRESH_NO_DECISION"),
        ([(13, "drift", True, "x")], "SKIP_MODEL_REFRESH_STALE_DECISION"),
        ([(1, "manual", True, "x")], "SKIP_MODEL_REFRESH_TRIGGER_MODE_MISMATCH"),
        ([(1, "drift", False, "raw data stale: 9h")], "SKIP_MODEL_REFRESH_BLOCKED"),
        ([(1, "drift", False, "no drift trigger detected")], "SKIP_MODEL_REFRESH_NO_RETRAIN_TRIGGER"),
        ([(1, "drift", True, "x"), (5, "manual", False, "y")], "TRIGGER_MODEL_REFRESH"),
    ],
)
def test_refresh_action(spark, rows, action):
    assert gate.refresh_action(decisions(spark, *rows), NOW).first().action == action


def test_training_skip(spark):
    reason = lambda *rows: gate.training_skip(decisions(spark, *rows), NOW).first().skip_reason
    assert reason() == "missing training gate decision"
    assert reason((13, "drift", True, "x")) == "stale training gate decision: 13.00h > 12.00h"
    assert reason((1, "manual", True, "x")) == "unexpected trigger_mode=manual; expected=drift"
    assert reason((1, "drift", False, "blocked")) == "blocked"
    assert reason((1, "drift", True, "x")) is None


REMEDIES = [
    ([("raw_count", 5, "ok")], "blocked", "none", "no data quality alerts to remediate", []),
    ([("raw_freshness_hours", 9, "alert")], "succeeded", "backfill_raw", "safe_actions=['backfill_raw']", ["fetch", "ingest", "features", "monitor"]),
    (
        [("raw_freshness_hours", 9, "alert"), ("raw_features_row_count_delta", 9, "alert"), ("prediction_count", 0, "ok")], "succeeded",
        "backfill_raw+rebuild_features+rerun_prediction", "safe_actions=['backfill_raw', 'rebuild_features', 'rerun_prediction']", ["fetch", "ingest", "features", "predict", "monitor"],
    ),
    ([("features_target_close_1h_null_count", 9, "alert")], "succeeded", "rebuild_features", "safe_actions", ["features", "monitor"]),
    ([("raw_null_open_time_count", 1, "alert")], "blocked", "manual_required", "raw_null_open_time_count requires landing/parser inspection", []),
    (
        [("schema_drift_missing_b", 1, "alert"), ("schema_drift_missing_a", 1, "alert"), ("prediction_age_hours", 9, "alert")], "attempted", "rerun_prediction",
        "safe_actions=['rerun_prediction']; schema drift requires manual handling: ['schema_drift_missing_a', 'schema_drift_missing_b']", ["predict", "monitor"],
    ),
    ([("data_drift_psi_volume", 9, "alert")], "blocked", "none", "no auto-remediable data quality alerts found", []),
]


@pytest.mark.parametrize("rows, status, action, reason, steps", REMEDIES)
def test_remediation(spark, rows, status, action, reason, steps):
    got = gate.remediation_plan(metrics(spark, *rows), NOW).first()
    assert (got.status, got.action_type, got.steps) == (status, action, steps)
    assert got.reason.startswith(reason)


def series(spark, n, price=2000.0):
    rows = [("a", NOW - timedelta(hours=n - i), price + i % 7) for i in range(n)]
    return spark.createDataFrame(rows, "symbol STRING, open_time TIMESTAMP, close DOUBLE")


def predictions(spark, n, shift=0.0):
    return series(spark, n).select(
        "symbol", F.col("open_time").alias("feature_open_time"), (F.col("open_time") + F.expr("INTERVAL 1 HOUR")).alias("prediction_time"),
        (F.col("close") + shift).alias("predicted_close"), F.lit("m").alias("model_uri"),
    )


def test_health_without_predictions_and_with_faults(spark):
    raw = series(spark, 5)
    raw = raw.unionByName(raw.limit(1)).unionByName(raw.limit(1).withColumn("open_time", F.lit(None).cast("timestamp")))
    feats = series(spark, 5).withColumn("target_close_1h", F.lit(None).cast("double"))
    got = {r.metric_name: r for r in monitor.health_metrics(raw, feats, None, NOW, ["symbol"]).collect()}
    assert got["raw_count"].metric_value == 7
    assert (got["raw_duplicate_open_time_count"].metric_value, got["raw_duplicate_open_time_count"].status) == (1, "alert")
    assert (got["raw_null_open_time_count"].metric_value, got["raw_null_open_time_count"].status) == (1, "alert")
    assert got["raw_freshness_hours"].status == "ok" and '"lineage"' in got["raw_freshness_hours"].details
    assert got["features_target_close_1h_null_count"].status == "alert"
    assert got["raw_features_row_count_delta"].status == "alert"
    assert (got["prediction_count"].status, "prediction_age_hours" in got) == ("warn", False)


def test_health_of_empty_tables(spark):
    none = series(spark, 1).where("false")
    got = {r.metric_name: r for r in monitor.health_metrics(none, none.withColumn("target_close_1h", F.lit(1.0)), predictions(spark, 1).where("false"), NOW, ["symbol"]).collect()}
    assert (got["raw_count"].metric_value, got["raw_freshness_hours"].metric_value, got["raw_freshness_hours"].status) == (0, None, "alert")
    assert (got["prediction_count"].metric_value, got["prediction_age_hours"].status) == (0, "alert")


def test_drift_metric_set_edges(spark):
    assert [r.metric_name for r in monitor.feature_drift_metrics(None, NOW, spark).collect()] == ["drift_features_table_exists"]
    empty = series(spark, 1).where("false")
    assert {r.metric_name for r in monitor.feature_drift_metrics(empty, NOW, columns=["close"], watched=[]).collect()} >= {"drift_features_row_count"}
    feats = series(spark, 400).withColumn("volume", F.lit(None).cast("double"))
    got = {r.metric_name: r for r in monitor.feature_drift_metrics(feats, NOW, columns=["volume", "spread"], watched=["close"]).collect()}
    assert got["schema_drift_missing_spread"].status == "alert"
    assert (got["data_drift_psi_volume"].metric_value, got["data_drift_psi_volume"].status) == (None, "warn")
    assert got["feature_quality_null_rate_volume"].status == "alert"
    assert got["price_level_drift_ks_close"].status == "ok"


def test_performance_edges(spark):
    run = lambda p, b: {r.metric_name: r for r in monitor.performance_metrics(p, b, ["symbol"], NOW, spark).collect()}
    assert run(None, None)["model_drift_joined_prediction_count"].status == "warn"
    assert run(predictions(spark, 5), series(spark, 5).where("false"))["model_drift_joined_prediction_count"].details.count("No actuals yet") == 1
    good = run(predictions(spark, 50), series(spark, 50))
    assert good["model_drift_joined_prediction_count"].metric_value == 49
    assert "model_drift_invalid_predicted_close_count_24h" not in good
    bad = run(predictions(spark, 50, shift=-1500.0), series(spark, 50))
    assert bad["model_drift_invalid_predicted_close_count_24h"].metric_value == 49
    assert bad["model_drift_mape_24h"].status == "warn"  # nothing valid to judge


def job_runs(spark, *results):
    rows = [
        (1, "job", i, i, 120000, (("TERMINATED", r, "") if r else ("RUNNING", None, "")), [("t", i, ("TERMINATED", r, ""))]) for i, r in enumerate(results)
    ]
    return spark.createDataFrame(rows, schemas.JOB_RUNS)


def test_job_quality(spark):
    got = monitor.job_quality(job_runs(spark, *["SUCCESS"] * 30, "FAILED", None)).first()
    assert (got.run_count, got.terminal_runs, got.failed_runs) == (20, 19, 1)
    assert got.success_rate == pytest.approx(18 / 19) and got.latest_run_id == 30 and got.latest_success == 0
    names = {r.metric_name: r for r in monitor.job_quality_metrics(job_runs(spark, "SUCCESS", "FAILED"), NOW).collect()}
    assert names["job_quality_success_rate_1"].status == "alert" and names["job_quality_latest_failed_task_count_1"].metric_value == 1
    running = {r.metric_name: r for r in monitor.job_quality_metrics(job_runs(spark, None), NOW).collect()}
    assert (running["job_quality_success_rate_1"].status, running["job_quality_latest_success_1"].status) == ("warn", "warn")
    catalog = spark.createDataFrame([(1, "job"), (2, "job idle"), (3, "other")], "job_id BIGINT, job_name STRING")
    listed = {r.metric_name: r for r in monitor.job_quality_metrics(job_runs(spark, "SUCCESS"), NOW, catalog=catalog, name_filter="job").collect()}
    assert listed["job_quality_matching_job_count"].metric_value == 2 and listed["job_quality_run_count_2"].status == "warn"


def test_recent_runs_limit_before_the_shuffle(spark):
    plan = monitor.recent_runs(job_runs(spark, "SUCCESS"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0  # a partial limit below the exchange


def test_trace_decoding(spark):
    trace = monitor.decode_trace(monitor.job_quality_metrics(job_runs(spark, "FAILED"), NOW, base_url="https://x"))
    row = trace.where("metric_name = 'job_quality_latest_failed_task_count_1'").first().trace
    assert (row.job_id, row.run_url, row.failed_tasks[0].task_key) == (1, "https://x/#job/1/run/0", "t")


def test_alert_edges(spark):
    df = metrics(spark, ("raw_freshness_hours", 4, "alert", 0), ("job_quality_x", 1, "alert", 1), ("job_quality_y", 1, "alert", 3))
    assert alerts.alert_count(df, NOW).first()[0] == 2
    assert alerts.job_alert_trace(df, NOW).first().latest_metric_name == "job_quality_x"
    none = predictions(spark, 1).where("false")
    assert alerts.prediction_age(none, NOW).first()[0] == 999999
    few = alerts.prediction_error_guarded(predictions(spark, 8), series(spark, 8), NOW, ["symbol"]).first()
    assert (few.n_eval, few.avg_pct_error) == (7, 0.0)
    feats = series(spark, 3).withColumn("target_close_1h", F.lit(None).cast("double"))
    got = {r.alert_name: r.state for r in alerts.evaluate(alerts.alert_set(df, feats, none, series(spark, 3), NOW, ["symbol"])).collect()}
    assert got["raw_data_stale"] == got["missing_targets"] == got["no_recent_prediction"] == "TRIGGERED"
    assert got["high_prediction_error"] == "OK"  # unknown value


def test_report_from_named_table(spark):
    metrics(spark, ("raw_count", 5, "ok")).createOrReplaceTempView("tl_metrics")
    got = reports.from_table(spark, "tl_metrics", "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE status = 'ok'")
    assert got.first().n == 1

"""Dashboard reports. Each is a function of its tables; top-N reports break ties by further columns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.parse import any_match
from tickloom.operators.bars import calendar_totals
from tickloom.operators.horizon import predictions_with_actuals
from tickloom.operators.indicators import HORIZON
from tickloom.plans.monitor import MIN_VALID_PREDICTION

# Prefix groups of the metric reports (fixed values).
DRIFT_GROUP = ("data_drift_", "label_drift_", "prediction_drift_", "model_drift_", "concept_drift_")
QUALITY_GROUP = ("feature_quality_", "schema_drift_")
JOB_GROUP = ("job_quality_",)

METRIC_COLUMNS = ("metric_time", "metric_name", "metric_value", "status", "details")


def newest(df: DataFrame, columns, order: list[str], limit: int, ties=()) -> DataFrame:
    """Top rows by descending ``order`` and ascending ``ties``; Spark keeps ``limit`` rows per task."""
    return df.orderBy(*[F.col(c).desc() for c in order], *[F.col(c).asc() for c in ties]).limit(limit).select(*columns)


def metric_tile(metrics: DataFrame, name: str, with_details: bool = False) -> DataFrame:
    """The newest value of one metric, named after it."""
    extra = ["details"] if with_details else []
    rows = metrics.where(F.col("metric_name") == name).select(
        "metric_time", F.col("metric_value").alias(name), "status", *extra
    )
    return newest(rows, rows.columns, ["metric_time"], 1)


def data_freshness(metrics: DataFrame) -> DataFrame:
    return metric_tile(metrics, "raw_freshness_hours", with_details=True)


def raw_count(metrics: DataFrame) -> DataFrame:
    return metric_tile(metrics, "raw_count")


def features_count(metrics: DataFrame) -> DataFrame:
    return metric_tile(metrics, "features_count")


def prediction_count(metrics: DataFrame) -> DataFrame:
    return metric_tile(metrics, "prediction_count")


def _ties(df: DataFrame, keys) -> list[str]:
    return [k for k in (*keys, "model_uri") if k in df.columns]


def latest_predictions(predictions: DataFrame, keys=(), limit: int = 50) -> DataFrame:
    columns = [*keys, "prediction_time", "feature_open_time", "predicted_close", "predicted_return_1h", "model_target_col", "model_uri"]
    return newest(predictions, columns, ["prediction_time"], limit, _ties(predictions, keys))


def actual_vs_predicted(
    predictions: DataFrame, bars: DataFrame, keys=(), limit: int = 100, min_valid: float = MIN_VALID_PREDICTION
) -> DataFrame:
    """Newest predictions with the close they forecast where it is known.

    Bars are unique by key and time, so the left join neither drops nor multiplies rows and the top-N
    can run first. Its at most ``limit`` rows are broadcast to pick their bars without a shuffle of
    the bars; the left join then meets two small sides.
    """
    valid = predictions.where(F.col("predicted_close") > min_valid)
    ties = _ties(predictions, keys)
    top = newest(valid, predictions.columns, ["prediction_time"], limit, ties)
    times = top.select(*keys, (F.col("feature_open_time") + F.lit(HORIZON)).alias("open_time")).distinct()
    wanted = F.broadcast(times) if limit <= 10_000 else times
    joined = predictions_with_actuals(top, bars.join(wanted, [*keys, "open_time"], "left_semi"), list(keys), "left")
    columns = [
        *keys, "prediction_time", "feature_open_time", "predicted_close", "actual_open_time", "actual_close", "abs_error", "pct_error",
    ]
    if "model_uri" in predictions.columns:
        columns.append("model_uri")
    return newest(joined, columns, ["prediction_time"], limit, ties)


def prediction_error_trend(
    predictions: DataFrame, bars: DataFrame, keys=(), min_valid: float = MIN_VALID_PREDICTION
) -> DataFrame:
    """Error of every prediction whose actual is known."""
    valid = predictions.where(F.col("predicted_close") > min_valid)
    joined = predictions_with_actuals(valid, bars, list(keys), "inner")
    return joined.select(*keys, "feature_open_time", "predicted_close", "actual_close", "abs_error", "pct_error")


def legacy_predictions(
    predictions: DataFrame, keys=(), limit: int = 100, min_valid: float = MIN_VALID_PREDICTION
) -> DataFrame:
    """Predictions that are missing or too small to be prices."""
    bad = predictions.where((F.col("predicted_close") <= min_valid) | F.col("predicted_close").isNull())
    columns = [
        *keys, "prediction_time", "feature_open_time", "predicted_close", "predicted_return_1h", "model_target_col", "model_version", "model_run_id",
    ]
    return newest(bad, columns, ["prediction_time"], limit, _ties(predictions, keys))


def refresh_decisions(decisions: DataFrame, limit: int = 50) -> DataFrame:
    columns = [
        "decision_time", "should_retrain", "reason", "trigger_mode", "raw_freshness_hours", "alert_count", "champion_exists",
    ]
    return newest(decisions, columns, ["decision_time"], limit)


def _metric_report(metrics: DataFrame, limit: int, prefixes=None, statuses=None) -> DataFrame:
    if prefixes:
        metrics = metrics.where(any_match(F.col("metric_name"), prefixes))
    if statuses:
        metrics = metrics.where(F.col("status").isin(*statuses))
    return newest(metrics, METRIC_COLUMNS, ["metric_time"], limit, ["metric_name"])


RAISED = ("alert", "warn")


def monitoring_alerts(metrics: DataFrame, limit: int = 100) -> DataFrame:
    return _metric_report(metrics, limit, statuses=RAISED)


def metrics_timeline(metrics: DataFrame, limit: int = 500) -> DataFrame:
    return _metric_report(metrics, limit)


def drift_metrics(metrics: DataFrame, limit: int = 300) -> DataFrame:
    return _metric_report(metrics, limit, DRIFT_GROUP + QUALITY_GROUP)


def drift_alerts(metrics: DataFrame, limit: int = 100) -> DataFrame:
    return _metric_report(metrics, limit, DRIFT_GROUP + QUALITY_GROUP, RAISED)


def job_metrics(metrics: DataFrame, limit: int = 300) -> DataFrame:
    return _metric_report(metrics, limit, JOB_GROUP)


def job_alerts(metrics: DataFrame, limit: int = 100) -> DataFrame:
    return _metric_report(metrics, limit, JOB_GROUP, RAISED)


def daily_volume(bars: DataFrame, start, end) -> DataFrame:
    """Daily totals over an inclusive time range."""
    return calendar_totals(bars, "1 day", start, end)


def _latest_run(explanations: DataFrame, kind: str, order: str, columns: list[str], limit: int) -> DataFrame:
    """Top features of the newest run that has rows of this kind; the run id is a scalar subquery."""
    rows = explanations.where(F.col("explanation_type") == kind)
    run = rows.agg(F.max_by("run_id", F.struct("created_at", "run_id"))).scalar()
    return newest(rows.where(F.col("run_id") == run), columns, [order], limit, ["feature"])


def contribution_report(explanations: DataFrame, limit: int = 30) -> DataFrame:
    columns = [
        "created_at", "run_id", "model_algo", "feature", "mean_abs_shap", "mean_shap", "sample_rows", "features_table_version", "feature_config_id",
    ]
    return _latest_run(explanations, "shap_summary", "mean_abs_shap", columns, limit)


def importance_report(explanations: DataFrame, limit: int = 30) -> DataFrame:
    columns = ["created_at", "run_id", "model_algo", "feature", "importance", "features_table_version", "feature_config_id"]
    return _latest_run(explanations, "feature_importance", "importance", columns, limit)


def training_manifests(manifests: DataFrame, limit: int = 20) -> DataFrame:
    columns = [
        "created_at", "run_id", "model_algo", "target_col", "raw_table_version", "features_table_version",
        "feature_config_version", "feature_config_id", "train_rows", "test_rows", "n_features",
    ]
    return newest(manifests, columns, ["created_at"], limit, ["run_id"])


def prediction_lineage(predictions: DataFrame, keys=(), limit: int = 50) -> DataFrame:
    """Serving versions next to training versions."""
    renamed = predictions.withColumnsRenamed(
        {
            "raw_table_version": "serving_raw_version",
            "features_table_version": "serving_features_version",
            "model_raw_table_version": "training_raw_version",
            "model_features_table_version": "training_features_version",
        }
    )
    columns = [
        *keys, "prediction_time", "feature_open_time", "predicted_close", "predicted_return_1h", "model_version",
        "model_run_id", "model_target_col", "serving_raw_version", "serving_features_version",
        "training_raw_version", "training_features_version", "model_feature_config_version", "model_feature_config_id",
    ]
    return newest(renamed, columns, ["prediction_time"], limit, _ties(predictions, keys))


def from_table(spark, table: str, sql: str) -> DataFrame:
    """Run report SQL against a table named at call time through ``IDENTIFIER(:t)``."""
    return spark.sql(sql, args={"t": table})


def since(as_of, hours: int) -> Column:
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return as_of - F.lit(timedelta(hours=hours))

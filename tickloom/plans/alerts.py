"""Alert values and their evaluation against thresholds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import scores
from tickloom.functions.parse import any_match
from tickloom.operators.evaluate import guarded_error
from tickloom.operators.horizon import predictions_with_actuals
from tickloom.plans.metrics import latest_metrics
from tickloom.plans.reports import DRIFT_GROUP, JOB_GROUP, QUALITY_GROUP, since

NO_PREDICTION_AGE = 999999  # fixed value: the age reported when nothing was ever predicted


def raw_freshness(metrics: DataFrame) -> DataFrame:
    rows = metrics.where(F.col("metric_name") == "raw_freshness_hours")
    return latest_metrics(rows).select(F.col("metric_value").alias("raw_freshness_hours"))


def recent_alerts(metrics: DataFrame, as_of, prefixes=None, hours: int = 2) -> DataFrame:
    rows = metrics.where((F.col("metric_time") >= since(as_of, hours)) & (F.col("status") == "alert"))
    return rows.where(any_match(F.col("metric_name"), prefixes)) if prefixes else rows


def alert_count(metrics: DataFrame, as_of, name: str = "alert_count", prefixes=None) -> DataFrame:
    return recent_alerts(metrics, as_of, prefixes).agg(F.count("*").alias(name))


def prediction_age(predictions: DataFrame, as_of) -> DataFrame:
    """Whole hours since the newest prediction."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    newest = F.max("prediction_time")
    age = F.timestamp_diff("HOUR", newest, as_of)
    return predictions.agg(F.when(newest.isNull(), F.lit(NO_PREDICTION_AGE)).otherwise(age).alias("prediction_age_hours"))


def _recent_scored(predictions: DataFrame, bars: DataFrame, as_of, keys, hours: int) -> DataFrame:
    fresh = predictions.where(F.col("prediction_time") >= since(as_of, hours))
    return predictions_with_actuals(fresh, bars, list(keys), "inner")


def prediction_error(predictions: DataFrame, bars: DataFrame, as_of, keys=(), hours: int = 24) -> DataFrame:
    """Mean relative error without a row floor (template variant, threshold 2%)."""
    rows = _recent_scored(predictions, bars, as_of, keys, hours)
    return rows.agg(scores.mape("actual_close", "predicted_close").alias("avg_pct_error"))


def prediction_error_guarded(predictions: DataFrame, bars: DataFrame, as_of, keys=(), hours: int = 24) -> DataFrame:
    """Mean relative error, 0 below 12 rows (deployed variant, threshold 5%)."""
    return guarded_error(_recent_scored(predictions, bars, as_of, keys, hours))


def missing_targets(features: DataFrame) -> DataFrame:
    return features.agg(F.count_if(F.col("target_close_1h").isNull()).alias("target_null_count"))


def job_alert_trace(metrics: DataFrame, as_of) -> DataFrame:
    """Number of recent job alerts and the newest of them, in one aggregate."""
    rows = recent_alerts(metrics, as_of, JOB_GROUP)
    newest = F.max(F.struct("metric_time", "metric_name", "metric_value", "details"))
    return rows.agg(F.count("*").alias("job_quality_alert_count"), newest.alias("m")).select(
        "job_quality_alert_count",
        F.col("m.metric_time").alias("latest_alert_time"),
        F.col("m.metric_name").alias("latest_metric_name"),
        F.col("m.metric_value").alias("latest_metric_value"),
        F.col("m.details").alias("latest_trace_details"),
    )


@dataclass(frozen=True)
class Alert:
    """A named one-row value and the limit above which it triggers."""

    name: str
    column: str
    threshold: float
    value: Callable[..., DataFrame]


def alert_set(metrics: DataFrame, features: DataFrame, predictions: DataFrame, bars: DataFrame, as_of, keys=()) -> list[Alert]:
    """The eight templates and the guarded error variant with their thresholds (fixed values)."""
    return [
        Alert("raw_data_stale", "raw_freshness_hours", 3.0, lambda: raw_freshness(metrics)),
        Alert("monitoring_has_alerts", "alert_count", 0.0, lambda: alert_count(metrics, as_of)),
        Alert("no_recent_prediction", "prediction_age_hours", 3.0, lambda: prediction_age(predictions, as_of)),
        Alert("high_prediction_error", "avg_pct_error", 0.02, lambda: prediction_error(predictions, bars, as_of, keys)),
        Alert("high_prediction_error_guarded", "avg_pct_error", 0.05, lambda: prediction_error_guarded(predictions, bars, as_of, keys)),
        Alert("missing_targets", "target_null_count", 1.0, lambda: missing_targets(features)),
        Alert("any_drift_alert", "drift_alert_count", 0.0, lambda: alert_count(metrics, as_of, "drift_alert_count", DRIFT_GROUP)),
        Alert(
            "feature_quality_or_schema_alert", "quality_alert_count", 0.0,
            lambda: alert_count(metrics, as_of, "quality_alert_count", QUALITY_GROUP),
        ),
        Alert("job_quality_alert", "job_quality_alert_count", 0.0, lambda: job_alert_trace(metrics, as_of)),
    ]


def evaluate(alerts: list[Alert]) -> DataFrame:
    """One row per alert: value, threshold and TRIGGERED or OK. An unknown value does not trigger."""
    rows = None
    for alert in alerts:
        value = F.col(alert.column).cast("double")
        state = F.when(value > alert.threshold, "TRIGGERED").otherwise("OK")
        row = alert.value().select(
            F.lit(alert.name).alias("alert_name"), value.alias("value"), F.lit(alert.threshold).alias("threshold"), state.alias("state")
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows

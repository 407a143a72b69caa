"""Long-format metric rows: (metric_time, metric_name, metric_value, status, details)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.status import OK


@dataclass(frozen=True)
class Metric:
    """One metric over a one-row frame. ``keep`` is false for rows that should not be written."""

    name: str | Column
    value: Column
    status: Column | str = OK
    message: Column | str = ""
    keep: Column | None = None


def _lit(x):
    return x if isinstance(x, Column) else F.lit(x)


def lineage_json(versions: dict | None = None) -> Column:
    """Struct with the version of each input table, for the ``details`` column."""
    versions = versions or {}
    return F.struct(
        *[F.lit(versions.get(name)).cast("bigint").alias(name) for name in ("raw", "features", "predictions")]
    )


def details_json(message: Column | str, versions: dict | None = None) -> Column:
    return F.to_json(
        F.struct(_lit(message).alias("message"), lineage_json(versions).alias("lineage")),
        {"ignoreNullFields": "false"},
    )


def metric_rows(facts: DataFrame, metrics: list[Metric], metric_time, versions: dict | None = None) -> DataFrame:
    """One output row per metric and input row; no driver-side list."""
    cells = [
        F.struct(
            _lit(m.name).alias("metric_name"),
            m.value.cast("double").alias("metric_value"),
            _lit(m.status).alias("status"),
            details_json(m.message, versions).alias("details"),
            (F.lit(True) if m.keep is None else m.keep).alias("_keep"),
        )
        for m in metrics
    ]
    return (
        facts.select(F.inline(F.array(*cells)))
        .where("_keep")
        .select(_lit(metric_time).alias("metric_time"), "metric_name", "metric_value", "status", "details")
    )


def latest_metrics(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The newest row of each metric name (per group), as an aggregate that combines on the map side."""
    row = F.struct("metric_time", "metric_value", "status", "details")
    newest = metrics.groupBy(*by, "metric_name").agg(F.max(row).alias("m"))
    return newest.select(*by, "metric_name", "m.*")


def status_counts(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count("*").alias("metric_count"),
        F.count_if(F.col("status") == "alert").alias("alert_count"),
        F.count_if(F.col("status") == "warn").alias("warn_count"),
    )

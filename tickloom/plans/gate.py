"""Retrain gate, its consumers and the remediation planner, as rules over one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.parse import any_match, first_true
from tickloom.operators.quality import age_hours
from tickloom.plans.metrics import latest_metrics

# Metric-name prefixes by role (fixed values).
DRIFT_PREFIXES = ("data_drift_", "model_drift_", "prediction_drift_", "label_drift_", "concept_drift_")
BLOCKING_PREFIXES = (
    "raw_duplicate_open_time_count", "raw_null_open_time_count", "raw_freshness_hours",
    "features_target_close_1h_null_count", "raw_features_row_count_delta",
    "feature_quality_", "schema_drift_",
)
VALIDATION_PREFIXES = ("raw_count", "features_count", *BLOCKING_PREFIXES)
MAX_RAW_FRESHNESS_HOURS, MAX_DECISION_AGE_HOURS = 3.0, 12.0


def gate_counts(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The six facts the gate looks at, from one aggregate over the latest metrics.

    ``by`` decides for many tables or assets at once.
    """
    name = F.col("metric_name")
    alert = F.col("status") == "alert"
    drift, blocking = any_match(name, DRIFT_PREFIXES), any_match(name, BLOCKING_PREFIXES)
    return latest_metrics(metrics, by).groupBy(*by).agg(
        F.count_if(alert).alias("alert_count"),
        F.count_if(alert & blocking).alias("blocking_alert_count"),
        F.count_if(alert & ~blocking & ~drift).alias("non_blocking_alert_count"),
        F.count_if(alert & drift).alias("drift_alert_count"),
        F.count_if(any_match(name, VALIDATION_PREFIXES)).alias("validation_metric_count"),
        F.max(F.when(name == "raw_freshness_hours", F.col("metric_value"))).alias("raw_freshness_hours"),
    )


def decide(
    facts: DataFrame,
    trigger_mode: Column | str = "trigger_mode",
    champion_exists: Column | str = "champion_exists",
    max_freshness: float = MAX_RAW_FRESHNESS_HOURS,
) -> DataFrame:
    """Add ``should_retrain``, ``reason`` and ``decision_status`` to rows of gate facts.

    Later rules override earlier ones: a drift alert allows a retrain even after the stale-data block.
    """
    c = F.col
    mode = c(trigger_mode) if isinstance(trigger_mode, str) else trigger_mode
    champion = c(champion_exists) if isinstance(champion_exists, str) else champion_exists
    hours = lambda x: F.format_string("%.2f", x)

    unblocked = c("blocking_alert_count") == 0
    stale = F.coalesce(c("raw_freshness_hours") > max_freshness, F.lit(False))
    unvalidated = (mode == "drift") & (c("validation_metric_count") == 0)
    drifted = (c("drift_alert_count") > 0) & unblocked & (c("validation_metric_count") > 0)
    first = ~champion & unblocked
    manual = (mode == "manual") & unblocked
    blocked = ~unblocked | unvalidated | stale

    should = F.when(drifted | first | manual, True).when(blocked, False).otherwise(mode == "scheduled")
    stated = F.array_compact(
        F.array(
            F.when(
                ~unblocked,
                F.concat(F.lit("latest monitoring has "), c("blocking_alert_count").cast("string"), F.lit(" blocking alert metrics")),
            ),
            F.when(unvalidated, F.lit("missing data/schema/feature quality validation metrics")),
            F.when(
                stale,
                F.concat(
                    F.lit("raw data stale: "), hours(c("raw_freshness_hours")), F.lit("h > "),
                    hours(F.lit(float(max_freshness))), F.lit("h"),
                ),
            ),
            F.when(
                drifted,
                F.concat(
                    F.lit("drift detected: "), c("drift_alert_count").cast("string"),
                    F.lit(" alert metrics; data/schema/feature quality validation passed"),
                ),
            ),
            F.when(first, F.lit("no Champion exists")),
            F.when(manual, F.concat(F.lit("trigger_mode="), mode)),
        )
    )
    default = F.when(mode == "drift", "no drift trigger detected").otherwise("scheduled refresh allowed")
    status = first_true(
        [(should, F.lit("RETRAIN_ALLOWED")), (blocked, F.lit("NO_RETRAIN_BLOCKED"))], F.lit("NO_RETRAIN_NO_TRIGGER")
    )
    return facts.withColumns(
        {
            "should_retrain": should,
            "reason": F.when(F.size(stated) > 0, F.concat_ws("; ", stated)).otherwise(default),
            "decision_status": status,
        }
    )


def decision_row(
    metrics: DataFrame | None,
    spark,
    decision_time,
    trigger_mode: str,
    champion_exists: bool,
    versions: dict | None = None,
    max_freshness: float = MAX_RAW_FRESHNESS_HOURS,
) -> DataFrame:
    """The row to append to the decisions table. ``metrics=None`` means there is no metrics table."""
    versions = versions or {}
    if metrics is None:
        zero = ("alert_count", "blocking_alert_count", "non_blocking_alert_count", "drift_alert_count", "validation_metric_count")
        facts = spark.range(1).select(
            *[F.lit(0).cast("bigint").alias(n) for n in zero], F.lit(None).cast("double").alias("raw_freshness_hours")
        )
    else:
        facts = gate_counts(metrics)
    decided = decide(facts, F.lit(trigger_mode), F.lit(champion_exists), max_freshness)
    version = lambda name: F.lit(versions.get(name, -1)).cast("bigint")
    tables = ("metrics", "raw", "features", "predictions")
    details = F.struct(
        "decision_status", "blocking_alert_count", "non_blocking_alert_count", "drift_alert_count",
        "validation_metric_count", F.struct(*[version(t).alias(t) for t in tables]).alias("lineage"),
    )
    return decided.select(
        F.lit(decision_time).alias("decision_time"),
        "should_retrain",
        "reason",
        F.lit(trigger_mode).alias("trigger_mode"),
        F.coalesce("raw_freshness_hours", F.lit(-1.0)).alias("raw_freshness_hours"),
        "alert_count",
        F.lit(champion_exists).alias("champion_exists"),
        *[version(t).alias(f"{t}_table_version") for t in tables],
        F.to_json(details).alias("details"),
    )


def latest_decision(decisions: DataFrame) -> DataFrame:
    """The newest decision as one row; all NULL when there is none."""
    columns = [c for c in decisions.columns if c != "decision_time"]
    row = F.struct("decision_time", *columns)
    return decisions.agg(F.max_by(row, F.struct("decision_time", *columns)).alias("d")).select("d.*")


def judge_refresh(
    decisions: DataFrame, as_of, expected_mode: str = "drift", max_age_hours: float = MAX_DECISION_AGE_HOURS
) -> DataFrame:
    """Add ``decision_age_hours`` and ``action``: what the refresh trigger does with each decision."""
    c = F.col
    age = age_hours(c("decision_time"), as_of)
    held_back = c("reason").rlike("blocking|stale|missing")
    action = first_true(
        [
            (c("decision_time").isNull(), F.lit("SKIP_MODEL_REFRESH_NO_DECISION")),
            (age > max_age_hours, F.lit("SKIP_MODEL_REFRESH_STALE_DECISION")),
            (c("trigger_mode") != expected_mode, F.lit("SKIP_MODEL_REFRESH_TRIGGER_MODE_MISMATCH")),
            (~c("should_retrain") & held_back, F.lit("SKIP_MODEL_REFRESH_BLOCKED")),
            (~c("should_retrain"), F.lit("SKIP_MODEL_REFRESH_NO_RETRAIN_TRIGGER")),
        ],
        F.lit("TRIGGER_MODEL_REFRESH"),
    )
    return decisions.withColumns({"decision_age_hours": age, "action": action})


def refresh_action(
    decisions: DataFrame, as_of, expected_mode: str = "drift", max_age_hours: float = MAX_DECISION_AGE_HOURS
) -> DataFrame:
    """The action for the newest decision; one row even when there is none."""
    return judge_refresh(latest_decision(decisions), as_of, expected_mode, max_age_hours)


def training_skip(
    decisions: DataFrame, as_of, expected_mode: str = "drift", max_age_hours: float = MAX_DECISION_AGE_HOURS
) -> DataFrame:
    """Why training should be skipped; ``skip_reason`` is NULL when it may run."""
    c = F.col
    age = age_hours(c("decision_time"), as_of)
    hours = lambda x: F.format_string("%.2f", x)
    reason = first_true(
        [
            (c("decision_time").isNull(), F.lit("missing training gate decision")),
            (
                age > max_age_hours,
                F.concat(
                    F.lit("stale training gate decision: "), hours(age), F.lit("h > "),
                    hours(F.lit(float(max_age_hours))), F.lit("h"),
                ),
            ),
            (
                c("trigger_mode") != expected_mode,
                F.concat(F.lit("unexpected trigger_mode="), c("trigger_mode"), F.lit(f"; expected={expected_mode}")),
            ),
            (~c("should_retrain"), c("reason")),
        ],
        F.lit(None).cast("string"),
    )
    return latest_decision(decisions).select("decision_time", reason.alias("skip_reason"))


# Alert -> what can be done about it (fixed values).
MANUAL_REASONS = {
    "raw_null_open_time_count": "raw_null_open_time_count requires landing/parser inspection",
    "raw_duplicate_open_time_count": "raw_duplicate_open_time_count requires canonical raw table inspection",
}
ACTION_STEPS = {
    "backfill_raw": ("fetch", "ingest", "features"),
    "rebuild_features": ("features",),
    "rerun_prediction": ("predict",),
}


def remediation_plan(metrics: DataFrame, action_time, by: tuple[str, ...] = ()) -> DataFrame:
    """One row: safe actions, the steps they run, reasons that need a person, and the resulting status.

    ``status`` is what gets recorded when every step succeeds. Works on the latest row per metric
    name, a set bounded by the number of metric names.
    """
    latest = latest_metrics(metrics, by)
    name, alert = F.col("metric_name"), F.col("status") == "alert"
    raised = lambda *names: F.count_if(alert & name.isin(*names)) > 0
    snapshot = F.map_from_entries(
        F.sort_array(F.collect_list(F.struct(name.alias("key"), F.struct("metric_value", "status", "details").alias("value"))))
    )
    facts = latest.groupBy(*by).agg(
        F.count_if(alert).alias("alerts"),
        *[raised(n).alias(n) for n in MANUAL_REASONS],
        F.sort_array(F.collect_list(F.when(alert & name.startswith("schema_drift_"), name))).alias("schema"),
        raised("raw_freshness_hours").alias("backfill"),
        raised("raw_features_row_count_delta", "features_target_close_1h_null_count").alias("rebuild"),
        (
            raised("prediction_age_hours")
            | (F.count_if((name == "prediction_count") & (F.col("metric_value") == 0)) > 0)
        ).alias("rerun"),
        F.to_json(snapshot).alias("metrics_snapshot"),
    )
    quoted = F.concat(F.lit("['"), F.concat_ws("', '", "schema"), F.lit("']"))
    manual = F.array_compact(
        F.array(
            *[F.when(F.col(n), F.lit(text)) for n, text in MANUAL_REASONS.items()],
            F.when(F.size("schema") > 0, F.concat(F.lit("schema drift requires manual handling: "), quoted)),
        )
    )
    safe = F.array_compact(
        F.array(
            *[F.when(F.col(flag), F.lit(action)) for flag, action in zip(("backfill", "rebuild", "rerun"), ACTION_STEPS)]
        )
    )
    # A backfill already rebuilds the features.
    steps = F.concat(
        *[
            F.when(F.col(flag), F.array(*[F.lit(s) for s in ACTION_STEPS[action]])).otherwise(F.array().cast("array<string>"))
            for flag, action in (("backfill", "backfill_raw"), ("_rebuild_only", "rebuild_features"), ("rerun", "rerun_prediction"))
        ]
    )
    planned = facts.withColumns({"_manual": manual, "_safe": safe, "_rebuild_only": F.col("rebuild") & ~F.col("backfill")})
    quiet, nothing_safe, by_hand = F.col("alerts") == 0, F.size("_safe") == 0, F.size("_manual") > 0
    listed = F.concat(F.lit("safe_actions=['"), F.concat_ws("', '", "_safe"), F.lit("']"))
    reason = first_true(
        [
            (quiet, F.lit("no data quality alerts to remediate")),
            (nothing_safe & by_hand, F.concat_ws("; ", "_manual")),
            (nothing_safe, F.lit("no auto-remediable data quality alerts found")),
        ],
        F.concat_ws("; ", listed, "_manual"),
    )
    status = first_true([(quiet | nothing_safe, F.lit("blocked")), (by_hand, F.lit("attempted"))], F.lit("succeeded"))
    action = first_true(
        [(quiet, F.lit("none")), (nothing_safe & by_hand, F.lit("manual_required")), (nothing_safe, F.lit("none"))],
        F.concat_ws("+", "_safe"),
    )
    no_steps = F.array().cast("array<string>")
    return planned.select(
        *by,
        F.lit(action_time).alias("action_time"),
        status.alias("status"),
        reason.alias("reason"),
        action.alias("action_type"),
        F.when(quiet | nothing_safe, no_steps).otherwise(F.array_append(steps, F.lit("monitor"))).alias("steps"),
        "metrics_snapshot",
    )

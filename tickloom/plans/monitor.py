"""Metric sets: table health, feature drift, prediction drift, forecast performance, job quality."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import scores
from tickloom.functions.status import (
    ALERT,
    DIRECTION_LIMITS,
    KS_LIMITS,
    MAPE_LIMITS,
    MONITOR_ONLY_ALERT,
    NULL_RATE_LIMITS,
    PSI_LIMITS,
    WARN,
    alert_unless,
    threshold_status,
)
from tickloom.operators.drift import (
    RECENT_HOURS,
    REFERENCE_HOURS,
    drift_scores,
    label_windows,
    recent_null_rates,
)
from tickloom.operators.evaluate import moves
from tickloom.operators.horizon import predictions_with_actuals
from tickloom.operators.quality import age_hours
from tickloom.plans.metrics import Metric, metric_rows
from tickloom.schemas import JOB_TRACE

FRESHNESS_HOURS = 3

# Feature columns whose drift may call for a retrain, and columns only watched (fixed values).
DRIFT_FEATURES = ("volume", "quote_volume", "trades", "return_1h")
WATCHED_FEATURES = ("close", "ma_24", "target_close_1h")
LABEL_COLUMNS = ("target_close_1h",)

# Predictions at or below this are left over from a time when returns were stored as prices (fixed value).
MIN_VALID_PREDICTION = 1000.0


def _one_row(spark, **scalars: Column) -> DataFrame:
    """A one-row frame of scalar subqueries: each input table is read once, nothing is joined."""
    return spark.range(1).select(*[value.alias(name) for name, value in scalars.items()])


def health_metrics(
    raw: DataFrame,
    features: DataFrame,
    predictions: DataFrame | None,
    as_of,
    keys: list[str],
    freshness_hours: float = FRESHNESS_HOURS,
    warmup_rows: int = 1,
    versions: dict | None = None,
) -> DataFrame:
    """Row counts, repeats, NULL keys, ages and the raw/feature row gap.

    ``warmup_rows`` is the allowed gap; a first feature build drops 24 rows per series, so the
    default of 1 alerts right after it.
    """
    per_key = raw.groupBy(*keys, "open_time").agg(F.count("*").alias("n"))
    raw_facts = per_key.agg(
        F.struct(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count_if(F.col("n") > 1).alias("repeats"),
            F.coalesce(F.sum(F.when(F.col("open_time").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.max("open_time").alias("latest"),
        )
    ).scalar()
    feature_facts = features.agg(
        F.struct(
            F.count("*").alias("rows"), F.count_if(F.col("target_close_1h").isNull()).alias("no_target")
        )
    ).scalar()
    scalars = {"raw": raw_facts, "feat": feature_facts}
    if predictions is not None:
        scalars["pred"] = predictions.agg(
            F.struct(F.count("*").alias("rows"), F.max("prediction_time").alias("latest"))
        ).scalar()
    facts = _one_row(raw.sparkSession, **scalars)
    c = F.col
    raw_age = age_hours(c("raw.latest"), as_of)
    gap = c("raw.rows") - c("feat.rows")
    metrics = [
        Metric("raw_count", c("raw.rows")),
        Metric("raw_duplicate_open_time_count", c("raw.repeats"), alert_unless(c("raw.repeats") == 0)),
        Metric("raw_null_open_time_count", c("raw.nulls"), alert_unless(c("raw.nulls") == 0)),
        Metric(
            "raw_freshness_hours",
            raw_age,
            alert_unless(raw_age <= freshness_hours),
            F.coalesce(F.concat(F.lit("latest_raw="), c("raw.latest").cast("string")), F.lit("No raw data")),
        ),
        Metric("features_count", c("feat.rows")),
        Metric(
            "features_target_close_1h_null_count",
            c("feat.no_target"),
            alert_unless(c("feat.no_target") <= 1),
            "Rows without a bar exactly one hour later have no target.",
        ),
        Metric("raw_features_row_count_delta", gap, alert_unless(F.abs(gap) <= warmup_rows)),
    ]
    if predictions is None:
        metrics.append(Metric("prediction_count", F.lit(0), WARN, "Predictions table does not exist"))
    else:
        age = age_hours(c("pred.latest"), as_of)
        metrics += [
            Metric("prediction_count", c("pred.rows")),
            Metric(
                "prediction_age_hours",
                age,
                alert_unless(age <= freshness_hours),
                F.coalesce(
                    F.concat(F.lit("latest_prediction_time="), c("pred.latest").cast("string")),
                    F.lit("No predictions"),
                ),
            ),
        ]
    return metric_rows(facts, metrics, as_of, versions)


def _score_metrics(prefix: Column | str, psi_alert: Column | float, ks_alert: Column | float, message: Column | str):
    """PSI and KS rows of a (feature, psi, ks) table."""
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    name = lambda kind: F.concat(as_col(prefix), F.lit(f"_{kind}_"), "feature")
    enough = F.when(F.col("psi").isNull(), F.lit("Insufficient rows")).otherwise(as_col(message))
    return [
        Metric(name("psi"), F.col("psi"), threshold_status(F.col("psi"), PSI_LIMITS[0], psi_alert), enough),
        Metric(name("ks"), F.col("ks"), threshold_status(F.col("ks"), KS_LIMITS[0], ks_alert), enough),
    ]


def feature_drift_metrics(
    features: DataFrame | None,
    metric_time,
    spark=None,
    columns=DRIFT_FEATURES,
    watched=WATCHED_FEATURES,
    recent_hours: int = RECENT_HOURS,
    reference_hours: int = REFERENCE_HOURS,
    versions: dict | None = None,
) -> DataFrame:
    """Window sizes, missing columns, null rates, PSI and KS. Watched columns never reach alert."""
    if features is None:
        gone = Metric("drift_features_table_exists", F.lit(0), ALERT, "Feature table is missing")
        return metric_rows(spark.range(1), [gone], metric_time, versions)
    rows = features.where(F.col("open_time").isNotNull())
    windows = label_windows(rows, "open_time", recent_hours, reference_hours)
    there = [c for c in columns if c in features.columns]
    seen = [c for c in watched if c in features.columns]
    sizes = windows.agg(
        F.count_if("is_recent").alias("recent"), F.count_if(~F.col("is_recent")).alias("reference")
    )
    some = F.col("recent") > 0
    out = metric_rows(
        sizes,
        [
            Metric("drift_features_row_count", F.lit(0), ALERT, "No feature rows", keep=~some),
            Metric("drift_recent_feature_count", F.col("recent"), keep=some),
            Metric("drift_reference_feature_count", F.col("reference"), keep=some),
            *[
                Metric(f"schema_drift_missing_{c}", F.lit(1), ALERT, "Missing feature", keep=some)
                for c in [*columns, *watched]
                if c not in features.columns
            ],
        ],
        metric_time,
        versions,
    )
    if there:
        rates = Metric(
            F.concat(F.lit("feature_quality_null_rate_"), "feature"),
            F.col("null_rate"),
            threshold_status(F.col("null_rate"), *NULL_RATE_LIMITS),
            "Recent-window null rate",
        )
        out = out.unionByName(metric_rows(recent_null_rates(windows, there), [rates], metric_time, versions))
    if there or seen:
        # One scoring pass for both groups. Columns without any value come back through the left join,
        # whose left side has one row per column.
        names = rows.sparkSession.createDataFrame([(c,) for c in [*there, *seen]], "feature STRING")
        scored = names.join(drift_scores(windows, [*there, *seen]), "feature", "left")
        may_alert = F.col("feature").isin(*there) if there else F.lit(False)
        prefix = (
            F.when(may_alert, "data_drift")
            .when(F.col("feature").isin(*LABEL_COLUMNS), "label_drift")
            .otherwise("price_level_drift")
        )
        limit = lambda alert: F.when(may_alert, alert).otherwise(MONITOR_ONLY_ALERT)
        text = F.when(may_alert, f"reference_hours={reference_hours}; recent_hours={recent_hours}").otherwise(
            "Monitor-only price/label level drift; not a retrain trigger"
        )
        # A watched column without values is left out; one that may alert is reported as unknown.
        kept = scored.where(may_alert | F.col("psi").isNotNull())
        metrics = _score_metrics(prefix, limit(PSI_LIMITS[1]), limit(KS_LIMITS[1]), text)
        out = out.unionByName(metric_rows(kept, metrics, metric_time, versions))
    return out


def prediction_drift_metrics(
    predictions: DataFrame,
    metric_time,
    recent_hours: int = RECENT_HOURS,
    reference_hours: int = REFERENCE_HOURS,
    versions: dict | None = None,
) -> DataFrame:
    """PSI and KS of the predicted close between the two windows of prediction time; watch only."""
    windows = label_windows(predictions, "prediction_time", recent_hours, reference_hours)
    name = predictions.sparkSession.createDataFrame([("predicted_close",)], "feature STRING")
    scored = name.join(drift_scores(windows, ["predicted_close"]), "feature", "left")
    text = "Monitor-only prediction level drift; not a retrain trigger"
    return metric_rows(
        scored, _score_metrics("prediction_drift", MONITOR_ONLY_ALERT, MONITOR_ONLY_ALERT, text), metric_time, versions
    )


def performance_facts(
    predictions: DataFrame,
    bars: DataFrame,
    keys: list[str],
    recent_hours: int = RECENT_HOURS,
    min_valid: float = MIN_VALID_PREDICTION,
    horizon: timedelta = timedelta(hours=1),
    series: list[str] | None = None,
) -> DataFrame:
    """One row: joined and invalid counts, error aggregates and direction accuracy of the recent window.

    The direction window runs by series over the recent hours only, so its size is set by the calendar.
    """
    joined = predictions_with_actuals(predictions, bars, keys, "inner", horizon)
    newest = joined.agg(F.max("prediction_time")).scalar()
    recent = joined.where(F.col("prediction_time") > newest - F.expr(f"INTERVAL {int(recent_hours)} HOURS"))
    valid = F.col("predicted_close") > min_valid
    order_keys = series if series is not None else keys
    # Invalid rows take no part in the direction test: partitioning by validity keeps them apart.
    marked = moves(recent.withColumn("_valid", valid), [*order_keys, "_valid"], "feature_open_time", plan=None)
    a = F.when(valid, F.col("actual_close"))
    p = F.when(valid, F.col("predicted_close"))
    return marked.agg(
        F.count("*").alias("joined"),
        F.count_if(valid).alias("scored"),
        F.count_if(F.col("predicted_close") <= min_valid).alias("invalid"),
        scores.rmse(a, p).alias("rmse"),
        scores.mae(a, p).alias("mae"),
        scores.mape(a, p).alias("mape"),
        scores.bias(a, p).alias("mean_error"),
        scores.p95_abs_error(a, p).alias("p95_abs_error"),
        scores.share_true(F.when(valid, F.col("same_move"))).alias("direction_accuracy"),
    )


def performance_metrics(
    predictions: DataFrame | None, bars: DataFrame | None, keys: list[str], metric_time, spark=None,
    versions: dict | None = None, **options,
) -> DataFrame:
    name = "model_drift_joined_prediction_count"
    if predictions is None or bars is None:
        gone = Metric(name, F.lit(0), WARN, "Predictions or raw table missing")
        return metric_rows(spark.range(1), [gone], metric_time, versions)
    c = F.col
    some = c("joined") > 0
    metrics = [
        Metric(name, F.lit(0), WARN, "No actuals yet", keep=~some),
        Metric(
            "model_drift_invalid_predicted_close_count_24h",
            c("invalid"),
            WARN,
            "Ignored predictions too small to be prices",
            keep=c("invalid") > 0,
        ),
        Metric(name, c("scored"), keep=some),
        Metric("model_drift_rmse_24h", c("rmse"), keep=some),
        Metric("model_drift_mae_24h", c("mae"), keep=some),
        Metric("model_drift_mape_24h", c("mape"), threshold_status(c("mape"), *MAPE_LIMITS), keep=some),
        Metric("model_drift_p95_abs_error_24h", c("p95_abs_error"), keep=some),
        Metric(
            "concept_drift_mean_error_bias_24h",
            c("mean_error"),
            message="Persistent signed error can indicate concept drift",
            keep=some,
        ),
        Metric(
            "model_drift_direction_accuracy_24h",
            c("direction_accuracy"),
            threshold_status(c("direction_accuracy"), *DIRECTION_LIMITS, higher_is_worse=False),
            keep=some,
        ),
    ]
    return metric_rows(performance_facts(predictions, bars, keys, **options), metrics, metric_time, versions)


# Job quality limits (fixed values).
LOOKBACK_RUNS, MIN_SUCCESS_RATE, MAX_DURATION_MINUTES = 20, 0.8, 60.0


def recent_runs(runs: DataFrame, lookback: int = LOOKBACK_RUNS) -> DataFrame:
    """The newest ``lookback`` runs of each job.

    A ``row_number`` filter this small is applied before the shuffle as well (window group limit), so
    each task sends at most ``lookback`` runs per job however many a job has.
    """
    newest_first = Window.partitionBy("job_id").orderBy(F.desc("start_time"), F.desc("run_id"))
    return runs.withColumn("_n", F.row_number().over(newest_first)).where(F.col("_n") <= lookback).drop("_n")


def job_quality(runs: DataFrame, lookback: int = LOOKBACK_RUNS) -> DataFrame:
    """Per job: runs, terminal runs, successes, failures, success rate and the newest (terminal) run."""
    terminal = F.col("state.life_cycle_state") == "TERMINATED"
    success = terminal & (F.col("state.result_state") == "SUCCESS")
    recent = recent_runs(runs, lookback)
    order = F.struct(F.coalesce(terminal, F.lit(False)).alias("t"), "start_time", "run_id")
    run = F.struct("job_name", "run_id", "execution_duration", "state", "tasks")
    counts = recent.groupBy("job_id").agg(
        F.count("*").alias("run_count"),
        F.count_if(terminal).alias("terminal_runs"),
        F.count_if(success).alias("successful_runs"),
        F.count_if(terminal & ~F.coalesce(success, F.lit(False))).alias("failed_runs"),
        F.sort_array(
            F.collect_list(F.when(terminal & ~F.coalesce(success, F.lit(False)), F.col("run_id")))
        ).alias("failed_run_ids"),
        F.max_by(run, order).alias("latest"),
    )
    failed_tasks = F.filter(
        F.coalesce(F.col("latest.tasks"), F.array().cast(recent.schema["tasks"].dataType)),
        lambda t: F.coalesce(t["state"]["result_state"] != "SUCCESS", F.lit(True)),
    )
    latest_done = F.coalesce(F.col("latest.state.life_cycle_state") == "TERMINATED", F.lit(False))
    latest_won = F.coalesce(F.col("latest.state.result_state") == "SUCCESS", F.lit(False))
    return counts.select(
        "job_id",
        "run_count",
        "terminal_runs",
        "successful_runs",
        "failed_runs",
        "failed_run_ids",
        F.try_divide("successful_runs", "terminal_runs").alias("success_rate"),
        F.col("latest.job_name").alias("job_name"),
        F.col("latest.run_id").alias("latest_run_id"),
        F.col("latest.state").alias("latest_state"),
        F.col("latest.execution_duration").alias("latest_duration_ms"),
        (F.col("latest.execution_duration") / 60000).alias("latest_duration_minutes"),
        F.when(latest_done, latest_won.cast("int")).alias("latest_success"),
        latest_won.alias("latest_won"),
        latest_done.alias("latest_is_terminal"),
        failed_tasks.alias("failed_tasks"),
        F.coalesce(F.size("latest.tasks"), F.lit(0)).alias("task_count"),
    )


def job_quality_metrics(
    runs: DataFrame,
    metric_time,
    lookback: int = LOOKBACK_RUNS,
    min_success_rate: float = MIN_SUCCESS_RATE,
    max_duration_minutes: float = MAX_DURATION_MINUTES,
    base_url: str = "",
    catalog: DataFrame | None = None,
    name_filter: str = "",
) -> DataFrame:
    """The number of jobs and five metrics per job; ``details`` is the trace JSON of the run judged.

    ``catalog`` (job_id, job_name) also reports jobs that never ran; ``name_filter`` keeps jobs whose
    name contains it.
    """
    if name_filter:
        runs = runs.where(F.col("job_name").contains(name_filter))
        catalog = None if catalog is None else catalog.where(F.col("job_name").contains(name_filter))
    jobs = job_quality(runs, lookback)
    c = F.col
    trace = [
        c("job_id"),
        F.coalesce("job_name", c("job_id").cast("string")).alias("job_name"),
        F.concat(F.lit(f"{base_url}/#job/"), c("job_id").cast("string")).alias("job_url"),
    ]
    run_url = F.concat(F.lit(f"{base_url}/#job/"), c("job_id").cast("string"), F.lit("/run/"), c("latest_run_id").cast("string"))
    of_run = [*trace, c("latest_run_id").alias("run_id"), run_url.alias("run_url"), c("latest_state").alias("state")]
    name = lambda kind: F.concat(F.lit(f"job_quality_{kind}_"), c("job_id").cast("string"))
    rate = c("success_rate")
    minutes = c("latest_duration_minutes")
    won = c("latest_won")
    failed = F.size("failed_tasks")
    rows = [
        (
            name("success_rate"),
            rate,
            F.when(rate.isNull(), "warn").when(rate < min_success_rate, "alert").otherwise("ok"),
            [*trace, c("terminal_runs"), c("successful_runs"), c("failed_runs"), F.lit(min_success_rate).alias("min_success_rate")],
        ),
        (
            name("failed_run_count"),
            c("failed_runs"),
            alert_unless(c("failed_runs") == 0),
            [*trace, c("failed_run_ids"), F.lit(lookback).alias("lookback_runs")],
        ),
        (
            name("latest_duration_minutes"),
            minutes,
            F.when(minutes.isNull(), "warn").when(minutes > max_duration_minutes, "alert").otherwise("ok"),
            [*of_run, F.lit(max_duration_minutes).alias("max_duration_minutes"), c("latest_duration_ms").alias("execution_duration_ms")],
        ),
        (
            name("latest_success"),
            c("latest_success"),
            F.when(won, "ok").when(c("latest_is_terminal"), "alert").otherwise("warn"),
            of_run,
        ),
        (
            name("latest_failed_task_count"),
            failed,
            alert_unless(failed == 0),
            [*of_run, c("failed_tasks"), c("task_count")],
        ),
    ]
    cells = [
        F.struct(
            metric.alias("metric_name"),
            value.cast("double").alias("metric_value"),
            status.alias("status"),
            F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("details"),
        )
        for metric, value, status, fields in rows
    ]
    time = metric_time if isinstance(metric_time, Column) else F.lit(metric_time)
    per_job = jobs.select(F.inline(F.array(*cells)))
    listed = jobs if catalog is None else catalog
    total = listed.agg(
        F.lit("job_quality_matching_job_count").alias("metric_name"),
        F.count("*").cast("double").alias("metric_value"),
        F.lit("ok").alias("status"),
        F.lit("").alias("details"),
    )
    out = total.unionByName(per_job)
    if catalog is not None:
        idle = catalog.join(jobs.select("job_id"), "job_id", "left_anti")
        out = out.unionByName(
            idle.select(
                name("run_count").alias("metric_name"),
                F.lit(0.0).alias("metric_value"),
                F.lit("warn").alias("status"),
                F.to_json(F.struct(*trace, F.lit("no recent runs").alias("reason"))).alias("details"),
            )
        )
    return out.select(time.alias("metric_time"), "*")


def decode_trace(metrics: DataFrame) -> DataFrame:
    """Job-quality rows with ``details`` read back into nested columns."""
    return metrics.where(F.col("metric_name").rlike("^job_quality_")).withColumn(
        "trace", F.from_json("details", JOB_TRACE)
    )

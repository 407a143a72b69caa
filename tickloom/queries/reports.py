"""Dashboard reports over the derived metrics history, predictions, decisions and explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.plans import reports as r
from tickloom.queries import base, monitoring
from tickloom.queries.base import SQL_BARS, SQL_METRICS, SQL_PREDICTIONS, SQL_SCORED, query, rounded, sql_r6, sql_rounded
from tickloom.schemas import EXPLANATIONS, MANIFEST, conform

KEYS = ("symbol",)
VALID = 5.0  # the derived prices are small


def _tile(name: str, metric: str, fn, details: bool = False):
    extra = ", details" if details else ""

    @query(name, f"WITH {SQL_METRICS} SELECT metric_time, {sql_r6('metric_value', metric)}, status{extra} FROM metrics WHERE metric_name = '{metric}' ORDER BY metric_time DESC LIMIT 1")
    def run(spark, sf):
        return rounded(fn(base.metrics_history(spark, sf)))


_tile("report_data_freshness", "raw_freshness_hours", r.data_freshness, True)
_tile("report_raw_count", "raw_count", r.raw_count)
_tile("report_features_count", "features_count", r.features_count)
_tile("report_prediction_count", "prediction_count", r.prediction_count)


@query(
    "report_latest_predictions",
    f"""WITH {SQL_PREDICTIONS} SELECT symbol, prediction_time, feature_open_time, {sql_rounded('predicted_close predicted_return_1h')}, model_target_col, model_uri
    FROM predictions ORDER BY prediction_time DESC, symbol, model_uri LIMIT 50""",
)
def latest_predictions(spark, sf):
    return rounded(r.latest_predictions(base.predictions(spark, sf), KEYS))


@query(
    "report_actual_vs_predicted",
    f"""WITH {SQL_PREDICTIONS} SELECT p.symbol, p.prediction_time, p.feature_open_time, {sql_rounded('predicted_close', 'p.')}, b.open_time AS actual_open_time,
    {sql_r6('b.close', 'actual_close')}, {sql_r6('abs(b.close - p.predicted_close)', 'abs_error')}, {sql_r6('abs(b.close - p.predicted_close) / abs(b.close)', 'pct_error')}, p.model_uri
    FROM predictions p LEFT JOIN bars b ON b.symbol = p.symbol AND b.open_time = p.feature_open_time + INTERVAL 1 HOUR
    WHERE p.predicted_close > {VALID} ORDER BY p.prediction_time DESC, p.symbol, p.model_uri LIMIT 100""",
)
def actual_vs_predicted(spark, sf):
    return rounded(r.actual_vs_predicted(base.predictions(spark, sf), base.bars(spark, sf), KEYS, min_valid=VALID))


@query("pred_error_trend", f"WITH {SQL_SCORED} SELECT symbol, feature_open_time, {sql_rounded('predicted_close actual_close abs_error pct_error')} FROM scored WHERE predicted_close > {VALID}")
def pred_error_trend(spark, sf):
    return rounded(r.prediction_error_trend(base.predictions(spark, sf), base.bars(spark, sf), KEYS, VALID))


@query(
    "legacy_predictions",
    f"""WITH {SQL_PREDICTIONS} SELECT symbol, prediction_time, feature_open_time, {sql_rounded('predicted_close predicted_return_1h')}, model_target_col, model_version, model_run_id
    FROM predictions WHERE predicted_close <= {VALID} OR predicted_close IS NULL ORDER BY prediction_time DESC, symbol, model_uri LIMIT 100""",
)
def legacy_predictions(spark, sf):
    return rounded(r.legacy_predictions(base.predictions(spark, sf), KEYS, min_valid=VALID))


_DRIFT_CASES = "trigger_mode = 'drift' AND champion_exists"


@query(
    "report_refresh_decisions",
    f"""WITH {monitoring._DECIDE} SELECT decision_time, should_retrain, reason, trigger_mode, {sql_r6('raw_freshness_hours', 'raw_freshness_hours')}, alert_count, champion_exists
    FROM decisions WHERE {_DRIFT_CASES} ORDER BY decision_time DESC LIMIT 50""",
)
def refresh_decisions(spark, sf):
    rows = monitoring.decisions(spark, sf).where((F.col("trigger_mode") == "drift") & F.col("champion_exists"))
    return rounded(r.refresh_decisions(rows))


def _metric_report(name: str, fn, limit: int, where: str):
    sql = f"""WITH {SQL_METRICS} SELECT metric_time, metric_name, {sql_r6('metric_value', 'metric_value')}, status, details FROM metrics
    WHERE {where} ORDER BY metrics.metric_time DESC, metrics.metric_name LIMIT {limit}"""

    @query(name, sql)
    def run(spark, sf):
        return rounded(fn(base.metrics_history(spark, sf)))


_DRIFT_OR_QUALITY = "regexp_matches(metric_name, '^(data_drift|label_drift|prediction_drift|model_drift|concept_drift|feature_quality|schema_drift)_')"
_JOB = "regexp_matches(metric_name, '^job_quality_')"
_RAISED = "status IN ('alert', 'warn')"
_metric_report("report_monitoring_alerts", r.monitoring_alerts, 100, _RAISED)
_metric_report("report_metrics_timeline", r.metrics_timeline, 500, "true")
_metric_report("report_drift_metrics", r.drift_metrics, 300, _DRIFT_OR_QUALITY)
_metric_report("report_drift_alerts", r.drift_alerts, 100, f"{_DRIFT_OR_QUALITY} AND {_RAISED}")
_metric_report("report_job_metrics", r.job_metrics, 300, _JOB)
_metric_report("report_job_alerts", r.job_alerts, 100, f"{_JOB} AND {_RAISED}")


@query(
    "report_daily_volume",
    f"""WITH {SQL_BARS} SELECT date_trunc('day', open_time)::TIMESTAMP AS bucket_date, {sql_r6('sum(volume)', 'volume')}, {sql_r6('sum(quote_volume)', 'quote_volume')}, count(*) AS bar_count
    FROM bars WHERE open_time >= TIMESTAMP '2024-01-03' AND open_time <= TIMESTAMP '2024-01-20' GROUP BY 1""",
)
def daily_volume(spark, sf):
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    return rounded(r.daily_volume(base.bars(spark, sf), at("2024-01-03"), at("2024-01-20")))


@query(
    "report_prediction_lineage",
    f"""WITH {SQL_PREDICTIONS} SELECT symbol, prediction_time, feature_open_time, {sql_rounded('predicted_close predicted_return_1h')}, model_version, model_run_id, model_target_col,
    raw_table_version AS serving_raw_version, features_table_version AS serving_features_version, model_raw_table_version AS training_raw_version,
    model_features_table_version AS training_features_version, model_feature_config_version, model_feature_config_id
    FROM predictions ORDER BY prediction_time DESC, symbol, model_uri LIMIT 50""",
)
def prediction_lineage(spark, sf):
    return rounded(r.prediction_lineage(base.predictions(spark, sf), KEYS))


# Explanations: one run per series, created when the series ends; contributions of six "features" are
# the close, volume and friends of its bars relative to their mean over all series.
_PARTS = ("open", "high", "low", "close", "volume", "trades")
_CELLS = ", ".join(f"{{'feature': '{p}', 'c': {p} - avg_{p}}}" for p in _PARTS)
_EXPLAIN = f"""{SQL_BARS}, centre AS (SELECT {', '.join(f'avg({p}) AS avg_{p}' for p in _PARTS)} FROM bars),
contributions AS (SELECT symbol, open_time, e.feature, e.c FROM (SELECT symbol, open_time, unnest([{_CELLS}]) AS e FROM bars, centre)),
explanations AS (SELECT symbol AS run_id, 'rule' AS model_algo, feature, max(open_time) AS created_at, avg(abs(c)) AS mean_abs_shap, avg(c) AS mean_shap, count(*) AS sample_rows,
  stddev_samp(c) AS importance, CAST(2 AS BIGINT) AS features_table_version, CAST(7 AS BIGINT) AS feature_config_id FROM contributions GROUP BY 1, 3),
latest AS (SELECT run_id FROM explanations ORDER BY created_at DESC, run_id DESC LIMIT 1)"""


def contributions(spark, sf):
    """(run_id, feature, created_at, mean_abs_shap, mean_shap, sample_rows, importance) from long-format contributions."""
    bars = base.bars(spark, sf)
    centre = bars.agg(F.struct(*[F.avg(p).alias(p) for p in _PARTS])).scalar()
    cells = F.array(*[F.struct(F.lit(p).alias("feature"), (F.col(p) - centre[p]).alias("c")) for p in _PARTS])
    long = bars.select(F.col("symbol").alias("run_id"), "open_time", F.inline(cells))
    return long.groupBy("run_id", "feature").agg(
        F.max("open_time").alias("created_at"),
        F.avg(F.abs("c")).alias("mean_abs_shap"),
        F.avg("c").alias("mean_shap"),
        F.count("*").alias("sample_rows"),
        F.stddev_samp("c").alias("importance"),
    )


def explanations(spark, sf):
    rows = contributions(spark, sf).withColumns(
        {
            "model_algo": F.lit("rule"),
            "features_table_version": F.lit(2),
            "feature_config_id": F.lit(7),
            "explanation_type": F.explode(F.array(F.lit("shap_summary"), F.lit("feature_importance"))),
        }
    )
    return conform(rows, EXPLANATIONS).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("explanation_contributions", f"WITH {_EXPLAIN} SELECT run_id, feature, {sql_rounded('mean_abs_shap mean_shap')}, sample_rows FROM explanations")
def explanation_contributions(spark, sf):
    return rounded(contributions(spark, sf).select("run_id", "feature", "mean_abs_shap", "mean_shap", "sample_rows"))


@query(
    "report_contributions",
    f"""WITH {_EXPLAIN} SELECT created_at, run_id, model_algo, feature, {sql_r6('mean_abs_shap', 'mean_abs_shap')}, {sql_r6('mean_shap', 'mean_shap')}, sample_rows, features_table_version, feature_config_id
    FROM explanations JOIN latest USING (run_id) ORDER BY explanations.mean_abs_shap DESC, feature LIMIT 30""",
)
def report_contributions(spark, sf):
    return rounded(r.contribution_report(explanations(spark, sf)))


@query(
    "report_importance",
    f"""WITH {_EXPLAIN} SELECT created_at, run_id, model_algo, feature, {sql_r6('importance', 'importance')}, features_table_version, feature_config_id
    FROM explanations JOIN latest USING (run_id) ORDER BY explanations.importance DESC, feature LIMIT 30""",
)
def report_importance(spark, sf):
    return rounded(r.importance_report(explanations(spark, sf)))


@query(
    "report_manifests",
    f"""WITH {SQL_BARS} SELECT max(open_time) AS created_at, symbol AS run_id, 'rule' AS model_algo, 'target_close_1h' AS target_col, CAST(1 AS BIGINT) AS raw_table_version,
    CAST(2 AS BIGINT) AS features_table_version, CAST(3 AS BIGINT) AS feature_config_version, CAST(7 AS BIGINT) AS feature_config_id,
    CAST(floor(count(*) * 0.8) AS BIGINT) AS train_rows, count(*) - CAST(floor(count(*) * 0.8) AS BIGINT) AS test_rows, CAST(6 AS BIGINT) AS n_features FROM bars GROUP BY symbol
    ORDER BY max(open_time) DESC, symbol LIMIT 20""",
)
def report_manifests(spark, sf):
    from tickloom.operators.split import split_index

    rows = base.bars(spark, sf).groupBy(F.col("symbol").alias("run_id")).agg(F.max("open_time").alias("created_at"), F.count("*").alias("n"))
    train = split_index(F.col("n"), 0.8)
    facts = {"model_algo": "rule", "target_col": "target_close_1h", "raw_table_version": 1, "features_table_version": 2, "feature_config_version": 3, "feature_config_id": 7, "n_features": 6}
    rows = rows.withColumns({**{k: F.lit(v) for k, v in facts.items()}, "train_rows": train, "test_rows": F.col("n") - train})
    return r.training_manifests(conform(rows, MANIFEST).withColumn("created_at", F.col("created_at").cast("timestamp_ntz")))

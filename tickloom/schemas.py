"""Table schemas, as DDL strings that every reader and writer shares.

Column names and types are fixed values: other tools read these tables by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_BAR_BODY = "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"

LANDING = (
    f"open_time STRING, {_BAR_BODY}, close_time STRING, quote_volume DOUBLE, trades BIGINT, "
    "source STRING, symbol STRING, interval STRING, fetched_at STRING"
)
STAGING = f"{LANDING}, _source_file STRING, _loaded_at TIMESTAMP"
RAW_BARS = (
    f"open_time TIMESTAMP, {_BAR_BODY}, close_time TIMESTAMP, quote_volume DOUBLE, trades BIGINT, "
    "source STRING, symbol STRING, interval STRING, fetched_at TIMESTAMP, ingested_at TIMESTAMP"
)
PREDICTIONS = (
    "prediction_time TIMESTAMP, feature_open_time TIMESTAMP, predicted_close DOUBLE, "
    "predicted_return_1h DOUBLE, model_uri STRING, model_version STRING, model_run_id STRING, "
    "model_target_col STRING, raw_table_version BIGINT, features_table_version BIGINT, "
    "model_raw_table_version BIGINT, model_features_table_version BIGINT, "
    "model_feature_config_version BIGINT, model_feature_config_id BIGINT"
)
METRICS = (
    "metric_time TIMESTAMP, metric_name STRING, metric_value DOUBLE, status STRING, details STRING"
)
DECISIONS = (
    "decision_time TIMESTAMP, should_retrain BOOLEAN, reason STRING, trigger_mode STRING, "
    "raw_freshness_hours DOUBLE, alert_count BIGINT, champion_exists BOOLEAN, "
    "metrics_table_version BIGINT, raw_table_version BIGINT, features_table_version BIGINT, "
    "predictions_table_version BIGINT, details STRING"
)
SELECTION_CONFIG = (
    "config_key STRING, config_value STRING, config_id BIGINT, config_version BIGINT, "
    "created_at STRING, created_by STRING, is_active BOOLEAN, n_features BIGINT, method STRING, "
    "source_table STRING, source_table_version BIGINT, target_col STRING, "
    "candidate_features_json STRING, dropped_features_json STRING, selection_metrics_json STRING, "
    "corr_threshold DOUBLE, mi_threshold DOUBLE"
)
MANIFEST = (
    "created_at TIMESTAMP, run_id STRING, model_algo STRING, target_col STRING, raw_table STRING, "
    "raw_table_version BIGINT, features_table STRING, features_table_version BIGINT, "
    "feature_config_table STRING, feature_config_version BIGINT, feature_config_id BIGINT, "
    "train_start_time TIMESTAMP, train_end_time TIMESTAMP, test_start_time TIMESTAMP, "
    "test_end_time TIMESTAMP, train_rows BIGINT, test_rows BIGINT, train_fraction DOUBLE, "
    "split_idx BIGINT, n_features BIGINT, feature_cols_json STRING"
)
EXPLANATIONS = (
    "run_id STRING, model_algo STRING, explanation_type STRING, feature STRING, importance DOUBLE, "
    "mean_abs_shap DOUBLE, mean_shap DOUBLE, sample_rows BIGINT, features_table_version BIGINT, "
    "feature_config_id BIGINT, created_at TIMESTAMP"
)
PROMOTIONS = (
    "evaluated_at TIMESTAMP, registered_version STRING, challenger_run_id STRING NOT NULL, "
    "champion_run_id STRING, expected_champion_version STRING, challenger_rmse DOUBLE, "
    "challenger_fair_rmse DOUBLE, challenger_fair_mae DOUBLE, challenger_directional_accuracy DOUBLE, "
    "champion_fair_rmse DOUBLE, champion_fair_mae DOUBLE, champion_directional_accuracy DOUBLE, "
    "challenger_eval_rows INT NOT NULL, champion_eval_rows INT NOT NULL, training_mode STRING, "
    "features_table STRING, features_table_version STRING, dataset_replay_status STRING, "
    "challenger_data_context STRING, champion_data_context STRING, promoted BOOLEAN NOT NULL"
)
REMEDIATION = (
    "action_time TIMESTAMP, status STRING, reason STRING, action_type STRING, metrics_snapshot STRING"
)
_STATE = "STRUCT<life_cycle_state: STRING, result_state: STRING, state_message: STRING>"
JOB_RUNS = (
    f"job_id BIGINT, job_name STRING, run_id BIGINT, start_time BIGINT, execution_duration BIGINT, state {_STATE}, "
    f"tasks ARRAY<STRUCT<task_key: STRING, run_id: BIGINT, state: {_STATE}>>"
)
JOB_TRACE = (
    f"job_id BIGINT, job_name STRING, job_url STRING, run_id BIGINT, run_url STRING, state {_STATE}, "
    f"failed_tasks ARRAY<STRUCT<task_key: STRING, run_id: BIGINT, state: {_STATE}>>"
)

# Name -> DDL of every table the library reads or writes.
TABLES = {
    "landing": LANDING,
    "staging": STAGING,
    "raw_bars": RAW_BARS,
    "predictions": PREDICTIONS,
    "metrics": METRICS,
    "decisions": DECISIONS,
    "selection_config": SELECTION_CONFIG,
    "manifest": MANIFEST,
    "explanations": EXPLANATIONS,
    "promotions": PROMOTIONS,
    "remediation": REMEDIATION,
    "job_runs": JOB_RUNS,
}


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    """A zero-row frame with the given schema."""
    return spark.createDataFrame([], struct_of(ddl))


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Project ``df`` onto a table schema: cast what is there, add what is missing as NULL."""
    from pyspark.sql import functions as F

    present = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in struct_of(ddl).fields
        ]
    )

"""Query registry, and the shared inputs that queries derive from the given tables.

Every input has two forms: a DataFrame builder and the same derivation as a SQL CTE for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from tickloom.operators.bars import build_bars
from tickloom.operators.indicators import drop_warmup, full_features
from tickloom.session import checkpointed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can state it, its oracle."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# -- comparable doubles -------------------------------------------------------------------------
# Engines add doubles in different orders. Results are compared at six decimals with an offset that
# keeps exact ties away from the rounding edge.


def r6(value: Column) -> Column:
    # Spark's floor of a double is a BIGINT; infinities, NaN and what does not fit it have no decimals left.
    scaled = value * 1e6 + 0.500123
    return F.when(F.abs(scaled) < float(1 << 62), F.floor(scaled).cast("double")).otherwise(scaled) / 1e6


def rounded(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Every DOUBLE column at six decimals."""
    return df.select(
        *[
            r6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType) and f.name not in skip else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def sql_r6(expression: str, name: str | None = None) -> str:
    text = f"floor(({expression}) * 1e6 + 0.500123) / 1e6"
    return f"{text} AS {name}" if name else text


def sql_rounded(columns: str | list[str], prefix: str = "") -> str:
    names = columns.split() if isinstance(columns, str) else columns
    return ", ".join(sql_r6(f"{prefix}{c}", c) for c in names)


# -- inputs -------------------------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars, one series per event type."""
    return build_bars(table(spark, sf, "events"), "event_type", tie="event_id", source="events")


def user_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars, one sparse series per user."""
    series = F.col("user_id").cast("string")
    return build_bars(table(spark, sf, "events"), series, tie="event_id", source="events")


def features(spark: SparkSession, sf: str, ieee: bool = False) -> DataFrame:
    """Full feature rows after the warm-up drop."""
    return drop_warmup(full_features(bars(spark, sf), ieee=ieee))


def stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature rows written once, for operators that read them in several passes."""
    return checkpointed(features(spark, sf))


def stored_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bars, features and predictions with the first two written once, as a deployment holds them."""
    raw = checkpointed(bars(spark, sf))
    rows = checkpointed(drop_warmup(full_features(raw)))
    return raw, rows, predictions(spark, sf, rows)


def newest_event(spark: SparkSession, sf: str) -> Column:
    """The evaluation time: the newest event, as a scalar subquery."""
    return table(spark, sf, "events").agg(F.max("ts")).scalar()


def predictions(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Two rule-based models over the feature rows: the last close and the 7-bar average."""
    rows = features(spark, sf) if rows is None else rows
    models = F.array(
        F.struct(F.lit("persistence").alias("model_uri"), F.col("close").alias("predicted_close")),
        F.struct(F.lit("ma7").alias("model_uri"), F.col("ma_7").alias("predicted_close")),
    )
    wide = rows.select(
        "symbol",
        F.col("open_time").alias("feature_open_time"),
        (F.col("open_time") + F.expr("INTERVAL 1 HOUR")).alias("prediction_time"),
        "close",
        F.inline(models),
    )
    return wide.select(
        "symbol",
        "feature_open_time",
        "prediction_time",
        "model_uri",
        "predicted_close",
        (F.try_divide("predicted_close", "close") - 1).alias("predicted_return_1h"),
        F.lit("target_close_1h").alias("model_target_col"),
        F.lit("1").alias("model_version"),
        F.concat(F.lit("run-"), "model_uri").alias("model_run_id"),
        F.lit(3).cast("bigint").alias("raw_table_version"),
        F.lit(2).cast("bigint").alias("features_table_version"),
        F.lit(1).cast("bigint").alias("model_raw_table_version"),
        F.lit(1).cast("bigint").alias("model_features_table_version"),
        F.lit(1).cast("bigint").alias("model_feature_config_version"),
        F.lit(7).cast("bigint").alias("model_feature_config_id"),
    )


# Metric names of the derived metrics history, by series and hour modulo 4.
METRIC_NAMES = {
    "click": ("raw_freshness_hours", "raw_count", "features_count", "prediction_count"),
    "error": ("data_drift_psi_volume", "model_drift_mape_24h", "label_drift_psi_target_close_1h", "prediction_drift_ks_predicted_close"),
    "purchase": ("feature_quality_null_rate_volume", "schema_drift_missing_trades", "raw_null_open_time_count", "raw_duplicate_open_time_count"),
    "signup": ("job_quality_success_rate_1", "job_quality_failed_run_count_2", "concept_drift_mean_error_bias_24h", "prediction_age_hours"),
    "view": ("features_target_close_1h_null_count", "raw_features_row_count_delta", "price_level_drift_psi_close", "job_quality_latest_success_3"),
}
METRIC_WARN, METRIC_ALERT = 110.0, 150.0


def metrics_history(spark: SparkSession, sf: str) -> DataFrame:
    """A metrics table with one row per bar: the close as value, statuses by fixed limits."""
    from tickloom.functions.status import threshold_status

    slot = F.hour("open_time") % 4
    names = F.create_map(
        *[x for symbol, row in METRIC_NAMES.items() for x in (F.lit(symbol), F.array(*[F.lit(n) for n in row]))]
    )
    return bars(spark, sf).select(
        F.col("open_time").alias("metric_time"),
        F.get(F.element_at(names, F.col("symbol")), slot).alias("metric_name"),
        F.col("close").alias("metric_value"),
        threshold_status(F.col("close"), METRIC_WARN, METRIC_ALERT).alias("status"),
        F.concat(F.lit('{"message":"'), "symbol", F.lit('"}')).alias("details"),
    )


# -- the same inputs as SQL ---------------------------------------------------------------------

SQL_BARS = """bars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS open_time,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, sum(value) AS volume,
         sum(value * value) AS quote_volume, count(*) AS trades,
         date_trunc('hour', ts) + INTERVAL 3599 SECOND AS close_time
  FROM events GROUP BY 1, 2)"""

SQL_USER_BARS = SQL_BARS.replace("bars AS", "user_bars AS", 1).replace("event_type AS symbol", "CAST(user_id AS VARCHAR) AS symbol")


def sql_features(source: str = "bars", name: str = "all_features") -> str:
    """CTEs that end in ``name``: every indicator for the bars in ``source``."""
    return f"""{name}_1 AS (
  SELECT *,
    lag(close, 1) OVER w AS close_lag_1h, lag(close, 2) OVER w AS close_lag_2h,
    lag(close, 4) OVER w AS close_lag_4h, lag(close, 12) OVER w AS close_lag_12h,
    lag(close, 24) OVER w AS close_lag_24h,
    close / lag(close, 1) OVER w - 1 AS return_1h, close / lag(close, 6) OVER w - 1 AS return_6h,
    close / lag(close, 24) OVER w - 1 AS return_24h,
    avg(close) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS ma_7,
    avg(close) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS ma_24,
    avg(close) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS ma_168,
    avg(close) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
      - avg(close) OVER (w ROWS BETWEEN 26 PRECEDING AND 1 PRECEDING) AS macd,
    coalesce(close - lag(close, 1) OVER w, 0.0) AS move,
    greatest(high - low, abs(high - lag(close, 1) OVER w), abs(low - lag(close, 1) OVER w)) AS true_range,
    stddev_samp(close) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS std_20,
    avg(close) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS mean_20,
    avg(volume) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS volume_24
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY open_time)),
{name}_2 AS (
  SELECT *,
    avg(macd) OVER (w ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS macd_signal,
    avg(greatest(move, 0.0)) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS up_14,
    avg(greatest(-move, 0.0)) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS down_14,
    avg(true_range) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS atr_14
  FROM {name}_1 WINDOW w AS (PARTITION BY symbol ORDER BY open_time)),
{name} AS (
  SELECT f.*, macd - macd_signal AS macd_hist,
    CASE WHEN down_14 = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + up_14 / nullif(down_14, 0)) END AS rsi_14,
    atr_14 / f.close AS atr_ratio, 4 * std_20 / nullif(mean_20, 0) AS bb_width,
    f.volume / nullif(volume_24, 0) AS volume_ratio, ln(1 + f.volume) AS log_volume,
    f.high - f.low AS hl_spread, f.close - f.open AS oc_change,
    f.close / ma_7 AS close_ma7_ratio, f.close / ma_24 AS close_ma24_ratio, f.close / ma_168 AS close_ma168_ratio,
    CAST(hour(f.open_time) AS INTEGER) AS hour, CAST(dayofweek(f.open_time) + 1 AS INTEGER) AS day_of_week,
    sin(2 * pi() * hour(f.open_time) / 24) AS hour_sin, cos(2 * pi() * hour(f.open_time) / 24) AS hour_cos,
    sin(2 * pi() * (dayofweek(f.open_time) + 1) / 7) AS weekday_sin, cos(2 * pi() * (dayofweek(f.open_time) + 1) / 7) AS weekday_cos,
    t.close AS target_close_1h, t.close / f.close - 1 AS target_return_1h
  FROM {name}_2 f LEFT JOIN {source} t ON t.symbol = f.symbol AND t.open_time = f.open_time + INTERVAL 1 HOUR)"""


SQL_WARM = """features AS (
  SELECT * FROM all_features
  WHERE close_lag_1h IS NOT NULL AND close_lag_2h IS NOT NULL AND close_lag_4h IS NOT NULL
    AND close_lag_12h IS NOT NULL AND close_lag_24h IS NOT NULL
    AND return_1h IS NOT NULL AND return_6h IS NOT NULL AND return_24h IS NOT NULL
    AND close_ma7_ratio IS NOT NULL AND close_ma24_ratio IS NOT NULL AND close_ma168_ratio IS NOT NULL
    AND macd IS NOT NULL AND macd_signal IS NOT NULL AND macd_hist IS NOT NULL AND rsi_14 IS NOT NULL
    AND atr_14 IS NOT NULL AND atr_ratio IS NOT NULL AND bb_width IS NOT NULL AND volume_ratio IS NOT NULL)"""

SQL_FEATURES = f"{SQL_BARS}, {sql_features()}, {SQL_WARM}"

SQL_PREDICTIONS = f"""{SQL_FEATURES}, predictions AS (
  SELECT symbol, open_time AS feature_open_time, open_time + INTERVAL 1 HOUR AS prediction_time, m.model_uri,
         m.predicted_close, m.predicted_close / close - 1 AS predicted_return_1h,
         'target_close_1h' AS model_target_col, '1' AS model_version, 'run-' || m.model_uri AS model_run_id,
         CAST(3 AS BIGINT) AS raw_table_version, CAST(2 AS BIGINT) AS features_table_version,
         CAST(1 AS BIGINT) AS model_raw_table_version, CAST(1 AS BIGINT) AS model_features_table_version,
         CAST(1 AS BIGINT) AS model_feature_config_version, CAST(7 AS BIGINT) AS model_feature_config_id
  FROM (SELECT *, unnest([{{'model_uri': 'persistence', 'predicted_close': close}},
                          {{'model_uri': 'ma7', 'predicted_close': ma_7}}]) AS m FROM features))"""

# Predictions next to the bar they forecast.
SQL_SCORED = f"""{SQL_PREDICTIONS}, scored AS (
  SELECT p.*, b.open_time AS actual_open_time, b.close AS actual_close,
         abs(b.close - p.predicted_close) AS abs_error, abs(b.close - p.predicted_close) / abs(b.close) AS pct_error
  FROM predictions p JOIN bars b ON b.symbol = p.symbol AND b.open_time = p.feature_open_time + INTERVAL 1 HOUR)"""

_CASES = " ".join(
    f"WHEN symbol = '{symbol}' AND hour(open_time) % 4 = {slot} THEN '{name}'"
    for symbol, row in METRIC_NAMES.items()
    for slot, name in enumerate(row)
)
SQL_METRICS = f"""{SQL_BARS}, metrics AS (
  SELECT open_time AS metric_time, CASE {_CASES} END AS metric_name, close AS metric_value,
         CASE WHEN close >= {METRIC_ALERT} THEN 'alert' WHEN close >= {METRIC_WARN} THEN 'warn' ELSE 'ok' END AS status,
         '{{"message":"' || symbol || '"}}' AS details
  FROM bars)"""

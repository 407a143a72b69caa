"""Predictions against actuals, error aggregates and direction tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import scores
from tickloom.operators import evaluate as ev
from tickloom.operators.horizon import predictions_with_actuals
from tickloom.operators.predict import score_latest
from tickloom.plans import monitor
from tickloom.queries import base
from tickloom.queries.base import SQL_FEATURES, SQL_PREDICTIONS, SQL_SCORED, query, rounded, sql_r6, sql_rounded

KEYS = ["symbol"]


def scored(spark, sf):
    raw, _, predictions = base.stored_tables(spark, sf)
    return predictions_with_actuals(predictions, raw, KEYS)


@query(
    "pred_vs_actual",
    f"WITH {SQL_SCORED} SELECT symbol, feature_open_time, model_uri, actual_open_time, {sql_rounded('predicted_close actual_close abs_error pct_error')} FROM scored",
)
def pred_vs_actual(spark, sf):
    columns = ["symbol", "feature_open_time", "model_uri", "actual_open_time", "predicted_close", "actual_close", "abs_error", "pct_error"]
    return rounded(scored(spark, sf).select(*columns))


@query(
    "pred_vs_actual_left",
    f"""WITH {SQL_PREDICTIONS} SELECT p.symbol, p.feature_open_time, p.model_uri, b.open_time AS actual_open_time, {sql_rounded('predicted_close', 'p.')},
    {sql_r6('abs(b.close - p.predicted_close)', 'abs_error')} FROM predictions p LEFT JOIN bars b ON b.symbol = p.symbol AND b.open_time = p.feature_open_time + INTERVAL 1 HOUR""",
)
def pred_vs_actual_left(spark, sf):
    joined = predictions_with_actuals(base.predictions(spark, sf), base.bars(spark, sf), KEYS, "left")
    return rounded(joined.select("symbol", "feature_open_time", "model_uri", "actual_open_time", "predicted_close", "abs_error"))


_ERRORS = """count(*) AS row_count, {rmse}, {mae}, {mape}, {bias}, {p95}""".format(
    rmse=sql_r6("sqrt(avg((actual_close - predicted_close) ** 2))", "rmse"),
    mae=sql_r6("avg(abs_error)", "mae"),
    mape=sql_r6("avg(pct_error)", "mape"),
    bias=sql_r6("avg(actual_close - predicted_close)", "mean_error"),
    p95=sql_r6("quantile_disc(abs_error, 0.95)", "p95_abs_error"),
)


@query("error_metrics", f"WITH {SQL_SCORED} SELECT symbol, model_uri, {_ERRORS} FROM scored GROUP BY 1, 2")
def error_metrics(spark, sf):
    return rounded(ev.error_summary(scored(spark, sf), by=("symbol", "model_uri")))


_STANDARD = """{rmse}, {mae}, {r2}, {mape}, {da}""".format(
    rmse=sql_r6("sqrt(avg((y - p) ** 2))", "rmse"),
    mae=sql_r6("avg(abs(y - p))", "mae"),
    r2=sql_r6("1 - sum((y - p) ** 2) / sum((y - m) ** 2)", "r2"),
    mape=sql_r6("avg(abs(y - p) / greatest(abs(y), 1e-10))", "mape"),
    da=sql_r6("avg(CASE WHEN (y > 0) = (p > 0) THEN 1.0 ELSE 0.0 END)", "directional_accuracy"),
)


@query(
    "score_metrics",
    f"""WITH {SQL_SCORED}, pairs AS (SELECT model_uri, actual_close AS y, predicted_close AS p, avg(actual_close) OVER (PARTITION BY model_uri) AS m FROM scored)
    SELECT model_uri, {_STANDARD} FROM pairs GROUP BY 1""",
)
def score_metrics(spark, sf):
    return rounded(ev.score_table(scored(spark, sf), "actual_close", "predicted_close", clip=1e-10, by=("model_uri",)))


_RETURNS_SQL = f"{SQL_FEATURES}, pairs AS (SELECT target_return_1h AS y, return_1h AS p FROM features WHERE target_return_1h IS NOT NULL)"


@query(
    "return_score_metrics",
    f"WITH {_RETURNS_SQL}, centred AS (SELECT *, avg(y) OVER () AS m FROM pairs) SELECT {_STANDARD.replace('greatest(abs(y), 1e-10)', 'greatest(abs(y), 0.01)')} FROM centred",
)
def return_score_metrics(spark, sf):
    """Last return as the forecast of the next one."""
    rows = base.features(spark, sf).where(F.col("target_return_1h").isNotNull())
    return rounded(ev.score_table(rows, "target_return_1h", "return_1h", clip=0.01))


@query("performance_log", f"WITH {SQL_SCORED} SELECT {sql_r6('sqrt(avg((actual_close - predicted_close) ** 2))', 'rmse')}, {sql_r6('avg(pct_error)', 'mape')} FROM scored")
def performance_log(spark, sf):
    return rounded(ev.performance_log(scored(spark, sf), "actual_close", "predicted_close"))


@query("p95_error", f"WITH {SQL_SCORED} SELECT model_uri, {sql_r6('quantile_disc(abs_error, 0.95)', 'p95_abs_error')} FROM scored GROUP BY 1")
def p95_error(spark, sf):
    return rounded(scored(spark, sf).groupBy("model_uri").agg(scores.p95_abs_error("actual_close", "predicted_close").alias("p95_abs_error")))


@query("direction_a", f"WITH {_RETURNS_SQL} SELECT {sql_r6('avg(CASE WHEN (y > 0) = (p > 0) THEN 1.0 ELSE 0.0 END)', 'accuracy')} FROM pairs")
def direction_a(spark, sf):
    """Same side of "greater than zero"."""
    rows = base.features(spark, sf).where(F.col("target_return_1h").isNotNull())
    return rounded(rows.agg(scores.share_true(scores.both_up_or_not("target_return_1h", "return_1h")).alias("accuracy")))


@query("direction_b", f"WITH {_RETURNS_SQL} SELECT {sql_r6('avg(CASE WHEN sign(y) = sign(p) THEN 1.0 ELSE 0.0 END)', 'accuracy')} FROM pairs")
def direction_b(spark, sf):
    """Equal three-valued sign."""
    rows = base.features(spark, sf).where(F.col("target_return_1h").isNotNull())
    return rounded(rows.agg(scores.share_true(scores.same_sign("target_return_1h", "return_1h")).alias("accuracy")))


_MOVES = """moves AS (SELECT *, sign(actual_close - lag(actual_close) OVER w) AS a, sign(predicted_close - lag(predicted_close) OVER w) AS p
  FROM {source} WINDOW w AS (PARTITION BY symbol, model_uri ORDER BY feature_open_time))"""


@query(
    "direction_c",
    f"""WITH {SQL_SCORED}, {_MOVES.format(source='scored')}
    SELECT model_uri, {sql_r6('avg(CASE WHEN a = p THEN 1.0 ELSE 0.0 END)', 'accuracy')} FROM moves WHERE a IS NOT NULL AND p IS NOT NULL GROUP BY 1""",
)
def direction_c(spark, sf):
    """Equal sign of the change since the previous prediction."""
    marked = ev.moves(scored(spark, sf), ["symbol", "model_uri"], "feature_open_time")
    return rounded(marked.groupBy("model_uri").agg(scores.share_true(F.col("same_move")).alias("accuracy")))


SQL_PERFORMANCE = f"""WITH {SQL_SCORED}, recent AS (SELECT * FROM scored WHERE prediction_time > (SELECT max(prediction_time) FROM scored) - INTERVAL 168 HOUR),
    valid AS (SELECT * FROM recent WHERE predicted_close > 1.0), {_MOVES.format(source='valid')}
    SELECT (SELECT count(*) FROM recent) AS joined, (SELECT count(*) FROM valid) AS scored, (SELECT count(*) FROM recent WHERE predicted_close <= 1.0) AS invalid,
      {sql_r6('sqrt(avg((actual_close - predicted_close) ** 2))', 'rmse')}, {sql_r6('avg(abs_error)', 'mae')}, {sql_r6('avg(pct_error)', 'mape')},
      {sql_r6('avg(actual_close - predicted_close)', 'mean_error')}, {sql_r6('quantile_disc(abs_error, 0.95)', 'p95_abs_error')},
      (SELECT {sql_r6('avg(CASE WHEN a = p THEN 1.0 ELSE 0.0 END)')} FROM moves WHERE a IS NOT NULL AND p IS NOT NULL) AS direction_accuracy FROM valid"""


@query("performance_recent", SQL_PERFORMANCE)
def performance_recent(spark, sf):
    raw, _, predictions = base.stored_tables(spark, sf)
    facts = monitor.performance_facts(
        predictions, raw, KEYS, min_valid=1.0, series=["symbol", "model_uri"]
    )
    return rounded(facts)


_EVAL = f"""{SQL_SCORED}, fresh AS (SELECT * FROM scored WHERE prediction_time >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR)"""


@query(
    "high_error_guarded",
    f"WITH {_EVAL} SELECT count(*) AS n_eval, {sql_r6('CASE WHEN count(*) < 12 THEN 0.0 ELSE coalesce(avg(pct_error), 0.0) END', 'avg_pct_error')} FROM fresh",
)
def high_error_guarded(spark, sf):
    from tickloom.plans.alerts import prediction_error_guarded

    return rounded(prediction_error_guarded(base.predictions(spark, sf), base.bars(spark, sf), base.newest_event(spark, sf), KEYS))


_LATEST = f"""{SQL_FEATURES}, newest AS (SELECT * FROM features WHERE ma_7 IS NOT NULL AND ma_24 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1)"""


@query(
    "score_latest_close",
    f"""WITH {_LATEST} SELECT symbol, open_time AS feature_open_time, {sql_r6('(ma_7 + ma_24) / 2', 'predicted_close')},
    {sql_r6('(ma_7 + ma_24) / 2 / close - 1', 'predicted_return_1h')}, 'blend' AS model_uri, 'target_close_1h' AS model_target_col FROM newest""",
)
def score_latest_close(spark, sf):
    """A rule-based close model on the newest complete row of each series."""
    return _score_latest(spark, sf, "target_close_1h", (F.col("ma_7") + F.col("ma_24")) / 2)


@query(
    "score_latest_return",
    f"""WITH {_LATEST} SELECT symbol, open_time AS feature_open_time, {sql_r6('close * (1 + (ma_7 - ma_24) / ma_24)', 'predicted_close')},
    {sql_r6('(ma_7 - ma_24) / ma_24', 'predicted_return_1h')}, 'blend' AS model_uri, 'target_return_1h' AS model_target_col FROM newest""",
)
def score_latest_return(spark, sf):
    """The same for a model that forecasts the return."""
    return _score_latest(spark, sf, "target_return_1h", (F.col("ma_7") - F.col("ma_24")) / F.col("ma_24"))


def _score_latest(spark, sf, target, prediction):
    out = score_latest(
        base.features(spark, sf), ["ma_7", "ma_24"], lambda df: df.withColumn("prediction", prediction), target,
        {"model_uri": "blend"}, base.newest_event(spark, sf),
    )
    return rounded(out.select("symbol", "feature_open_time", "predicted_close", "predicted_return_1h", "model_uri", "model_target_col"))


@query(
    "prediction_upsert",
    f"""WITH {SQL_PREDICTIONS}, held AS (SELECT symbol, feature_open_time, model_uri, predicted_close FROM predictions),
    fresh AS (SELECT symbol, feature_open_time, model_uri, predicted_close * 2 AS predicted_close FROM predictions WHERE model_uri = 'ma7'
      UNION ALL SELECT symbol, feature_open_time, 'blend', predicted_close FROM predictions WHERE model_uri = 'ma7')
    SELECT symbol, feature_open_time, model_uri, {sql_rounded('predicted_close')} FROM fresh UNION ALL
    SELECT symbol, feature_open_time, model_uri, {sql_rounded('predicted_close')} FROM held WHERE model_uri <> 'ma7'""",
)
def prediction_upsert(spark, sf):
    """Re-scored predictions merged by series, feature time and model."""
    from tickloom.operators.upsert import upsert

    held = base.predictions(spark, sf).select("symbol", "feature_open_time", "model_uri", "predicted_close")
    ma7 = held.where(F.col("model_uri") == "ma7")
    fresh = ma7.withColumn("predicted_close", F.col("predicted_close") * 2).unionByName(ma7.withColumn("model_uri", F.lit("blend")))
    return rounded(upsert(held, fresh, ["symbol", "feature_open_time", "model_uri"]))

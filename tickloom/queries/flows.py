"""Runs over versioned tables that read only the days they need."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tickloom.operators import indicators as ind
from tickloom.plans import flow, monitor, refresh
from tickloom.plans.recent import recent_pair
from tickloom.queries import base
from tickloom.queries.base import ORACLES, SQL_FEATURES, checkpointed, query, rounded, sql_rounded
from tickloom.queries.features import FULL
from tickloom.queries.forecast import SQL_PERFORMANCE
from tickloom.session import shared_folder


def deployment(spark) -> flow.Tables:
    """Versioned tables in a folder of their own."""
    return flow.Tables(spark, f"{shared_folder(spark)}/tickloom/{uuid.uuid4().hex}")


@query("features_incremental", ORACLES["features_full_dropna"])
def features_incremental(spark, sf):
    """The feature table after a first build and two more over newer bars, each from the tail of the one before."""
    tables = deployment(spark)
    bars = checkpointed(base.bars(spark, sf))
    newest = bars.agg(F.max("open_time")).scalar()
    age = lambda hours: newest - F.expr(f"INTERVAL {hours} HOURS")
    tables.raw.create(bars.where(F.col("open_time") <= age(60)))
    flow.refresh_features(tables)
    for older, newer in ((60, 24), (24, 0)):
        tables.raw.upsert(bars.where((F.col("open_time") > age(older)) & (F.col("open_time") <= age(newer))), [*ind.KEYS, ind.TIME])
        flow.refresh_features(tables)
    return rounded(tables.features.read().select("symbol", "open_time", *FULL.split()))


@query("performance_newest_first", SQL_PERFORMANCE)
def performance_newest_first(spark, sf):
    """Forecast errors of the newest 168 hours from the days of two versioned tables that hold them."""
    tables = deployment(spark)
    raw, _, predictions = base.stored_tables(spark, sf)
    tables.raw.create(raw)
    tables.predictions.create(predictions)
    judged, bars = recent_pair(tables.predictions, tables.raw, ind.KEYS)
    return rounded(monitor.performance_facts(judged, bars, ind.KEYS, min_valid=1.0, series=["symbol", "model_uri"]))


_RULES = {"blend": "(ma_7 + ma_24) / 2", "ma7": "ma_7", "persistence": "close"}
_SPAN = 240
_ERRORS = ["challenger_rmse", "challenger_fair_rmse", "challenger_fair_mae", "champion_fair_rmse", "champion_fair_mae"]
_SCORED = " UNION ALL ".join(f"SELECT '{m}' AS m, sqrt(avg(({p} - y) ** 2)) AS rmse, avg(abs({p} - y)) AS mae FROM test" for m, p in _RULES.items())
_CHOSEN = "CASE (SELECT m FROM best) " + " ".join(f"WHEN '{m}' THEN {p}" for m, p in _RULES.items()) + " END"


@query(
    "model_refresh",
    f"""WITH {SQL_FEATURES}, complete AS (SELECT symbol, open_time, close, ma_7, ma_24, target_close_1h AS y FROM features
      WHERE close IS NOT NULL AND ma_7 IS NOT NULL AND ma_24 IS NOT NULL AND target_close_1h IS NOT NULL),
    numbered AS (SELECT *, row_number() OVER (ORDER BY open_time, symbol) - 1 AS i, count(*) OVER () AS n FROM complete),
    test AS (SELECT * FROM numbered WHERE i >= floor(n * 0.8)), scored AS ({_SCORED}), best AS (SELECT * FROM scored ORDER BY rmse, mae, m LIMIT 1),
    newest AS (SELECT *, {_CHOSEN} AS p FROM complete QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= {_SPAN}),
    fair AS (SELECT count(*) AS n, sqrt(avg((ma_7 - y) ** 2)) AS c_rmse, avg(abs(ma_7 - y)) AS c_mae, sqrt(avg((p - y) ** 2)) AS n_rmse, avg(abs(p - y)) AS n_mae FROM newest),
    history AS (SELECT 'r1/ma7' AS challenger_run_id, 'ma7' AS training_mode, CAST(NULL AS VARCHAR) AS champion_run_id, rmse AS challenger_rmse, c_rmse AS challenger_fair_rmse,
      c_mae AS challenger_fair_mae, CAST(NULL AS DOUBLE) AS champion_fair_rmse, CAST(NULL AS DOUBLE) AS champion_fair_mae, n AS eval_rows, true AS promoted FROM scored, fair WHERE m = 'ma7'
      UNION ALL SELECT 'r2/' || m, m, 'r1/ma7', rmse, n_rmse, n_mae, c_rmse, c_mae, n, n_rmse < c_rmse AND n_mae < c_mae AND n >= 100 FROM best, fair)
    SELECT challenger_run_id, training_mode, champion_run_id, {sql_rounded(_ERRORS)}, eval_rows, promoted FROM history""",
)
def model_refresh(spark, sf):
    """The promotion history of two whole refresh runs with rule-based models: a first champion, then the best of three against it."""
    tables = deployment(spark)
    raw, rows, _ = base.stored_tables(spark, sf)
    tables.raw.create(raw)
    tables.features.create(rows)
    linear = lambda df, columns, target: df.agg(F.array(*[F.struct(F.lit(c).alias("feature"), F.abs(F.corr(c, target)).alias("importance")) for c in columns]).alias("x")).select(F.inline("x"))
    for run, hour, names in (("r1", 0, ["ma7"]), ("r2", 1, list(_RULES))):
        trainers = {name: refresh.rule_trainer(_RULES[name]) for name in names}
        # Thresholds that keep every column: each rule needs its own.
        chosen = refresh.Settings(["close", "ma_7", "ma_24"], "target_close_1h", trainers, linear, corr_threshold=2.0, mi_threshold=-1.0, per_series=_SPAN)
        refresh.refresh(tables, run, datetime(2025, 1, 1, hour), chosen)
    found = refresh.history(tables).withColumn("eval_rows", F.col("challenger_eval_rows").cast("bigint"))
    return rounded(found.select("challenger_run_id", "training_mode", "champion_run_id", *_ERRORS, "eval_rows", "promoted"))

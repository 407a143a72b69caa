"""Splits, folds, manifests, replay, fair evaluation, promotion and feature-list resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import govern as g
from tickloom.operators import split as s
from tickloom.operators.evaluate import Candidate, common_keys, evaluate_models, fair_comparison
from tickloom.queries import base
from tickloom.queries.base import SQL_FEATURES, SQL_SCORED, query, rounded, sql_r6
from tickloom.session import checkpointed
from tickloom.sources.snapshots import version_availability

COLUMNS = ["return_1h", "ma_7", "rsi_14"]
TARGET = "target_return_1h"
_MODEL = f"""{SQL_FEATURES}, model AS (SELECT symbol, open_time, {TARGET}, {', '.join(COLUMNS)} FROM features
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [TARGET, *COLUMNS])}),
indexed AS (SELECT *, row_number() OVER (ORDER BY open_time, symbol) - 1 AS row_idx, count(*) OVER () AS n FROM model),
split AS (SELECT *, CASE WHEN row_idx < CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM indexed)"""


def model_rows(spark, sf):
    """Model columns of complete rows."""
    return s.complete_rows(base.features(spark, sf), [TARGET, *COLUMNS])


@query("temporal_split", f"WITH {_MODEL} SELECT symbol, open_time, row_idx, split FROM split")
def temporal_split(spark, sf):
    return s.temporal_split(model_rows(spark, sf)).select("symbol", "open_time", "row_idx", "split")


_FOLDS = f"""{_MODEL}, blocks AS (SELECT *, CASE WHEN row_idx < n - 5 * (n // 6) THEN -1 ELSE (row_idx - (n - 5 * (n // 6))) // (n // 6) END AS block FROM indexed)"""


@query(
    "cv_folds",
    f"""WITH {_FOLDS} SELECT CAST(fold AS INTEGER) AS fold, count(*) FILTER (block < fold) AS train_rows, count(*) FILTER (block = fold) AS validate_rows,
    max(open_time) FILTER (block < fold) AS train_end, min(open_time) FILTER (block = fold) AS validate_start, max(open_time) FILTER (block = fold) AS validate_end
    FROM blocks, (SELECT unnest(range(5)) AS fold) GROUP BY 1""",
)
def cv_folds(spark, sf):
    return s.fold_summary(s.cv_blocks(model_rows(spark, sf)))


RUN = {
    "run_id": "run-1", "model_algo": "gbt", "raw_table": "raw", "raw_table_version": 3, "features_table": "features", "features_table_version": 2,
    "feature_config_table": "config", "feature_config_version": 1, "feature_config_id": 7,
}
_BOUNDS = """min(open_time) FILTER (split = 'train') AS train_start_time, max(open_time) FILTER (split = 'train') AS train_end_time,
  min(open_time) FILTER (split = 'test') AS test_start_time, max(open_time) FILTER (split = 'test') AS test_end_time,
  count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows"""


def manifest(spark, sf, split):
    return g.dataset_manifest(split, RUN, COLUMNS, TARGET, 0.8, base.newest_event(spark, sf))


@query(
    "manifest",
    f"""WITH {_MODEL} SELECT 'run-1' AS run_id, 'gbt' AS model_algo, '{TARGET}' AS target_col, {_BOUNDS}, count(*) FILTER (split = 'train') AS split_idx,
    CAST({len(COLUMNS)} AS INTEGER) AS n_features, '["{'", "'.join(COLUMNS)}"]' AS feature_cols_json FROM split""",
)
def manifest_query(spark, sf):
    out = manifest(spark, sf, s.temporal_split(model_rows(spark, sf)))
    columns = ["run_id", "model_algo", "target_col", "train_start_time", "train_end_time", "test_start_time", "test_end_time", "train_rows", "test_rows", "split_idx", "n_features", "feature_cols_json"]
    return out.select(*columns)


_CHECKS = {
    "row_count": "train_rows + test_rows", "duplicate_keys": "0", "split_idx": "train_rows", "train_rows": "train_rows", "test_rows": "test_rows",
    "train_start_time": "epoch_us(train_start_time)", "train_end_time": "epoch_us(train_end_time)",
    "test_start_time": "epoch_us(test_start_time)", "test_end_time": "epoch_us(test_end_time)", "n_features": str(len(COLUMNS)),
}
_REPLAY = " UNION ALL ".join(f"SELECT '{n}' AS check_name, CAST({e} AS BIGINT) AS expected, CAST({e} AS BIGINT) AS actual, true AS passed FROM facts" for n, e in _CHECKS.items())


@query("replay_check", f"WITH {_MODEL}, facts AS (SELECT {_BOUNDS} FROM split) {_REPLAY}")
def replay_check(spark, sf):
    """A rebuilt split against its manifest: every check passes."""
    split = s.temporal_split(model_rows(spark, sf))
    return g.replay_checks(split, manifest(spark, sf, split), ["open_time", "symbol"])


_LATER = f"{_MODEL}, facts AS (SELECT {_BOUNDS} FROM split), kept AS (SELECT * EXCLUDE (row_idx, n, split) FROM split WHERE open_time > (SELECT min(open_time) FROM split)), " \
    "again AS (SELECT *, row_number() OVER (ORDER BY open_time, symbol) - 1 AS row_idx, count(*) OVER () AS n FROM kept), " \
    "relabelled AS (SELECT *, CASE WHEN row_idx < CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM again), " \
    f"found AS (SELECT {_BOUNDS} FROM relabelled)"


@query(
    "replay_mismatch",
    f"WITH {_LATER} " + " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, e.v = a.v AS passed FROM (SELECT CAST({x} AS BIGINT) AS v FROM facts) e, (SELECT CAST({x} AS BIGINT) AS v FROM found) a" for n, x in _CHECKS.items()
    ),
)
def replay_mismatch(spark, sf):
    """Replay after the first hour was lost: the checks that must notice do."""
    rows = checkpointed(model_rows(spark, sf))
    original = s.temporal_split(rows)
    first = rows.agg(F.min("open_time")).scalar()
    replayed = s.temporal_split(rows.where(F.col("open_time") > first))
    return g.replay_checks(replayed, manifest(spark, sf, original), ["open_time", "symbol"]).select("check_name", "passed")


# -- two rule-based models ----------------------------------------------------------------------

_FAIR = f"""{SQL_SCORED}, returns AS (SELECT symbol, feature_open_time, model_uri, actual_close / (predicted_close / (1 + predicted_return_1h)) - 1 AS actual, predicted_return_1h AS predicted FROM scored),
shared AS (SELECT feature_open_time, symbol FROM returns WHERE model_uri = 'ma7' INTERSECT SELECT feature_open_time, symbol FROM returns WHERE model_uri = 'persistence'),
keys AS (SELECT * FROM shared QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY feature_open_time DESC) <= 2000),
rows AS (SELECT c.actual AS ca, c.predicted AS cp, n.actual AS na, n.predicted AS np FROM keys k
  JOIN returns c ON c.symbol = k.symbol AND c.feature_open_time = k.feature_open_time AND c.model_uri = 'persistence'
  JOIN returns n ON n.symbol = k.symbol AND n.feature_open_time = k.feature_open_time AND n.model_uri = 'ma7'),
fair AS (SELECT count(*) AS eval_rows, count(*) >= 100 AS enough_rows, sqrt(avg((ca - cp) ** 2)) AS champion_rmse, avg(abs(ca - cp)) AS champion_mae,
  avg(CASE WHEN sign(ca) = sign(cp) THEN 1.0 ELSE 0.0 END) AS champion_directional_accuracy, sqrt(avg((na - np) ** 2)) AS challenger_rmse, avg(abs(na - np)) AS challenger_mae,
  avg(CASE WHEN sign(na) = sign(np) THEN 1.0 ELSE 0.0 END) AS challenger_directional_accuracy FROM rows)"""
_FAIR_COLUMNS = ["champion_rmse", "champion_mae", "champion_directional_accuracy", "challenger_rmse", "challenger_mae", "challenger_directional_accuracy"]


def returns(spark, sf):
    from tickloom.queries.forecast import scored

    rows = scored(spark, sf)
    paid = F.col("predicted_close") / (1 + F.col("predicted_return_1h"))
    return checkpointed(
        rows.select(
            "feature_open_time", "symbol", "model_uri", (F.col("actual_close") / paid - 1).alias("actual"), F.col("predicted_return_1h").alias("predicted")
        )
    )


def fair(spark, sf):
    rows = returns(spark, sf)
    of = lambda uri: rows.where(F.col("model_uri") == uri).drop("model_uri")
    return fair_comparison(of("persistence"), of("ma7"), ["feature_open_time", "symbol"])


@query("fair_eval", f"WITH {_FAIR} SELECT eval_rows, enough_rows, {base.sql_rounded(_FAIR_COLUMNS)} FROM fair")
def fair_eval(spark, sf):
    return rounded(fair(spark, sf))


_SPAN = 240
_MODELS = f"""{SQL_FEATURES}, newest AS (
  SELECT * FROM features WHERE target_close_1h IS NOT NULL AND close IS NOT NULL AND ma_7 IS NOT NULL AND ma_24 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= {_SPAN}),
rows AS (SELECT target_close_1h AS a, close AS cp, (ma_7 + ma_24) / 2 AS np FROM newest),
fair AS (SELECT count(*) AS eval_rows, count(*) >= 100 AS enough_rows, sqrt(avg((a - cp) ** 2)) AS champion_rmse, avg(abs(a - cp)) AS champion_mae,
  avg(CASE WHEN sign(a) = sign(cp) THEN 1.0 ELSE 0.0 END) AS champion_directional_accuracy, sqrt(avg((a - np) ** 2)) AS challenger_rmse, avg(abs(a - np)) AS challenger_mae,
  avg(CASE WHEN sign(a) = sign(np) THEN 1.0 ELSE 0.0 END) AS challenger_directional_accuracy FROM rows)"""


@query("fair_eval_models", f"WITH {_MODELS} SELECT eval_rows, enough_rows, {base.sql_rounded(_FAIR_COLUMNS)} FROM fair")
def fair_eval_models(spark, sf):
    """Two rule-based models with different feature lists, on the newest 240 rows of every series that suit both."""
    champion = Candidate(["close"], lambda df: df.withColumn("prediction", F.col("close")))
    challenger = Candidate(["ma_7", "ma_24"], lambda df: df.withColumn("prediction", (F.col("ma_7") + F.col("ma_24")) / 2))
    return rounded(evaluate_models(base.stored_features(spark, sf), ["open_time", "symbol"], "target_close_1h", champion, challenger, _SPAN))


@query(
    "common_keys",
    f"WITH {_FAIR} SELECT feature_open_time, symbol FROM shared",
)
def common_keys_query(spark, sf):
    """INTERSECT of the keys two models scored."""
    rows = returns(spark, sf)
    of = lambda uri: rows.where(F.col("model_uri") == uri)
    return common_keys(of("persistence"), of("ma7"), ["feature_open_time", "symbol"])


@query(
    "promotion",
    f"""WITH {_FAIR} SELECT eval_rows, challenger_rmse < champion_rmse AND challenger_mae < champion_mae
      AND challenger_directional_accuracy >= champion_directional_accuracy AS promote, challenger_rmse < champion_rmse AS promote_simple FROM fair""",
)
def promotion(spark, sf):
    full = g.promote(fair(spark, sf))
    simple = g.promote_if_lower_rmse(full.withColumnRenamed("promote", "full_rule")).withColumnRenamed("promote", "promote_simple")
    return simple.select("eval_rows", F.col("full_rule").alias("promote"), "promote_simple")


# Candidates: each series and model is a run; the run is trained when it has 100 scored rows and
# validated unless its series is the shortest name.
_CANDIDATES = f"""{SQL_SCORED}, candidates AS (
  SELECT symbol, model_uri AS model_algo, symbol || '-' || model_uri AS run_id, sqrt(avg((actual_close - predicted_close) ** 2)) AS rmse, avg(abs_error) AS mae,
    avg(CASE WHEN (actual_close > predicted_close) THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
    CASE WHEN count(*) >= 100 THEN 'trained' ELSE 'skipped' END AS training_status, CASE WHEN model_uri = 'ma7' OR length(symbol) > 4 THEN 'validated' ELSE 'failed' END AS dataset_replay_status
  FROM scored GROUP BY 1, 2)"""


def candidates(spark, sf):
    from tickloom.functions import scores
    from tickloom.queries.forecast import scored

    a, p = "actual_close", "predicted_close"
    return scored(spark, sf).groupBy("symbol", F.col("model_uri").alias("model_algo")).agg(
        F.concat_ws("-", "symbol", "model_uri").alias("run_id"),
        scores.rmse(a, p).alias("rmse"),
        scores.mae(a, p).alias("mae"),
        scores.share_true(F.col(a) > F.col(p)).alias("directional_accuracy"),
        F.when(F.count("*") >= 100, "trained").otherwise("skipped").alias("training_status"),
        F.when((F.col("model_uri") == "ma7") | (F.length("symbol") > 4), "validated").otherwise("failed").alias("dataset_replay_status"),
    )


_ELIGIBLE = "training_status = 'trained' AND dataset_replay_status = 'validated'"


@query(
    "best_challenger",
    f"""WITH {_CANDIDATES} SELECT symbol, run_id, model_algo, {base.sql_rounded('rmse mae directional_accuracy')} FROM candidates WHERE {_ELIGIBLE}
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY rmse, mae, directional_accuracy DESC, run_id) = 1""",
)
def best_challenger(spark, sf):
    best = g.best_candidate(candidates(spark, sf), by=("symbol",))
    return rounded(best.select("symbol", "run_id", "model_algo", "rmse", "mae", "directional_accuracy"))


@query(
    "promote_lock",
    """WITH aliases AS (SELECT CAST(o_custkey AS VARCHAR) AS model_name, max(o_orderkey) AS version FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
    requests AS (SELECT CAST(o_custkey AS VARCHAR) AS model_name, max(o_orderkey) AS new_version, max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS expected_version,
      max(o_totalprice) > 200000 AS promote FROM orders GROUP BY 1)
    SELECT r.model_name, promote AND a.version IS NOT DISTINCT FROM expected_version AS promoted, promote AND a.version IS DISTINCT FROM expected_version AS lock_conflict,
      CASE WHEN promote AND a.version IS NOT DISTINCT FROM expected_version THEN new_version ELSE a.version END AS final_version
    FROM requests r LEFT JOIN aliases a ON a.model_name = r.model_name""",
)
def promote_lock(spark, sf):
    """Customers as models, orders as versions: promote only where the alias did not move."""
    orders = base.table(spark, sf, "orders").withColumn("model_name", F.col("o_custkey").cast("string"))
    aliases = orders.where(F.col("o_orderstatus") != "P").groupBy("model_name").agg(F.max("o_orderkey").alias("version")).withColumn("alias", F.lit("champion"))
    requests = orders.groupBy("model_name").agg(
        F.max("o_orderkey").alias("new_version"),
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("expected_version"),
        (F.max("o_totalprice") > 200000).alias("promote"),
    )
    return g.promote_locked(requests, aliases).select("model_name", "promoted", "lock_conflict", "final_version")


_SOURCES_SQL = """src AS (SELECT CAST(user_id AS VARCHAR) AS run_id, ts AS created_at, '["' || event_type || '", "' || event_id || '"]' AS cols,
    CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS priority FROM events)"""


@query(
    "feature_cols_resolve",
    f"""WITH {_SOURCES_SQL} SELECT run_id, list_extract(['artifact', 'manifest', 'versioned_config', 'active_config'], priority + 1) AS feature_cols_source, cols AS feature_cols_json,
    CAST(2 AS INTEGER) AS n_features FROM src QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY priority, created_at DESC, cols DESC) = 1""",
)
def feature_cols_resolve(spark, sf):
    """Users as runs; the event type says which source holds the list."""
    e = base.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("ts").alias("created_at"),
        F.concat(F.lit('["'), "event_type", F.lit('", "'), F.col("event_id").cast("string"), F.lit('"]')).alias("feature_cols_json"),
        "event_type",
    )
    named = {"artifact": ["purchase"], "manifest": ["signup"], "versioned_config": ["click"], "active_config": ["view", "error"]}
    return g.resolve_feature_columns({name: e.where(F.col("event_type").isin(*types)) for name, types in named.items()})


@query(
    "active_config_lookup",
    """SELECT o_orderpriority AS config_key, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS config_id FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""",
)
def active_config_lookup(spark, sf):
    """Priorities as config keys, open orders as active rows: the newest active row of each key."""
    configs = base.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("config_key"), F.col("o_orderkey").alias("config_id"), F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderstatus") == "O").alias("is_active"),
    )
    return g.active_configs(configs).select("config_key", "config_id")


@query(
    "version_availability",
    """WITH available AS (SELECT o_orderpriority AS table_name, date_diff('day', TIMESTAMP '1990-01-01', o_orderdate) AS version, max(o_totalprice) / 1000 AS retention_hours FROM orders GROUP BY 1, 2),
    required AS (SELECT DISTINCT o_orderpriority AS table_name, date_diff('day', TIMESTAMP '1990-01-01', o_orderdate) + 1 AS version FROM orders)
    SELECT r.table_name, r.version, retention_hours IS NOT NULL AS available, coalesce(retention_hours >= 168, false) AS retained,
      CASE WHEN retention_hours IS NULL THEN 'missing' WHEN retention_hours < 168 THEN 'retention too short' ELSE 'ok' END AS status
    FROM required r LEFT JOIN available a ON a.table_name = r.table_name AND a.version = r.version""",
)
def version_availability_query(spark, sf):
    """Order days as versions with a retention; required are the versions one day later."""
    start = F.lit("1990-01-01").cast("timestamp_ntz")
    orders = base.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("table_name"), F.timestamp_diff("DAY", start, F.col("o_orderdate")).alias("version"), "o_totalprice"
    )
    available = orders.groupBy("table_name", "version").agg((F.max("o_totalprice") / 1000).alias("retention_hours"))
    required = orders.select("table_name", (F.col("version") + 1).alias("version")).distinct()
    return version_availability(required, available, 168)

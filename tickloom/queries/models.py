"""Model training, search and explanations (no SQL equivalent), and the stateful table paths."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickloom.functions.rules import bar_rules
from tickloom.operators import models as m
from tickloom.operators import split as s
from tickloom.operators.evaluate import score_table
from tickloom.queries import base
from tickloom.queries.base import SQL_BARS, query, rounded, sql_rounded
from tickloom.session import checkpointed, shared_folder
from tickloom.sources.landing import write_landing
from tickloom.sources.snapshots import SnapshotTable
from tickloom.streaming.ingest import IngestPaths, start_ingest

COLUMNS = ["return_1h", "close_ma7_ratio", "macd_hist", "rsi_14", "atr_ratio", "bb_width", "volume_ratio", "hour_sin", "hour_cos"]
TARGET = "target_return_1h"


def model_rows(spark, sf):
    return s.complete_rows(base.features(spark, sf), [TARGET, *COLUMNS])


def _split(spark, sf):
    rows = s.temporal_split(model_rows(spark, sf))
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


def _train_and_score(spark, sf, algo, params=None):
    train, test = _split(spark, sf)
    model = m.train(train, COLUMNS, TARGET, algo, params)
    scored = m.predict(model, test, COLUMNS)
    return score_table(scored, TARGET, "prediction", clip=1e-10).withColumn("model_algo", F.lit(algo))


@query("train_rf")
def train_rf(spark, sf):
    """Baseline forest: 100 trees of depth 10, scored on the last fifth of the rows."""
    return _train_and_score(spark, sf, "random_forest")


@query("train_gbt")
def train_gbt(spark, sf):
    """Boosted trees with the operator's defaults, 20 rounds of depth 6."""
    return _train_and_score(spark, sf, "gbt")


def _search(spark, sf):
    """(train, test, sampled settings, search table): two forests as sampled, over three expanding folds."""
    train, test = (checkpointed(part) for part in _split(spark, sf))  # the test part stays unseen
    trials = m.sample_params("random_forest", 2)
    found = m.search(s.cv_blocks(train.drop("row_idx"), folds=3), COLUMNS, TARGET, "random_forest", trials, folds=3)
    return train, test, trials, found


@query("param_search")
def param_search(spark, sf):
    """Errors of the trials, and the scores of the best one after a refit on the train part, on the test part."""
    train, test, trials, found = _search(spark, sf)
    best = m.best_trial(found)
    _, scored = m.refit(train, test, COLUMNS, TARGET, "random_forest", trials[best])
    scores = score_table(scored, TARGET, "prediction", clip=1e-10).withColumn("trial_number", F.lit(best))
    return found.withColumn("params", F.to_json("params")).join(F.broadcast(scores), "trial_number", "left")


@query("importance")
def importance(spark, sf):
    train, _ = _split(spark, sf)
    return m.built_in_importance(m.train(train, COLUMNS, TARGET, "random_forest"), spark, COLUMNS)


@query("permutation_importance")
def permutation_importance(spark, sf):
    """Prediction change per feature over the whole test part."""
    train, test = _split(spark, sf)
    return m.permutation_contributions(m.train(train, COLUMNS, TARGET, "random_forest"), test.drop("row_idx"), COLUMNS, ["open_time", "symbol"])


@query("model_explanations")
def model_explanations(spark, sf):
    """Both kinds of explanation in the explanations-table layout."""
    train, test = _split(spark, sf)
    model = m.train(train, COLUMNS, TARGET, "random_forest")
    contributions = m.permutation_contributions(model, test.drop("row_idx"), COLUMNS, ["open_time", "symbol"])
    versions = {"features_table_version": 2, "feature_config_id": 7}
    rows = m.explanation_rows(m.built_in_importance(model, spark, COLUMNS), contributions, "run-1", "random_forest", versions, base.newest_event(spark, sf))
    return rows.drop("created_at")


def _scratch(spark) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tickloom/{uuid.uuid4().hex}"


_CORRECTED = f"""{SQL_BARS}, corrected AS (
  SELECT * REPLACE (volume + CASE WHEN hour(open_time) % 3 = 0 THEN 1 ELSE 0 END AS volume) FROM bars)"""
_BAR_LIST = "symbol, open_time, close_time, trades, " + sql_rounded("open high low close volume quote_volume")
_BAR_COLUMNS = ["symbol", "open_time", "close_time", "trades", "open", "high", "low", "close", "volume", "quote_volume"]


def _ntz_bars(df):
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("open_time", "close_time")}
    return rounded(df.withColumns(times).select(*_BAR_COLUMNS))


def _corrections(bars):
    return bars.where(F.hour("open_time") % 3 == 0).withColumn("volume", F.col("volume") + 1)


@query("stream_ingest", f"WITH {_CORRECTED} SELECT {_BAR_LIST} FROM corrected")
def stream_ingest(spark, sf):
    """Bars written as landing CSV, ingested by the file stream; then a file of corrections, ingested by
    a second run that must see only the new file. Event values are no prices, so bars of any sign are good."""
    root = _scratch(spark)
    paths = IngestPaths(f"{root}/landing", f"{root}/checkpoint", f"{root}/staging", f"{root}/raw")
    bars = checkpointed(base.bars(spark, sf).withColumn("fetched_at", F.col("close_time")))
    write_landing(bars, paths.landing)
    start_ingest(spark, paths, rules=bar_rules(signs=False))
    write_landing(_corrections(bars), paths.landing)
    start_ingest(spark, paths, rules=bar_rules(signs=False))
    return _ntz_bars(SnapshotTable(spark, paths.raw).read())


@query(
    "snapshot_time_travel",
    f"""WITH {_CORRECTED} SELECT CAST(0 AS BIGINT) AS version, {_BAR_LIST} FROM bars UNION ALL SELECT CAST(1 AS BIGINT), {_BAR_LIST} FROM corrected""",
)
def snapshot_time_travel(spark, sf):
    """A versioned table after an upsert, read as of both versions."""
    table = SnapshotTable(spark, f"{_scratch(spark)}/bars")
    bars = checkpointed(base.bars(spark, sf))
    first = table.create(bars)
    second = table.upsert(_corrections(bars), ["symbol", "open_time"])
    versions = [
        _ntz_bars(table.read(v)).select(F.lit(v).cast("bigint").alias("version"), *_BAR_COLUMNS) for v in (first, second)
    ]
    return versions[0].unionByName(versions[1])

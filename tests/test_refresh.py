"""The model refresh: stopped after any step and resumed, it equals one run."""

import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.plans import flow, refresh as r

COLUMNS = ["close", "ma", "copy", "noise"]
TARGET = "target_close_1h"


@pytest.fixture(scope="module")
def features(spark):
    from datetime import datetime

    at = F.lit(datetime(2025, 1, 1)) + F.make_dt_interval(hours=F.col("id").cast("int"))
    close = 100 + F.col("id") % 29
    rows = spark.range(400).select(F.lit("a").alias("symbol"), at.alias("open_time"), close.cast("double").alias("close"), (close + 3 - F.col("id") % 7).cast("double").alias("ma"))
    rows = rows.withColumns({"copy": F.col("close") * 2, "noise": F.pmod(F.hash("open_time"), F.lit(11)).cast("double"), TARGET: F.col("close") + 1})
    return rows


def settings(**trainers):
    correlation = lambda rows, columns, target: rows.agg(F.array(*[F.struct(F.lit(c).alias("feature"), F.abs(F.corr(c, target)).alias("importance")) for c in columns]).alias("x")).select(F.inline("x"))
    return r.Settings(COLUMNS, TARGET, trainers, importance=correlation, corr_threshold=0.99, mi_threshold=0.3, min_eval_rows=50)


def deployment(spark, path, features):
    tables = flow.Tables(spark, str(path))
    tables.features.create(features)
    tables.raw.create(features.select("symbol", "open_time", "close"))
    return tables


MA, CLOSE = r.rule_trainer("ma"), r.rule_trainer("close")


def facts(tables):
    rows = r.history(tables).sort("evaluated_at").collect()
    return [row.asDict() for row in rows]


def test_stopped_after_any_step_equals_one_run(spark, tmp_path, features, hours, monkeypatch):
    both = settings(ma=MA, close=CLOSE)
    whole = deployment(spark, tmp_path / "whole", features)
    r.refresh(whole, "r1", hours(400), settings(ma=MA))
    row = r.refresh(whole, "r2", hours(401), both).first()
    assert row.promoted and row.training_mode == "close" and row.champion_run_id == "r1/ma" and row.challenger_fair_rmse == 1.0
    assert r.refresh(whole, "r2", hours(999), both).collect() == [row] and r.history(whole).columns == schemas.struct_of(schemas.PROMOTIONS).names
    chosen = {c.config_version: json.loads(c.config_value) for c in r.results(whole, "selection").collect()}
    assert all(c == ["close", "ma"] for c in chosen.values()) and len(chosen) == 2

    stopped = deployment(spark, tmp_path / "stopped", features)
    r.refresh(stopped, "r1", hours(400), settings(ma=MA))
    done, real = [], r.run_step

    def one_more(tables, run_id, step, inputs, make):
        def once():
            if done and done[-1] == "stop":
                raise RuntimeError(step)
            done.append("stop")
            return make()

        return real(tables, run_id, step, inputs, once)

    monkeypatch.setattr(r, "run_step", one_more)
    stops = 0
    for attempt in range(20):
        done.clear()
        try:
            r.refresh(stopped, "r2", hours(401 if attempt == 0 else 5000), both)
            break
        except RuntimeError:
            stops += 1
        if attempt == 3:  # newer versions do not change a run that has begun
            stopped.features.upsert(features.limit(1).withColumn("close", F.lit(-1e6)), ["symbol", "open_time"])
    assert stops == 9  # all but the last of 10 steps
    assert facts(stopped) == facts(whole)


def test_champion_stays_if_not_beaten_or_changed_meanwhile(spark, tmp_path, features, hours, monkeypatch):
    tables = deployment(spark, tmp_path, features)
    r.refresh(tables, "r1", hours(400), settings(close=CLOSE))
    assert not r.refresh(tables, "r2", hours(401), settings(ma=MA, close=CLOSE)).first().promoted  # equal, so not better
    with pytest.raises(ValueError, match="no trainer for close"):
        r.refresh(tables, "r3", hours(402), settings(ma=MA))
    exact = r.rule_trainer("close + 1")
    other = r.rule_trainer("close + 0.5")
    real = r._evaluation

    def overtaken(*args):
        monkeypatch.setattr(r, "_evaluation", real)
        assert r.refresh(tables, "r5", hours(404), settings(close=CLOSE, other=other)).first().promoted
        return real(*args)

    monkeypatch.setattr(r, "_evaluation", overtaken)
    assert not r.refresh(tables, "r4", hours(403), settings(close=CLOSE, exact=exact)).first().promoted
    assert r.champion(tables).challenger_run_id == "r5/other"


def test_gate_holds_a_run_back(spark, tmp_path, features, hours):
    from dataclasses import replace

    tables = deployment(spark, tmp_path, features)
    decision = spark.createDataFrame([(hours(400), False, "no trigger", "drift")], "decision_time TIMESTAMP, should_retrain BOOLEAN, reason STRING, trigger_mode STRING")
    tables.append("decisions", schemas.conform(decision, schemas.DECISIONS))
    held = replace(settings(ma=MA), trigger_mode="drift")
    assert r.refresh(tables, "r1", hours(400), held).count() == 0 and r.recorded(tables).count() == 1
    assert r.champion(tables) is None


def test_trees_are_read_back(spark, tmp_path, features, hours):
    tables = deployment(spark, tmp_path, features)
    row = r.refresh(tables, "r1", hours(400), settings(gbt=r.tree_trainer("gbt", {"maxIter": 3, "maxDepth": 3}))).first()
    again = r.refresh(tables, "r2", hours(401), settings(gbt=r.tree_trainer("gbt", {"maxIter": 3, "maxDepth": 3}))).first()
    assert row.promoted and not again.promoted and again.champion_fair_rmse == again.challenger_fair_rmse

"""One deployment end to end: landing files to decision, training set and replay."""

from datetime import timedelta

from pyspark.sql import functions as F

from tickloom.operators.govern import replay_checks
from tickloom.operators.indicators import drop_warmup, full_features
from tickloom.plans import flow
from tickloom.sources.landing import write_landing
from tickloom.streaming.ingest import IngestPaths

COLUMNS = ["return_1h", "rsi_14"]


def landing(spark, hours, start, n):
    price = 5000 + F.pmod(F.hash("id"), F.lit(100))
    return spark.range(start, start + n).select(
        (F.lit(hours(0)) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("open_time"),
        price.cast("double").alias("open"), (price + 9).cast("double").alias("high"), (price - 9).cast("double").alias("low"),
        (price + 1).cast("double").alias("close"), (price / 10).cast("double").alias("volume"),
        (F.lit(hours(0)) + F.make_dt_interval(hours=F.col("id").cast("int"), mins=F.lit(59))).alias("close_time"),
        price.cast("double").alias("quote_volume"), F.lit(5).alias("trades"), F.lit("x").alias("source"), F.lit("AAA").alias("symbol"),
        F.lit("1h").alias("interval"), F.lit(hours(0)).alias("fetched_at"),
    )


def test_hourly_drift_and_training_runs(spark, tmp_path, hours):
    tables = flow.Tables(spark, str(tmp_path / "t"))
    paths = IngestPaths(*(str(tmp_path / n) for n in ("landing", "checkpoint", "staging")), raw=f"{tmp_path}/t/raw")
    scorer = lambda df: df.withColumn("prediction", F.col("return_1h") * 0)
    run = lambda as_of: flow.hourly(tables, paths, as_of, COLUMNS, scorer, "target_return_1h", {"model_uri": "zero"}, warmup_rows=24)
    for end in (300, 301, 302):
        write_landing(landing(spark, hours, 0 if end == 300 else end - 1, 300 if end == 300 else 1), paths.landing)
        statuses = {r.metric_name: r.status for r in run(hours(end) + timedelta(minutes=5)).collect()}
        assert set(statuses.values()) == {"ok"}
    assert tables.versions() == {"raw": 2, "features": 2, "predictions": 2}
    assert tables.features.read().count() == 302 - 24
    made = {r.feature_open_time: (r.predicted_close, r.features_table_version) for r in tables.predictions.read().collect()}
    assert len(made) == 3 and made[hours(301)][1] == 2
    # Incremental builds touched the newest days only and equal a rebuild of everything.
    written = {r.version: r.days_written for r in tables.features.versions().collect()}
    assert written[0] == 12 and written[1] <= 2 and written[2] <= 2
    rebuilt = drop_warmup(full_features(tables.raw.read()))
    held = tables.features.read().select(rebuilt.columns)
    assert held.count() == rebuilt.count() and held.exceptAll(rebuilt).count() == 0
    assert flow.refresh_features(tables) == 2  # nothing new

    decision = flow.drift_check(tables, hours(302)).first()
    assert decision.trigger_mode == "drift" and decision.features_table_version == 2
    names = {r.metric_name for r in tables.log("metrics").select("metric_name").distinct().collect()}
    assert {"raw_count", "data_drift_psi_volume", "prediction_drift_ks_predicted_close", "model_drift_rmse_24h"} <= names
    assert tables.log("decisions").count() == 1

    split, manifest = flow.training_set(tables, COLUMNS, "target_return_1h", {"run_id": "r"}, hours(302))
    row = manifest.first()
    assert (row.train_rows + row.test_rows, row.features_table_version) == (277, 2)
    assert all(r.passed for r in replay_checks(split, manifest, ["open_time", "symbol"]).collect())
    assert flow.rows_of(split, "train").count() == row.train_rows


def test_first_build_of_a_young_series(spark, tmp_path, hours):
    """Ten bars give no feature row; the tables exist all the same, and the next runs go on from there."""
    tables = flow.Tables(spark, str(tmp_path / "t"))
    paths = IngestPaths(*(str(tmp_path / n) for n in ("landing", "checkpoint", "staging")), raw=f"{tmp_path}/t/raw")
    scorer = lambda df: df.withColumn("prediction", F.col("return_1h") * 0)
    run = lambda as_of: flow.hourly(tables, paths, as_of, COLUMNS, scorer, "target_return_1h", {"model_uri": "zero"}, warmup_rows=24)
    write_landing(landing(spark, hours, 0, 10), paths.landing)
    run(hours(10) + timedelta(minutes=5))
    assert tables.versions() == {"raw": 0, "features": 0, "predictions": 0}
    assert tables.features.read().count() == 0 and "rsi_14" in tables.features.read().columns
    write_landing(landing(spark, hours, 10, 30), paths.landing)
    run(hours(40) + timedelta(minutes=5))
    rebuilt = drop_warmup(full_features(tables.raw.read()))
    held = tables.features.read().select(rebuilt.columns)
    assert held.count() == rebuilt.count() == 16 and held.exceptAll(rebuilt).count() == 0
    assert tables.predictions.read().count() == 1

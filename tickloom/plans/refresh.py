"""The model refresh: gate, selection, split, training, replay, comparison and promotion as one resumable run.

Every step writes its result to a folder of its own and then appends one row (run, step, inputs, folder) to the step
table. A step whose row is there, with the same inputs, is read and not run again, so a run that stopped goes on where it
stopped. The first step pins the table versions, the time and the champion, so what is resumed later sees what the
first attempt saw. Selection configs and the promotion history are the results of those steps in all recorded runs;
nothing else is appended, so a step that runs twice leaves no second row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from tickloom.functions import scores
from tickloom.operators import models, stats
from tickloom.operators.evaluate import MIN_EVALUATION_ROWS, NEWEST_PER_SERIES, Candidate, evaluate_models
from tickloom.operators.govern import best_candidate, dataset_manifest, promote, promote_locked, promotion_history, replay_checks, selection_config
from tickloom.operators.indicators import KEYS, TIME
from tickloom.operators.quality import require_rows
from tickloom.operators.split import complete_rows, temporal_split
from tickloom.plans import gate
from tickloom.plans.flow import Tables, rows_of
from tickloom.schemas import PROMOTIONS, empty_table
from tickloom.sources.snapshots import union_all

_STEPS = "run_id STRING, step STRING, inputs STRING, folder STRING, recorded_at TIMESTAMP"
Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Trainer:
    """One algorithm: ``fit(rows, feature_cols, target, folder)`` keeps what it learns in the folder, and
    ``load(spark, folder, feature_cols)`` gives a scorer that adds ``prediction``."""

    fit: Callable[[DataFrame, list[str], str, str], None]
    load: Callable[[SparkSession, str, list[str]], Scorer]


def tree_trainer(algo: str, params: dict | None = None) -> Trainer:
    """Forests or boosted trees, saved and read back as MLlib does."""
    reader = {"random_forest": RandomForestRegressionModel, "gbt": GBTRegressionModel}[algo]

    def load(_, folder: str, feature_cols: list[str]) -> Scorer:
        model = reader.load(folder)
        return lambda df: models.predict(model, df, feature_cols)

    return Trainer(lambda rows, cols, target, folder: models.train(rows, cols, target, algo, params).write().overwrite().save(folder), load)


def rule_trainer(prediction: str) -> Trainer:
    """A fixed SQL expression; nothing is learned."""
    return Trainer(lambda *_: None, lambda *_: lambda df: df.withColumn("prediction", F.expr(prediction)))


def forest_importance(rows: DataFrame, columns: list[str], target: str) -> DataFrame:
    return models.built_in_importance(models.train(rows, columns, target, "random_forest"), rows.sparkSession, columns)


@dataclass(frozen=True)
class Settings:
    """What a refresh looks at. ``trainers`` must also hold the champion's algorithm. ``trigger_mode`` asks the newest gate
    decision of that mode; None runs without one."""

    candidates: list[str]
    target: str
    trainers: dict[str, Trainer]
    importance: Callable[[DataFrame, list[str], str], DataFrame] = forest_importance
    keys: list[str] = field(default_factory=lambda: list(KEYS))
    corr_threshold: float = stats.CORR_THRESHOLD
    mi_threshold: float = stats.MI_THRESHOLD
    fraction: float = 0.8
    min_rows: int = 100
    per_series: int = NEWEST_PER_SERIES
    min_eval_rows: int = MIN_EVALUATION_ROWS
    trigger_mode: str | None = None


# -- the step table -----------------------------------------------------------------------------


def recorded(tables: Tables) -> DataFrame:
    """All recorded steps; empty before the first."""
    try:
        return tables.spark.read.schema(_STEPS).parquet(f"{tables.root.rstrip('/')}/refresh_steps")
    except AnalysisException:
        return tables.spark.createDataFrame([], _STEPS)


def results(tables: Tables, step: str, ddl: str | None = None) -> DataFrame:
    """The result of a step in every run that recorded it."""
    done = recorded(tables).where(F.col("step") == step).groupBy("run_id").agg(F.max_by("folder", "recorded_at").alias("folder"))
    folders = [r.folder for r in done.sort("run_id").toLocalIterator()]  # one a refresh
    return union_all([tables.spark.read.parquet(f) for f in folders]) if folders else empty_table(tables.spark, ddl)


def run_step(tables: Tables, run_id: str, step: str, inputs: dict, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """(result, its folder): read if recorded with these inputs, else made, written and recorded."""
    named = json.dumps(inputs, sort_keys=True)
    same = (F.col("run_id") == run_id) & (F.col("step") == step) & (F.col("inputs") == named)
    folder = recorded(tables).where(same).agg(F.max_by("folder", "recorded_at")).first()[0]
    if folder is None:
        folder = f"{tables.root.rstrip('/')}/refresh/{run_id}/{step}-{uuid.uuid4().hex}"
        make().write.parquet(folder)
        row = tables.spark.createDataFrame([(run_id, step, named, folder)], "run_id STRING, step STRING, inputs STRING, folder STRING")
        tables.append("refresh_steps", row.withColumn("recorded_at", F.current_timestamp()))
    return tables.spark.read.parquet(folder), folder


def history(tables: Tables) -> DataFrame:
    """One row per finished refresh, in the promotion-history layout."""
    return results(tables, "promotion", PROMOTIONS)


def champion(tables: Tables) -> Row | None:
    """The newest promoted row of the history."""
    promoted = history(tables).where("promoted")
    return promoted.agg(F.max_by(F.struct(*promoted.columns), F.struct("evaluated_at", "challenger_run_id")).alias("c")).first().c


# -- the run ------------------------------------------------------------------------------------


def _pinned(tables: Tables, as_of, settings: Settings) -> DataFrame:
    now, held = tables.versions(), champion(tables)
    reason = None
    if settings.trigger_mode is not None:
        reason = gate.training_skip(tables.log("decisions"), as_of, settings.trigger_mode).first().skip_reason
    return tables.spark.createDataFrame(
        [(as_of, now["features"], now["raw"], held and held.challenger_run_id, reason)],
        "as_of TIMESTAMP, features_version BIGINT, raw_version BIGINT, champion STRING, skip_reason STRING",
    )


def _selected(tables: Tables, at: Row, settings: Settings) -> DataFrame:
    """The selection config row of this run."""
    s = settings
    features = tables.features.read(at.features_version)
    rows = complete_rows(features, [s.target, *s.candidates], TIME, s.keys)
    require_rows(rows, s.min_rows)
    pairs = stats.correlation_pairs(rows, s.candidates)
    ranking = stats.rank_features(stats.mutual_information(rows, s.candidates, s.target), s.importance(rows, s.candidates, s.target))
    decided = stats.select_features(ranking, pairs, s.corr_threshold, s.mi_threshold)
    created = at.as_of.isoformat()
    return selection_config(
        decided, int(at.as_of.timestamp()), created, "features", at.features_version, s.target, s.corr_threshold, s.mi_threshold, pairs, s.candidates
    )


def _split(tables: Tables, at: Row, columns: list[str], settings: Settings) -> DataFrame:
    rows = complete_rows(tables.features.read(at.features_version), [settings.target, *columns], TIME, settings.keys)
    return temporal_split(rows, settings.fraction, [TIME, *settings.keys])


def _candidate(spark, run_id: str, algo: str, columns: list[str], split: DataFrame, folder: str, settings: Settings) -> DataFrame:
    """One trained model and its errors on the test part."""
    trainer = settings.trainers[algo]
    trainer.fit(rows_of(split, "train"), columns, settings.target, folder)
    scored = trainer.load(spark, folder, columns)(rows_of(split, "test"))
    measured = scored.agg(
        scores.rmse(settings.target, "prediction").alias("rmse"),
        scores.mae(settings.target, "prediction").alias("mae"),
        scores.share_true(scores.same_sign(settings.target, "prediction")).alias("directional_accuracy"),
    )
    return measured.select(
        F.lit(f"{run_id}/{algo}").alias("run_id"), F.lit(algo).alias("model_algo"), F.lit(folder).alias("model_folder"),
        F.lit(json.dumps(columns)).alias("feature_cols_json"), "rmse", "mae", "directional_accuracy", F.lit("trained").alias("training_status"),
    )


def _model(tables: Tables, settings: Settings, row: Row) -> Candidate:
    if row.model_algo not in settings.trainers:
        raise ValueError(f"no trainer for {row.model_algo}, the algorithm of {row.run_id}")
    columns = json.loads(row.feature_cols_json)
    return Candidate(columns, settings.trainers[row.model_algo].load(tables.spark, row.model_folder, columns))


def _evaluation(tables: Tables, at: Row, best: Row, settings: Settings) -> DataFrame:
    """Both models on the same newest rows; without a champion its columns are NULL."""
    held = None
    if at.champion is not None:
        held = results(tables, "best").where(F.col("run_id") == at.champion).first()
    new = _model(tables, settings, best)
    features = tables.features.read(at.features_version)
    old = new if held is None else _model(tables, settings, held)
    judged = evaluate_models(features, [TIME, *settings.keys], settings.target, old, new, settings.per_series, settings.min_eval_rows)
    if held is None:
        return judged.withColumns({c: F.lit(None).cast("double") for c in judged.columns if c.startswith("champion_")})
    return judged


def _promotion(tables: Tables, at: Row, best: Row, judged: DataFrame) -> DataFrame:
    """The history row: promoted if better and if the champion is still the one that was evaluated."""
    spark, now = tables.spark, champion(tables)
    wanted = promote(judged, at.champion is not None).first()
    request = spark.createDataFrame(
        [("model", at.champion, best.run_id, wanted.promote and (wanted.enough_rows or at.champion is None))],
        "model_name STRING, expected_version STRING, new_version STRING, promote BOOLEAN",
    )
    alias = spark.createDataFrame([("model", "champion", now and now.challenger_run_id)], "model_name STRING, alias STRING, version STRING")
    facts = {
        "registered_version": best.run_id, "challenger_run_id": best.run_id, "champion_run_id": at.champion, "expected_champion_version": at.champion,
        "challenger_rmse": best.rmse, "challenger_fair_rmse": wanted.challenger_rmse, "challenger_fair_mae": wanted.challenger_mae,
        "challenger_directional_accuracy": wanted.challenger_directional_accuracy, "champion_fair_rmse": wanted.champion_rmse,
        "champion_fair_mae": wanted.champion_mae, "champion_directional_accuracy": wanted.champion_directional_accuracy,
        "challenger_eval_rows": wanted.eval_rows, "champion_eval_rows": wanted.eval_rows if at.champion is not None else 0, "training_mode": best.model_algo,
        "features_table": "features", "features_table_version": at.features_version, "dataset_replay_status": best.dataset_replay_status,
    }
    row = promote_locked(request, alias).select("promoted", *[F.lit(v).alias(k) for k, v in facts.items()])
    return promotion_history(row, at.as_of)


def refresh(tables: Tables, run_id: str, as_of, settings: Settings) -> DataFrame:
    """The history row of the run; no row if the gate held it back or no candidate is eligible.

    Calling it again with the same ``run_id`` goes on after the last recorded step, or returns the same row. ``as_of`` counts
    the first time only.
    """
    spark = tables.spark

    def step(name: str, inputs: dict, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
        return run_step(tables, run_id, name, inputs, make)

    at = step("start", {}, lambda: _pinned(tables, as_of, settings))[0].first()
    if at.skip_reason is not None:
        return empty_table(spark, PROMOTIONS)
    versions = {"features": at.features_version, "raw": at.raw_version}
    config, config_at = step("selection", versions, lambda: _selected(tables, at, settings))
    columns = json.loads(config.first().config_value)
    if not columns:
        raise ValueError("the selection keeps no feature")
    split, split_at = step("split", {**versions, "selection": config_at}, lambda: _split(tables, at, columns, settings))
    run = {"run_id": run_id, "features_table": "features", "features_table_version": at.features_version, "raw_table": "raw", "raw_table_version": at.raw_version}
    manifest, manifest_at = step(
        "manifest", {**versions, "split": split_at}, lambda: dataset_manifest(split, run, columns, settings.target, settings.fraction, at.as_of, TIME)
    )
    # The replay builds the split anew from the pinned version and compares it with the manifest.
    replay, replay_at = step(
        "replay",
        {**versions, "manifest": manifest_at},
        lambda: replay_checks(_split(tables, at, columns, settings), manifest, [*settings.keys, TIME], TIME),
    )
    status = F.lit("validated" if replay.where(~F.col("passed")).isEmpty() else "failed")
    trained = {}
    for algo in sorted(settings.trainers):
        folder = f"{tables.root.rstrip('/')}/refresh/{run_id}/model-{algo}"
        trained[algo] = step(f"train-{algo}", {"split": split_at}, lambda: _candidate(spark, run_id, algo, columns, split, folder, settings))
    rows = union_all([df for df, _ in trained.values()]).withColumn("dataset_replay_status", status)
    inputs = {"replay": replay_at, **{algo: folder for algo, (_, folder) in trained.items()}}
    found, best_at = step("best", inputs, lambda: best_candidate(rows).coalesce(1))
    best = found.where(F.col("run_id").isNotNull()).first()
    if best is None:
        return empty_table(spark, PROMOTIONS)
    judged, judged_at = step("evaluation", {**versions, "best": best_at, "champion": at.champion}, lambda: _evaluation(tables, at, best, settings))
    return step("promotion", {"evaluation": judged_at, "champion": at.champion}, lambda: _promotion(tables, at, best, judged))[0]

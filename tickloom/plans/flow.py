"""The recurring runs over versioned tables: the hourly run, the drift check, and the training set of a refresh.

Every step is an operator of this library between two tables; nothing is carried on the driver but
version numbers and the decision of the gate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from tickloom.operators.govern import dataset_manifest
from tickloom.operators.indicators import FULL_LOOKBACK, HORIZON, KEYS, TIME, drop_warmup, features_since, full_features
from tickloom.operators.predict import score_latest
from tickloom.operators.quality import require_rows
from tickloom.operators.split import complete_rows, temporal_split
from tickloom.operators.windows import last_rows
from tickloom.plans import gate, monitor
from tickloom.plans.recent import recent_pair
from tickloom.schemas import METRICS, conform
from tickloom.sources.snapshots import NO_DAY, UNKNOWN_DAY, SnapshotTable, remove_folder, union_all
from tickloom.streaming.ingest import IngestPaths, start_ingest


@dataclass(frozen=True)
class Tables:
    """The versioned tables of one deployment, under one root folder."""

    spark: SparkSession
    root: str

    def _table(self, name: str, time: str, newest_of: str | None = None) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root.rstrip('/')}/{name}", time, newest_of)

    @property
    def raw(self) -> SnapshotTable:
        return self._table("raw", TIME)

    @property
    def features(self) -> SnapshotTable:
        return self._table("features", TIME)

    @property
    def predictions(self) -> SnapshotTable:
        return self._table("predictions", "feature_open_time", "prediction_time")

    def versions(self) -> dict:
        tables = {"raw": self.raw, "features": self.features, "predictions": self.predictions}
        return {name: table.latest_version() for name, table in tables.items()}

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root.rstrip('/')}/{name}")

    def log(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}")


_BUILDS = "features_version BIGINT, raw_version BIGINT, tail STRING, tail_day STRING"


@dataclass(frozen=True)
class Build:
    """Feature rows to merge, and the state that the next build starts from.

    ``tail`` holds, of every series, the newest raw rows before one horizon ahead of ``tail_day``, as many as the longest frame
    reaches back. ``raw_version`` is the version that both were made from; ``previous`` is the build before.
    """

    rows: DataFrame
    tail: DataFrame | None
    tail_day: str | None
    raw_version: int
    previous: Row | None


def _start(bars: DataFrame, day: str) -> Column:
    """One horizon before a day, as a value of the table's time column."""
    return (F.to_timestamp(F.lit(day)) - F.lit(HORIZON)).cast(bars.schema[TIME].dataType)


def _tail(bars: DataFrame, day: str, keys: list[str]) -> DataFrame:
    return last_rows(bars.where(F.col(TIME) < _start(bars, day)), keys, TIME, FULL_LOOKBACK)


def _last_build(tables: Tables) -> Row | None:
    try:
        log = tables.spark.read.schema(_BUILDS).parquet(f"{tables.root.rstrip('/')}/feature_builds")
    except AnalysisException:
        return None
    newest = F.max_by(F.struct(*log.columns), F.struct("raw_version", "features_version"))
    return log.agg(newest.alias("b")).first().b


def pending_build(tables: Tables, keys: list[str] | None = None, full: bool = False) -> Build | None:
    """What the raw versions since the last build change; None where there are none.

    Rows from one horizon before the earliest raw day written since then are built anew (the last row before that day gets its target
    now). What their frames look back on comes from the stored tail and the days after it, so an hourly build reads a day
    or two however long the history is. A correction older than the tail reads the history once and moves the tail back; the next build
    moves it forward again. ``full`` builds all rows.
    """
    keys = KEYS if keys is None else keys
    last = _last_build(tables) if tables.features.exists() else None
    raw_version = tables.raw.latest_version()
    if last is not None and not full and last.raw_version == raw_version:
        return None
    day = tables.raw.first_day_after(last.raw_version) if last is not None and not full else None
    if day is None or day in (UNKNOWN_DAY, NO_DAY):
        bars = tables.raw.read(raw_version)
        days = tables.raw.days()
        if not days:
            return Build(full_features(bars, keys), None, None, raw_version, last)
        return Build(full_features(bars, keys), _tail(bars, days[-1].day, keys), days[-1].day, raw_version, last)
    if last.tail_day is not None and last.tail_day <= day:
        since = tables.raw.read_days((datetime.fromisoformat(last.tail_day) - HORIZON).date().isoformat())
        bars = tables.spark.read.parquet(last.tail).unionByName(since.where(F.col(TIME) >= _start(since, last.tail_day)), allowMissingColumns=True)
    else:
        bars = tables.raw.read(raw_version)
    return Build(features_since(bars, _start(bars, day), keys), _tail(bars, day, keys), day, raw_version, last)


def refresh_features(tables: Tables, keys: list[str] | None = None, full: bool = False) -> int:
    """Merge the feature rows that newer raw versions can change; new columns join the table.

    The log row names the tail, so a stop before it leaves the last build's tail in use: the next run does the
    same work again and merges the same rows.
    """
    keys = KEYS if keys is None else keys
    build = pending_build(tables, keys, full)
    if build is None:
        return tables.features.latest_version()
    version = tables.features.upsert(drop_warmup(build.rows), [*keys, TIME], unique=True)
    folder = None
    if build.tail is not None:
        folder = f"{tables.root.rstrip('/')}/tails/{uuid.uuid4().hex}"
        build.tail.write.parquet(folder)
    tables.append("feature_builds", tables.spark.createDataFrame([(version, build.raw_version, folder, build.tail_day)], _BUILDS))
    before = build.previous
    if before is not None and before.tail is not None and (before.raw_version, before.features_version) < (build.raw_version, version):
        remove_folder(tables.spark, before.tail)
    return version


def record_predictions(
    tables: Tables,
    feature_cols: list[str],
    scorer: Callable[[DataFrame], DataFrame],
    target_col: str,
    model: dict,
    prediction_time,
    keys: list[str] | None = None,
) -> int:
    """Score the newest complete row of each series and merge by series, feature time and model."""
    keys = KEYS if keys is None else keys
    now = tables.versions()
    lineage = {**model, "raw_table_version": now["raw"], "features_table_version": now["features"]}
    rows = score_latest(tables.features.read(), feature_cols, scorer, target_col, lineage, prediction_time, keys)
    return tables.predictions.upsert(rows, [*keys, "feature_open_time", "model_uri"], unique=True)


def hourly(
    tables: Tables, paths: IngestPaths, as_of, feature_cols, scorer, target_col: str, model: dict, warmup_rows: int = 1
) -> DataFrame:
    """Ingest, features, scoring, health metrics. Returns the metrics that were appended."""
    start_ingest(tables.spark, paths)
    refresh_features(tables)
    record_predictions(tables, feature_cols, scorer, target_col, model, as_of)
    health = monitor.health_metrics(
        tables.raw.read(), tables.features.read(), tables.predictions.read(), as_of, KEYS, warmup_rows=warmup_rows, versions=tables.versions()
    )
    tables.append("metrics", conform(health, METRICS))
    return health


def drift_check(
    tables: Tables, as_of, trigger_mode: str = "drift", champion_exists: bool = True, min_valid: float = monitor.MIN_VALID_PREDICTION
) -> DataFrame:
    """Append drift and performance metrics, then the gate's decision. Returns the decision row."""
    versions = tables.versions()
    features, predictions = tables.features.read(), tables.predictions.read()
    judged, bars = recent_pair(tables.predictions, tables.raw, KEYS)
    found = union_all(
        [
            monitor.feature_drift_metrics(features, as_of, versions=versions),
            monitor.prediction_drift_metrics(predictions, as_of, versions=versions),
            monitor.performance_metrics(
                judged, bars, KEYS, as_of, versions=versions, min_valid=min_valid, series=[*KEYS, "model_uri"]
            ),
        ]
    )
    tables.append("metrics", conform(found, METRICS))
    decision = gate.decision_row(tables.log("metrics"), tables.spark, as_of, trigger_mode, champion_exists, versions)
    tables.append("decisions", decision)
    return decision


def training_set(
    tables: Tables, feature_cols: list[str], target_col: str, run: dict, created_at, fraction: float = 0.8, min_rows: int = 100
) -> tuple[DataFrame, DataFrame]:
    """(labelled split, its manifest row) from the newest feature version."""
    version = tables.features.latest_version()
    rows = complete_rows(tables.features.read(version), [target_col, *feature_cols])
    require_rows(rows, min_rows)
    split = temporal_split(rows, fraction)
    facts = {"features_table": "features", "features_table_version": version, "raw_table": "raw", "raw_table_version": tables.raw.latest_version(), **run}
    return split, dataset_manifest(split, facts, feature_cols, target_col, fraction, created_at)


def rows_of(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col("split") == name)

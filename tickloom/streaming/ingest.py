"""Landing files to raw bars as one file stream.

Each micro-batch is staged, parsed, validated, reduced to the newest load per key and merged into the
raw table. A replayed batch stages under the same batch id, and the raw table knows by the stream and batch
id that it holds the batch, so running it twice publishes nothing new.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.operators.quality import batch_summary, split_valid
from tickloom.operators.upsert import retain_recent
from tickloom.sources.landing import BAR_KEYS, newest_load, parse_landing, read_landing_stream
from tickloom.sources.snapshots import SnapshotTable, remove_folder


class BadBatch(ValueError):
    """A batch with unparseable or invalid rows, in fail-fast mode."""


@dataclass(frozen=True)
class IngestPaths:
    landing: str
    checkpoint: str
    staging: str
    raw: str
    quarantine: str | None = None  # set it to keep good rows and set bad ones aside


def merge_batch(batch: DataFrame, raw: SnapshotTable, quarantine: str | None = None, defaults=None, batch_id: int = 0, stream: str | None = None, rules: dict[str, Column] | None = None) -> None:
    """Parse, check and merge one batch of landing rows.

    Without a quarantine folder any bad row fails the batch, counts included; with one, bad rows are
    written there with the rules they break and the rest is merged. The folder of a batch is
    overwritten, so a replay sets the same rows aside once. ``stream`` tells batches of equal number apart; with
    it, a batch that the raw table holds is skipped. ``rules`` (default: ``bar_rules()``) say which rows are bad.
    """
    batch_name = None if stream is None else f"{stream}:{batch_id}"
    if raw.version_of(batch_name) is not None:
        return
    parsed = parse_landing(batch, **({"defaults": defaults} if defaults else {}))
    facts = batch_summary(parsed, rules).first()
    if facts["row_count"] == 0:
        return
    bad = facts["null_open_time_count"] + facts["invalid_count"]
    good = parsed
    if bad and quarantine is None:
        raise BadBatch(
            f"{facts['null_open_time_count']} rows with an unparseable open_time and "
            f"{facts['invalid_count']} invalid rows of {facts['row_count']}"
        )
    if bad:
        good, rejected = split_valid(parsed, rules=rules)
        unparsed = F.col("open_time").isNull()
        lost = good.where(unparsed).withColumn("broken_rules", F.array(F.lit("open_time_unparseable")))
        rejected.unionByName(lost).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        good = good.where(~unparsed)
        if good.limit(1).count() == 0:
            return
    raw.upsert(newest_load(good), BAR_KEYS, unique=True, batch=batch_name)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint folder over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_ingest(spark: SparkSession, paths: IngestPaths, max_files_per_trigger: int | None = None, rules: dict[str, Column] | None = None):
    """Drain the landing folder and stop. Returns the finished query. ``rules`` as in :func:`merge_batch`."""
    raw = SnapshotTable(spark, paths.raw)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # The staging folder of a batch is overwritten, so a replay does not stage rows twice; the
        # merge reads it back, so the CSV files are parsed once.
        folder = f"{paths.staging}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        stream = stream_id(batch.sparkSession, paths.checkpoint)
        merge_batch(batch.sparkSession.read.schema(batch.schema).parquet(folder), raw, paths.quarantine, batch_id=batch_id, stream=stream, rules=rules)

    query = (
        read_landing_stream(spark, paths.landing, max_files_per_trigger)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", paths.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def staged_append(spark: SparkSession, landing: str, checkpoint: str, staging: str):
    """Only the first half: append landing rows to a staging folder and stop."""
    query = (
        read_landing_stream(spark, landing)
        .writeStream.format("parquet")
        .option("path", staging)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def expired_batches(staging: DataFrame, as_of, hours: int = 48) -> DataFrame:
    """Staged batches whose every row is past the retention."""
    kept = retain_recent(staging, as_of, hours).select("batch_id").distinct()
    return staging.select("batch_id").distinct().join(kept, "batch_id", "left_anti")


def merged_batches(raw: SnapshotTable, stream: str) -> int:
    """The last batch of a stream that the raw table holds, -1 for none. Batches come in order, so all earlier ones are done."""
    number = F.substring_index("batch", ":", -1).cast("bigint")
    last = raw.index().where(F.substring_index("batch", ":", 1) == stream).agg(F.max(number)).first()[0]
    return -1 if last is None else last


def remove_expired(spark: SparkSession, paths: IngestPaths, as_of, hours: int = 48) -> list[int]:
    """Delete the folders of staged batches that are merged and wholly past the retention; returns their ids.

    A batch goes or stays as a whole. A folder that is gone is not listed again, so a stop half-way leaves the rest to
    the next call.
    """
    staging = spark.read.option("basePath", paths.staging).parquet(paths.staging)
    done = merged_batches(SnapshotTable(spark, paths.raw), stream_id(spark, paths.checkpoint))
    expired = expired_batches(staging, as_of, hours).where(F.col("batch_id") <= done)
    removed = []
    for row in expired.sort("batch_id").toLocalIterator():
        remove_folder(spark, f"{paths.staging}/batch_id={row.batch_id}")
        removed.append(row.batch_id)
    return removed

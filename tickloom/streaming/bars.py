"""Ticks to bars as a stream: repeated ticks count once, late ones count until the watermark has passed them.

A bar is written once, when the watermark passes its end, and its state is dropped then; the ids of ticks are
kept as long as a repetition may still count. Both states are bounded by the lateness, not by the length of the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.operators.bars import HOUR_US, build_bars

LATENESS = "2 hours"


def stream_bars(
    ticks: DataFrame,
    series: Column | str = "symbol",
    ts: str = "ts",
    value: str = "value",
    tick_id: str = "tick_id",
    lateness: str = LATENESS,
    bar_us: int = HOUR_US,
    interval: str = "1h",
    source: str = "ticks",
) -> DataFrame:
    """The bars of ``build_bars`` over a stream of ticks, in append mode.

    Ticks older than the newest tick less ``lateness`` at the start of a micro-batch are dropped, repetitions by ``tick_id`` within
    the lateness too; later repetitions are older than the watermark. Ticks without a time belong to no bar.
    """
    # A watermark needs an instant; times without zone are read in the session's.
    once = ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness).dropDuplicatesWithinWatermark([tick_id])
    return build_bars(once, series, ts, value, tick_id, bar_us, interval, source)


def run_bars(bars: DataFrame, out: str, checkpoint: str):
    """Write the closed bars of everything that has arrived to parquet files, exactly once, and stop. Returns the finished query."""
    query = (
        bars.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_ticks(spark: SparkSession, folder: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files of ticks as they arrive, oldest first."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)

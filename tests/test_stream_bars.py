"""Streaming bars against the batch bars: late and repeated ticks, restarts, bounded state."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.bars import build_bars
from tickloom.streaming.bars import read_ticks, run_bars, stream_bars

SCHEMA = "tick_id BIGINT, symbol STRING, ts TIMESTAMP, value DOUBLE"


def ticks(hours, n=400):
    """Three series, a tick every seven minutes, whole numbers as values so that sums are exact."""
    return [(i, "abc"[i % 3], hours(0) + timedelta(minutes=7 * i), float((i * 37) % 101)) for i in range(n)]


def deliveries(rows):
    """Files in order of arrival: an eighth of the ticks comes 90 minutes late, a seventh comes again after 40 minutes, and some come
    again after two days, long after their bar was closed."""
    sent = [(r[2] + timedelta(minutes=90 if r[0] % 8 == 0 else 0), r) for r in rows]
    sent += [(r[2] + timedelta(minutes=130), r) for r in rows if r[0] % 7 == 0]
    sent += [(r[2] + timedelta(days=1), r) for r in rows if r[0] % 50 == 1 and r[0] < 150]
    sent.sort(key=lambda x: (x[0], x[1][0]))
    first = sent[0][0]
    files = {}
    for at, row in sent:
        files.setdefault(int((at - first) / timedelta(hours=6)), []).append(row)
    return [files[k] for k in sorted(files)]


def land(spark, folder, files):
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, root, max_files=1):
    bars = stream_bars(read_ticks(spark, f"{root}/ticks", SCHEMA, max_files))
    return run_bars(bars, f"{root}/bars", f"{root}/checkpoint")


def rows(spark, root):
    return sorted(tuple(r) for r in spark.read.parquet(f"{root}/bars").collect())


@pytest.fixture
def expected(spark, hours):
    every = spark.createDataFrame(ticks(hours), SCHEMA)
    closed = every.agg(F.max("ts") - F.expr("INTERVAL 2 HOURS")).first()[0]
    bars = build_bars(every, tie="tick_id").where(F.col("open_time") + F.expr("INTERVAL 1 HOUR") <= closed)
    return sorted(tuple(r) for r in bars.collect())


def test_closed_hours_equal_the_batch_and_state_expires(spark, tmp_path, hours, expected):
    land(spark, f"{tmp_path}/ticks", deliveries(ticks(hours)))
    query = run(spark, tmp_path)
    assert rows(spark, tmp_path) == expected and len(expected) > 100
    kept = [s["numRowsTotal"] for s in query.lastProgress["stateOperators"]]
    assert sum(kept) <= 3 * 3 + 60  # three open hours of three series, and the ids of a few hours


def test_stopped_and_resumed_runs_equal_one(spark, tmp_path, hours, expected):
    files = deliveries(ticks(hours))
    for part in (files[:2], files[2:3], [], files[3:]):
        land(spark, f"{tmp_path}/ticks", part)
        run(spark, tmp_path)
    assert rows(spark, tmp_path) == expected


def test_ticks_without_time_and_empty_runs(spark, tmp_path, hours):
    land(spark, f"{tmp_path}/ticks", [[(1, "a", None, 5.0), (2, "a", hours(0), 1.0), (2, "a", hours(0), 1.0), (3, None, hours(0), 2.0), (4, "a", hours(9), None)]])
    run(spark, tmp_path)
    got = [(r.symbol, r.trades, r.open) for r in spark.read.parquet(f"{tmp_path}/bars").collect()]
    assert sorted(got, key=str) == [("a", 1, 1.0), (None, 1, 2.0)]
    run(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/bars").count() == 2

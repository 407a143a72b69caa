"""Builds from the stored tail and newest-first reads: only the needed days are listed, and nothing else changes."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.indicators import drop_warmup, full_features
from tickloom.plans import flow, monitor
from tickloom.plans.recent import recent_pair
from tickloom.sources.snapshots import SnapshotTable

KEYS = ["symbol", "open_time"]


def bars(spark, hours, spans):
    """Hourly bars of several series: {symbol: hours}."""
    rows = []
    for symbol, span in spans.items():
        for i in span:
            price = 5000.0 + (i * 37 + len(symbol)) % 101
            rows.append((symbol, hours(i), hours(i) + timedelta(minutes=59), price, price + 9, price - 9, price + 1, price / 10, price * 3, 5))
    names = "symbol STRING, open_time TIMESTAMP, close_time TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, trades INT"
    return spark.createDataFrame(rows, names)


def days_read(df):
    return {m.group(1) for f in df.inputFiles() if "/raw/" in f and (m := re.search("day=([^/]+)", f))}


def same(left, right):
    left = left.select(right.columns)
    return left.count() == right.count() and left.exceptAll(right).isEmpty()


def test_hourly_build_reads_the_days_it_rewrites(spark, tmp_path, hours):
    tables = flow.Tables(spark, str(tmp_path))
    # A long series, one that ended long ago, a young one.
    tables.raw.create(bars(spark, hours, {"long": range(480), "ended": range(30, 250), "young": range(470, 480)}))
    flow.refresh_features(tables)
    assert flow.pending_build(tables) is None
    for span, late in ((range(480, 481), {}), (range(481, 506), {}), (range(506, 507), {"ended": range(500, 502)})):
        tables.raw.upsert(bars(spark, hours, {"long": span, "young": span, **late}), KEYS)
        build = flow.pending_build(tables)
        version = flow.refresh_features(tables)
        written = {r.day for r in tables.features.index().where(F.col("version") == version).collect()}
        # From the eve of the last build's day on: what is rewritten, and at a change of day one day more.
        eve = (datetime.fromisoformat(build.previous.tail_day) - timedelta(hours=1)).date().isoformat()
        assert days_read(build.rows) and days_read(build.rows) <= written | {eve}
        assert len(days_read(build.rows)) <= 3
        assert same(tables.features.read(), drop_warmup(full_features(tables.raw.read())))
    # One tail is held at a time.
    assert len(list((tmp_path / "tails").iterdir())) == 1
    # A correction of old bars, then an ordinary hour.
    for spans in ({"long": range(100, 103)}, {"long": range(507, 508)}, {"long": range(508, 509)}):
        tables.raw.upsert(bars(spark, hours, spans).withColumn("volume", F.col("volume") + 1), KEYS)
        build = flow.pending_build(tables)
        flow.refresh_features(tables)
        assert same(tables.features.read(), drop_warmup(full_features(tables.raw.read())))
    assert len(days_read(build.rows)) <= 2


def test_a_build_stopped_before_its_log_is_done_again(spark, tmp_path, hours, monkeypatch):
    tables = flow.Tables(spark, str(tmp_path))
    tables.raw.create(bars(spark, hours, {"a": range(200)}))
    flow.refresh_features(tables)
    tables.raw.upsert(bars(spark, hours, {"a": range(200, 202)}), KEYS)
    with monkeypatch.context() as patch:
        patch.setattr(flow.Tables, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            flow.refresh_features(tables)
    tables.raw.upsert(bars(spark, hours, {"a": range(202, 230)}), KEYS)
    flow.refresh_features(tables)
    assert same(tables.features.read(), drop_warmup(full_features(tables.raw.read())))


def predictions(spark, hours, rows):
    """(symbol, feature hour, hour of prediction, predicted close)."""
    data = [(s, None if h is None else hours(h), hours(at), p, "m") for s, h, at, p in rows]
    return spark.createDataFrame(data, "symbol STRING, feature_open_time TIMESTAMP, prediction_time TIMESTAMP, predicted_close DOUBLE, model_uri STRING")


@pytest.mark.parametrize("recent_hours", [24, 60])
def test_newest_first_read_equals_the_whole_join(spark, tmp_path, hours, recent_hours):
    raw = SnapshotTable(spark, f"{tmp_path}/raw")
    raw.create(bars(spark, hours, {"a": range(700), "b": range(650)}))
    table = SnapshotTable(spark, f"{tmp_path}/predictions", "feature_open_time", "prediction_time")
    rows = [(s, h, h + 1, 5050.0 + h % 7) for s in "ab" for h in range(0, 1000, 5)]  # 700 and later have no bar yet
    rows += [("a", 40, 690, 5100.0), ("a", None, 999, 1.0), ("c", 900, 2000, 1.0), ("b", 130, 640, 3.0)]  # an old hour predicted anew
    table.create(predictions(spark, hours, rows))
    judged, held = recent_pair(table, raw, ["symbol"], recent_hours)
    facts = lambda p, b: monitor.performance_facts(p, b, ["symbol"], recent_hours, series=["symbol", "model_uri"]).first()
    whole = facts(table.read(), raw.read())
    assert facts(judged, held) == whole and whole.joined > 3
    listed = {re.search("day=([^/]+)", f).group(1) for f in judged.inputFiles()}
    assert hours(40).date().isoformat() in listed and len(listed) <= 3 + recent_hours // 24 + (recent_hours > 50)
    assert len(days_read(held)) <= 2 * len(listed)


def test_newest_first_read_without_joined_rows(spark, tmp_path, hours):
    raw = SnapshotTable(spark, f"{tmp_path}/raw")
    raw.create(bars(spark, hours, {"a": range(30)}))
    table = SnapshotTable(spark, f"{tmp_path}/predictions", "feature_open_time", "prediction_time")
    table.create(predictions(spark, hours, []))
    for rows in ([], [("a", 500, 501, 5000.0)], [("z", 3, 4, 5000.0)]):
        if rows:
            table.upsert(predictions(spark, hours, rows), ["symbol", "feature_open_time", "model_uri"])
        judged, held = recent_pair(table, raw, ["symbol"])
        assert judged.count() == 0 and monitor.performance_facts(judged, held, ["symbol"]).first().joined == 0


def test_days_of_an_index_without_newest_values_are_read(spark, tmp_path, hours):
    """A table written without ``newest_of`` gives the same facts, from all its days."""
    raw = SnapshotTable(spark, f"{tmp_path}/raw")
    raw.create(bars(spark, hours, {"a": range(100)}))
    rows = [("a", h, h + 1, 5050.0) for h in range(100)]
    SnapshotTable(spark, f"{tmp_path}/predictions", "feature_open_time").create(predictions(spark, hours, rows))
    table = SnapshotTable(spark, f"{tmp_path}/predictions", "feature_open_time", "prediction_time")
    judged, held = recent_pair(table, raw, ["symbol"], 24)
    facts = lambda p, b: monitor.performance_facts(p, b, ["symbol"], 24).first()
    assert facts(judged, held) == facts(table.read(), raw.read())

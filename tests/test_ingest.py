"""Parsing, landing files, the ingest stream and versioned tables."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.parse import interval_hours, parse_timestamp
from tickloom.functions.rules import bar_rules
from tickloom.operators.bars import build_bars, closed_bars, high_water, newer_than
from tickloom.operators.upsert import loaded_since, retain_recent, upsert
from tickloom.sources.jobs import read_job_runs
from tickloom.sources.landing import (
    CSV_COLUMNS_SHORT,
    newest_load,
    parse_klines,
    parse_landing,
    read_landing_batch,
    to_landing_rows,
    write_landing,
)
from tickloom.sources.snapshots import SnapshotTable, save, table_exists, union_all, version_availability
from tickloom.streaming.ingest import BadBatch, IngestPaths, expired_batches, merge_batch, remove_expired, staged_append, start_ingest, stream_id

KLINE = [1700000000000, "40000.0", "41000.0", "39000.0", "40500.0", "100.0", 1700003600000, "4000000.0", 1000]


def landing_rows(spark, n=4, start=0, close=100.0, **change):
    rows = []
    for i in range(start, start + n):
        t = datetime(2025, 1, 1) + timedelta(hours=i)
        row = {
            "open_time": t.strftime("%Y-%m-%dT%H:%M:%SZ"), "open": 99.0, "high": 200.0, "low": 90.0, "close": close, "volume": 5.0,
            "close_time": (t + timedelta(minutes=59)).strftime("%Y-%m-%dT%H:%M:%SZ"), "quote_volume": 500.0, "trades": 7,
            "source": "x", "symbol": "AAA", "interval": "1h", "fetched_at": "2025-02-01T00:00:00Z",
        }
        rows.append(tuple({**row, **change}.values()))
    return spark.createDataFrame(rows, schemas.LANDING)


def paths_in(folder, quarantine=False):
    p = lambda name: str(folder / name)
    return IngestPaths(p("landing"), p("checkpoint"), p("staging"), p("raw"), p("bad") if quarantine else None)


def land(df, folder):
    df.coalesce(1).write.mode("append").option("header", True).csv(folder)


def test_kline_array_to_row(spark):
    row = parse_klines(spark.createDataFrame([(json.dumps(KLINE),)], "kline STRING")).first()
    assert (row.open, row.close, row.trades) == (40000.0, 40500.0, 1000)
    assert row.open_time == datetime(2023, 11, 14, 22, 13, 20)
    assert (row.symbol, row.interval) == ("BTCUSDT", "1h")


def test_bad_kline_cells_become_null(spark):
    row = parse_klines(spark.createDataFrame([('[1700000000000, "x"]',)], "kline STRING")).first()
    assert row.open is None and row.trades is None and row.open_time is not None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-01T00:00:00Z", datetime(2025, 1, 1)),
        ("2025-01-01 00:00:00", datetime(2025, 1, 1)),
        ("2025-01-01T00:00:00+00:00", datetime(2025, 1, 1)),
        ("2025-01-01T02:00:00+02:00", datetime(2025, 1, 1)),
        ("2025-01-01", datetime(2025, 1, 1)),
        ("soon", None),
        (None, None),
    ],
)
def test_timestamp_spellings(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(parse_timestamp("t")).first()[0] == expected


@pytest.mark.parametrize(
    "text, hours",
    [
        ("interval 1 week", 168.0), ("interval 30 days", 720.0), ("'INTERVAL 1 week 2 days'", 216.0), ("interval 90 minutes", 1.5),
        ("interval 1.5 hours", 1.5), ("interval 1 day2 hours", 26.0), ("interval", None), ("1 week", None), ("interval 1 month", None),
        ("interval 1 day x", None), ("", None), (None, None),
    ],
)
def test_interval_text(spark, text, hours):
    got = spark.createDataFrame([(text,)], "t STRING").select(interval_hours("t")).first()[0]
    assert got == (pytest.approx(hours) if hours is not None else None)


def test_landing_csv_header_and_default_source(spark, tmp_path):
    bars = spark.createDataFrame([(datetime(2025, 1, 1), 1.0)], "open_time TIMESTAMP, open DOUBLE")
    write_landing(bars.coalesce(1), str(tmp_path / "out"), columns=CSV_COLUMNS_SHORT)
    text = next((tmp_path / "out").glob("*.csv")).read_text().splitlines()
    assert text[0] == "open_time,open,high,low,close,volume,close_time,quote_volume,trades,source"
    assert text[1].startswith("2025-01-01T00:00:00Z,1.0,") and text[1].endswith(",binance")


def test_short_layout_gets_default_symbol_and_interval(spark, tmp_path):
    rows = landing_rows(spark, 1).select(*CSV_COLUMNS_SHORT)
    land(rows, str(tmp_path / "short"))
    row = parse_landing(read_landing_batch(spark, str(tmp_path / "short"), CSV_COLUMNS_SHORT)).first()
    assert (row.symbol, row.interval, row.fetched_at) == ("BTCUSDT", "1h", None)


def test_high_water_mark(spark):
    loaded = spark.createDataFrame([("a", datetime(2025, 1, 1, 5)), ("a", datetime(2025, 1, 1, 3))], "symbol STRING, open_time TIMESTAMP")
    mark = high_water(loaded).first()
    assert mark.next_start - mark.high_water == timedelta(milliseconds=1)
    incoming = spark.createDataFrame(
        [("a", datetime(2025, 1, 1, 5)), ("a", datetime(2025, 1, 1, 6)), ("b", datetime(2025, 1, 1, 1))], "symbol STRING, open_time TIMESTAMP"
    )
    assert {(r.symbol, r.open_time.hour) for r in newer_than(incoming, loaded).collect()} == {("a", 6), ("b", 1)}


def test_only_closed_bars_pass(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1, 1),), (datetime(2025, 1, 1, 2),)], "close_time TIMESTAMP")
    assert closed_bars(df, datetime(2025, 1, 1, 2)).count() == 1


def test_latest_load_wins_then_file_name(spark):
    parsed = parse_landing(
        landing_rows(spark, 1, close=1.0).withColumns({"_loaded_at": F.lit(datetime(2025, 1, 1)), "_source_file": F.lit("z")})
        .unionByName(landing_rows(spark, 1, close=2.0).withColumns({"_loaded_at": F.lit(datetime(2025, 1, 2)), "_source_file": F.lit("a")}))
        .unionByName(landing_rows(spark, 1, close=3.0).withColumns({"_loaded_at": F.lit(datetime(2025, 1, 2)), "_source_file": F.lit("b")}))
    )
    rows = newest_load(parsed).collect()
    assert [r.close for r in rows] == [3.0] and "_loaded_at" not in rows[0]


def test_stream_ingests_once_and_resolves_overlaps(spark, tmp_path):
    paths = paths_in(tmp_path)
    land(landing_rows(spark, 4), paths.landing)
    start_ingest(spark, paths)
    raw = SnapshotTable(spark, paths.raw)
    assert raw.latest_version() == 0 and raw.read().count() == 4
    start_ingest(spark, paths)  # nothing new
    assert raw.latest_version() == 0
    land(landing_rows(spark, 4, start=2, close=150.0), paths.landing)
    start_ingest(spark, paths)
    got = {r.open_time.hour: r.close for r in raw.read().collect()}
    assert got == {0: 100.0, 1: 100.0, 2: 150.0, 3: 150.0, 4: 150.0, 5: 150.0}
    assert raw.read(0).count() == 4  # the older version is still readable


def test_bad_rows_fail_the_batch_or_go_to_quarantine(spark, tmp_path):
    strict = paths_in(tmp_path / "strict")
    land(landing_rows(spark, 1, open_time="never"), strict.landing)
    with pytest.raises(Exception, match="unparseable"):
        start_ingest(spark, strict)
    assert issubclass(BadBatch, ValueError)
    lenient = paths_in(tmp_path / "lenient", quarantine=True)
    land(landing_rows(spark, 1, open_time="never").unionByName(landing_rows(spark, 1, start=1, volume=-1.0)).unionByName(landing_rows(spark, 2, start=5)), lenient.landing)
    start_ingest(spark, lenient)
    assert SnapshotTable(spark, lenient.raw).read().count() == 2
    reasons = {tuple(r.broken_rules) for r in spark.read.parquet(lenient.quarantine).collect()}
    assert reasons == {("open_time_unparseable",), ("negative_volume",)}


def test_values_of_any_sign_pass_without_the_sign_rules(spark, tmp_path):
    paths = paths_in(tmp_path)
    land(landing_rows(spark, 2, low=0.0).unionByName(landing_rows(spark, 1, start=2, low=-5.0, volume=-5.0)), paths.landing)
    start_ingest(spark, paths, rules=bar_rules(signs=False))
    assert SnapshotTable(spark, paths.raw).read().count() == 3
    crossed = paths_in(tmp_path / "crossed")
    land(landing_rows(spark, 1, low=100.5), crossed.landing)
    with pytest.raises(Exception, match="1 invalid rows"):
        start_ingest(spark, crossed, rules=bar_rules(signs=False))


def test_staging_append_captures_origin(spark, tmp_path):
    land(landing_rows(spark, 2), str(tmp_path / "l"))
    staged_append(spark, str(tmp_path / "l"), str(tmp_path / "c"), str(tmp_path / "s"))
    row = spark.read.parquet(str(tmp_path / "s")).first()
    assert row._source_file.endswith(".csv") and row._loaded_at is not None


def test_retention_and_run_slice(spark):
    now = datetime(2025, 1, 10)
    df = spark.createDataFrame([(1, now), (2, now - timedelta(hours=49)), (3, None)], "batch_id INT, _loaded_at TIMESTAMP")
    assert {r.batch_id for r in retain_recent(df, now).collect()} == {1, 3}
    assert [r.batch_id for r in expired_batches(df, now).collect()] == [2]
    assert loaded_since(df, now).count() == 1
    with pytest.raises(ValueError):
        loaded_since(df, None)


def test_upsert_is_idempotent_and_null_safe(spark):
    target = spark.createDataFrame([(1, None, "old"), (2, 1, "old")], "a INT, b INT, v STRING")
    source = spark.createDataFrame([(1, None, "new"), (3, 1, "new")], "a INT, b INT, v STRING")
    once = upsert(target, source, ["a", "b"])
    assert sorted((r.a, r.v) for r in once.collect()) == [(1, "new"), (2, "old"), (3, "new")]
    assert sorted(map(tuple, upsert(once, source, ["a", "b"]).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    assert upsert(target, source, ["a", "b"], null_safe=["a"]).count() == 4


def test_snapshots(spark, tmp_path, hours):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    df = spark.createDataFrame([("a", hours(h), 1.0) for h in (0, 30, 60)], "symbol STRING, open_time TIMESTAMP, v DOUBLE")
    assert table.create(df) == 0
    with pytest.raises(ValueError):
        table.create(df)
    change = spark.createDataFrame([("a", hours(30), 2.0, "x"), ("a", hours(31), 3.0, "y")], "symbol STRING, open_time TIMESTAMP, v DOUBLE, note STRING")
    assert table.upsert(change, ["symbol", "open_time"]) == 1
    assert sorted(r.v for r in table.read().collect()) == [1.0, 1.0, 2.0, 3.0]
    assert "note" in table.read().columns and "note" not in table.read(0).columns
    assert {r.version: r.days_written for r in table.versions().collect()} == {0: 3, 1: 1}  # only the touched day
    with pytest.raises(ValueError):
        table.read(9)
    with pytest.raises(ValueError, match="repeated"):
        table.upsert(df.unionByName(df), ["symbol", "open_time"])
    with pytest.raises(ValueError, match="include"):
        table.upsert(df, ["symbol"])


def test_version_availability(spark):
    need = spark.createDataFrame([("raw", 1), ("raw", 2), ("cfg", -1), ("f", 1)], "table_name STRING, version BIGINT")
    have = spark.createDataFrame([("raw", 1, 200.0), ("f", 1, 100.0)], "table_name STRING, version BIGINT, retention_hours DOUBLE")
    got = {(r.table_name, r.version): r.status for r in version_availability(need, have, 168).collect()}
    assert got == {("raw", 1): "ok", ("raw", 2): "missing", ("cfg", -1): "optional", ("f", 1): "retention too short"}


def test_catalog_tables(spark):
    spark.sql("DROP TABLE IF EXISTS tl_demo")
    assert not table_exists(spark, "tl_demo")
    df = spark.range(3)
    save(df, "tl_demo", "errorifexists")
    with pytest.raises(Exception):
        save(df, "tl_demo", "errorifexists")
    save(df, "tl_demo", "append")
    assert table_exists(spark, "tl_demo") and spark.table("tl_demo").count() == 6
    save(df.withColumn("x", F.lit(1)), "tl_demo", "overwrite")
    assert spark.table("tl_demo").columns == ["id", "x"]
    spark.sql("DROP TABLE tl_demo")


def test_schemas_and_evolution(spark):
    for ddl in schemas.TABLES.values():
        assert schemas.empty_table(spark, ddl).count() == 0
    old = spark.createDataFrame([(1,)], "a INT")
    new = spark.createDataFrame([(2, "x")], "a INT, b STRING")
    assert [r.b for r in union_all([old, new]).orderBy("a").collect()] == [None, "x"]


def test_job_runs_from_json(spark, tmp_path):
    state = {"life_cycle_state": "TERMINATED", "result_state": "FAILED", "state_message": "x"}
    run = {"job_id": 1, "job_name": "j", "run_id": 2, "start_time": 3, "execution_duration": 60000, "state": state, "tasks": [{"task_key": "t", "run_id": 4, "state": state}]}
    (tmp_path / "r.json").write_text(json.dumps(run) + "\n")
    row = read_job_runs(spark, str(tmp_path)).first()
    assert row.tasks[0].state.result_state == "FAILED" and row.execution_duration == 60000


def test_ticks_of_one_microsecond_are_ordered_by_the_whole_tie(spark, hours):
    ids = [2**31, 2**31 - 1, -5, 2**63 - 1, -(2**63), 7]
    ticks = spark.createDataFrame([("a", hours(0), float(n), i) for n, i in enumerate(ids)], "symbol string, ts timestamp_ntz, value double, id bigint")
    for width in (3_600_000_000, 86_400_000_000, 366 * 86_400_000_000):
        bar = build_bars(ticks, tie="id", bar_us=width).first()
        assert (bar.open, bar.close) == (4.0, 3.0)


def _table_rows(hours, *closes):
    return [("a", hours(n), c) for n, c in enumerate(closes)]


_BARS = "symbol string, open_time timestamp_ntz, close double"


def test_publish_stopped_before_its_index_row_is_harmless(spark, hours, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame(_table_rows(hours, 1.0, 2.0), _BARS))
    change = spark.createDataFrame(_table_rows(hours, 9.0), _BARS)
    with monkeypatch.context() as m:
        m.setattr("tickloom.sources.snapshots.F.current_timestamp", lambda: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            table.upsert(change, ["symbol", "open_time"])
    assert table.latest_version() == 0
    assert table.upsert(change, ["symbol", "open_time"]) == 1
    assert sorted(r.close for r in table.read().collect()) == [2.0, 9.0]
    assert sorted(r.close for r in table.read(0).collect()) == [1.0, 2.0]


def test_replayed_batch_sets_bad_rows_aside_once(spark, hours, tmp_path):
    rows = landing_rows(spark, 1, start=1, volume=-1.0).unionByName(landing_rows(spark, 2, start=5))
    batch = rows.withColumns({"_loaded_at": F.lit(hours(9)), "_source_file": F.lit("f")})
    raw, quarantine = SnapshotTable(spark, str(tmp_path / "raw")), str(tmp_path / "bad")
    for _ in range(2):
        merge_batch(batch, raw, quarantine, batch_id=3)
    assert spark.read.parquet(quarantine).count() == 1
    merge_batch(batch, raw, quarantine, batch_id=4)
    assert spark.read.parquet(quarantine).count() == 2


def test_replayed_batch_publishes_nothing(spark, tmp_path):
    paths = paths_in(tmp_path)
    land(landing_rows(spark, 4), paths.landing)
    start_ingest(spark, paths)
    raw, stream = SnapshotTable(spark, paths.raw), stream_id(spark, paths.checkpoint)
    batch = spark.read.parquet(f"{paths.staging}/batch_id=0")
    merge_batch(batch, raw, batch_id=0, stream=stream)
    assert raw.latest_version() == 0 and raw.version_of(f"{stream}:0") == 0
    merge_batch(batch, raw, batch_id=0, stream="another stream")
    merge_batch(batch, raw)  # without a name every merge is a version
    assert raw.latest_version() == 2 and raw.read().count() == 4


def test_a_write_without_rows_keeps_the_version(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([("a", datetime(2025, 1, 1), 1.0)], "symbol STRING, open_time TIMESTAMP, close DOUBLE")
    assert table.upsert(rows.limit(0), ["symbol", "open_time"]) == 0
    assert table.read().count() == 0 and table.read().columns == rows.columns
    assert table.upsert(rows, ["symbol", "open_time"]) == 1
    assert table.upsert(rows.limit(0), ["symbol", "open_time"], batch="b") == 1
    assert table.read().collect() == rows.collect() and table.read(0).count() == 0


def test_expired_batches_are_removed_as_a_whole(spark, tmp_path):
    paths = paths_in(tmp_path)
    for start in range(0, 16, 4):
        land(landing_rows(spark, 4, start=start), paths.landing)
        start_ingest(spark, paths)
    now = datetime(2025, 6, 10)
    # The load times are those of this run; batch 0 is made old, batch 1 half old, batch 3 old but not merged.
    for batch, ages in {0: [90, 90], 1: [90, 1], 2: [1, 1], 3: [90, 90]}.items():
        rows = spark.read.parquet(f"{paths.staging}/batch_id={batch}").collect()
        aged = spark.createDataFrame([{**r.asDict(), "_loaded_at": now - timedelta(hours=ages[i % 2])} for i, r in enumerate(rows)])
        aged.write.mode("overwrite").parquet(f"{paths.staging}/batch_id={batch}")
    index = spark.read.parquet(f"{paths.raw}/index").where("version < 3").collect()
    held = SnapshotTable(spark, paths.raw).index().schema
    spark.createDataFrame(index, held).write.parquet(f"{tmp_path}/other/index")
    unmerged = IngestPaths(paths.landing, paths.checkpoint, paths.staging, f"{tmp_path}/other")
    assert remove_expired(spark, unmerged, now) == [0]
    assert sorted(p.name for p in (tmp_path / "staging").glob("batch_id=*")) == ["batch_id=1", "batch_id=2", "batch_id=3"]
    assert remove_expired(spark, unmerged, now) == []
    assert remove_expired(spark, paths, now) == [3]
    assert SnapshotTable(spark, paths.raw).read().count() == 16

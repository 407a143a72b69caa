"""Validation rules, batch checks, profiles and de-duplication."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality as q
from tickloom.operators.dedup import duplicate_keys, latest_per_key, one_per_key

GOOD = {
    "symbol": "a", "interval": "1h", "open_time": datetime(2025, 1, 1), "close_time": datetime(2025, 1, 1, 0, 59), "fetched_at": datetime(2025, 1, 2),
    "open": 2.0, "high": 3.0, "low": 1.0, "close": 2.5, "volume": 1.0, "quote_volume": 1.0, "trades": 1,
}
SCHEMA = (
    "symbol STRING, interval STRING, open_time TIMESTAMP, close_time TIMESTAMP, fetched_at TIMESTAMP, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, trades BIGINT"
)


def frame(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], SCHEMA)


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"close_time": None}, "close_time_missing"),
        ({"close_time": datetime(2025, 1, 1)}, "close_time_not_after_open_time"),
        ({"open": 0.0, "low": 0.0}, "non_positive_open"),
        ({"high": 2.2}, "high_below_others"),
        ({"low": 2.2}, "low_above_others"),
        ({"volume": -1.0}, "negative_volume"),
        ({"quote_volume": -1.0}, "negative_quote_volume"),
        ({"trades": -1}, "negative_trades"),
        ({"symbol": None}, "symbol_missing"),
        ({"interval": None}, "interval_missing"),
        ({"fetched_at": None}, "fetched_at_missing"),
    ],
)
def test_each_rule_fires(spark, change, rule):
    assert rule in q.mark_broken(frame(spark, change)).first().broken_rules


def test_good_row_and_null_price(spark):
    df = frame(spark, {}, {"close": None})
    assert q.split_valid(df)[0].count() == 2  # an unknown price breaks no comparison
    good, bad = q.split_valid(df, strict=True)
    assert good.count() == 1 and bad.first().broken_rules == ["null_close"]


def test_fail_fast(spark):
    q.require_clean(frame(spark, {}))
    with pytest.raises(ValueError, match="empty"):
        q.require_clean(frame(spark, {}).where("false"))
    with pytest.raises(ValueError, match="negative_volume"):
        q.require_clean(frame(spark, {}, {"volume": -1.0}))
    q.require_rows(spark.range(100))
    with pytest.raises(ValueError):
        q.require_rows(spark.range(99))


def test_batch_errors_report_repeats_and_parse_errors(spark):
    df = frame(spark, {}, {}, {}, {"open_time": datetime(2025, 1, 1, 1), "open": None, "volume": -1.0})
    got = {(r.open_time.hour, r.error, r.surplus) for r in q.batch_errors(df, ["symbol", "open_time"]).collect()}
    assert got == {(0, "duplicate_open_time", 2), (1, "parse_error", 0), (1, "close_time_not_after_open_time", 0)} - {(1, "close_time_not_after_open_time", 0)}
    many = frame(spark, *[{"open_time": datetime(2025, 1, 1) + timedelta(hours=i), "volume": -1.0} for i in range(30)])
    assert q.batch_errors(many, ["symbol", "open_time"], limit=20).count() == 20


def test_missing_ratio(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "a INT, b STRING")
    assert [(r["column"], round(r.null_ratio, 3)) for r in q.missing_ratio(df).collect()] == [("b", 0.667)]
    assert q.missing_ratio(df, 2 / 3).count() == 0  # strictly above
    assert {r.null_ratio for r in q.missing_ratio(df.where("false")).collect()} == {1.0}


def test_freshness_states(spark):
    df = frame(spark, {})
    state = lambda d, hours: q.freshness(d, datetime(2025, 1, 1) + timedelta(hours=hours)).first()
    assert (state(df, 2).status, state(df, 2).alert) == ("fresh", False)
    assert (state(df, 2.01).status, state(df, 2.01).alert) == ("stale", True)
    assert (state(df.where("false"), 1).status, state(df.where("false"), 1).alert) == ("no_data", True)


def test_schema_check_ignores_case(spark):
    assert q.missing_columns(frame(spark, {}), ["OPEN", "close", "spread"]) == ["spread"]
    assert q.existing_columns(frame(spark, {}), ["spread", "close"]) == ["close"]


def test_histogram_counts_everything(spark):
    df = spark.range(101).withColumn("v", F.col("id") / 10)
    rows = q.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r.row_count for r in rows] == [10] * 9 + [11]
    flat = q.histogram(df.withColumn("v", F.lit(1.0)), "v", 4)
    assert flat.agg(F.sum("row_count")).first()[0] == 101


def test_column_summary(spark):
    row = q.column_summary(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v DOUBLE"), ["v"]).first()
    assert (row["count"], row["mean"], row["std"], row["min"], row["max"]) == (3, 2.0, 1.0, 1.0, 3.0)
    assert (row.null_count, row.null_pct) == (1, 25.0)


def test_dedup(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d")], "k INT, t INT, v STRING")
    assert {(r.k, r.v) for r in latest_per_key(df, ["k"], ["t"]).collect()} == {(1, "c"), (2, "d")}
    assert one_per_key(df, ["k"]).count() == 2
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 3)]

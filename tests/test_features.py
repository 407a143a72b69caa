"""Indicator semantics on small hand-made series."""

import math

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as ind


def bars(spark, rows):
    """rows: (open_time, open, high, low, close, volume)"""
    df = spark.createDataFrame(rows, "open_time TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE")
    return df.withColumn("symbol", F.lit("a"))


def ramp(spark, hours, n=24):
    return bars(spark, [(hours(t), 39900.0 + t, 40100.0 + t, 39800.0 + t, 40000.0 + t, 100.0 + t) for t in range(n)])


def rows_by_time(df):
    return [r.asDict() for r in df.orderBy("open_time").collect()]


def test_basic_feature_set(spark, hours):
    out = rows_by_time(ind.basic_features(ramp(spark, hours), sizes=[7], lag_steps=[1]))
    assert len(out) == 24
    assert out[1]["close_lag_1h"] == 40000.0
    assert out[1]["return_1h"] == pytest.approx(1 / 40000.0)
    assert out[0]["target_close_1h"] == 40001.0
    assert out[0]["ma_7"] is None and out[3]["ma_7"] == pytest.approx(40001.0)
    assert out[0]["hl_spread"] == 300.0 and out[0]["oc_change"] == 100.0
    assert out[23]["target_close_1h"] is None


def test_target_needs_the_exact_next_hour(spark, hours):
    df = bars(spark, [(hours(0), 1.0, 2.0, 0.5, 1.5, 10.0), (hours(2), 1.0, 2.0, 0.5, 1.7, 10.0)])
    assert rows_by_time(ind.basic_features(df, sizes=[1], lag_steps=[1]))[0]["target_close_1h"] is None


def test_repeated_bars_count_once(spark, hours):
    df = ramp(spark, hours, 5)
    assert ind.basic_features(df.unionByName(df), sizes=[7], lag_steps=[1]).count() == 5


def test_rsi_is_100_without_losses_and_null_on_the_first_row(spark, hours):
    out = rows_by_time(ind.full_features(ramp(spark, hours), plan=None))
    assert out[0]["rsi_14"] is None
    assert all(r["rsi_14"] == 100.0 for r in out[1:])


def test_rsi_by_hand(spark, hours):
    closes = [10.0, 11.0, 10.5, 10.5, 12.0, 11.0]
    df = bars(spark, [(hours(i), c, c, c, c, 1.0) for i, c in enumerate(closes)])
    out = rows_by_time(ind.full_features(df, plan=None))
    gains = [0, 1.0, 0, 0, 1.5]
    losses = [0, 0, 0.5, 0, 0]
    strength = (sum(gains) / 5) / (sum(losses) / 5)
    assert out[5]["rsi_14"] == pytest.approx(100 - 100 / (1 + strength))


def test_first_true_range_is_high_minus_low(spark, hours):
    out = rows_by_time(ind.full_features(ramp(spark, hours), plan=None))
    assert out[1]["atr_14"] == pytest.approx(300.0)


def test_macd_uses_simple_averages(spark, hours):
    out = rows_by_time(ind.full_features(ramp(spark, hours, 40), plan=None))
    close = [40000.0 + t for t in range(40)]
    macd = lambda t: sum(close[t - 12 : t]) / 12 - sum(close[t - 26 : t]) / 26
    assert out[39]["macd"] == pytest.approx(macd(39))
    assert out[39]["macd_signal"] == pytest.approx(sum(macd(t) for t in range(30, 39)) / 9)


def test_calendar_encoding(spark, hours):
    first = rows_by_time(ind.full_features(ramp(spark, hours, 3), plan=None))[2]
    assert (first["hour"], first["day_of_week"]) == (2, 4)  # a Wednesday
    assert first["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 2 / 24))
    assert first["weekday_cos"] == pytest.approx(math.cos(2 * math.pi * 4 / 7))


def test_zero_prices_give_null_not_an_error(spark, hours):
    df = bars(spark, [(hours(i), 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(3)])
    out = rows_by_time(ind.full_features(df, plan=None))
    assert out[2]["return_1h"] is None and out[2]["volume_ratio"] is None


def test_warmup_drops_24_rows_per_series(spark, hours):
    full = ind.full_features(ramp(spark, hours, 60), plan=None)
    assert ind.drop_warmup(full).count() == 36
    report = ind.warmup_report(full).first()
    assert (report.rows_before, report.rows_after, report.rows_dropped) == (60, 36, 24)


def test_plan_must_cover_the_lookback(spark, hours):
    from tickloom.operators.windows import BlockPlan

    with pytest.raises(ValueError):
        ind.full_features(ramp(spark, hours), plan=BlockPlan(lookback=100, block_rows=500))


def test_ieee_divides_by_zero_prices_and_keeps_the_rows(spark, hours):
    closes = [5.0] * 24 + [0.0, 3.0, 0.0, 0.0] + [5.0] * 2
    df = bars(spark, [(hours(i), c, c + 1, c, c, 1.0) for i, c in enumerate(closes)])
    full = ind.full_features(df, plan=None, ieee=True)
    out = rows_by_time(full)
    assert out[25]["return_1h"] == math.inf and math.isnan(out[27]["return_1h"])
    assert out[24]["target_return_1h"] == math.inf and out[24]["atr_ratio"] == math.inf
    assert out[0]["return_1h"] is None and out[29]["return_1h"] == 0.0
    assert ind.drop_warmup(full).count() == 6


def test_rounding_keeps_what_has_no_decimals(spark):
    from tickloom.queries.base import r6

    values = [math.inf, -math.inf, math.nan, 1e300, -3e13, 1.23456789, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    got = [r.v for r in df.select("i", r6(F.col("v")).alias("v")).orderBy("i").collect()]
    assert got[:2] == [math.inf, -math.inf] and math.isnan(got[2]) and got[3:] == [1e300, -3e13, 1.234568, None]


def test_basic_features_of_zero_prices(spark, hours):
    df = bars(spark, [(hours(i), c, c, c, c, 1.0) for i, c in enumerate([0.0, 3.0, 0.0])])
    of = lambda **how: [r["return_1h"] for r in rows_by_time(ind.basic_features(df, unique=True, **how))]
    assert of(ieee=True) == [None, math.inf, -1.0] and of() == [None, None, -1.0]

"""Ticks to bars, and bars to calendar totals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

HOUR_US = 3_600_000_000


def _tick_order(ts: str, tie: str | None, bar_us: int) -> Column:
    """One number that orders the ticks of a bar: microsecond offset, then ``tie``.

    A struct would order them too, but a struct is not a fixed-width buffer, so Spark would have to
    sort every partition before aggregating. A DECIMAL of 38 digits is one: it holds the offset times
    2^64 plus any 64-bit ``tie``, for bars of up to a year and more, so the hash aggregate stays and
    the order is exact.
    """
    if tie is None:
        return F.col(ts)
    offset = F.pmod(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(bar_us))
    return offset.cast("decimal(17,0)") * F.lit(Decimal(1 << 64)) + F.col(tie).cast("bigint").cast("decimal(20,0)")


def build_bars(
    ticks: DataFrame,
    series: Column | str = "symbol",
    ts: str = "ts",
    value: str = "value",
    tie: str | None = None,
    bar_us: int = HOUR_US,
    interval: str = "1h",
    source: str = "ticks",
) -> DataFrame:
    """OHLCV bars per series. One hash aggregate: the map side combines, so a series that holds a
    third of all ticks still sends one row per bar and map task to the shuffle.

    ``ticks`` may be a stream with a watermark on ``ts``: the window stays a struct until after the aggregate, so that Spark
    knows when the state of a bar is over.
    """
    series = F.col(series) if isinstance(series, str) else series
    priced = ticks.select(
        series.alias("symbol"),
        F.window(ts, f"{bar_us} microseconds").alias("_bar"),
        F.col(value).alias("_v"),
        _tick_order(ts, tie, bar_us).alias("_order"),
    )
    bars = priced.groupBy("symbol", "_bar").agg(
        F.min_by("_v", "_order").alias("open"),
        F.max("_v").alias("high"),
        F.min("_v").alias("low"),
        F.max_by("_v", "_order").alias("close"),
        F.sum("_v").alias("volume"),
        F.sum(F.col("_v") * F.col("_v")).alias("quote_volume"),
        F.count("*").alias("trades"),
    )
    bars = bars.withColumn("open_time", F.col("_bar.start"))
    last_second = F.expr(f"INTERVAL {bar_us // 1_000_000 - 1} SECONDS")
    return bars.select(
        "symbol",
        "open_time",
        "open",
        "high",
        "low",
        "close",
        "volume",
        (F.col("open_time") + last_second).alias("close_time"),
        "quote_volume",
        "trades",
        F.lit(source).alias("source"),
        F.lit(interval).alias("interval"),
    )


def calendar_totals(
    bars: DataFrame, width: str = "1 day", start=None, end=None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Volume, quote volume and bar count per calendar bucket, both range ends included."""
    if start is not None:
        bars = bars.where(F.col("open_time") >= start)
    if end is not None:
        bars = bars.where(F.col("open_time") <= end)
    bucket = F.window("open_time", width)["start"].alias("bucket_date")
    return bars.groupBy(*keys, bucket).agg(
        F.sum("volume").alias("volume"),
        F.sum("quote_volume").alias("quote_volume"),
        F.count("*").alias("bar_count"),
    )


def closed_bars(bars: DataFrame, as_of) -> DataFrame:
    """Bars whose interval is over at ``as_of``."""
    return bars.where(F.col("close_time") < as_of)


def high_water(bars: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Newest open time per series and the next start, one millisecond later."""
    newest = F.max("open_time")
    return bars.groupBy(*keys).agg(
        newest.alias("high_water"), (newest + F.expr("INTERVAL 1 MILLISECOND")).alias("next_start")
    )


def newer_than(incoming: DataFrame, loaded: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Incoming bars past the high-water mark of their series; unknown series pass whole."""
    marks = high_water(loaded, keys).select(*keys, "next_start")
    return (
        incoming.join(marks, list(keys), "left")
        .where(F.col("next_start").isNull() | (F.col("open_time") >= F.col("next_start")))
        .drop("next_start")
    )

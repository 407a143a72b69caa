"""Technical indicators and targets.

Every trailing frame ends at the row before the current one and is shorter at the start of a
series. An indicator states its columns in up to three steps: windows over bar columns, windows over
those, and plain arithmetic. :func:`apply` merges the steps of any set of indicators, so the whole
set costs one shuffle, one sort and two window operators.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.dedup import one_per_key
from tickloom.operators.windows import BlockPlan, SeriesWindow, last_rows, over_series

# Default parameters and the columns a feature row must have (fixed values).
LAGS = (1, 2, 4, 12, 24)
RETURN_STEPS = (1, 6, 24)
AVERAGES = (7, 24, 168)
WARMUP_COLUMNS = (
    "close_lag_1h", "close_lag_2h", "close_lag_4h", "close_lag_12h", "close_lag_24h",
    "return_1h", "return_6h", "return_24h",
    "close_ma7_ratio", "close_ma24_ratio", "close_ma168_ratio",
    "macd", "macd_signal", "macd_hist", "rsi_14", "atr_14", "atr_ratio", "bb_width", "volume_ratio",
)
CANDIDATE_FEATURES = (
    "return_1h", "return_6h", "return_24h",
    "ma_7", "ma_24", "ma_168", "close_ma7_ratio", "close_ma24_ratio", "close_ma168_ratio",
    "macd", "macd_signal", "macd_hist", "rsi_14", "atr_14", "atr_ratio", "bb_width",
    "volume_ratio", "log_volume", "hl_spread", "oc_change",
    "close_lag_1h", "close_lag_2h", "close_lag_4h", "close_lag_12h", "close_lag_24h",
    "hour", "day_of_week", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos",
    "open", "high", "low", "close", "volume", "quote_volume", "trades",
)
KEYS = ["symbol"]
TIME = "open_time"
HORIZON = timedelta(hours=1)


Columns = dict[str, Column]


@dataclass(frozen=True)
class Indicator:
    """Named columns by step. Names that start with ``_`` are scratch and dropped at the end."""

    base: Columns = field(default_factory=dict)
    chained: Columns = field(default_factory=dict)
    final: Columns = field(default_factory=dict)


def apply(df: DataFrame, *indicators: Indicator) -> DataFrame:
    scratch: list[str] = []
    for step in ("base", "chained", "final"):
        columns: Columns = {}
        for indicator in indicators:
            columns.update(getattr(indicator, step))
        if columns:
            df = df.withColumns(columns)
            scratch += [name for name in columns if name.startswith("_")]
    return df.drop(*scratch)


def quotient(a: Column | str, b: Column | str, ieee: bool = False) -> Column:
    """``a / b`` of doubles. Division by zero gives NULL, or with ``ieee`` the infinity or NaN that SQL engines with
    IEEE arithmetic give."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    known = F.try_divide(a, b)
    return F.when(b == 0, a * F.pow(b, F.lit(-1.0))).otherwise(known) if ieee else known


def lags(w: SeriesWindow, steps=LAGS) -> Indicator:
    return Indicator(base={f"close_lag_{n}h": F.lag("close", n).over(w.ordered) for n in steps})


def returns(w: SeriesWindow, steps=RETURN_STEPS, ieee: bool = False) -> Indicator:
    past = {n: F.lag("close", n).over(w.ordered) for n in steps}
    return Indicator(base={f"return_{n}h": quotient("close", past[n], ieee) - 1 for n in steps})


def spreads() -> Indicator:
    return Indicator(
        final={"hl_spread": F.col("high") - F.col("low"), "oc_change": F.col("close") - F.col("open")}
    )


def averages(w: SeriesWindow, sizes=AVERAGES, ratios: bool = True, ieee: bool = False) -> Indicator:
    return Indicator(
        base={f"ma_{n}": F.avg("close").over(w.trailing(n)) for n in sizes},
        final={f"close_ma{n}_ratio": quotient("close", f"ma_{n}", ieee) for n in sizes} if ratios else {},
    )


def macd(w: SeriesWindow, fast: int = 12, slow: int = 26, signal: int = 9) -> Indicator:
    """Difference of two simple (not exponential) averages, its own trailing average, their gap."""
    mean = {n: F.avg("close").over(w.trailing(n)) for n in (fast, slow)}
    return Indicator(
        base={"macd": mean[fast] - mean[slow]},
        chained={"macd_signal": F.avg("macd").over(w.trailing(signal))},
        final={"macd_hist": F.col("macd") - F.col("macd_signal")},
    )


def rsi(w: SeriesWindow, size: int = 14) -> Indicator:
    """Simple-mean RSI; 100 when the frame has no loss. An unknown first change counts as zero."""
    move = F.coalesce(F.col("close") - F.lag("close", 1).over(w.ordered), F.lit(0.0))
    frame, zero = w.trailing(size), F.lit(0.0)
    strength = F.try_divide("_up", "_down")
    return Indicator(
        base={"_move": move},
        chained={
            "_up": F.avg(F.greatest(F.col("_move"), zero)).over(frame),
            "_down": F.avg(F.greatest(-F.col("_move"), zero)).over(frame),
        },
        final={
            f"rsi_{size}": F.when(F.col("_down") == 0, 100.0).otherwise(
                100.0 - F.try_divide(F.lit(100.0), 1 + strength)
            )
        },
    )


def atr(w: SeriesWindow, size: int = 14, ieee: bool = False) -> Indicator:
    """Average true range and its ratio to the close. Without a previous close the range is high-low."""
    before = F.lag("close", 1).over(w.ordered)
    span = F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)
    )
    return Indicator(
        base={"_range": span},
        chained={f"atr_{size}": F.avg("_range").over(w.trailing(size))},
        final={"atr_ratio": quotient(f"atr_{size}", "close", ieee)},
    )


def band_width(w: SeriesWindow, size: int = 20) -> Indicator:
    """Width of a band of two sample deviations either side of the mean, relative to the mean."""
    frame = w.trailing(size)
    width = F.try_divide(4 * F.stddev_samp("close").over(frame), F.avg("close").over(frame))
    return Indicator(base={"bb_width": width})


def volumes(w: SeriesWindow, size: int = 24) -> Indicator:
    usual = F.avg("volume").over(w.trailing(size))
    return Indicator(
        base={"volume_ratio": F.try_divide("volume", usual)}, final={"log_volume": F.log1p("volume")}
    )


def calendar(time: str = TIME) -> Indicator:
    """Hour, weekday (1 = Sunday) and both as points on a circle."""
    hour, weekday = F.hour(time), F.dayofweek(time)
    turn = {"hour": hour * (2 * math.pi) / 24, "weekday": weekday * (2 * math.pi) / 7}
    return Indicator(
        final={
            "hour": hour,
            "day_of_week": weekday,
            **{f"{k}_sin": F.sin(angle) for k, angle in turn.items()},
            **{f"{k}_cos": F.cos(angle) for k, angle in turn.items()},
        }
    )


def targets(w: SeriesWindow, horizon: timedelta = HORIZON, ieee: bool = False) -> Indicator:
    """Close at exactly ``horizon`` later and the return to it; NULL when that bar is missing."""
    return Indicator(
        base={"target_close_1h": w.at_offset("close", horizon)},
        final={"target_return_1h": quotient("target_close_1h", "close", ieee) - 1},
    )


# The longest look-back of the full set: the 168-row average. Chains reach less far (26 + 9, 14 + 1).
FULL_LOOKBACK = 168
FULL_PLAN = BlockPlan(lookback=FULL_LOOKBACK, ahead=HORIZON)


def basic_features(
    bars: DataFrame,
    sizes=AVERAGES,
    lag_steps=LAGS,
    keys: list[str] | None = None,
    plan: BlockPlan | None = FULL_PLAN,
    unique: bool = False,
    ieee: bool = False,
) -> DataFrame:
    """The small feature set: averages, lags, one return, spreads, hour, weekday, next-hour close.

    Repeated bars are reduced to one per (keys, open_time) first, unless ``unique`` says there are
    none (bars built by aggregation, or merged by key). ``ieee`` as in :func:`full_features`.
    """
    keys = KEYS if keys is None else keys
    reach = max([*sizes, *lag_steps, 1])
    if plan is not None and plan.lookback < reach:
        raise ValueError(f"these features look back {reach} rows, plan has {plan.lookback}")

    def build(df, w):
        when = Indicator(final={"hour": F.hour(TIME), "day_of_week": F.dayofweek(TIME)})
        target = Indicator(base={"target_close_1h": w.at_offset("close", HORIZON)})
        return apply(
            df, averages(w, sizes, ratios=False), lags(w, lag_steps), returns(w, (1,), ieee), spreads(), when, target
        )

    rows = bars if unique else one_per_key(bars, [*keys, TIME])
    return over_series(rows, keys, TIME, build, plan)


def full_features(
    bars: DataFrame, keys: list[str] | None = None, plan: BlockPlan | None = FULL_PLAN, ieee: bool = False
) -> DataFrame:
    """All indicator groups and both targets. ``bars`` must hold one row per (keys, open_time).

    Blocks are on by default, so one long series spreads over the cluster. Returns and ratios of a zero price are NULL,
    or with ``ieee`` infinite or NaN.
    """
    keys = KEYS if keys is None else keys
    if plan is not None and plan.lookback < FULL_LOOKBACK:
        raise ValueError(f"the full feature set looks back {FULL_LOOKBACK} rows, plan has {plan.lookback}")

    def build(df, w):
        groups = (lags, macd, rsi, band_width, volumes)
        by_price = (returns, averages, atr, targets)
        return apply(df, spreads(), calendar(), *[group(w) for group in groups], *[group(w, ieee=ieee) for group in by_price])

    return over_series(bars, keys, TIME, build, plan)


def features_since(
    bars: DataFrame, start, keys: list[str] | None = None, plan: BlockPlan | None = FULL_PLAN, ieee: bool = False
) -> DataFrame:
    """:func:`full_features` of the bars from ``start`` on, without computing the rest.

    Each series brings the rows its longest frame can reach before ``start``; chained frames reach
    less far, so the result equals the full computation filtered to ``start``.
    """
    keys = KEYS if keys is None else keys
    start = start if isinstance(start, Column) else F.lit(start)
    context = last_rows(bars.where(F.col(TIME) < start), keys, TIME, FULL_LOOKBACK)
    fresh = bars.where(F.col(TIME) >= start)
    return full_features(context.unionByName(fresh), keys, plan, ieee).where(F.col(TIME) >= start)


def _known(required) -> Column:
    known = F.lit(True)
    for name in required:
        known = known & F.col(name).isNotNull()
    return known


def drop_warmup(features: DataFrame, required=WARMUP_COLUMNS) -> DataFrame:
    """Rows whose look-back columns are all known; NaN is known. The longest needed lag decides: 24 rows per series."""
    return features.where(_known(required))


def warmup_report(features: DataFrame, required=WARMUP_COLUMNS) -> DataFrame:
    """Rows before, after and dropped, from one aggregate instead of two counts."""
    known = _known(required)
    return features.agg(
        F.count("*").alias("rows_before"),
        F.count_if(known).alias("rows_after"),
        (F.count("*") - F.count_if(known)).alias("rows_dropped"),
    )


def extra_features(
    bars: DataFrame, keys: list[str] | None = None, plan: BlockPlan | None = FULL_PLAN
) -> DataFrame:
    """Documented optional columns: 24-row volatility of returns and the log return to the next hour."""
    keys = KEYS if keys is None else keys

    def build(df, w):
        more = Indicator(
            chained={"volatility_24h": F.stddev_samp("return_1h").over(w.trailing(24))},
            final={"target_log_return_1h": F.ln(F.try_divide("target_close_1h", "close"))},
        )
        return apply(df, returns(w, (1,)), targets(w), more)

    return over_series(bars, keys, TIME, build, plan)

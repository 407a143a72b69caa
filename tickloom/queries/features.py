"""Bars, indicators, targets and the block-window variants."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tickloom.operators import indicators as ind
from tickloom.operators.bars import calendar_totals
from tickloom.operators.windows import BlockPlan, over_series, row_index
from tickloom.queries import base
from tickloom.queries.base import SQL_BARS, SQL_FEATURES, SQL_USER_BARS, query, rounded, sql_features, sql_rounded
from tickloom.session import checkpointed

BAR_COLUMNS = ["symbol", "open_time", "close_time", "open", "high", "low", "close", "volume", "quote_volume", "trades"]
_BAR_SQL = "symbol, open_time, close_time, trades, " + sql_rounded("open high low close volume quote_volume")


@query("bars_hourly", f"WITH {SQL_BARS} SELECT {_BAR_SQL} FROM bars")
def bars_hourly(spark, sf):
    return rounded(base.bars(spark, sf).select(*BAR_COLUMNS))


@query("bars_hourly_by_user", f"WITH {SQL_USER_BARS} SELECT {_BAR_SQL} FROM user_bars")
def bars_hourly_by_user(spark, sf):
    return rounded(base.user_bars(spark, sf).select(*BAR_COLUMNS))


@query(
    "volume_daily",
    f"""WITH {SQL_BARS} SELECT date_trunc('day', open_time)::TIMESTAMP AS bucket_date, {sql_rounded(['sum(volume)']).replace('AS sum(volume)', 'AS volume')},
    {sql_rounded(['sum(quote_volume)']).replace('AS sum(quote_volume)', 'AS quote_volume')}, count(*) AS bar_count FROM bars GROUP BY 1""",
)
def volume_daily(spark, sf):
    return rounded(calendar_totals(base.bars(spark, sf)))


def _indicator(name: str, columns: str, build, extra_where: str = ""):
    """Register one indicator group over the bars, all rows."""
    sql = f"WITH {SQL_BARS}, {sql_features()} SELECT symbol, open_time, {sql_rounded(columns)} FROM all_features {extra_where}"

    @query(name, sql)
    def run(spark, sf):
        out = over_series(base.bars(spark, sf), ind.KEYS, ind.TIME, build, ind.FULL_PLAN)
        return rounded(out.select("symbol", "open_time", *columns.split()))

    return run


_indicator("ind_lags_returns", "close_lag_1h close_lag_2h close_lag_4h close_lag_12h close_lag_24h return_1h return_6h return_24h", lambda df, w: ind.apply(df, ind.lags(w), ind.returns(w, ieee=True)))
_indicator("ind_averages", "ma_7 ma_24 ma_168 close_ma7_ratio close_ma24_ratio close_ma168_ratio", lambda df, w: ind.apply(df, ind.averages(w, ieee=True)))
_indicator("ind_spreads", "hl_spread oc_change", lambda df, w: ind.apply(df, ind.spreads()))
_indicator("ind_macd", "macd macd_signal macd_hist", lambda df, w: ind.apply(df, ind.macd(w)))
_indicator("ind_rsi", "rsi_14", lambda df, w: ind.apply(df, ind.rsi(w)))
_indicator("ind_atr", "atr_14 atr_ratio", lambda df, w: ind.apply(df, ind.atr(w, ieee=True)))
_indicator("ind_bollinger", "bb_width", lambda df, w: ind.apply(df, ind.band_width(w)))
_indicator("ind_volume", "volume_ratio log_volume", lambda df, w: ind.apply(df, ind.volumes(w)))
_indicator("targets_exact_horizon", "target_close_1h target_return_1h", lambda df, w: ind.apply(df, ind.targets(w, ieee=True)))


@query(
    "ind_cyclical",
    f"""WITH {SQL_BARS}, {sql_features()} SELECT symbol, open_time, hour, day_of_week,
    {sql_rounded('hour_sin hour_cos weekday_sin weekday_cos')} FROM all_features""",
)
def ind_cyclical(spark, sf):
    out = ind.apply(base.bars(spark, sf), ind.calendar())
    return rounded(out.select("symbol", "open_time", "hour", "day_of_week", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos"))


_BASIC = "ma_7 ma_24 ma_168 close_lag_1h close_lag_2h close_lag_4h close_lag_12h close_lag_24h return_1h hl_spread oc_change target_close_1h"


@query(
    "bars_features_target",
    f"WITH {SQL_BARS}, {sql_features()} SELECT symbol, open_time, hour, day_of_week, {sql_rounded('close ' + _BASIC)} FROM all_features",
)
def bars_features_target(spark, sf):
    """Flagship: ticks to bars to the basic feature set with the exact next-hour target."""
    out = ind.basic_features(base.bars(spark, sf), unique=True, ieee=True)
    return rounded(out.select("symbol", "open_time", "hour", "day_of_week", "close", *_BASIC.split()))


@query(
    "user_features_target",
    f"WITH {SQL_USER_BARS}, {sql_features('user_bars')} SELECT symbol, open_time, {sql_rounded('close ' + _BASIC)} FROM all_features",
)
def user_features_target(spark, sf):
    """The same over many sparse series."""
    out = ind.basic_features(base.user_bars(spark, sf), unique=True, ieee=True)
    return rounded(out.select("symbol", "open_time", "close", *_BASIC.split()))


FULL = (
    "close return_1h return_6h return_24h ma_7 ma_24 ma_168 close_ma7_ratio close_ma24_ratio close_ma168_ratio macd macd_signal "
    "macd_hist rsi_14 atr_14 atr_ratio bb_width volume_ratio log_volume hl_spread oc_change close_lag_1h close_lag_2h "
    "close_lag_4h close_lag_12h close_lag_24h hour_sin hour_cos weekday_sin weekday_cos target_close_1h target_return_1h"
)


@query("features_full_dropna", f"WITH {SQL_FEATURES} SELECT symbol, open_time, {sql_rounded(FULL)} FROM features")
def features_full_dropna(spark, sf):
    return rounded(base.features(spark, sf, ieee=True).select("symbol", "open_time", *FULL.split()))


@query("user_features_full", f"WITH {SQL_USER_BARS}, {sql_features('user_bars')}, {base.SQL_WARM} SELECT symbol, open_time, {sql_rounded(FULL)} FROM features")
def user_features_full(spark, sf):
    out = ind.drop_warmup(ind.full_features(base.user_bars(spark, sf), ieee=True))
    return rounded(out.select("symbol", "open_time", *FULL.split()))


@query("blocked_window_features", f"WITH {SQL_BARS}, {sql_features()} SELECT symbol, open_time, {sql_rounded(FULL)} FROM all_features")
def blocked_window_features(spark, sf):
    """Full features with blocks small enough that every series is cut several times."""
    plan = BlockPlan(ind.FULL_LOOKBACK, ind.HORIZON, bucket=timedelta(days=1), block_rows=200, split_above=0)
    return rounded(ind.full_features(base.bars(spark, sf), plan=plan, ieee=True).select("symbol", "open_time", *FULL.split()))


@query(
    "features_since",
    f"""WITH {SQL_BARS}, {sql_features()} SELECT symbol, open_time, {sql_rounded(FULL)} FROM all_features
    WHERE open_time >= (SELECT max(open_time) FROM bars) - INTERVAL 72 HOUR""",
)
def features_since(spark, sf):
    """Only the newest three days, as an hourly run computes them."""
    bars = checkpointed(base.bars(spark, sf))
    start = bars.agg(F.max("open_time")).scalar() - F.expr("INTERVAL 72 HOURS")
    return rounded(ind.features_since(bars, start, ieee=True).select("symbol", "open_time", *FULL.split()))


@query(
    "warmup_report",
    f"""WITH {SQL_FEATURES} SELECT (SELECT count(*) FROM all_features) AS rows_before, (SELECT count(*) FROM features) AS rows_after,
    (SELECT count(*) FROM all_features) - (SELECT count(*) FROM features) AS rows_dropped""",
)
def warmup_report(spark, sf):
    return ind.warmup_report(ind.full_features(base.bars(spark, sf), ieee=True))


@query(
    "features_optional",
    f"""WITH {SQL_BARS}, {sql_features()}, extra AS (SELECT symbol, open_time,
      stddev_samp(return_1h) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS volatility_24h,
      ln(target_close_1h / close) AS target_log_return_1h FROM all_features)
    SELECT symbol, open_time, {sql_rounded('volatility_24h target_log_return_1h')} FROM extra""",
)
def features_optional(spark, sf):
    out = ind.extra_features(base.bars(spark, sf))
    return rounded(out.select("symbol", "open_time", "volatility_24h", "target_log_return_1h"))


@query(
    "row_index_exact",
    f"WITH {SQL_BARS} SELECT symbol, open_time, row_number() OVER (ORDER BY open_time, symbol) - 1 AS row_idx FROM bars",
)
def row_index_exact(spark, sf):
    return row_index(base.bars(spark, sf).select("symbol", "open_time"), ["open_time", "symbol"])

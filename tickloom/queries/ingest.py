"""Parsing, incremental load, de-duplication, upsert and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.parse import interval_hours, parse_timestamp
from tickloom.operators.bars import closed_bars, newer_than
from tickloom.operators.dedup import duplicate_keys, latest_per_key, one_per_key
from tickloom.operators.upsert import grow_columns, keep_single_active, loaded_since, retain_recent, upsert
from tickloom.queries import base
from tickloom.queries.base import SQL_BARS, query, rounded, sql_rounded
from tickloom.sources.landing import parse_klines, parse_landing, to_landing_rows

_PRICES = "open high low close volume quote_volume"


def _ms(column: str):
    return F.unix_millis(F.col(column).cast("timestamp"))


def _ntz(column: str):
    return F.col(column).cast("timestamp_ntz")


@query("kline_parse", f"WITH {SQL_BARS} SELECT symbol, open_time, close_time, trades, {sql_rounded(_PRICES)} FROM bars")
def kline_parse(spark, sf):
    """Bars packed into positional JSON arrays (numbers as text) and read back."""
    quoted = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    cells = [
        _ms("open_time").cast("string"),
        *[quoted(c) for c in ("open", "high", "low", "close", "volume")],
        _ms("close_time").cast("string"),
        quoted("quote_volume"),
        F.col("trades").cast("string"),
    ]
    packed = base.bars(spark, sf).select("symbol", F.concat(F.lit("["), F.concat_ws(", ", *cells), F.lit("]")).alias("kline"))
    parsed = parse_klines(packed, keep=["symbol"])
    out = parsed.select("symbol", _ntz("open_time").alias("open_time"), _ntz("close_time").alias("close_time"), *_PRICES.split(), "trades")
    return rounded(out)


@query(
    "timestamp_multi_parse",
    """WITH spelled AS (SELECT event_id, CASE event_id % 5
        WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
        WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' WHEN 3 THEN strftime(ts, '%Y-%m-%d')
        ELSE 'not a time ' || event_id END AS text FROM events)
    SELECT event_id, text, coalesce(try_strptime(text, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(text, '%Y-%m-%d %H:%M:%S'),
        try_strptime(replace(text, '+00:00', ''), '%Y-%m-%dT%H:%M:%S'), try_strptime(text, '%Y-%m-%d')) AS parsed FROM spelled""",
)
def timestamp_multi_parse(spark, sf):
    events = base.table(spark, sf, "events")
    fmt = lambda pattern: F.date_format("ts", pattern)
    text = F.element_at(
        F.array(
            fmt("yyyy-MM-dd'T'HH:mm:ss'Z'"),
            fmt("yyyy-MM-dd HH:mm:ss"),
            F.concat(fmt("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")),
            fmt("yyyy-MM-dd"),
            F.concat(F.lit("not a time "), F.col("event_id").cast("string")),
        ),
        (F.col("event_id") % 5 + 1).cast("int"),
    )
    return events.select("event_id", text.alias("text")).withColumn("parsed", parse_timestamp("text").cast("timestamp_ntz"))


@query(
    "closed_bars",
    f"""WITH {SQL_BARS} SELECT symbol, open_time, close_time FROM bars WHERE close_time < (SELECT max(ts) FROM events)""",
)
def closed_bars_query(spark, sf):
    return closed_bars(base.bars(spark, sf), base.newest_event(spark, sf)).select("symbol", "open_time", "close_time")


# The first load ends at a different hour per series: bars of the first 400 hours, fewer for longer names.
_LOADED_SQL = "open_time < TIMESTAMP '2024-01-01' + to_hours(CAST(400 + 20 * length(symbol) AS INTEGER))"


def _loaded(df):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return df.where(F.col("open_time") < start + F.make_dt_interval(hours=(400 + 20 * F.length("symbol")).cast("int")))


@query(
    "hwm_increment",
    f"""WITH {SQL_BARS}, marks AS (SELECT symbol, max(open_time) AS hw FROM bars WHERE {_LOADED_SQL} GROUP BY 1)
    SELECT b.symbol, b.open_time, {sql_rounded('close', 'b.')} FROM bars b LEFT JOIN marks m ON m.symbol = b.symbol
    WHERE m.hw IS NULL OR b.open_time >= m.hw + INTERVAL 1 MILLISECOND""",
)
def hwm_increment(spark, sf):
    bars = base.bars(spark, sf)
    return rounded(newer_than(bars, _loaded(bars)).select("symbol", "open_time", "close"))


# Two overlapping loads of the bars: the later one corrects hours divisible by 3.
_LOADS_SQL = f"""{SQL_BARS}, loads AS (
  SELECT symbol, open_time, close, trades, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at, 'a.csv' AS source_file FROM bars
  UNION ALL SELECT symbol, open_time, close + 1, trades, TIMESTAMP '2024-02-01 01:00:00', 'b.csv' FROM bars WHERE hour(open_time) % 3 = 0
  UNION ALL SELECT symbol, open_time, close + 2, trades, TIMESTAMP '2024-02-01 01:00:00', 'c.csv' FROM bars WHERE hour(open_time) % 6 = 0)"""


def _loads(spark, sf):
    bars = base.bars(spark, sf).select("symbol", "open_time", "close", "trades")
    copies = F.array_compact(
        F.array(
            F.struct(F.lit(0.0).alias("add"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"), F.lit("a.csv").alias("source_file")),
            *[
                F.when(
                    F.hour("open_time") % every == 0,
                    F.struct(F.lit(add).alias("add"), F.lit("2024-02-01 01:00:00").cast("timestamp_ntz").alias("loaded_at"), F.lit(name).alias("source_file")),
                )
                for every, add, name in ((3, 1.0, "b.csv"), (6, 2.0, "c.csv"))
            ],
        )
    )
    return bars.select("*", F.inline(copies)).select("symbol", "open_time", (F.col("close") + F.col("add")).alias("close"), "trades", "loaded_at", "source_file")


@query(
    "dedup_latest",
    f"""WITH {_LOADS_SQL} SELECT symbol, open_time, {sql_rounded('close')}, trades, loaded_at, source_file FROM loads
    QUALIFY row_number() OVER (PARTITION BY symbol, open_time ORDER BY loaded_at DESC, source_file DESC) = 1""",
)
def dedup_latest(spark, sf):
    return rounded(latest_per_key(_loads(spark, sf), ["symbol", "open_time"], ["loaded_at", "source_file"]))


@query(
    "dedup_any",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""",
)
def dedup_any(spark, sf):
    """Any-row de-duplication of a table whose key repeats; made repeatable by content order."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return one_per_key(base.table(spark, sf, "lineitem").select(*columns), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys_query(spark, sf):
    return duplicate_keys(base.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "upsert_bars",
    f"""WITH {SQL_BARS}, target AS (SELECT symbol, open_time, close FROM bars WHERE {_LOADED_SQL}),
    source AS (SELECT symbol, open_time, close + 1 AS close, trades FROM bars WHERE NOT ({_LOADED_SQL}) OR hour(open_time) % 3 = 0)
    SELECT symbol, open_time, {sql_rounded('close')}, trades FROM source
    UNION ALL SELECT symbol, open_time, {sql_rounded('close')}, NULL FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.symbol IS NOT DISTINCT FROM t.symbol AND s.open_time IS NOT DISTINCT FROM t.open_time)""",
)
def upsert_bars(spark, sf):
    """Merge with a source that also brings a new column."""
    bars = base.bars(spark, sf).select("symbol", "open_time", "close", "trades")
    target = _loaded(bars).select("symbol", "open_time", "close")
    late = bars.join(_loaded(bars).select("symbol", "open_time"), ["symbol", "open_time"], "left_anti")
    fixed = _loaded(bars).where(F.hour("open_time") % 3 == 0)
    source = late.unionByName(fixed).withColumn("close", F.col("close") + 1)
    return rounded(upsert(grow_columns(target, source), source, ["symbol", "open_time"]))


_KEY_SQL = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END"


@query(
    "upsert_null_keys",
    f"""WITH target AS (SELECT l_orderkey AS k1, {_KEY_SQL} AS k2, max(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2),
    source AS (SELECT l_orderkey AS k1, {_KEY_SQL} AS k2, max(l_quantity) + 100 AS q FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2)
    SELECT k1, k2, q FROM source UNION ALL
    SELECT k1, k2, q FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.k1 = t.k1 AND s.k2 IS NOT DISTINCT FROM t.k2)""",
)
def upsert_null_keys(spark, sf):
    """Open lines merged over closed ones; the second key part may be NULL and then matches NULL."""
    part = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber"))
    lines = base.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k1"), part.alias("k2"), "l_quantity", "l_returnflag")
    held = lines.where(F.col("l_returnflag") != "N").groupBy("k1", "k2").agg(F.max("l_quantity").alias("q"))
    new = lines.where(F.col("l_returnflag") == "N").groupBy("k1", "k2").agg((F.max("l_quantity") + 100).alias("q"))
    return upsert(held, new, ["k1", "k2"], null_safe=["k2"])


@query(
    "config_single_active",
    """WITH configs AS (SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'selected_features' ELSE 'other' END AS config_key,
        CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey END AS config_id, o_orderkey AS config_version, o_orderstatus <> 'P' AS is_active FROM orders),
    last AS (SELECT max(config_version) AS v FROM configs WHERE config_key = 'selected_features')
    SELECT config_key, config_id, config_version,
      CASE WHEN config_key = 'selected_features' AND is_active AND coalesce(config_id, config_version) <> (SELECT v FROM last) THEN false ELSE is_active END AS is_active
    FROM configs""",
)
def config_single_active(spark, sf):
    """Deactivate every older active row of one config key."""
    configs = base.table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority").startswith("1"), "selected_features").otherwise("other").alias("config_key"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey")).alias("config_id"),
        F.col("o_orderkey").alias("config_version"),
        (F.col("o_orderstatus") != "P").alias("is_active"),
    )
    newest = configs.where(F.col("config_key") == "selected_features").agg(F.max("config_version")).scalar()
    return keep_single_active(configs, newest)


@query("retention_filter", "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR")
def retention_filter(spark, sf):
    return retain_recent(base.table(spark, sf, "events").select("event_id", "ts"), base.newest_event(spark, sf), 48, "ts")


@query("batch_slice", "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR")
def batch_slice(spark, sf):
    run_start = base.newest_event(spark, sf) - F.expr("INTERVAL 6 HOURS")
    return loaded_since(base.table(spark, sf, "events").select("event_id", "ts"), run_start, "ts")


@query(
    "interval_hours",
    f"""SELECT event_id, CASE WHEN event_id % 7 = 6 THEN NULL ELSE {base.sql_r6('''(event_id % 5) * 168.0 + (user_id % 30) * 24.0
      + (event_id % 24) + (event_id % 60) / 60.0 + (user_id % 60) / 3600.0''')} END AS hours FROM events""",
)
def interval_hours_query(spark, sf):
    """Interval texts spelled from event columns; every seventh has a part that cannot be read."""
    part = lambda n, unit: F.concat(n.cast("string"), F.lit(f" {unit}"))
    e, u = F.col("event_id"), F.col("user_id")
    text = F.concat(
        F.lit("Interval "),
        F.concat_ws(" ", part(e % 5, "weeks"), part(u % 30, "day"), part(e % 24, "hours"), part(e % 60, "minute"), part(u % 60, "seconds")),
        F.when(e % 7 == 6, " 1 fortnight").otherwise(""),
    )
    return rounded(base.table(spark, sf, "events").select("event_id", interval_hours(text).alias("hours")))


@query(
    "landing_round_trip",
    f"""WITH {SQL_BARS} SELECT symbol, open_time, close_time, {sql_rounded(_PRICES)}, trades, 'events' AS source, '1h' AS interval FROM bars""",
)
def landing_round_trip(spark, sf):
    """Bars to landing text rows and back through the parser, without defaults being needed."""
    rows = to_landing_rows(base.bars(spark, sf).withColumn("fetched_at", F.col("open_time")))
    parsed = parse_landing(rows)
    out = parsed.select("symbol", _ntz("open_time").alias("open_time"), _ntz("close_time").alias("close_time"), *_PRICES.split(), "trades", "source", "interval")
    return rounded(out)

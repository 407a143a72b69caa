"""Validation, profiles and freshness."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import quality as q
from tickloom.queries import base
from tickloom.queries.base import SQL_BARS, query, rounded, sql_r6, sql_rounded

# Bars with faults chosen by trades and hour.
_FAULTY_SQL = f"""{SQL_BARS}, faulty AS (
  SELECT CASE WHEN trades % 11 = 5 THEN NULL ELSE symbol END AS symbol, open_time,
         CASE WHEN trades % 7 = 2 THEN NULL ELSE open END AS open,
         CASE WHEN hour(open_time) = 3 THEN close - 1 ELSE high END AS high, low, close,
         CASE WHEN hour(open_time) = 5 THEN -volume ELSE volume END AS volume, quote_volume, trades,
         CASE WHEN hour(open_time) = 7 THEN open_time - INTERVAL 1 HOUR WHEN hour(open_time) = 8 THEN NULL ELSE close_time END AS close_time,
         '1h' AS interval, open_time AS fetched_at
  FROM bars)"""


def faulty(spark, sf):
    hour = F.hour("open_time")
    return base.bars(spark, sf).select(
        F.when(F.col("trades") % 11 != 5, F.col("symbol")).alias("symbol"),
        "open_time",
        F.when(F.col("trades") % 7 != 2, F.col("open")).alias("open"),
        F.when(hour == 3, F.col("close") - 1).otherwise(F.col("high")).alias("high"),
        "low",
        "close",
        F.when(hour == 5, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
        "quote_volume",
        "trades",
        F.when(hour == 7, F.col("open_time") - F.expr("INTERVAL 1 HOUR")).when(hour != 8, F.col("close_time")).alias("close_time"),
        "interval",
        F.col("open_time").alias("fetched_at"),
    )


_RULES_SQL = {
    "close_time_missing": "close_time IS NULL",
    "close_time_not_after_open_time": "close_time <= open_time",
    "non_positive_open": "open <= 0", "non_positive_high": "high <= 0", "non_positive_low": "low <= 0", "non_positive_close": "close <= 0",
    "high_below_others": "high < greatest(open, low, close)",
    "low_above_others": "low > least(open, high, close)",
    "negative_volume": "volume < 0", "negative_quote_volume": "quote_volume < 0", "negative_trades": "trades < 0",
    "symbol_missing": "symbol IS NULL", "interval_missing": "interval IS NULL", "fetched_at_missing": "fetched_at IS NULL",
}
_NAMES_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _RULES_SQL.items()) + ")"


@query("validate_rules", f"WITH {_FAULTY_SQL} SELECT symbol, open_time, {sql_rounded('close')}, {_NAMES_SQL} AS broken_rules FROM faulty")
def validate_rules(spark, sf):
    out = q.mark_broken(faulty(spark, sf))
    return rounded(out.select("symbol", "open_time", "close", F.concat_ws(",", "broken_rules").alias("broken_rules")))


_STRICT_SQL = {**_RULES_SQL, **{f"null_{p}": f"{p} IS NULL" for p in ("open", "high", "low", "close")}}


@query(
    "validate_summary",
    f"""WITH {_FAULTY_SQL} SELECT count(*) AS row_count, count(*) FILTER (open_time IS NULL) AS null_open_time_count,
    count(*) FILTER ({' OR '.join(f'coalesce({c}, false)' for c in _STRICT_SQL.values())}) AS invalid_count,
    {', '.join(f'count(*) FILTER ({c}) AS {n}' for n, c in _STRICT_SQL.items())} FROM faulty""",
)
def validate_summary(spark, sf):
    """All counts of the strict rule set in one pass."""
    return q.batch_summary(faulty(spark, sf), strict=True)


@query(
    "validate_split",
    f"""WITH {_FAULTY_SQL} SELECT symbol, open_time, {sql_rounded('close')} FROM faulty
    WHERE NOT ({' OR '.join(f'coalesce({c}, false)' for c in _RULES_SQL.values())})""",
)
def validate_split(spark, sf):
    good, _ = q.split_valid(faulty(spark, sf))
    return rounded(good.select("symbol", "open_time", "close"))


_BATCH_SQL = {
    "close_time_not_after_open_time": "close_time <= open_time",
    "non_positive_price": "least(open, high, low, close) <= 0",
    "high_below_ohlc": "high < greatest(open, low, close)",
    "low_above_ohlc": "low > least(open, high, close)",
    "negative_volume_or_trades": "volume < 0 OR quote_volume < 0 OR trades < 0",
}


@query(
    "validate_batch_errors",
    f"""WITH {_FAULTY_SQL}, batch AS (SELECT * EXCLUDE (symbol), coalesce(symbol, 'unknown') AS symbol FROM faulty
      UNION ALL SELECT * EXCLUDE (symbol), coalesce(symbol, 'unknown') FROM faulty WHERE hour(open_time) = 9),
    marked AS (SELECT *, open_time IS NULL OR close_time IS NULL OR open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL
      OR volume IS NULL OR quote_volume IS NULL OR trades IS NULL AS unparsed FROM batch)
    SELECT symbol, open_time, 'parse_error' AS error, 0::BIGINT AS surplus FROM marked WHERE unparsed
    {' '.join(f"UNION ALL SELECT symbol, open_time, '{n}', 0 FROM marked WHERE NOT unparsed AND ({c})" for n, c in _BATCH_SQL.items())}
    UNION ALL SELECT symbol, open_time, 'duplicate_open_time', count(*) - 1 FROM marked WHERE NOT unparsed GROUP BY 1, 2 HAVING count(*) > 1""",
)
def validate_batch_errors(spark, sf):
    """A fetched batch with faults and repeated hours."""
    rows = faulty(spark, sf).withColumn("symbol", F.coalesce("symbol", F.lit("unknown")))
    copies = F.when(F.hour("open_time") == 9, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return q.batch_errors(rows.select("*", F.explode(copies).alias("_copy")).drop("_copy"), ["symbol", "open_time"])


_DOCS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query(
    "missing_ratio",
    f"""WITH joined AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
    counts AS (SELECT count(*) AS n, {', '.join(f'count(*) - count({c}) AS "{c}"' for c in _DOCS)} FROM joined),
    long AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, \"{c}\" / n AS null_ratio FROM counts" for c in _DOCS)})
    SELECT col AS "column", {sql_r6('null_ratio', 'null_ratio')}, true AS alert FROM long WHERE null_ratio > 0.05""",
)
def missing_ratio(spark, sf):
    docs = base.table(spark, sf, "documents").join(base.table(spark, sf, "labels"), "doc_id", "left")
    return rounded(q.missing_ratio(docs.select(*_DOCS)))


_FEATS = ["close", "ma_168", "return_24h", "target_close_1h", "volume"]


@query(
    "null_counts",
    f"""WITH {base.SQL_BARS}, {base.sql_features()} {' UNION ALL '.join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, count(*) AS row_count FROM all_features" for c in _FEATS)}""",
)
def null_counts(spark, sf):
    from tickloom.operators.indicators import full_features

    return q.null_counts(full_features(base.bars(spark, sf)), _FEATS)


@query(
    "freshness",
    f"""WITH {SQL_BARS} SELECT max(open_time) AS latest,
      {sql_r6("(epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(open_time))) / 3600000000.0", 'age_hours')},
      CASE WHEN max(open_time) IS NULL THEN 'no_data' WHEN (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(open_time))) / 3600000000.0 <= 2 THEN 'fresh' ELSE 'stale' END AS status,
      NOT coalesce((epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(open_time))) / 3600000000.0 <= 2, false) AS alert FROM bars""",
)
def freshness(spark, sf):
    return rounded(q.freshness(base.bars(spark, sf), base.newest_event(spark, sf)))


_SUMMARY = ["close", "volume", "return_1h", "rsi_14", "target_return_1h"]
_STATS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {sql_r6(f'avg({c})', 'mean')}, {sql_r6(f'stddev_samp({c})', 'std')}, {sql_r6(f'min({c})', 'min')},
    {sql_r6(f'quantile_disc({c}, 0.25)', 'p25')}, {sql_r6(f'quantile_disc({c}, 0.5)', 'p50')}, {sql_r6(f'quantile_disc({c}, 0.75)', 'p75')}, {sql_r6(f'max({c})', 'max')},
    count(*) - count({c}) AS null_count, {sql_r6(f'round((count(*) - count({c})) * 100.0 / count(*), 2)', 'null_pct')} FROM features"""
    for c in _SUMMARY
)


@query("column_summary", f"WITH {base.SQL_FEATURES} {_STATS_SQL}")
def column_summary(spark, sf):
    return rounded(q.column_summary(base.features(spark, sf), _SUMMARY))


@query(
    "histogram",
    f"""WITH {SQL_BARS}, ends AS (SELECT min(close) AS lo, max(close) AS hi FROM bars),
    placed AS (SELECT CAST(least(floor((close - lo) * 50 / (hi - lo)), 49) AS BIGINT) AS bin FROM bars, ends),
    counts AS (SELECT bin, count(*) AS n FROM placed GROUP BY 1)
    SELECT r.bin, {sql_r6('lo + r.bin * ((hi - lo) / 50)', 'bin_start')}, {sql_r6('lo + (r.bin + 1) * ((hi - lo) / 50)', 'bin_end')}, coalesce(n, 0) AS row_count
    FROM (SELECT unnest(range(50)) AS bin) r LEFT JOIN counts USING (bin), ends""",
)
def histogram(spark, sf):
    return rounded(q.histogram(base.bars(spark, sf), "close", 50))


@query(
    "document_length_histogram",
    """WITH ends AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents),
    placed AS (SELECT CAST(least(floor((n_chars - lo)::DOUBLE * 20 / (hi - lo)), 19) AS BIGINT) AS bin FROM documents, ends),
    counts AS (SELECT bin, count(*) AS n FROM placed GROUP BY 1)
    SELECT r.bin, coalesce(n, 0) AS row_count FROM (SELECT unnest(range(20)) AS bin) r LEFT JOIN counts USING (bin)""",
)
def document_length_histogram(spark, sf):
    return q.histogram(base.table(spark, sf, "documents"), "n_chars", 20).select("bin", "row_count")


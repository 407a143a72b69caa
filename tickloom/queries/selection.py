"""Correlation, mutual information, ranking, pruning and the selection config."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tickloom.operators import stats
from tickloom.operators.govern import selection_config
from tickloom.operators.quality import existing_columns
from tickloom.queries import base
from tickloom.queries.base import SQL_FEATURES, query, rounded, sql_r6

COLUMNS = ["return_1h", "return_6h", "ma_7", "ma_24", "close_ma7_ratio", "macd", "macd_hist", "rsi_14", "atr_14", "bb_width", "volume_ratio", "close", "close_lag_1h"]
TARGET = "target_return_1h"
PAIR_LIMIT, MI_LIMIT = 0.5, 0.011

_COMPLETE = f"""{SQL_FEATURES}, complete AS (SELECT {', '.join(COLUMNS)}, {TARGET} FROM features
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*COLUMNS, TARGET])})"""
_PAIRS = "pairs AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS correlation FROM complete" for a, b in combinations(COLUMNS, 2)
) + ")"


def complete(spark, sf):
    rows = base.stored_features(spark, sf)
    return rows.select(*existing_columns(rows, [*COLUMNS, TARGET])).dropna()


@query(
    "corr_pairs",
    f"""WITH {_COMPLETE}, {_PAIRS} SELECT feature_1, feature_2, {sql_r6('correlation', 'correlation')}, {sql_r6('abs(correlation)', 'abs_correlation')}
    FROM pairs WHERE abs(correlation) >= {PAIR_LIMIT}""",
)
def corr_pairs(spark, sf):
    return rounded(stats.correlation_pairs(complete(spark, sf), COLUMNS, PAIR_LIMIT))


_DECILES = ", ".join(str(i / 10) for i in range(1, 10))


def _bucket(value: str, cuts: str) -> str:
    return f"len(list_filter({cuts}, lambda c: c < {value}))"


_MI = f"""long AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS x, {TARGET} AS y FROM complete" for c in COLUMNS)}),
ycuts AS (SELECT quantile_disc({TARGET}, [{_DECILES}]) AS yc FROM complete),
xcuts AS (SELECT feature, quantile_disc(x, [{_DECILES}]) AS xc FROM long GROUP BY 1),
joint AS (SELECT l.feature, {_bucket('x', 'xc')} AS bx, {_bucket('y', 'yc')} AS b_y, count(*) AS n FROM long l JOIN xcuts USING (feature), ycuts GROUP BY 1, 2, 3),
parts AS (SELECT *, sum(n) OVER (PARTITION BY feature)::DOUBLE AS t, sum(n) OVER (PARTITION BY feature, bx)::DOUBLE AS nx, sum(n) OVER (PARTITION BY feature, b_y)::DOUBLE AS ny FROM joint),
mi AS (SELECT feature, sum(n / t * ln(n * t / (nx * ny))) AS mi FROM parts GROUP BY 1)"""


@query("mutual_info", f"WITH {_COMPLETE}, {_MI} SELECT feature, {sql_r6('mi', 'mi')} FROM mi")
def mutual_info(spark, sf):
    return rounded(stats.mutual_information(complete(spark, sf), COLUMNS, TARGET))


# A deterministic stand-in for model importance: absolute correlation with the target, at 3 decimals so that ties occur.
_IMPORTANCE = "importance AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, floor(abs(corr({c}, {TARGET})) * 100 + 0.500123) / 100 AS importance FROM complete" for c in COLUMNS
) + ")"
_RANK = f"""{_COMPLETE}, {_MI}, {_IMPORTANCE}, ranking AS (
  SELECT feature, mi, importance,
    rank() OVER (ORDER BY mi DESC) + (count(*) OVER (PARTITION BY mi) - 1) / 2.0 AS rank_mi,
    rank() OVER (ORDER BY importance DESC) + (count(*) OVER (PARTITION BY importance) - 1) / 2.0 AS rank_importance
  FROM mi LEFT JOIN importance USING (feature))"""


def _importance(rows):
    cells = [
        F.struct(F.lit(c).alias("feature"), (F.floor(F.abs(F.corr(c, TARGET)) * 100 + 0.500123) / 100.0).alias("importance")) for c in COLUMNS
    ]
    return rows.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _ranking(rows):
    return stats.rank_features(stats.mutual_information(rows, COLUMNS, TARGET), _importance(rows))


@query(
    "feature_rank",
    f"""WITH {_RANK} SELECT feature, {sql_r6('mi', 'mi')}, {sql_r6('importance', 'importance')}, {sql_r6('rank_mi', 'rank_mi')},
    {sql_r6('rank_importance', 'rank_importance')}, {sql_r6('(rank_mi + rank_importance) / 2', 'avg_rank')} FROM ranking""",
)
def feature_rank(spark, sf):
    return rounded(_ranking(complete(spark, sf)))


# The greedy rule over pairs in descending correlation, as a recursive walk over the numbered pairs.
_PRUNE = f"""{_RANK}, {_PAIRS}, numbered AS (
  SELECT row_number() OVER (ORDER BY abs(correlation) DESC, feature_1, feature_2) AS n, feature_1, feature_2,
    CASE WHEN r1.rank_mi + r1.rank_importance <= r2.rank_mi + r2.rank_importance THEN feature_2 ELSE feature_1 END AS loser
  FROM pairs JOIN ranking r1 ON r1.feature = feature_1 JOIN ranking r2 ON r2.feature = feature_2 WHERE abs(correlation) >= {PAIR_LIMIT}),
walk AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS dropped
  UNION ALL SELECT p.n, CASE WHEN list_contains(w.dropped, p.feature_1) OR list_contains(w.dropped, p.feature_2) THEN w.dropped ELSE list_append(w.dropped, p.loser) END
  FROM walk w JOIN numbered p ON p.n = w.n + 1),
dropped AS (SELECT dropped FROM walk ORDER BY n DESC LIMIT 1),
decided AS (SELECT feature, CASE WHEN list_contains((SELECT dropped FROM dropped), feature) THEN 'collinear' WHEN mi < {MI_LIMIT} THEN 'low_mi' ELSE 'keep' END AS decision FROM ranking)"""


def _decided(rows):
    pairs = stats.correlation_pairs(rows, COLUMNS)
    # One row per column, read three times.
    ranking = base.checkpointed(_ranking(rows))
    return stats.select_features(ranking, pairs, PAIR_LIMIT, MI_LIMIT), pairs


@query("feature_prune", f"WITH RECURSIVE {_PRUNE} SELECT feature, decision FROM decided")
def feature_prune(spark, sf):
    return _decided(complete(spark, sf))[0].select("feature", "decision")


@query(
    "selection_config_row",
    f"""WITH RECURSIVE {_PRUNE} SELECT 'selected_features' AS config_key, CAST(17 AS BIGINT) AS config_id, true AS is_active, count(*) FILTER (decision = 'keep') AS n_features,
    '["' || string_agg(feature, '","' ORDER BY list_position({COLUMNS}, feature)) FILTER (decision = 'keep') || '"]' AS config_value,
    '["' || string_agg(feature, '","' ORDER BY feature) FILTER (decision <> 'keep') || '"]' AS dropped_features_json,
    '["' || string_agg(feature, '","' ORDER BY list_position({COLUMNS}, feature)) || '"]' AS candidate_features_json FROM decided""",
)
def selection_config_row(spark, sf):
    decided, pairs = _decided(complete(spark, sf))
    row = selection_config(decided, 17, "2024-02-01T00:00:00", "features", 3, TARGET, PAIR_LIMIT, MI_LIMIT, pairs, COLUMNS)
    return row.select("config_key", "config_id", "is_active", "n_features", "config_value", "dropped_features_json", "candidate_features_json")

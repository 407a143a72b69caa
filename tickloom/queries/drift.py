"""Cut points, PSI, KS, null rates and the long drift metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import drift as d
from tickloom.operators.quantiles import exact_cuts
from tickloom.plans import monitor
from tickloom.queries import base
from tickloom.queries.base import SQL_FEATURES, SQL_PREDICTIONS, query, rounded, sql_r6
from tickloom.session import checkpointed

COLUMNS = ["volume", "quote_volume", "trades", "return_1h", "close", "ma_24", "target_close_1h"]
# The data spans 30 days: 168 recent hours against the 500 before them.
RECENT, REFERENCE = 168, 500

_WINDOWS = f"""windows AS (
  SELECT *, open_time > (SELECT max(open_time) FROM features) - INTERVAL {RECENT} HOUR AS is_recent FROM features
  WHERE open_time > (SELECT max(open_time) FROM features) - INTERVAL {RECENT + REFERENCE} HOUR)"""


def sql_drift(columns, windows: str = "windows") -> str:
    """CTEs ending in ``drift`` (feature, n_reference, n_recent, psi, ks)."""
    deciles = ", ".join(f"{i / 10}" for i in range(1, 10))
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, is_recent FROM {windows} WHERE {c} IS NOT NULL" for c in columns
    )
    return f"""long AS ({long}),
cuts AS (SELECT feature, quantile_disc(value, [{deciles}]) AS cuts FROM long WHERE NOT is_recent GROUP BY 1),
placed AS (SELECT l.feature, is_recent, len(list_filter(cuts, lambda c: c < value)) AS bucket FROM long l JOIN cuts c ON c.feature = l.feature),
sizes AS (SELECT feature, count(*) FILTER (NOT is_recent) AS n_ref, count(*) FILTER (is_recent) AS n_rec FROM placed GROUP BY 1),
grid AS (SELECT feature, unnest(range(10)) AS bucket, n_ref, n_rec FROM sizes),
shares AS (
  SELECT g.feature, g.bucket, any_value(n_ref) AS n_ref, any_value(n_rec) AS n_rec,
         count(*) FILTER (NOT is_recent) / any_value(n_ref) AS ref_share, count(*) FILTER (is_recent) / any_value(n_rec) AS rec_share
  FROM grid g LEFT JOIN placed p ON p.feature = g.feature AND p.bucket = g.bucket GROUP BY 1, 2),
running AS (SELECT *, abs(sum(ref_share - rec_share) OVER (PARTITION BY feature ORDER BY bucket)) AS gap FROM shares),
drift AS (
  SELECT feature, any_value(n_ref) AS n_reference, any_value(n_rec) AS n_recent,
         sum((greatest(rec_share, 1e-6) - greatest(ref_share, 1e-6)) * ln(greatest(rec_share, 1e-6) / greatest(ref_share, 1e-6))) AS psi,
         max(gap) FILTER (bucket < 9) AS ks
  FROM running GROUP BY 1)"""


_DRIFT = f"{SQL_FEATURES}, {_WINDOWS}, {sql_drift(COLUMNS)}"


def windows(spark, sf):
    return d.label_windows(base.stored_features(spark, sf), "open_time", RECENT, REFERENCE)


@query("quantile_cuts", f"WITH {_DRIFT} SELECT feature, position, {sql_r6('cuts[position]', 'cut')} FROM cuts, (SELECT unnest(range(1, 10)) AS position)")
def quantile_cuts(spark, sf):
    cuts = d.cut_points(windows(spark, sf).where(~F.col("is_recent")), COLUMNS)
    return rounded(cuts.select("feature", F.posexplode("cuts")).select("feature", (F.col("pos") + 1).cast("bigint").alias("position"), F.col("col").alias("cut")))


@query("psi", f"WITH {_DRIFT} SELECT feature, n_reference, n_recent, {sql_r6('psi', 'psi')} FROM drift")
def psi(spark, sf):
    return rounded(d.drift_scores(windows(spark, sf), COLUMNS).select("feature", "n_reference", "n_recent", "psi"))


@query("ks_deciles", f"WITH {_DRIFT} SELECT feature, {sql_r6('ks', 'ks')} FROM drift")
def ks_deciles(spark, sf):
    return rounded(d.drift_scores(windows(spark, sf), COLUMNS).select("feature", "ks"))


@query(
    "null_rate_recent",
    f"WITH {SQL_FEATURES}, {_WINDOWS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {sql_r6(f'(count(*) - count({c})) / count(*)', 'null_rate')} FROM windows WHERE is_recent" for c in COLUMNS
    ),
)
def null_rate_recent(spark, sf):
    return rounded(d.recent_null_rates(windows(spark, sf), COLUMNS))


def _status(value: str, warn: float, alert: float) -> str:
    return f"CASE WHEN {value} IS NULL THEN 'warn' WHEN {value} >= {alert} THEN 'alert' WHEN {value} >= {warn} THEN 'warn' ELSE 'ok' END"


_ALERTING = "'volume', 'quote_volume', 'trades', 'return_1h'"


@query(
    "drift_metrics_long",
    f"""WITH {_DRIFT}, rates AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, (count(*) - count({c})) / count(*) AS v FROM windows WHERE is_recent" for c in COLUMNS[:4])}),
    rows AS (
      SELECT 'drift_recent_feature_count' AS metric_name, (SELECT count(*) FROM windows WHERE is_recent)::DOUBLE AS v, 'ok' AS status
      UNION ALL SELECT 'drift_reference_feature_count', (SELECT count(*) FROM windows WHERE NOT is_recent), 'ok'
      UNION ALL SELECT 'schema_drift_missing_spread_ratio', 1, 'alert'
      UNION ALL SELECT 'feature_quality_null_rate_' || feature, v, {_status('v', 0.05, 0.2)} FROM rates
      UNION ALL SELECT 'data_drift_psi_' || feature, psi, {_status('psi', 0.25, 1.0)} FROM drift WHERE feature IN ({_ALERTING})
      UNION ALL SELECT 'data_drift_ks_' || feature, ks, {_status('ks', 0.30, 0.60)} FROM drift WHERE feature IN ({_ALERTING})
      UNION ALL SELECT CASE WHEN feature = 'target_close_1h' THEN 'label_drift' ELSE 'price_level_drift' END || '_psi_' || feature, psi, {_status('psi', 0.25, 999)} FROM drift WHERE feature NOT IN ({_ALERTING})
      UNION ALL SELECT CASE WHEN feature = 'target_close_1h' THEN 'label_drift' ELSE 'price_level_drift' END || '_ks_' || feature, ks, {_status('ks', 0.30, 999)} FROM drift WHERE feature NOT IN ({_ALERTING}))
    SELECT metric_name, {sql_r6('v', 'metric_value')}, status FROM rows""",
)
def drift_metrics_long(spark, sf):
    """The whole drift metric set, one requested column of which does not exist."""
    out = monitor.feature_drift_metrics(
        base.stored_features(spark, sf), base.newest_event(spark, sf), columns=(*monitor.DRIFT_FEATURES, "spread_ratio"),
        recent_hours=RECENT, reference_hours=REFERENCE,
    )
    return rounded(out.select("metric_name", "metric_value", "status"))


_PRED_WINDOWS = f"""windows AS (
  SELECT *, prediction_time > (SELECT max(prediction_time) FROM predictions) - INTERVAL {RECENT} HOUR AS is_recent FROM predictions
  WHERE prediction_time > (SELECT max(prediction_time) FROM predictions) - INTERVAL {RECENT + REFERENCE} HOUR)"""


@query(
    "prediction_drift",
    f"""WITH {SQL_PREDICTIONS}, {_PRED_WINDOWS}, {sql_drift(['predicted_close'])}
    SELECT 'prediction_drift_psi_predicted_close' AS metric_name, {sql_r6('psi', 'metric_value')}, {_status('psi', 0.25, 999)} AS status FROM drift
    UNION ALL SELECT 'prediction_drift_ks_predicted_close', {sql_r6('ks')}, {_status('ks', 0.30, 999)} FROM drift""",
)
def prediction_drift(spark, sf):
    predictions = checkpointed(base.predictions(spark, sf))
    out = monitor.prediction_drift_metrics(predictions, base.newest_event(spark, sf), RECENT, REFERENCE)
    return rounded(out.select("metric_name", "metric_value", "status"))


_ORDER_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

_ORDERS = f"""ordered AS (
  SELECT *, l_shipdate > (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 8760 HOUR AS is_recent FROM lineitem
  WHERE l_shipdate > (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 26280 HOUR), {sql_drift(_ORDER_COLUMNS, "ordered")}"""


@query("lineitem_drift", f"WITH {_ORDERS} SELECT feature, n_reference, n_recent, {sql_r6('psi', 'psi')}, {sql_r6('ks', 'ks')} FROM drift")
def lineitem_drift(spark, sf):
    """Drift of order-line columns, the last year against the two before, with exact cut points."""
    w = d.label_windows(base.table(spark, sf, "lineitem"), "l_shipdate", 8760, 17520)
    return rounded(d.drift_scores(w, _ORDER_COLUMNS, exact=True))


_CUT_LIST = f"""WITH long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem WHERE {c} IS NOT NULL" for c in _ORDER_COLUMNS)}),
ranked AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS place, count(*) OVER (PARTITION BY feature) AS n FROM long)
SELECT feature, CAST(p AS BIGINT) AS percent, value AS cut FROM ranked, (SELECT unnest(range(1, 100)) AS p) WHERE place = (p * n + 99) // 100"""


@query("exact_percentiles", _CUT_LIST)
def exact_percentiles(spark, sf):
    """All 99 percentiles of four order-line columns, exact."""
    cuts = exact_cuts(base.table(spark, sf, "lineitem"), _ORDER_COLUMNS, parts=100)
    listed = cuts.select("feature", F.posexplode("cuts").alias("at", "cut"))
    return listed.select("feature", (F.col("at") + 1).cast("bigint").alias("percent"), "cut")

"""Error aggregates of scored rows and the fair comparison of two models."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import scores
from tickloom.operators.dedup import duplicate_keys
from tickloom.operators.windows import BlockPlan, over_series

# Evaluation bounds (fixed values): newest rows of each series, and rows in all that a judgement needs.
NEWEST_PER_SERIES, MIN_EVALUATION_ROWS = 2000, 100


def error_summary(scored: DataFrame, actual="actual_close", predicted="predicted_close", by=()) -> DataFrame:
    """count, rmse, mae, mape, mean error, p95 of the absolute error."""
    return scored.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        scores.rmse(actual, predicted).alias("rmse"),
        scores.mae(actual, predicted).alias("mae"),
        scores.mape(actual, predicted).alias("mape"),
        scores.bias(actual, predicted).alias("mean_error"),
        scores.p95_abs_error(actual, predicted).alias("p95_abs_error"),
    )


def score_table(scored: DataFrame, actual: str, predicted: str, clip: float | None = None, by=()) -> DataFrame:
    """rmse, mae, r2, mape plus the share of rows on the same side of zero."""
    side = scores.share_true(scores.both_up_or_not(actual, predicted)).alias("directional_accuracy")
    return scored.groupBy(*by).agg(*scores.standard_scores(actual, predicted, clip), side)


def performance_log(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The two numbers logged per run."""
    return scored.agg(
        scores.rmse(actual, predicted).alias("rmse"), scores.mape(actual, predicted).alias("mape")
    )


def moves(
    scored: DataFrame,
    keys: list[str],
    time: str,
    actual="actual_close",
    predicted="predicted_close",
    plan: BlockPlan | None = BlockPlan(lookback=1),
) -> DataFrame:
    """Add ``same_move``: do both sides change in the same direction since the previous row?

    Long series run in blocks. ``plan=None`` suits input that is already bounded in time, such as the
    recent window of the monitors.
    """
    mark = lambda df, w: df.withColumn("same_move", scores.same_move(actual, predicted, w.ordered))
    return over_series(scored, keys, time, mark, plan)


def guarded_error(scored: DataFrame, at_least: int = 12) -> DataFrame:
    """Mean relative error, reported as 0 while there are too few rows to judge."""
    mean = F.avg(F.try_divide(F.abs(F.col("actual_close") - F.col("predicted_close")), F.abs("actual_close")))
    value = F.when(F.count("*") < at_least, F.lit(0.0)).otherwise(F.coalesce(mean, F.lit(0.0)))
    return scored.agg(F.count("*").alias("n_eval"), value.alias("avg_pct_error"))


def common_keys(left: DataFrame, right: DataFrame, keys: list[str], per_series: int | None = None) -> DataFrame:
    """Keys both tables hold; of every series only the newest ``per_series`` where that is given."""
    both = left.select(*keys).intersect(right.select(*keys))
    return both if per_series is None else newest_per_series(both, keys, per_series)


def newest_per_series(rows: DataFrame, keys: list[str], per_series: int) -> DataFrame:
    """The newest ``per_series`` rows of every series; ``keys`` is the time column, then the series.

    However many series there are, each is judged over the same span. The row-number limit is applied before the shuffle too, so a
    long series sends ``per_series`` rows a task, and with no series column the selection is a top-n.
    """
    time, *series = keys
    if not series:
        return rows.orderBy(F.col(time).desc()).limit(per_series)
    order = Window.partitionBy(*series).orderBy(F.col(time).desc())
    return rows.withColumn("_newest", F.row_number().over(order)).where(F.col("_newest") <= per_series).drop("_newest")


def _judged(rows: DataFrame, min_rows: int) -> DataFrame:
    """One row with rmse, mae and equal-sign accuracy of both models; rows has (side)_actual and (side)_predicted."""
    columns: list[Column] = [F.count("*").alias("eval_rows"), (F.count("*") >= min_rows).alias("enough_rows")]
    for name in ("champion", "challenger"):
        a, p = f"{name}_actual", f"{name}_predicted"
        columns += [
            scores.rmse(a, p).alias(f"{name}_rmse"),
            scores.mae(a, p).alias(f"{name}_mae"),
            scores.share_true(scores.same_sign(a, p)).alias(f"{name}_directional_accuracy"),
        ]
    return rows.agg(*columns)


def fair_comparison(
    champion: DataFrame,
    challenger: DataFrame,
    keys: list[str],
    actual: str = "actual",
    predicted: str = "predicted",
    per_series: int = NEWEST_PER_SERIES,
    min_rows: int = MIN_EVALUATION_ROWS,
) -> DataFrame:
    """Two tables of scored rows on the newest rows that both hold: one row with the errors of each.

    ``keys`` is the time column, then the series, and is unique in both tables. The join is the intersection, so
    keys are neither listed nor sent anywhere apart from their rows.
    """
    side = lambda df, name: df.dropna(subset=[actual, predicted]).select(
        *keys, F.col(actual).alias(f"{name}_actual"), F.col(predicted).alias(f"{name}_predicted")
    )
    rows = side(champion, "champion").join(side(challenger, "challenger"), keys)
    return _judged(newest_per_series(rows, keys, per_series), min_rows)


@dataclass(frozen=True)
class Candidate:
    """A model under evaluation: its feature columns, and a scorer that adds ``prediction``."""

    feature_cols: list[str]
    scorer: Callable[[DataFrame], DataFrame]


def evaluation_columns(champion: Candidate, challenger: Candidate) -> list[str]:
    """The union of both feature lists, sorted."""
    return sorted({*champion.feature_cols, *challenger.feature_cols})


def evaluation_rows(features: DataFrame, keys: list[str], target: str, columns: list[str], per_series: int = NEWEST_PER_SERIES) -> DataFrame:
    """Rows of the feature table that are complete for both models, the newest of every series.

    A row that is complete in the union of the columns is one that each model could score by itself, so no
    keys are intersected. Missing columns and repeated keys are refused.
    """
    missing = [c for c in (*keys, target, *columns) if c not in features.columns]
    if missing:
        raise ValueError(f"evaluation columns are missing: {missing}")
    repeated = duplicate_keys(features, keys).limit(1).collect()
    if repeated:
        raise ValueError(f"evaluation needs unique keys {keys}, found repeated {repeated[0].asDict()}")
    rows = features.select(*dict.fromkeys([*keys, target, *columns])).dropna(subset=[target, *columns])
    return newest_per_series(rows, keys, per_series)


def evaluate_models(
    features: DataFrame,
    keys: list[str],
    target: str,
    champion: Candidate,
    challenger: Candidate,
    per_series: int = NEWEST_PER_SERIES,
    min_rows: int = MIN_EVALUATION_ROWS,
) -> DataFrame:
    """Both models over the same rows in one pass: one row with the errors of each."""
    rows = evaluation_rows(features, keys, target, evaluation_columns(champion, challenger), per_series)
    for name, model in (("champion", champion), ("challenger", challenger)):
        rows = model.scorer(rows).withColumnsRenamed({"prediction": f"{name}_predicted"}).withColumn(f"{name}_actual", F.col(target))
    return _judged(rows, min_rows)

"""Scoring the newest complete row of every series and turning scores into prediction rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tickloom.schemas import PREDICTIONS, struct_of


def latest_complete(
    features: DataFrame, feature_cols: list[str], keys: list[str] | None = None, time: str = "open_time"
) -> DataFrame:
    """Newest row per series with all features and the close known.

    (keys, time) is unique, so one ``max_by`` per column picks the same row, and fixed-width buffers
    keep it a hash aggregate over an unsorted scan; a ``max_by`` of the whole row would sort.
    """
    keys = ["symbol"] if keys is None else keys
    needed = list(dict.fromkeys([*feature_cols, "close"]))
    ready = features.select(*keys, time, *needed).dropna(subset=needed)
    newest = [F.max_by(c, time).alias(c) for c in needed]
    return ready.groupBy(*keys).agg(F.max(time).alias("_newest"), *newest).select(
        *keys, F.col("_newest").alias(time), *needed
    )


def to_close_and_return(scored: DataFrame, target_col: str, prediction: str = "prediction") -> DataFrame:
    """``predicted_close`` and ``predicted_return_1h`` from a score of either target kind."""
    if target_col == "target_return_1h":
        change, price = F.col(prediction), F.col("close") * (1 + F.col(prediction))
    elif target_col == "target_close_1h":
        change, price = F.try_divide(F.col(prediction), F.col("close")) - 1, F.col(prediction)
    else:
        raise ValueError(f"unsupported target column: {target_col}")
    return scored.withColumns({"predicted_close": price, "predicted_return_1h": change})


def score_latest(
    features: DataFrame,
    feature_cols: list[str],
    scorer: Callable[[DataFrame], DataFrame],
    target_col: str,
    lineage: dict,
    prediction_time,
    keys: list[str] | None = None,
) -> DataFrame:
    """Prediction rows for the newest complete row of each series.

    ``scorer`` adds a ``prediction`` column (for a fitted MLlib model, its ``transform``). ``lineage``
    fills the model and table-version columns.
    """
    keys = ["symbol"] if keys is None else keys
    scored = to_close_and_return(scorer(latest_complete(features, feature_cols, keys)), target_col)
    fixed = {**lineage, "model_target_col": target_col, "prediction_time": prediction_time}
    out = scored.withColumnRenamed("open_time", "feature_open_time")
    columns = []
    for field in struct_of(PREDICTIONS).fields:
        if field.name in ("predicted_close", "predicted_return_1h"):
            columns.append(F.col(field.name))
        elif field.name == "feature_open_time":
            columns.append(F.col(field.name))
        else:
            value = F.lit(fixed.get(field.name))
            columns.append((value if field.name == "prediction_time" else value.cast(field.dataType)).alias(field.name))
    return out.select(*keys, *columns)


PREDICTION_KEYS = ["feature_open_time", "model_uri"]

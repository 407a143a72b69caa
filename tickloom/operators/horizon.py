"""Joins at an exact time offset: equi-joins, so gaps give no match instead of a wrong one."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.indicators import HORIZON


def _shift(column: str, by: timedelta):
    return F.col(column) + F.lit(by)


def attach_ahead(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    columns: dict[str, str],
    ahead: timedelta = HORIZON,
    how: str = "left",
) -> DataFrame:
    """Add ``columns`` (right name -> new name) of the right row at exactly ``left_time + ahead``.

    The right side is narrowed before the shuffle. Key plus time is near unique on the right, so the
    join hash spreads even one dominant series over all tasks.
    """
    wanted = right.select(
        *keys,
        F.col(right_time).alias("_at"),
        *[F.col(old).alias(new) for old, new in columns.items()],
    )
    return (
        left.withColumn("_at", _shift(left_time, ahead)).join(wanted, [*keys, "_at"], how).drop("_at")
    )


def predictions_with_actuals(
    predictions: DataFrame, bars: DataFrame, keys: list[str], how: str = "inner", ahead: timedelta = HORIZON
) -> DataFrame:
    """Predictions next to the close they forecast, with absolute and relative error."""
    columns = {"open_time": "actual_open_time", "close": "actual_close"}
    joined = attach_ahead(predictions, bars, keys, "feature_open_time", "open_time", columns, ahead, how)
    gap = F.abs(F.col("actual_close") - F.col("predicted_close"))
    return joined.withColumns(
        {"abs_error": gap, "pct_error": F.try_divide(gap, F.abs("actual_close"))}
    )

"""Forecast-error aggregates and direction tests, as expressions for one ``agg`` call."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def rmse(actual, predicted) -> Column:
    gap = _c(actual) - _c(predicted)
    return F.sqrt(F.avg(gap * gap))


def mae(actual, predicted) -> Column:
    return F.avg(F.abs(_c(actual) - _c(predicted)))


def mape(actual, predicted, clip: float | None = None) -> Column:
    """Mean of |error| / |actual|. ``clip`` puts a floor under the denominator (1e-10 in search)."""
    size = F.abs(_c(actual))
    if clip is not None:
        size = F.greatest(size, F.lit(clip))
    return F.avg(F.try_divide(F.abs(_c(actual) - _c(predicted)), size))


def bias(actual, predicted) -> Column:
    return F.avg(_c(actual) - _c(predicted))


def r2(actual, predicted) -> Column:
    """1 - SSE/SST in one pass: SST comes from the population variance of the actuals."""
    gap = _c(actual) - _c(predicted)
    both = gap.isNotNull()
    return 1 - F.try_divide(F.avg(gap * gap), F.var_pop(F.when(both, _c(actual))))


def p95_abs_error(actual, predicted, accuracy: int = 10000) -> Column:
    return F.percentile_approx(F.abs(_c(actual) - _c(predicted)), 0.95, accuracy)


# Three direction tests that differ at zero and in what they compare; each row gives true/false/NULL.


def both_up_or_not(actual, predicted) -> Column:
    """Same side of "greater than zero": zero counts as not up."""
    return (_c(actual) > 0) == (_c(predicted) > 0)


def same_sign(actual, predicted) -> Column:
    """Equal sign with three values: zero only agrees with zero."""
    return F.signum(_c(actual)) == F.signum(_c(predicted))


def same_move(actual, predicted, ordered) -> Column:
    """Equal sign of the change since the previous row of ``ordered`` (a window spec)."""
    return F.signum(_c(actual) - F.lag(_c(actual)).over(ordered)) == F.signum(
        _c(predicted) - F.lag(_c(predicted)).over(ordered)
    )


def share_true(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def standard_scores(actual, predicted, clip: float | None = None) -> list[Column]:
    """rmse, mae, r2, mape: the set every evaluation reports."""
    return [
        rmse(actual, predicted).alias("rmse"),
        mae(actual, predicted).alias("mae"),
        r2(actual, predicted).alias("r2"),
        mape(actual, predicted, clip).alias("mape"),
    ]

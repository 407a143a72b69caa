"""Threshold statuses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

OK, WARN, ALERT = "ok", "warn", "alert"

# Thresholds (warn, alert) by metric family (fixed values). 999 means "never alert".
PSI_LIMITS = (0.25, 1.0)
KS_LIMITS = (0.30, 0.60)
MONITOR_ONLY_ALERT = 999.0
NULL_RATE_LIMITS = (0.05, 0.2)
MAPE_LIMITS = (0.02, 0.05)
DIRECTION_LIMITS = (0.45, 0.40)


def _lit(value):
    return value if isinstance(value, Column) else F.lit(value)


def threshold_status(value: Column, warn, alert, higher_is_worse: bool = True) -> Column:
    """``ok``/``warn``/``alert`` by inclusive limits; an unknown value is a warning."""
    warn, alert = _lit(warn), _lit(alert)
    reached = (lambda limit: value >= limit) if higher_is_worse else (lambda limit: value <= limit)
    return (
        F.when(value.isNull(), WARN).when(reached(alert), ALERT).when(reached(warn), WARN).otherwise(OK)
    )


def alert_unless(condition: Column) -> Column:
    """``ok`` when the condition holds; anything else, NULL included, is an alert."""
    return F.when(condition, OK).otherwise(ALERT)

"""Recent forecast errors from versioned tables, newest day first: only the days of the recent window are read."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.drift import RECENT_HOURS
from tickloom.operators.horizon import predictions_with_actuals
from tickloom.operators.indicators import HORIZON
from tickloom.sources.snapshots import SnapshotTable, union_all


def _runs(days: list[str]) -> list[tuple[str, str]]:
    """Days in order as (first, last) of every stretch without a gap, so that one listing serves a stretch."""
    out: list[tuple[str, str]] = []
    for day in sorted(days):
        if out and date.fromisoformat(day) - date.fromisoformat(out[-1][1]) <= timedelta(days=1):
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


def _days_ahead(day: str, horizon: timedelta) -> list[str]:
    """The days in which the bars one horizon after any time of ``day`` lie, with an hour to spare for zone changes."""
    start = datetime.combine(date.fromisoformat(day), time()) + horizon
    first, last = (start - timedelta(hours=1)).date(), (start + timedelta(hours=25)).date()
    return [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]


def _read(table: SnapshotTable, days: list[str]) -> DataFrame:
    return union_all([table.read_days(first, last) for first, last in _runs(days)] or [table.read_days("~")])


def recent_pair(
    predictions: SnapshotTable, bars: SnapshotTable, keys: list[str], recent_hours: int = RECENT_HOURS, horizon: timedelta = HORIZON
) -> tuple[DataFrame, DataFrame]:
    """The days of both tables that hold the recent window of joined predictions, for ``performance_facts``.

    The window ends at the newest ``prediction_time`` of a prediction whose bar is known. Days are tried in the order of the newest
    ``prediction_time`` that the index keeps for them, twice as many each time, until no day left can hold a newer one; the walk is
    as long as the newest predictions wait for their bars, not as the history. A day for which the index keeps none is read first.
    Facts of the pair equal those of the whole tables. Rows without ``feature_open_time``, and days whose bars are not there yet, join nothing and are left out.
    """
    held = {r.day for r in bars.days()}
    ahead = lambda chosen: sorted({d for day in chosen for d in _days_ahead(day, horizon)} & held)
    # A day that no known bar can follow joins nothing.
    known = [r for r in predictions.days() if ahead([r.day])]
    days = [r for r in known if r.newest is None] + sorted((r for r in known if r.newest is not None), key=lambda r: r.newest, reverse=True)
    found, at, step = None, 0, 2
    while at < len(days) and (found is None or days[at].newest is None or days[at].newest > found):
        chosen = [r.day for r in days[at : at + step]]
        joined = predictions_with_actuals(_read(predictions, chosen), _read(bars, ahead(chosen)), keys, "inner", horizon)
        newest = joined.agg(F.max(F.col("prediction_time").cast("timestamp"))).first()[0]
        found = newest if found is None or (newest is not None and newest > found) else found
        at, step = at + step, step * 2
    since = None if found is None else found - timedelta(hours=recent_hours)
    needed = [r.day for r in days if since is not None and (r.newest is None or r.newest > since)]
    return _read(predictions, needed), _read(bars, ahead(needed))

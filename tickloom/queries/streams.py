"""Stateful streams, run to the end of what has arrived."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickloom.queries import base
from tickloom.queries.base import SQL_BARS, query, rounded
from tickloom.queries.features import _BAR_SQL, BAR_COLUMNS
from tickloom.session import checkpointed, shared_folder
from tickloom.streaming.bars import read_ticks, run_bars, stream_bars

# Days of ticks that arrive in one file.
_DAYS = 6


def deliver(ticks, folder: str) -> None:
    """Write ticks in the order in which they arrive: an eighth 90 minutes late, a seventh once more after 40 minutes, and a few
    again when their bar has long been closed. All of it follows from the ids, at any size."""
    late = F.when(F.col("event_id") % 8 == 0, F.expr("INTERVAL 90 MINUTES")).otherwise(F.expr("INTERVAL 0 MINUTES"))
    again = lambda share, delay: F.when(F.col("event_id") % share == 1, F.expr(f"INTERVAL {delay}"))
    sent = ticks.withColumn("delay", F.explode(F.array(late, again(7, "130 MINUTES"), again(50, "7 DAYS")))).where("delay IS NOT NULL")
    first = ticks.agg(F.date_trunc("day", F.min("ts"))).scalar()
    arrived = (F.unix_micros((F.col("ts") + F.col("delay")).cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / F.lit(_DAYS * 86_400_000_000)
    files = checkpointed(sent.withColumn("file", F.floor(arrived)).drop("delay"))
    last = files.agg(F.max("file")).first()[0]
    for file in range(0 if last is None else last + 1):  # one write per period of days, so that they arrive in order
        files.where(F.col("file") == file).drop("file").coalesce(1).write.mode("append").parquet(folder)


@query(
    "stream_bars",
    f"WITH {SQL_BARS} SELECT {_BAR_SQL} FROM bars WHERE open_time + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)",
)
def stream_bars_query(spark, sf):
    """Bars of the closed hours from a stream of ticks that come late and repeatedly, file by file."""
    root = f"{shared_folder(spark)}/tickloom/{uuid.uuid4().hex}"
    ticks = base.table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    deliver(ticks, f"{root}/ticks")
    bars = stream_bars(read_ticks(spark, f"{root}/ticks", ticks.schema, 1), "event_type", tick_id="event_id", source="events")
    run_bars(bars, f"{root}/bars", f"{root}/checkpoint")
    times = {c: F.col(c).cast(ticks.schema["ts"].dataType) for c in ("open_time", "close_time")}
    return rounded(spark.read.parquet(f"{root}/bars").withColumns(times).select(*BAR_COLUMNS))

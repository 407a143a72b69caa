"""Row-frame windows over long series, cut into overlapping blocks.

A window partitioned by series alone puts a whole series into one task. That is fine for short
series, so series are counted first; only those with more than ``split_above`` rows are cut into
blocks of about ``block_rows`` rows. The rows a block needs from its predecessor (``lookback``) and,
for exact-horizon targets, from later blocks (``ahead``) are copied into it, the window runs by
(series, block), and the copies are dropped. The result equals the plain window.

The cut needs no global sort. A small table counts rows per (long series, calendar bucket); its
running sum gives each bucket the index of its first row, and ``index div block_rows`` is the block.
Buckets are narrowed until each holds few enough rows, so dense series are cut as well as sparse
ones; where even one microsecond holds more, blocks are made larger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickloom.session import checkpointed

_BLOCK, _COPY = "_block", "_copy"
_MICROSECOND = timedelta(microseconds=1)


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _bucket(time: str, width: timedelta, before: timedelta = timedelta()) -> Column:
    """Start, in microseconds, of the calendar bucket of the time (or of a time ``before`` it). Never NULL,
    so that joining on it does not add a not-null test of the whole expression to every scanned row."""
    at = _micros(time) - before // _MICROSECOND
    return F.coalesce(at - F.pmod(at, F.lit(width // _MICROSECOND)), F.lit(-(1 << 62)))


@dataclass(frozen=True)
class BlockPlan:
    """How a series is cut. ``bucket`` is where narrowing starts, see :func:`fitted`."""

    lookback: int
    ahead: timedelta | None = None
    bucket: timedelta = timedelta(days=7)
    block_rows: int = 65_536
    split_above: int = 1_000_000  # series up to this many rows stay whole; 0 cuts every series

    def __post_init__(self):
        if self.block_rows <= self.lookback:
            raise ValueError(f"block_rows={self.block_rows} must exceed lookback={self.lookback}")

    @property
    def bucket_cap(self) -> int:
        return self.block_rows - self.lookback


def _bucket_starts(df: DataFrame, keys: list[str], time: str, width: timedelta) -> DataFrame:
    """(keys, bucket, rows, index of the first row) for every bucket."""
    counts = df.groupBy(*keys, _bucket(time, width).alias("_bucket")).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def long_series(df: DataFrame, keys: list[str], plan: BlockPlan) -> DataFrame:
    """Keys of the series to cut: at most (all rows / split_above) of them."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return counts.where(F.col("_rows") > plan.split_above).select(*keys)


def _cut_rows(df: DataFrame, keys: list[str], time: str, plan: BlockPlan) -> DataFrame:
    """Keys and times of the series to cut, stored: widths and starts of the buckets are found from it, not from the input."""
    rows = df.select(*keys, time)
    if plan.split_above > 0:
        return checkpointed(rows.join(long_series(df, keys, plan), keys, "left_semi"))
    return checkpointed(rows.dropna(subset=keys))


def fitted(rows: DataFrame, keys: list[str], time: str, plan: BlockPlan) -> BlockPlan:
    """The plan with buckets narrow enough for ``rows``: none holds more than ``block_rows - lookback`` rows.

    Every try counts rows per bucket, which combines on the map side; three or four are enough for one
    row a second. Rows of one microsecond cannot be told apart by time, so they set the least block.
    """
    while True:
        fullest = _bucket_starts(rows, keys, time, plan.bucket).agg(F.max("_rows")).first()[0] or 0
        if fullest <= plan.bucket_cap:
            return plan
        if plan.bucket <= _MICROSECOND:
            return replace(plan, block_rows=fullest + plan.lookback)
        # Half as much again as an even spread would need.
        narrower = plan.bucket * plan.bucket_cap // (fullest * 2)
        plan = replace(plan, bucket=max(_MICROSECOND, min(narrower, plan.bucket // 2)))


def assign_blocks(df: DataFrame, keys: list[str], time: str, plan: BlockPlan) -> DataFrame:
    """Add the block number and emit the copies; ``_copy`` marks rows to drop after the window.

    With at most ``block_rows - lookback`` rows per bucket every block but the last holds at least
    ``lookback`` rows, so copies for trailing frames only ever go to the next block. A row that may be a
    target goes to the block that holds the time ``ahead`` before it. Series that stay whole (and rows
    without a key) are block 0.
    """
    rows = _cut_rows(df, keys, time, plan)
    plan = fitted(rows, keys, time, plan)
    size = plan.block_rows
    block = F.expr(f"_start div {size}")
    starts = checkpointed(
        _bucket_starts(rows, keys, time, plan.bucket).select(
            *keys,
            "_bucket",
            block.alias(_BLOCK),
            # Some rows may lie within `lookback` of the next block's first row.
            (F.col("_start") + F.col("_rows") > (block + 1) * size - plan.lookback).alias("_feeds_next"),
        )
    )
    placed = df.withColumn("_bucket", _bucket(time, plan.bucket)).join(starts, [*keys, "_bucket"], "left")
    placed = placed.withColumn(_BLOCK, F.coalesce(_BLOCK, F.lit(0)))
    home = lambda block, copy: F.struct(block.alias("b"), F.lit(copy).alias("c"))
    homes = [home(F.col(_BLOCK), False), F.when(F.col("_feeds_next"), home(F.col(_BLOCK) + 1, True))]
    if plan.ahead:
        # The bucket of the row that this one is the target of; without rows there, nobody asks.
        asks = starts.select(*keys, F.col("_bucket").alias("_asking"), F.col(_BLOCK).alias("_asking_block"))
        placed = placed.withColumn("_asking", _bucket(time, plan.bucket, plan.ahead)).join(asks, [*keys, "_asking"], "left")
        homes.append(F.when(F.col("_asking_block") != F.col(_BLOCK), home(F.col("_asking_block"), True)))
    return placed.select(*df.columns, F.inline(F.array_compact(F.array(*homes))).alias(_BLOCK, _COPY))


@dataclass
class SeriesWindow:
    """Frames over one series (or one block of it), ordered by time."""

    partition: tuple[str, ...]
    time: str

    @cached_property
    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.partition).orderBy(self.time)

    def trailing(self, rows: int) -> WindowSpec:
        """The ``rows`` rows before the current one, which is not part of the frame."""
        return self.ordered.rowsBetween(-rows, -1)

    def at_offset(self, column: str, ahead: timedelta) -> Column:
        """``column`` of the row at exactly ``time + ahead``; NULL when that row is missing.

        A range frame with equal ends: a gap never shifts the answer to the next row, the window
        already sorted for the features is reused, and no self-join is needed.
        """
        parts = ", ".join(f"`{p}`" for p in self.partition)
        step = f"INTERVAL {ahead // _MICROSECOND} MICROSECONDS FOLLOWING"
        return F.expr(
            f"max(`{column}`) OVER (PARTITION BY {parts} ORDER BY `{self.time}` "
            f"RANGE BETWEEN {step} AND {step})"
        )


def over_series(
    df: DataFrame,
    keys: list[str],
    time: str,
    build: Callable[[DataFrame, SeriesWindow], DataFrame],
    plan: BlockPlan | None = None,
) -> DataFrame:
    """Run ``build(df, window)`` with a window that is local to a series.

    With a plan, one counting job (keys only, combined on the map side) looks for series long enough
    to cut. None: the plain window, one shuffle. Some: those run in blocks, the rest stay whole.
    ``plan=None`` skips the look where every series is known to be short.
    """
    whole = SeriesWindow(tuple(keys), time)
    if plan is None or (plan.split_above > 0 and not long_series(df, keys, plan).limit(1).count()):
        return build(df, whole)
    built = build(assign_blocks(df, keys, time, plan), SeriesWindow((*keys, _BLOCK), time))
    return built.where(~F.col(_COPY)).drop(_BLOCK, _COPY)


def last_rows(df: DataFrame, keys: list[str], time: str, rows: int) -> DataFrame:
    """The newest ``rows`` rows of each series. The limit also applies before the shuffle, so a task
    sends at most ``rows`` rows per series however long the series is."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col(time).desc())
    return df.withColumn("_n", F.row_number().over(newest_first)).where(F.col("_n") <= rows).drop("_n")


def row_index(
    df: DataFrame,
    order: list[str],
    keys: list[str] | None = None,
    bucket: timedelta = timedelta(hours=1),
    name: str = "row_idx",
) -> DataFrame:
    """Exact zero-based row number in ``order`` without a global sort; lazy.

    ``order[0]`` is the time column. Rows are numbered inside (keys, bucket) and shifted by the
    number of rows in earlier buckets, so a task holds one calendar bucket. Where a single bucket may
    hold a large share of the table, use :func:`stored_row_index`.
    """
    keys = keys or []
    starts = _bucket_starts(df, keys, order[0], bucket).select(*keys, "_bucket", "_start")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    placed = df.withColumn("_bucket", _bucket(order[0], bucket)).join(starts, [*keys, "_bucket"])
    number = F.col("_start") + F.row_number().over(inside) - 1
    return placed.select(*df.columns, number.cast("bigint").alias(name))


# Layout of Spark's monotonically_increasing_id: partition above, position in the low 33 bits.
_POSITION_BITS = 33


def stored_row_index(df: DataFrame, order: list[str], name: str = "row_idx") -> DataFrame:
    """Exact zero-based row number in ``order``, written once to the shared folder.

    Rows are range-partitioned on the whole order, which splits even one hot timestamp as long as the
    full order tells its rows apart, and sorted inside partitions. The position in the partition plus
    the rows of earlier partitions is the index. Writing first fixes the ranges, so a lost executor
    cannot renumber rows between the count and the use.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = checkpointed(ranged.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", _POSITION_BITS)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per write task: bounded by the shuffle partition setting, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    position = F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + position).alias(name))
    )

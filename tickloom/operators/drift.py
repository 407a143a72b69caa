"""Distribution drift between a reference and a recent window, all columns in one pass.

Two scans of the window whatever the number of columns: one takes the reference cut points, one
counts both sides per bucket. PSI and KS come from the same ten counts per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Cut probabilities, and the floor for empty buckets.
BUCKETS = 10
EMPTY_SHARE = 1e-6
RECENT_HOURS, REFERENCE_HOURS = 168, 720


def label_windows(
    df: DataFrame, time: str, recent_hours: int = RECENT_HOURS, reference_hours: int = REFERENCE_HOURS
) -> DataFrame:
    """Keep rows of the two windows that end at the newest row and mark ``is_recent``.

    The newest time is one scalar subquery, so the bounds reach the scan as plain comparisons.
    Both windows exclude their lower bound.
    """
    newest = df.agg(F.max(time)).scalar()
    recent_from = newest - F.expr(f"INTERVAL {int(recent_hours)} HOURS")
    oldest = newest - F.expr(f"INTERVAL {int(recent_hours + reference_hours)} HOURS")
    return df.where(F.col(time) > oldest).withColumn("is_recent", F.col(time) > recent_from)


def cut_points(df: DataFrame, columns: list[str], parts: int = BUCKETS, accuracy: int = 10000) -> DataFrame:
    """(feature, cuts) from bounded quantile sketches, all columns in one aggregate."""
    shares = [i / parts for i in range(1, parts)]
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias("cuts"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def bucket_of(value: Column, cuts: Column, parts: int = BUCKETS) -> Column:
    """How many cut points lie strictly below the value: bucket i is (cut i, cut i+1]."""
    below = [(F.element_at(cuts, i) < value).cast("int") for i in range(1, parts)]
    return reduce(lambda a, b: a + b, below)


def to_long(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """(keep..., feature, value) with NULL values left out."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def bucket_counts(windows: DataFrame, columns: list[str], accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """(feature, bucket, n_reference, n_recent). The cut table has one row per column, so it is
    broadcast: its size is the number of columns asked for, not the data. ``exact`` cuts take a few passes more."""
    from tickloom.operators.quantiles import exact_cuts

    reference = windows.where(~F.col("is_recent"))
    cuts = exact_cuts(reference, columns) if exact else cut_points(reference, columns, accuracy=accuracy)
    values = to_long(windows, columns, ["is_recent"])
    placed = values.join(F.broadcast(cuts), "feature").select(
        "feature", bucket_of(F.col("value"), F.col("cuts")).alias("bucket"), "is_recent"
    )
    return placed.groupBy("feature", "bucket").agg(
        F.count_if(~F.col("is_recent")).alias("n_reference"), F.count_if("is_recent").alias("n_recent")
    )


def drift_scores(windows: DataFrame, columns: list[str], accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """PSI and the largest CDF gap at the deciles per column; NULL when a window has no values."""
    counts = bucket_counts(windows, columns, accuracy, exact)
    at = lambda i, side: F.sum(F.when(F.col("bucket") == i, F.col(side)).otherwise(0))
    sides = {
        side: F.array(*[at(i, side).cast("double") for i in range(BUCKETS)])
        for side in ("n_reference", "n_recent")
    }
    per_feature = counts.groupBy("feature").agg(*[a.alias(f"_{s}") for s, a in sides.items()])
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, n: acc + n)
    per_feature = per_feature.select(
        "feature",
        "_n_reference",
        "_n_recent",
        total(F.col("_n_reference")).alias("_ref"),
        total(F.col("_n_recent")).alias("_rec"),
    )
    floor = F.lit(EMPTY_SHARE)
    term = lambda a, b: (b - a) * F.ln(b / a)
    shares = F.zip_with(
        "_n_reference",
        "_n_recent",
        lambda a, b: term(
            F.greatest(F.try_divide(a, F.col("_ref")), floor), F.greatest(F.try_divide(b, F.col("_rec")), floor)
        ),
    )
    gaps = F.zip_with(
        "_n_reference",
        "_n_recent",
        lambda a, b: F.try_divide(a, F.col("_ref")) - F.try_divide(b, F.col("_rec")),
    )
    # The CDF gap at a cut is the running sum of the share gaps.
    start = F.struct(F.lit(0.0).alias("run"), F.lit(0.0).alias("worst"))
    step = lambda acc, g: F.struct(
        (acc["run"] + g).alias("run"), F.greatest(acc["worst"], F.abs(acc["run"] + g)).alias("worst")
    )
    scored = (F.col("_ref") > 0) & (F.col("_rec") > 0)
    return per_feature.select(
        "feature",
        F.col("_ref").cast("bigint").alias("n_reference"),
        F.col("_rec").cast("bigint").alias("n_recent"),
        F.when(scored, total(shares)).alias("psi"),
        F.when(scored, F.aggregate(F.slice(gaps, 1, BUCKETS - 1), start, step)["worst"]).alias("ks"),
    )


def recent_null_rates(windows: DataFrame, columns: list[str]) -> DataFrame:
    """Share of NULLs per column in the recent window; 1.0 when that window is empty."""
    recent = F.count_if("is_recent")
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.coalesce(
                F.try_divide(F.count_if(F.col("is_recent") & F.col(c).isNull()), recent), F.lit(1.0)
            ).alias("null_rate"),
        )
        for c in columns
    ]
    return windows.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

"""Keyed upsert and conditional update as plain DataFrame expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str], null_safe=True) -> DataFrame:
    """Target rows without a source match, plus all source rows; columns are the union of both.

    ``null_safe`` names the keys (or all of them) where NULL matches NULL. Source keys must be
    unique, as a merge would demand; de-duplicate first. Only source keys travel to the anti-join.
    """
    renamed = source.select(*[F.col(k).alias(f"_src_{k}") for k in keys])
    safe = set(keys) if null_safe is True else set(null_safe or ())
    tests = [
        F.col(k).eqNullSafe(F.col(f"_src_{k}")) if k in safe else F.col(k) == F.col(f"_src_{k}")
        for k in keys
    ]
    untouched = target.join(renamed, reduce(lambda a, b: a & b, tests), "left_anti")
    return untouched.unionByName(source, allowMissingColumns=True)


def grow_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Add the columns of ``like`` that ``df`` lacks, as typed NULLs (a zero-row schema merge)."""
    have = set(df.columns)
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in like.schema.fields if f.name not in have}
    )


def keep_single_active(configs: DataFrame, active_id, key: str = "selected_features") -> DataFrame:
    """Switch off every active row of a config key except the given id."""
    row_id = F.coalesce("config_id", "config_version")
    stale = (F.col("config_key") == key) & F.col("is_active") & (row_id != active_id)
    return configs.withColumn("is_active", F.when(stale, F.lit(False)).otherwise(F.col("is_active")))


def retain_recent(staging: DataFrame, as_of, hours: int = 48, loaded_at: str = "_loaded_at") -> DataFrame:
    """Staging rows young enough to keep. Rows without a load time are kept: their age is unknown."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    cutoff = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return staging.where(~F.coalesce(F.col(loaded_at) < cutoff, F.lit(False)))


def loaded_since(staging: DataFrame, run_started_at, loaded_at: str = "_loaded_at") -> DataFrame:
    """Rows of this run only; the start is required so that retained rows are not merged again."""
    if run_started_at is None:
        raise ValueError("run_started_at is required: without it retained rows would be merged again")
    return staging.where(F.col(loaded_at) >= run_started_at)

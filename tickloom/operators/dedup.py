"""De-duplication by key, as aggregates.

The maximum combines on the map side, so a key that holds a third of all rows sends one row per map
task. A ``row_number`` window would ship and sort every copy in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[str], drop_order: bool = False) -> DataFrame:
    """One row per key: the greatest by the ordering columns, compared left to right.

    Rows that tie on all of them are told apart by their whole content, so a rerun picks the same one.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    # One struct holds order and content. NULL sorts below every value in it, so a missing load time loses.
    picked = df.groupBy(*keys).agg(F.max(F.struct(*newest_first, *rest)).alias("_row"))
    kept = [c for c in df.columns if not (drop_order and c in newest_first)]
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in kept])


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Any-row de-duplication made repeatable: the greatest row by content wins."""
    return latest_per_key(df, keys, [])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)

"""Temporal train/test split and expanding cross-validation folds over an exact row index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.windows import stored_row_index


def complete_rows(df: DataFrame, columns: list[str], time: str = "open_time", keys=("symbol",)) -> DataFrame:
    """The model columns of rows where all of them are known."""
    return df.select(*keys, time, *[c for c in columns if c not in (*keys, time)]).dropna()


def split_index(rows: Column, fraction: float) -> Column:
    """Number of leading rows in the train part (truncated, as in integer conversion)."""
    return F.floor(rows * F.lit(float(fraction))).cast("bigint")


def temporal_split(df: DataFrame, fraction: float = 0.8, order: list[str] | None = None) -> DataFrame:
    """Add ``row_idx`` and ``split`` (train/test): the first share of rows by time trains, unshuffled.

    The indexed rows are stored once; counting and every later pass read that copy.
    """
    indexed = stored_row_index(df, order or ["open_time", "symbol"])
    total = indexed.agg(F.count("*")).scalar()
    return indexed.withColumn(
        "split", F.when(F.col("row_idx") < split_index(total, fraction), "train").otherwise("test")
    )


def cv_blocks(df: DataFrame, folds: int = 5, order: list[str] | None = None) -> DataFrame:
    """Add ``cv_block``: fold i validates on block i and trains on every row with a smaller block.

    The first rows, which only ever train, are block -1. One column serves all folds, so no row is
    copied per fold.
    """
    size = F.floor(F.col("_n") / (folds + 1))
    first = F.col("_n") - folds * size
    indexed = stored_row_index(df, order or ["open_time", "symbol"])
    total = indexed.agg(F.count("*")).scalar()
    block = F.when(F.col("row_idx") < first, F.lit(-1)).otherwise(
        F.floor((F.col("row_idx") - first) / size)
    )
    return indexed.withColumn("_n", total).withColumn("cv_block", block.cast("int")).drop("_n")


def fold_train(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("cv_block") < fold)


def fold_validate(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("cv_block") == fold)


def fold_summary(blocks: DataFrame, folds: int = 5, time: str = "open_time") -> DataFrame:
    """Train and validation sizes and bounds per fold, from one aggregate over the blocks."""
    block = F.col("cv_block")
    cells = []
    for fold in range(folds):
        cells.append(
            F.struct(
                F.lit(fold).alias("fold"),
                F.count_if(block < fold).alias("train_rows"),
                F.count_if(block == fold).alias("validate_rows"),
                F.max(F.when(block < fold, F.col(time))).alias("train_end"),
                F.min(F.when(block == fold, F.col(time))).alias("validate_start"),
                F.max(F.when(block == fold, F.col(time))).alias("validate_end"),
            )
        )
    return blocks.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

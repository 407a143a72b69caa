"""Helpers shared by the operators: ids, column picks, hashing of ids, stored intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import checkpointed as stored  # noqa: F401  (written to the shared folder, read back)
from tickloom.session import shared_folder


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared folder, not made yet."""
    return f"{shared_folder(spark)}/tickloom/{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only the id and the text (NULL as empty), so that other columns can have any names."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also where lambdas read it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z only, so that the result does not depend on a locale or a Unicode version."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def new_column(docs: DataFrame, name: str) -> str:
    """``name``, or something longer where ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def slices(batch: pa.RecordBatch, column: str, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch with about ``size`` bytes of ``column`` each, one row at least."""
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + (n or 0) > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)

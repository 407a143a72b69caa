"""Job-run records as nested JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schemas import JOB_RUNS, struct_of


def read_job_runs(spark: SparkSession, path) -> DataFrame:
    """Runs with their state and tasks; the schema is given, so no inference pass over the files."""
    return spark.read.schema(struct_of(JOB_RUNS)).json(path)

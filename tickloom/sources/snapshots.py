"""Versioned parquet tables for catalogs that have no transactional table format.

A version is a set of day folders. Publishing writes only the days that changed, to a folder of its own,
and then appends one index row per day that names the folder; readers see a version once its index rows
exist. A stop in between leaves a folder that nobody reads, and the next attempt is not in its way. An
upsert rewrites the touched days, not the table. One writer at a time is assumed.

A write may name its batch, which the index keeps: a batch that is published already is not written again, and its
version is returned. A write without rows publishes nothing, except that a first version keeps the columns.

The index may also keep, for every day written, the newest value of a second time column (``newest_of``), so that a
reader who wants the newest rows by that column can tell which days to read.

Layout: ``root/data/ATTEMPT/day=YYYY-MM-DD/*.parquet`` and ``root/index/*.parquet``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from tickloom.operators.dedup import duplicate_keys
from tickloom.operators.upsert import grow_columns, upsert
from tickloom.session import checkpointed

_INDEX = "version BIGINT, day STRING, committed_at TIMESTAMP, folder STRING, batch STRING, newest TIMESTAMP"
# Days of rows without a time, and of a first version without rows.
UNKNOWN_DAY, NO_DAY = "unknown", "none"


class SnapshotTable:
    """A table whose rows have a time column; ``day`` folders come from it."""

    def __init__(self, spark: SparkSession, root: str, time: str = "open_time", newest_of: str | None = None):
        self.spark, self.root, self.time, self.newest_of = spark, root.rstrip("/"), time, newest_of

    def _day(self):
        return F.coalesce(F.date_format(self.time, "yyyy-MM-dd"), F.lit(UNKNOWN_DAY))

    # -- metadata ---------------------------------------------------------------------------

    def index(self) -> DataFrame:
        """(version, day, committed_at, folder, batch, newest); empty before the first version."""
        try:
            return self.spark.read.schema(_INDEX).parquet(f"{self.root}/index")
        except AnalysisException:
            return self.spark.createDataFrame([], _INDEX)

    def exists(self) -> bool:
        return self.latest_version() is not None

    def latest_version(self) -> int | None:
        return self.index().agg(F.max("version")).first()[0]

    def versions(self) -> DataFrame:
        return self.index().groupBy("version").agg(
            F.max("committed_at").alias("committed_at"), F.count("*").alias("days_written")
        )

    def version_of(self, batch: str | None) -> int | None:
        """The version that a batch was published as."""
        if batch is None:
            return None
        return self.index().where(F.col("batch") == batch).agg(F.max("version")).first()[0]

    def first_day_after(self, version: int | None) -> str | None:
        """The earliest day written by any version newer than the given one."""
        newer = self.index() if version is None else self.index().where(F.col("version") > version)
        return newer.agg(F.min("day")).first()[0]

    # -- reading ----------------------------------------------------------------------------

    def _paths(self, index: DataFrame) -> list[str]:
        """Newest folder of each day of an index: one path per day, as a file listing."""
        days = index.groupBy("day").agg(F.max_by("folder", "version").alias("folder"))
        return [f"{self.root}/data/{r.folder}/day={r.day}" for r in days.sort("day").toLocalIterator()]

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (default: newest). Columns added later read as NULL."""
        version = self.latest_version() if version is None else version
        known = self.index().where(F.col("version") == version).limit(1).count() if version is not None else 0
        if not known:
            raise ValueError(f"version {version} of {self.root} is not available")
        return self.spark.read.option("mergeSchema", True).parquet(*self._paths(self.index().where(F.col("version") <= version)))

    def days(self) -> list[Row]:
        """(day, newest) of every day with rows that have a time, in order; ``newest`` is NULL where it was not kept."""
        rows = self.index().where(~F.col("day").isin(UNKNOWN_DAY, NO_DAY))
        return rows.groupBy("day").agg(F.max_by("newest", "version").alias("newest")).sort("day").collect()  # one row a day

    def read_days(self, first: str, last: str | None = None) -> DataFrame:
        """The newest rows of the days from ``first`` to ``last``; only their folders are listed.

        Without such a day the result is empty, with the columns of one of the other days.
        """
        known = self.index().where(~F.col("day").isin(UNKNOWN_DAY, NO_DAY))
        wanted = F.col("day") >= first if last is None else F.col("day").between(first, last)
        paths = self._paths(known.where(wanted))
        if paths:
            return self.spark.read.option("mergeSchema", True).parquet(*paths)
        one = self.index().agg(F.max_by(F.struct("day", "folder"), "version").alias("d")).select("d.*")
        return self.spark.read.parquet(*[f"{self.root}/data/{r.folder}/day={r.day}" for r in one.collect()]).limit(0)

    # -- writing ----------------------------------------------------------------------------

    def _publish(self, df: DataFrame, batch: str | None = None) -> int:
        latest = self.latest_version()
        folder = uuid.uuid4().hex
        path = f"{self.root}/data/{folder}"
        # Rebalancing sizes the tasks by data: a heavy day (or all rows without a time) is written by
        # several, and light days share one.
        sized = df.withColumn("day", self._day()).hint("rebalance", "day")
        sized.write.partitionBy("day").parquet(path)
        # The schema is given, as a folder without files has none to infer.
        tracked = [f for f in df.schema.fields if f.name == self.newest_of]
        newest = F.max(self.newest_of) if tracked else F.lit(None)
        written = self.spark.read.schema(StructType([StructField("day", StringType()), *tracked])).parquet(path).groupBy("day").agg(newest.cast("timestamp").alias("newest"))
        if written.limit(1).count() == 0:
            if latest is not None:
                return latest
            df.limit(0).write.parquet(f"{path}/day={NO_DAY}")
            written = self.spark.createDataFrame([(NO_DAY, None)], "day STRING, newest TIMESTAMP")
        version = 0 if latest is None else latest + 1
        rows = written.select(
            F.lit(version).cast("bigint").alias("version"),
            "day",
            F.current_timestamp().alias("committed_at"),
            F.lit(folder).alias("folder"),
            F.lit(batch).cast("string").alias("batch"),
            "newest",
        )
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/index")
        return version

    def create(self, df: DataFrame) -> int:
        """First version; fails when the table is already there."""
        if self.exists():
            raise ValueError(f"{self.root} already has versions")
        return self._publish(df)

    def upsert(self, source: DataFrame, keys: list[str], null_safe=True, unique: bool = False, batch: str | None = None) -> int:
        """Merge by key. Only the days present in the source are read and rewritten. Repeated source
        keys are refused; ``unique`` skips that check where they cannot occur. A ``batch`` that is
        published already changes nothing.

        A row of the source belongs to the day of its time, so a key must include the time column.
        """
        if self.time not in keys:
            raise ValueError(f"the key must include {self.time}")
        published = self.version_of(batch)
        if published is not None:
            return published
        # Several passes follow, so the source is evaluated once.
        source = checkpointed(source)
        if not unique and duplicate_keys(source, keys).limit(1).count():
            raise ValueError(f"the source holds repeated keys {keys}")
        touched = source.select(self._day().alias("day")).distinct()
        folders = self._paths(self.index().join(touched, "day", "left_semi"))
        if not folders:
            return self._publish(source, batch)
        target = self.spark.read.option("mergeSchema", True).parquet(*folders)
        merged = upsert(grow_columns(target, source), source, keys, null_safe)
        return self._publish(merged, batch)


def version_availability(required: DataFrame, available: DataFrame, min_retention_hours: float) -> DataFrame:
    """Is every required (table_name, version) still there and kept long enough?

    ``available``: table_name, version, retention_hours. Negative versions are optional and pass.
    """
    optional = F.col("version") < 0
    found = F.col("retention_hours").isNotNull()
    kept = F.coalesce(F.col("retention_hours") >= min_retention_hours, F.lit(False))
    return required.join(available, ["table_name", "version"], "left").select(
        "table_name",
        "version",
        (optional | found).alias("available"),
        (optional | kept).alias("retained"),
        F.when(optional, "optional").when(~found, "missing").when(~kept, "retention too short").otherwise("ok").alias("status"),
    )


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the file system that its path names; one that is gone is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Append frames by name; later columns are NULL in earlier rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def save(df: DataFrame, name: str, mode: str = "append") -> None:
    """Write a catalog table: append, overwrite (schema included) or errorifexists."""
    writer = df.write.format("parquet").mode(mode)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(name)

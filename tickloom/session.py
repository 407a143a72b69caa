"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every entry point wants; anything already set by the cluster wins.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture costs a round trip per column expression while a plan is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in SESSION_DEFAULTS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session, whose executor is the driver, may leave it unset: it then gets a folder of
    its own, removed when the process ends. On a cluster an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        folder = tempfile.mkdtemp(prefix="tickloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_FOLDERS[context.applicationId] = folder
    return _LOCAL_FOLDERS[context.applicationId]


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage like ``DataFrame.checkpoint`` and, being parquet, keeps column pruning and filter
    pushdown for the passes that follow.
    """
    path = f"{shared_folder(df.sparkSession)}/tickloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

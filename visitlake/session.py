"""Session defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, name: str = "visitlake", event_log: str | None = None) -> SparkSession:
    """A session for tests and benches. On a cluster, use the one the cluster gives.
    ``event_log`` is a folder for an event log that can be read while jobs run; files are then
    read by the tasks themselves, since what other threads read for them is not counted."""
    builder = SparkSession.builder.master(f"local[{cores}]")
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log).config("spark.eventLog.compress", "false")
        builder = builder.config("spark.hadoop.parquet.hadoop.vectored.io.enabled", "false")
    return (
        builder.appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="visitlake-wh-"))
        .getOrCreate()
    )


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="visitlake-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names, or, in local
    mode only, a temporary one per application."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return _local_folder(context.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes a stage as a table and reads it back, by default under the shared folder.

    Cuts the lineage, survives lost executors, and tells Catalyst the real size.
    """
    path = path or scratch_path(df.sparkSession, "stage")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

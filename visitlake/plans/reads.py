"""What jobs have read, out of Spark's event log.

An application that writes its event log uncompressed can look up there what the tasks of
its own jobs took from files: bytes and rows that were read, not those a plan might read.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = "spark.jobGroup.id"


def is_logged(spark: SparkSession) -> bool:
    """Whether this application's event log can be read while it runs."""
    setting = lambda name, default: spark.sparkContext.getConf().get(name, default)
    return setting("spark.eventLog.enabled", "false") == "true" and setting("spark.eventLog.compress", "true") == "false"


def events(spark: SparkSession) -> DataFrame:
    """One row for each line logged so far: ``value`` and its ``Event``."""
    context = spark.sparkContext
    folder, application = context.getConf().get("spark.eventLog.dir").rstrip("/"), context.applicationId
    rolled = context.getConf().get("spark.eventLog.rolling.enabled", "true") == "true"
    path = f"{folder}/eventlog_v2_{application}/events_*" if rolled else f"{folder}/{application}*"
    return spark.read.text(path).withColumn("Event", F.get_json_object("value", "$.Event"))


def reads_by_group(spark: SparkSession) -> DataFrame:
    """``JobGroup, BytesRead, RowsRead``: input of all tasks of the jobs of each group."""
    logged = events(spark)
    at = lambda path: F.get_json_object("value", path)
    jobs = logged.filter("Event = 'SparkListenerJobStart'").select(
        at(f"$.Properties['{GROUP}']").alias("JobGroup"), F.explode(F.from_json(at("$['Stage IDs']"), "array<int>")).alias("Stage"))
    metric = lambda name: F.sum(at(f"$['Task Metrics']['Input Metrics']['{name}']").cast("bigint"))
    stages = logged.filter("Event = 'SparkListenerTaskEnd'").groupBy(at("$['Stage ID']").cast("int").alias("Stage")).agg(
        metric("Bytes Read").alias("BytesRead"), metric("Records Read").alias("RowsRead"))
    # A stage that several jobs name has run for the first of them.
    owners = jobs.filter("JobGroup IS NOT NULL").groupBy("Stage").agg(F.min("JobGroup").alias("JobGroup"))
    return owners.join(stages, "Stage").groupBy("JobGroup").agg(F.sum("BytesRead").alias("BytesRead"), F.sum("RowsRead").alias("RowsRead"))


def await_logged(spark: SparkSession, group: str, seconds: float = 30) -> None:
    """Returns when the log holds the end of all jobs started in ``group``; it is written behind the jobs."""
    until = time.monotonic() + seconds
    while True:
        logged = events(spark)
        job = F.get_json_object("value", "$['Job ID']").cast("int")
        started = logged.filter("Event = 'SparkListenerJobStart'").filter(F.get_json_object("value", f"$.Properties['{GROUP}']") == group)
        open_jobs = started.select(job.alias("Job")).join(logged.filter("Event = 'SparkListenerJobEnd'").select(job.alias("Job")), "Job", "left_anti")
        found = started.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        if found and not open_jobs.head(1):
            return
        if time.monotonic() > until:
            raise TimeoutError(f"the event log does not show the end of {group}")
        time.sleep(0.2)

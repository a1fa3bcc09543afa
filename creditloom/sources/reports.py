"""Report and queue sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.scoring import queue_of


def write_report(rows: DataFrame, path: str) -> None:
    """Append report rows under their run time (column `run_ts`)."""
    stamp = F.date_format("run_ts", "yyyyMMdd'T'HHmmss'Z'")
    rows.withColumn("run", stamp).write.mode("append").partitionBy("run").json(path)


def latest_report(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the latest run; the run folders are pruned to that one."""
    reports = spark.read.json(path)
    newest = reports.agg(F.max("run").alias("run")).scalar()
    return reports.filter(F.col("run") == newest)


def write_queues(events: DataFrame, path: str, mode: str = "append") -> None:
    """Triage events in one folder per action."""
    rows = events.withColumn("queue", queue_of(F.col("action")))
    rows.write.mode(mode).partitionBy("queue").json(path)


GLOBAL_QUEUE = "latest"


def latest_per_queue(events: DataFrame) -> DataFrame:
    """The newest event of every queue, and of all queues under `latest`.

    Also valid on a stream, where the state is one row per queue.
    """
    newest = F.max(F.struct("emitted_at", "client_id", F.struct(*events.columns).alias("event")))
    queues = F.array(queue_of(F.col("action")), F.lit(GLOBAL_QUEUE))
    return (
        events.withColumn("queue", F.explode(queues))
        .groupBy("queue")
        .agg(newest.alias("m"))
        .select("queue", "m.event.*")
    )

"""Structured Streaming versions of triage, queues, monitoring and drift.

Sinks are files. A `foreachBatch` sink writes each micro-batch to a folder of its own
number with overwrite, so a replayed batch replaces itself and never counts twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from creditloom.functions import is_fresh
from creditloom.operators.drift import bin_counts, category_counts, psi_categorical, psi_numeric, reference_edges
from creditloom.operators.scoring import queue_of, triage
from creditloom.session import materialize


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived, then stop; a later run continues from there.

    State is kept in RocksDB unless the session chose a store, so it may outgrow the heap.
    """
    conf = SparkSession.active().conf
    if not conf.get(STATE_STORE, None) or conf.get(STATE_STORE).endswith("HDFSBackedStateStoreProvider"):
        conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return running


def replay(rows: DataFrame, batch: str, source: str, checkpoint: str, job: Callable[[DataFrame], DataStreamWriter]) -> None:
    """Run a streaming job over a table as it arrived, the rows of one number of column `batch` after the other.

    Each number's rows are added to the folder `source` as new files, then the job runs to the end of what is there and stops; the
    next run continues from its checkpoint. So a micro-batch holds exactly one number's rows, however many
    files they are, and the watermark of each is that of the numbers before. Rows without number are left out; the
    numbers are few, as each is a run.
    """
    spark = rows.sparkSession
    kept = materialize(rows.filter(F.col(batch).isNotNull()), "arrivals")
    for number in sorted(r[0] for r in kept.select(batch).distinct().collect()):
        kept.filter(F.col(batch) == number).drop(batch).write.mode("append").parquet(source)
        run_available(job(read_stream(spark, source, kept.drop(batch).schema)), checkpoint)


def triage_stream(scored: DataFrame, client: str, score: str, threshold: float, at: Column) -> DataFrame:
    """One triage event per scored client."""
    return triage(scored, client, score, threshold, at)


def queue_sink(events: DataFrame, path: str) -> DataStreamWriter:
    """Append events to one folder per queue."""
    return (
        events.withColumn("queue", queue_of(F.col("action")))
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("queue")
        .option("path", path)
    )


def upsert_sink(rows: DataFrame, path: str) -> DataStreamWriter:
    """Changed rows of every micro-batch, under the batch number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.outputMode("update").foreachBatch(write)


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state of an upsert sink: per key the row of the highest batch."""
    rows = spark.read.option("basePath", path).parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch")
    return rows.groupBy(*keys).agg(newest.alias("v")).select(*keys, "v.*")


def monitor_window(
    checks: DataFrame, ts: str, status: str, every: str = "5 minutes", late_by: str = "10 minutes"
) -> DataFrame:
    """Counts of check results per tumbling window; state ends with the watermark."""
    return (
        checks.withWatermark(ts, late_by)
        .groupBy(F.window(ts, every).alias("w"))
        .agg(
            *[F.count_if(F.col(status) == s).alias(s) for s in ("ok", "warn", "fail")],
            F.count("*").alias("checks"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ok", "warn", "fail", "checks")
    )


def fresh_only(events: DataFrame, runs: DataFrame, on: str, ts: str, trained_at: str, hours: float = 24.0) -> DataFrame:
    """Events whose model was trained within the window before them; `runs` is a static table."""
    joined = events.join(runs.select(on, trained_at), on)
    return joined.filter(is_fresh(F.col(trained_at), F.col(ts), hours)).drop(trained_at)


def dedupe_events(events: DataFrame, keys: Sequence[str], ts: str, late_by: str = "1 hour") -> DataFrame:
    """First arrival per key within the watermark; keys are dropped from state after it."""
    return events.withWatermark(ts, late_by).dropDuplicatesWithinWatermark(list(keys))


def changes_only(rows: DataFrame) -> DataStreamWriter:
    """Run a stateful job for its state alone; the changed rows are not kept."""
    return rows.writeStream.outputMode("update").format("noop")


def append_sink(rows: DataFrame, path: str) -> DataStreamWriter:
    return rows.writeStream.outputMode("append").format("parquet").option("path", path)


def psi_sink(
    incoming: DataFrame,
    reference: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    path: str,
) -> DataStreamWriter:
    """Drift of every micro-batch against a reference table: (feature, psi) per batch number.

    The reference is read when the stream is defined: its bin edges are found, its bins and categories
    counted and the counts written. A micro-batch reads the counts, never the reference.
    """
    edges = reference_edges(reference, numeric) if numeric else {}
    bins = materialize(bin_counts(reference, numeric, edges), "psi-bins") if numeric else None
    tokens = materialize(category_counts(reference, categorical), "psi-categories") if categorical else None

    def write(batch: DataFrame, number: int) -> None:
        parts = []
        if numeric:
            parts.append(psi_numeric(bins, batch, numeric, edges=edges, counted=True))
        if categorical:
            parts.append(psi_categorical(tokens, batch, categorical, counted=True))
        reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return incoming.writeStream.outputMode("append").foreachBatch(write)

"""The newest event of every queue as keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from creditloom.operators.scoring import queue_of
from creditloom.sources.reports import GLOBAL_QUEUE

AT, TIE, TIED = "emitted_at", "client_id", "tied"


class NewestEvent(StatefulProcessor):
    """State per queue: its newest event, and how many events share that event's time, in microseconds.

    A later time replaces the event; of events of one time the largest client counts. With `idle_ms` a
    timer in event time ends the state of a queue that has had no event for so long.
    """

    def __init__(self, schema: T.StructType, idle_ms: int | None) -> None:
        self.schema, self.idle_ms = schema, idle_ms
        self.at, self.tie, self.tied = (schema.fieldNames().index(c) for c in (AT, TIE, TIED))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = tuple(self.newest.get()) if self.newest.exists() else None
        best = before
        for row in rows:
            best = self._later(best, tuple(row[c] for c in self.schema.fieldNames()))
        if best == before:
            return
        self.newest.update(best)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(best[self.at] // 1000 + self.idle_ms)
        yield Row(queue=key[0], **dict(zip(self.schema.fieldNames(), best)))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _later(self, a: tuple | None, b: tuple) -> tuple:
        if a is None or b[self.at] > a[self.at]:
            return b
        if b[self.at] < a[self.at]:
            return a
        first, second = (b, a) if _or_least(b[self.tie]) > _or_least(a[self.tie]) else (a, b)
        return (*first[: self.tied], first[self.tied] + second[self.tied], *first[self.tied + 1 :])


def _or_least(value: Any) -> tuple:
    return (value is not None, value)


def newest_events(events: DataFrame, idle_after: timedelta | None = None) -> DataFrame:
    """The queues whose newest event changed, `latest` standing for all queues; a streaming DataFrame.

    Before the shuffle every task keeps one row per queue of each batch of rows, so a queue that gets
    a third of the events costs its task a row per ten thousand. The state is a row per queue in the
    state store and does not grow with the number of micro-batches; `newest_now` reads it. Events
    without a time are left out. With `idle_after` the newest time seen is the watermark.

    Adds queue and tied: the number of events that have the newest event's time.
    """
    numbered = events.filter(F.col(AT).isNotNull()).withColumns({c: F.unix_micros(c) for c in _times(events.schema)})
    kept = T.StructType([*numbered.schema.fields, T.StructField(TIED, T.LongType())])
    schema = T.StructType([T.StructField("queue", T.StringType()), *kept.fields])
    first = numbered.withColumn("queue", queue_of(F.col("action"))).mapInArrow(_newest_of_batch, schema)
    if idle_after is not None:
        first = first.withColumn("at", F.timestamp_micros(AT)).withWatermark("at", "0 seconds")
    changed = first.groupBy("queue").transformWithState(
        NewestEvent(kept, None if idle_after is None else int(idle_after / timedelta(milliseconds=1))),
        outputStructType=schema, outputMode="Update", timeMode="None" if idle_after is None else "EventTime",
    )
    return changed.withColumns({c: F.timestamp_micros(c) for c in _times(events.schema)})


def _times(schema: T.StructType) -> list[str]:
    """The columns that travel as microseconds, as Python's times depend on the worker's time zone."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)]


def _newest_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.Table.from_batches([batch]).sort_by([(AT, "descending"), (TIE, "descending")])
        names = [c for c in rows.column_names if c != "queue"]
        for queue in [*pc.unique(rows["queue"]).to_pylist(), GLOBAL_QUEUE] if rows.num_rows else []:
            mine = rows if queue == GLOBAL_QUEUE else rows.filter(pc.equal(rows["queue"], queue))
            if not mine.num_rows:
                continue
            tied = pc.sum(pc.equal(mine[AT], mine[AT][0])).as_py()
            head = mine.select(names).slice(0, 1).append_column(TIED, pa.array([tied], pa.int64()))
            yield from head.add_column(0, "queue", pa.array([queue])).to_batches()


def newest_now(spark: SparkSession, checkpoint: str, times: Sequence[str] = (AT,)) -> DataFrame:
    """The current state behind `newest_events`: (queue, its newest event, tied), from its checkpoint.

    `times` names the events' timestamp columns.
    """
    rows = spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint).select("key.queue", "value.*")
    return rows.withColumns({c: F.timestamp_micros(c) for c in times})

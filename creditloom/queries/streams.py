"""Streaming jobs over the events table, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.queries.decisions import DECISION
from creditloom.queries.monitoring import CHECK_NAME, CHECK_STATUS, categorical_psi_sql, numeric_psi_sql
from creditloom.queries.registry import query
from creditloom.session import materialize, shared_dir
from creditloom.sources import fixtures as fx
from creditloom.streaming import jobs, state

T = 0.08
PROBABILITY = "(event_id * 7919 % 1000) / 1000e0 * 0.2e0"


def event_stream(spark, sf_dir):
    schema = fx.table(spark, sf_dir, "events").schema
    events = jobs.read_stream(spark, f"{sf_dir}/event[s].parquet", schema)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def decide(events):
    scored = events.selectExpr("user_id", "ts", f"{PROBABILITY} AS probability")
    return jobs.triage_stream(scored, "user_id", "probability", T, F.col("ts"))


def decisions(spark, sf_dir):
    return decide(event_stream(spark, sf_dir))


# When an event arrives: in six-day batches, one in ten a batch later and one in fifty two batches later.
ARRIVAL = """CAST(least(5, greatest(0, floor(({seconds}) / 518400e0)) + CASE WHEN event_id % 10 = 3 THEN 1
  WHEN event_id % 50 = 7 THEN 2 ELSE 0 END) AS INT)"""
ARRIVED = ARRIVAL.format(seconds="unix_timestamp(ts) - 1704067200")
ARRIVED_SQL = ARRIVAL.format(seconds="floor(epoch(ts)) - 1704067200")


def arrivals(spark, sf_dir):
    """The events with the number of the batch they arrive in."""
    events = fx.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.withColumn("arrived", F.expr(ARRIVED))


TRIAGE_SQL = f"""SELECT 'credit_decision_triage' AS event_type, ts AS emitted_at, user_id AS client_id, probability,
  {DECISION} FROM (SELECT user_id, ts, {PROBABILITY} AS probability FROM events)"""


@query("triage_stream", f"SELECT *, action AS queue FROM ({TRIAGE_SQL})", "probability threshold")
def triage_stream(spark, sf_dir):
    base = shared_dir(spark, "triage")
    jobs.run_available(jobs.queue_sink(decisions(spark, sf_dir), f"{base}/queues"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/queues")


@query(
    "latest_per_queue",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY emitted_at DESC, client_id DESC) AS rn
          FROM (SELECT *, action AS queue FROM ({TRIAGE_SQL}) UNION ALL SELECT *, 'latest' FROM ({TRIAGE_SQL}))) WHERE rn = 1""",
    "probability threshold",
)
def latest_per_queue(spark, sf_dir):
    base = shared_dir(spark, "latest")
    jobs.replay(
        arrivals(spark, sf_dir), "arrived", f"{base}/source", f"{base}/checkpoint",
        lambda events: jobs.changes_only(state.newest_events(decide(events))),
    )
    return state.newest_now(spark, f"{base}/checkpoint").drop(state.TIED)


@query(
    "latest_ties",
    f"""SELECT queue, max(emitted_at) AS emitted_at, count(*) AS tied FROM (
          SELECT *, max(emitted_at) OVER (PARTITION BY queue) AS newest FROM (
            SELECT queue, date_trunc('day', emitted_at) AS emitted_at FROM (
              SELECT *, action AS queue FROM ({TRIAGE_SQL}) UNION ALL SELECT *, 'latest' FROM ({TRIAGE_SQL}))))
        WHERE emitted_at = newest GROUP BY 1""",
)
def latest_ties(spark, sf_dir):
    """Decisions emitted once a day: how many share each queue's newest time."""
    base = shared_dir(spark, "ties")
    jobs.replay(
        arrivals(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts")), "arrived", f"{base}/source", f"{base}/checkpoint",
        lambda events: jobs.changes_only(state.newest_events(decide(events))),
    )
    return state.newest_now(spark, f"{base}/checkpoint").select("queue", "emitted_at", "tied")


@query(
    "monitor_window",
    f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) FILTER (WHERE status = 'ok') AS ok,
          count(*) FILTER (WHERE status = 'warn') AS warn, count(*) FILTER (WHERE status = 'fail') AS fail, count(*) AS checks
        FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, lower({CHECK_STATUS}) AS status FROM events) GROUP BY 1""",
)
def monitor_window(spark, sf_dir):
    base = shared_dir(spark, "monitor")
    checks = event_stream(spark, sf_dir).selectExpr("ts", f"{CHECK_NAME} AS name", f"lower({CHECK_STATUS}) AS status")
    windows = jobs.monitor_window(checks, "ts", "status")
    jobs.run_available(jobs.upsert_sink(windows, f"{base}/rows"), f"{base}/checkpoint")
    return jobs.latest_rows(spark, f"{base}/rows", ["window_start", "window_end"])


@query(
    "fresh_only",
    """SELECT event_id, ts, event_type FROM events JOIN (
         SELECT event_type, min(ts) + INTERVAL 1 DAY * length(event_type) AS trained_at FROM events GROUP BY 1) USING (event_type)
       WHERE trained_at >= ts - INTERVAL 24 HOUR""",
)
def fresh_only(spark, sf_dir):
    base = shared_dir(spark, "fresh")
    runs = fx.table(spark, sf_dir, "events").groupBy("event_type").agg(F.min("ts").alias("first"))
    age = F.make_dt_interval(F.length("event_type"))
    runs = runs.select("event_type", (F.col("first") + age).alias("trained_at"))
    events = event_stream(spark, sf_dir).select("event_id", "ts", "event_type")
    fresh = jobs.fresh_only(events, runs, "event_type", "ts", "trained_at")
    jobs.run_available(jobs.append_sink(fresh, f"{base}/rows"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows").select("event_id", "ts", "event_type")


@query("dedupe_stream", "SELECT event_id, ts, user_id, value FROM events", "value")
def dedupe_stream(spark, sf_dir):
    """Every event arrives once, one in five twice."""
    base = shared_dir(spark, "dedupe")
    events = event_stream(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    again = event_stream(spark, sf_dir).select("event_id", "ts", "user_id", "value").filter("event_id % 5 = 0")
    once = jobs.dedupe_events(events.union(again), ["event_id"], "ts")
    jobs.run_available(jobs.append_sink(once, f"{base}/rows"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows")


@query(
    "monitor_closed_windows",
    f"""WITH a AS (SELECT *, {ARRIVED_SQL} AS arrived, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM events),
          marks AS (SELECT b AS arrived, (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM a WHERE a.arrived < b) AS mark
                    FROM (SELECT DISTINCT arrived AS b FROM a)),
          ends AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS last FROM a)
        SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) FILTER (WHERE lower({CHECK_STATUS}) = 'ok') AS ok,
          count(*) FILTER (WHERE lower({CHECK_STATUS}) = 'warn') AS warn, count(*) FILTER (WHERE lower({CHECK_STATUS}) = 'fail') AS fail,
          count(*) AS checks
        FROM a JOIN marks USING (arrived), ends
        WHERE (mark IS NULL OR window_start + INTERVAL 5 MINUTE > mark) AND window_start + INTERVAL 5 MINUTE <= last GROUP BY 1""",
)
def monitor_closed_windows(spark, sf_dir):
    """Windows that the watermark has closed, each written once; rows that come after that are dropped."""
    base = shared_dir(spark, "closed")

    def job(events):
        checks = events.selectExpr("ts", f"{CHECK_NAME} AS name", f"lower({CHECK_STATUS}) AS status")
        return jobs.append_sink(jobs.monitor_window(checks, "ts", "status", late_by="1 day"), f"{base}/rows")

    jobs.replay(arrivals(spark, sf_dir), "arrived", f"{base}/source", f"{base}/checkpoint", job)
    return spark.read.parquet(f"{base}/rows")


@query(
    "dedupe_late_stream",
    f"""WITH once AS (SELECT event_id, ts, user_id, value, {ARRIVED_SQL} AS arrived FROM events),
          a AS (SELECT * FROM once UNION ALL SELECT * REPLACE (least(5, arrived + 1) AS arrived) FROM once WHERE event_id % 5 = 0),
          marks AS (SELECT b AS arrived, (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM a WHERE a.arrived < b) AS mark
                    FROM (SELECT DISTINCT arrived AS b FROM a))
        SELECT DISTINCT event_id, ts, user_id, value FROM a JOIN marks USING (arrived) WHERE mark IS NULL OR ts > mark""",
    "value",
)
def dedupe_late_stream(spark, sf_dir):
    """One event in five arrives again a batch later; state ends with the watermark, later copies are late."""
    base = shared_dir(spark, "dedupe")
    events = arrivals(spark, sf_dir).select("event_id", "ts", "user_id", "value", "arrived")
    again = events.filter("event_id % 5 = 0").withColumn("arrived", F.least(F.lit(5), F.col("arrived") + 1))
    jobs.replay(
        events.union(again), "arrived", f"{base}/source", f"{base}/checkpoint",
        lambda rows: jobs.append_sink(jobs.dedupe_events(rows, ["event_id"], "ts", "1 day"), f"{base}/rows"),
    )
    return spark.read.parquet(f"{base}/rows")


HALF = "TIMESTAMP '2024-01-16 00:00:00'"
OLD, NEW = (f"(SELECT value AS v FROM events WHERE ts {op} {HALF})" for op in ("<", ">="))
OLD_TYPE, NEW_TYPE = (f"(SELECT event_type AS v FROM events WHERE ts {op} {HALF})" for op in ("<", ">="))


@query(
    "stream_psi",
    f"{numeric_psi_sql('value', OLD, NEW)} UNION ALL {categorical_psi_sql('event_type', OLD_TYPE, NEW_TYPE)}",
    "psi",
)
def stream_psi(spark, sf_dir):
    base = shared_dir(spark, "psi")
    half = F.lit("2024-01-16 00:00:00").cast("timestamp")
    reference = fx.table(spark, sf_dir, "events").filter(F.col("ts") < half).select("value", "event_type")
    incoming = event_stream(spark, sf_dir).filter(F.col("ts") >= half).select("value", "event_type")
    jobs.run_available(
        jobs.psi_sink(incoming, reference, ["value"], ["event_type"], f"{base}/rows"), f"{base}/checkpoint"
    )
    return jobs.latest_rows(spark, f"{base}/rows", ["feature"])


BATCHES = 4
WEEK = "CAST(least(3, floor((epoch(ts) - 1705363200) / 302400e0)) AS INT)"


def _of_batch(number: int) -> str:
    value, kind = (f"(SELECT {c} AS v FROM events WHERE ts >= {HALF} AND {WEEK} = {number})" for c in ("value", "event_type"))
    return f"""SELECT {number} AS batch, * FROM ({numeric_psi_sql('value', OLD, value)} UNION ALL
      {categorical_psi_sql('event_type', OLD_TYPE, kind)})"""


@query("stream_psi_batches", " UNION ALL ".join(map(_of_batch, range(BATCHES))), "psi")
def stream_psi_batches(spark, sf_dir):
    """The drift of every micro-batch against the reference that was counted when the stream was defined."""
    base = shared_dir(spark, "psi")
    half = F.lit("2024-01-16 00:00:00").cast("timestamp")
    events = fx.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    week = F.least(F.lit(BATCHES - 1), F.floor((F.unix_micros("ts") / 1e6 - 1705363200) / 302400)).cast("int")
    incoming = events.filter(F.col("ts") >= half).select("value", "event_type", week.alias("week"))
    reference = materialize(events.filter(F.col("ts") < half).select("value", "event_type"), "reference")
    jobs.replay(
        incoming, "week", f"{base}/source", f"{base}/checkpoint",
        lambda rows: jobs.psi_sink(rows, reference, ["value"], ["event_type"], f"{base}/rows"),
    )
    return spark.read.option("basePath", f"{base}/rows").parquet(f"{base}/rows")

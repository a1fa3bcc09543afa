from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from creditloom.operators.drift import psi_numeric
from creditloom.session import shared_dir
from creditloom.sources import latest_per_queue
from creditloom.streaming import jobs, state

START = datetime(2026, 1, 1)


@pytest.fixture()
def events(spark):
    """Six files with one event a minute, written one after another."""
    path = shared_dir(spark, "events")
    for part in range(6):
        rows = [(i, START + timedelta(minutes=i), i % 5, (i * 7 % 100) / 500) for i in range(part * 20, part * 20 + 20)]
        spark.createDataFrame(rows, "id long, ts timestamp, client long, p double").coalesce(1).write.mode("append").parquet(path)
    return path, spark.read.parquet(path)


def stream(spark, events, files=1):
    path, table = events
    return jobs.read_stream(spark, path, table.schema, files_per_batch=files)


def test_triage_stream_equals_batch(spark, events):
    base = shared_dir(spark, "out")
    triaged = jobs.triage_stream(stream(spark, events), "client", "p", 0.08, F.col("ts"))
    jobs.run_available(jobs.queue_sink(triaged, f"{base}/q"), f"{base}/c")
    out = spark.read.parquet(f"{base}/q")
    batch = jobs.triage_stream(events[1], "client", "p", 0.08, F.col("ts"))
    assert out.drop("queue").exceptAll(batch).isEmpty() and out.count() == batch.count() == 120
    # a second run finds nothing new
    jobs.run_available(jobs.queue_sink(triaged, f"{base}/q"), f"{base}/c")
    assert spark.read.parquet(f"{base}/q").count() == 120


def test_latest_per_queue_over_batches(spark, events):
    base = shared_dir(spark, "out")
    triaged = jobs.triage_stream(stream(spark, events), "client", "p", 0.08, F.col("ts"))
    jobs.run_available(jobs.upsert_sink(latest_per_queue(triaged), f"{base}/r"), f"{base}/c")
    got = {r["queue"]: r["emitted_at"] for r in jobs.latest_rows(spark, f"{base}/r", ["queue"]).collect()}
    batch = jobs.triage_stream(events[1], "client", "p", 0.08, F.col("ts"))
    want = {r["action"]: r["m"] for r in batch.groupBy("action").agg(F.max("emitted_at").alias("m")).collect()}
    assert got.pop("latest") == START + timedelta(minutes=119)
    assert got == want


def test_windows_over_batches(spark, events):
    base = shared_dir(spark, "out")
    checks = stream(spark, events, 2).withColumn("status", F.when(F.col("id") % 2 == 0, "ok").otherwise("fail"))
    windows = jobs.monitor_window(checks, "ts", "status")
    jobs.run_available(jobs.upsert_sink(windows, f"{base}/r"), f"{base}/c")
    rows = jobs.latest_rows(spark, f"{base}/r", ["window_start", "window_end"]).collect()
    assert len(rows) == 24 and {r["checks"] for r in rows} == {5} and sum(r["ok"] for r in rows) == 60


def test_dedupe_and_fresh(spark, events):
    base = shared_dir(spark, "out")
    twice = stream(spark, events, 6).union(stream(spark, events, 6))
    jobs.run_available(jobs.append_sink(jobs.dedupe_events(twice, ["id"], "ts"), f"{base}/d"), f"{base}/c")
    assert spark.read.parquet(f"{base}/d").count() == 120
    models = spark.createDataFrame([(0, START), (1, START - timedelta(hours=23))], "client long, trained_at timestamp")
    fresh = jobs.fresh_only(stream(spark, events), models, "client", "ts", "trained_at")
    jobs.run_available(jobs.append_sink(fresh, f"{base}/f"), f"{base}/c2")
    rows = spark.read.parquet(f"{base}/f").collect()
    assert {r["id"] for r in rows if r["client"] == 0} == set(range(0, 120, 5))
    assert {r["id"] for r in rows if r["client"] == 1} == {i for i in range(1, 120, 5) if i <= 60}


def test_psi_per_batch(spark, events):
    base = shared_dir(spark, "out")
    reference = events[1].select("p")
    incoming = stream(spark, events, 6).select("p")
    jobs.run_available(jobs.psi_sink(incoming, reference, ["p"], [], f"{base}/r"), f"{base}/c")
    got = jobs.latest_rows(spark, f"{base}/r", ["feature"]).first()["psi"]
    assert got == pytest.approx(psi_numeric(reference, reference, ["p"]).first()["psi"])


EVENT = "emitted_at timestamp, client_id long, action string, p double"


def emitted(spark, rows):
    return spark.createDataFrame([(START + timedelta(minutes=m), c, a, 0.5, b) for m, c, a, b in rows], f"{EVENT}, batch int")


def run_state(spark, rows, **options):
    base = shared_dir(spark, "state")

    jobs.replay(
        emitted(spark, rows), "batch", f"{base}/s", f"{base}/c", lambda e: jobs.changes_only(state.newest_events(e, **options))
    )
    return base, {r["queue"]: (r["emitted_at"], r["client_id"], r["tied"]) for r in state.newest_now(spark, f"{base}/c").collect()}


def test_newest_event_is_keyed_state(spark):
    a, b = "mesa_analise", "recusa_candidata"
    rows = [(1, 1, a, 0), (5, 2, a, 0), (5, 9, a, 0), (5, 4, a, 1), (4, 7, b, 1), (2, 8, b, 2), (5, 3, b, 3), (5, None, b, 3), (1, 5, a, 4)]
    base, got = run_state(spark, rows)
    at = START + timedelta(minutes=5)
    assert got == {a: (at, 9, 3), b: (at, 3, 2), "latest": (at, 9, 5)}
    # the state is one row a queue after five batches, and a later run goes on from it
    rows = spark.read.format("statestore").option("stateVarName", "newest").load(f"{base}/c")
    assert rows.count() == 3


def test_idle_queues_end(spark):
    a, b = "mesa_analise", "recusa_candidata"
    rows = [(0, 1, a, 0), (1, 2, b, 0), (30, 3, a, 1), (31, 4, a, 1), (100, 5, a, 2), (101, 6, a, 3)]
    _, got = run_state(spark, rows, idle_after=timedelta(minutes=40))
    assert set(got) == {a, "latest"} and got[a][1] == 6


def test_replay_drops_what_comes_after_the_watermark(spark):
    base = shared_dir(spark, "late")
    rows = [(0, 0), (3, 0), (20, 0), (21, 1), (4, 1), (12, 1), (60, 2), (22, 2), (9, 2), (61, 3)]
    table = spark.createDataFrame([(START + timedelta(minutes=m), "ok", b) for m, b in rows], "ts timestamp, status string, b int")

    def job(checks):
        return jobs.append_sink(jobs.monitor_window(checks, "ts", "status", "5 minutes", "10 minutes"), f"{base}/r")

    jobs.replay(table, "b", f"{base}/s", f"{base}/c", job)
    got = {int((r["window_start"] - START).total_seconds()) // 60: r["checks"] for r in spark.read.parquet(f"{base}/r").collect()}
    # batch 1 has watermark 10: minute 4 is late; batch 2 has 11: minutes 9 is late, 22 is not; 60 and 61 stay open
    assert got == {0: 2, 10: 1, 20: 3}


def test_replay_of_no_rows(spark):
    base = shared_dir(spark, "none")
    jobs.replay(emitted(spark, []), "batch", f"{base}/s", f"{base}/c", lambda e: jobs.changes_only(state.newest_events(e)))

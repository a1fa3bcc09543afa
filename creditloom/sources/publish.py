"""Stage, check, publish.

A table is written once, into a fresh folder of its attempt: a retry of a run never
touches rows that were published under the same run id. Publishing a run that passed its
checks appends one record to the table's publication log; readers follow the latest
record. So a failed run leaves the last good version in place and keeps its own folder
for inspection, nothing is copied, and a lost executor cannot leave a half-written
current version.

Records are numbered. A publisher claims the next number by creating its file, which the
file system refuses if another one did so first (HDFS does that atomically; a local disk
only looks before it creates); then it takes the next number. So of publishers at the same time
all are kept, and the highest number is current. A claim without a record, of a publisher that
died, is passed over. Attempts that no record names are removed once they are old.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.quality import FAIL, Check, QualityError, run_suite
from creditloom.sources.tables import write_table

LOG_SCHEMA = "run_id string, location string, published_at timestamp, passes int, warnings int, version long"
ORPHAN_AGE = timedelta(days=7)
"""More than any attempt needs from its first file to its record."""


def _safe(run_id: str) -> str:
    """A folder name; ids that it makes equal share a folder, in which every attempt has its own."""
    return "".join(c if c.isalnum() or c in "-_" else "_" for c in run_id)


def stage(df: DataFrame, path: str, run_id: str) -> str:
    """Write an attempt's version of the table and return its folder."""
    location = f"{path.rstrip('/')}/runs/{_safe(run_id)}/attempt={uuid.uuid4().hex}"
    write_table(df, location, mode="errorifexists")
    return location


def publish(spark: SparkSession, path: str, run_id: str, location: str, results: DataFrame) -> None:
    """Make a staged run current; refused when a check failed."""
    rows = results.collect()  # one row per check
    failures = [r["message"] for r in rows if r["level"] == FAIL]
    if failures:
        raise QualityError(rows[0]["stage"], failures)
    levels = [r["level"] for r in rows]
    _claim(spark, path, {
        "run_id": run_id, "location": location, "published_at": datetime.now(timezone.utc).isoformat(),
        "passes": levels.count("PASS"), "warnings": levels.count("WARNING"),
    })


def _folder(spark: SparkSession, path: str):
    """The file system and the Hadoop path of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _listed(files, folder) -> list:
    return list(files.listStatus(folder)) if files.exists(folder) else []


def _claim(spark: SparkSession, path: str, record: dict, version: int | None = None) -> int:
    """Write a record under the first free number from `version` on, by default after the last."""
    log = f"{path.rstrip('/')}/published"
    files, folder = _folder(spark, log)
    files.mkdirs(folder)
    if version is None:
        names = [status.getPath().getName() for status in _listed(files, folder)]
        taken = [int(n[1:-5]) for n in names if n[0] == "v" and n.endswith(".json") and n[1:-5].isdigit()]
        version = max(taken, default=0) + 1
    while True:
        try:
            out = files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{log}/v{version:012d}.json"), False)
            break
        except Py4JJavaError as error:
            if not error.java_exception.getClass().getSimpleName().startswith("FileAlreadyExists"):
                raise
            version += 1
    try:
        out.write(bytearray(json.dumps(record | {"version": version}).encode()))
    finally:
        out.close()
    return version


def remove_orphans(spark: SparkSession, path: str, older_than: timedelta = ORPHAN_AGE) -> list[str]:
    """Delete the attempts that no record names and that were last written before that age; returns them.

    What a record names stays, so readers of any published version are not disturbed.
    """
    named = {r["location"].rstrip("/").split("/")[-1] for r in published_runs(spark, path).select("location").collect()}
    oldest = (time.time() - older_than.total_seconds()) * 1000
    files, runs = _folder(spark, f"{path.rstrip('/')}/runs")
    removed = []
    for run in _listed(files, runs):
        for attempt in _listed(files, run.getPath()):
            if attempt.getPath().getName() not in named and attempt.getModificationTime() < oldest:
                files.delete(attempt.getPath(), True)
                removed.append(attempt.getPath().toString())
    return removed


def publish_if_valid(
    df: DataFrame,
    stage_name: str,
    checks: Callable[[DataFrame], Sequence[Check]],
    path: str,
    run_id: str,
    orphan_age: timedelta = ORPHAN_AGE,
) -> DataFrame:
    """Write, re-read and check the written rows, then publish; returns the check rows.

    A run that is published also removes the attempts that no record names and that are older than `orphan_age`.
    """
    spark = df.sparkSession
    location = stage(df, path, run_id)
    written = spark.read.parquet(location)
    results = run_suite(written, stage_name, checks(written))
    rows = spark.createDataFrame(results.collect(), results.schema)  # checks run once
    publish(spark, path, run_id, location, rows)
    remove_orphans(spark, path, orphan_age)
    return rows


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; claims without a record have none."""
    return spark.read.schema(LOG_SCHEMA).json(f"{path.rstrip('/')}/published").where("location IS NOT NULL")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The latest published version of a table."""
    latest = published_runs(spark, path).agg(F.max_by("location", F.struct(F.coalesce("version", F.lit(0)), "published_at")).alias("at")).first()
    if latest["at"] is None:
        raise FileNotFoundError(f"nothing published at {path}")
    return spark.read.parquet(latest["at"])

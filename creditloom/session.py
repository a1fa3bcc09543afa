"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int = 8, app: str = "creditloom", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    The folder is the one the session names; only a local session without the
    setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="creditloom-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return f"{base.rstrip('/')}/creditloom/{purpose}-{uuid.uuid4().hex}"


_recorders: list[list[str]] = []


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several jobs read, and go on from the written copy.

    Unlike a cached block, the files survive the loss of an executor.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    for folders in _recorders:
        folders.append(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that `materialize` writes inside the block, for `remove` once nothing reads them."""
    folders: list[str] = []
    _recorders.append(folders)
    try:
        yield folders
    finally:
        _recorders.remove(folders)


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete written intermediate tables, and let Spark drop the shuffle files of results that are gone."""
    if not folders:
        return
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = path_of(folder)
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()

"""Landing-zone audit against the manifest of expected files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of the files under a folder; contents are not read.

    A scan skips empty files, so the names come from the file index the scan planned with.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "path string").select(name)
    sizes = files.select(name, "length")
    return names.join(sizes, "file", "left").select("file", F.coalesce("length", F.lit(0)).alias("length"))


def audit_landing(spark: SparkSession, manifest: Sequence[str], path: str) -> DataFrame:
    """(file, problem) rows: expected files that are missing, then files that are empty."""
    expected = spark.createDataFrame([(name,) for name in manifest], "file string")
    found = landed_files(spark, path)
    missing = expected.join(found, "file", "left_anti").select("file", F.lit("missing").alias("problem"))
    empty = found.filter("length = 0").select("file", F.lit("empty").alias("problem"))
    return missing.unionByName(empty).orderBy(F.col("problem").desc(), "file")


def require_landed(spark: SparkSession, manifest: Sequence[str], path: str) -> None:
    """Stop when an expected file is missing."""
    missing = audit_landing(spark, manifest, path).filter("problem = 'missing'").collect()
    if missing:
        raise FileNotFoundError(f"expected files missing: {', '.join(r['file'] for r in missing)}")

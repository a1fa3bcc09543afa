"""Table scans and writes: CSV with header, Parquet, the latin-1 column dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions import nan_to_null
from creditloom.operators.joins import first_by_position


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere downstream; NaN is folded into it at the scan."""
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in fractional}) if fractional else df


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """Header CSV. Give a schema at scale; without one Spark reads the file twice to infer it."""
    reader = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("nullValue", "")
        .option("nanValue", "NaN")
        .option("escape", '"')
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_columns_to_null(reader.csv(path))


def read_parquet_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet on any Hadoop file system; only the wanted columns reach the scan."""
    df = spark.read.parquet(path)
    return nan_columns_to_null(df.select(*columns) if columns else df)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(column, table, description, special): one row per described column.

    The last row of an application table wins, otherwise the first row seen. The order of rows is
    that of files by name, of blocks in a file, and of rows in a block, however the files are split.
    """
    raw = read_csv_table(spark, path, "Table string, Row string, Description string, Special string", "ISO-8859-1")
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return dictionary_rows(raw.withColumn("position", place))


def dictionary_rows(raw: DataFrame) -> DataFrame:
    """Resolve (Table, Row, Description, Special, position) rows to one per column."""
    rows = raw.select(
        F.trim("Row").alias("column"),
        F.trim("Table").alias("table"),
        F.trim("Description").alias("description"),
        F.coalesce(F.trim("Special"), F.lit("")).alias("special"),
        "position",
    )
    chosen = first_by_position(rows, "column", F.col("table").contains("application_"), "position")
    return chosen.select("column", "table", "description", "special")


def write_table(df: DataFrame, path: str, schema: T.StructType | None = None, mode: str = "overwrite") -> None:
    """Parquet write, cast to a fixed schema when one is given."""
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    df.write.mode(mode).option("compression", "snappy").parquet(path)

"""Catalog of a modelling table's columns: statistics, category, source, description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.cleaning import numeric_columns
from creditloom.operators.features import DROP_COLUMNS

# Name prefix -> source of an aggregated feature.
PREFIX_SOURCES = {
    "BUREAU_": "bureau.csv",
    "BB_": "bureau_balance.csv",
    "POS_": "POS_CASH_balance.csv",
    "CC_": "credit_card_balance.csv",
    "PREV_": "previous_application.csv",
    "INST_": "installments_payments.csv",
    "HAS_": "features Gold",
}
DERIVED = (
    "AGE_YEARS",
    "FLAG_EMPLOYED",
    "EXT_SOURCE_MEAN",
    "EXT_SOURCE_CNT",
    "CREDIT_INCOME_RATIO",
    "ANNUITY_INCOME_RATIO",
    "LOG_AMT_CREDIT",
    "DAYS_EMPLOYED_YEARS",
)
ENGINEERED = "feature engineering Gold"


def column_statistics(df: DataFrame) -> DataFrame:
    """(column, rows, nulls, distinct_values, min/max as number or text).

    Counts and ranges come from one aggregate. Distinct values are counted over
    (column, value) rows, which merge in each task before the shuffle.
    """
    numbers = set(numeric_columns(df))
    rows = []
    for c in df.columns:
        as_number = c in numbers
        number = F.col(c).cast("double") if as_number else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if as_number else F.col(c).cast("string")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("rows"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.min(number).alias("min_number"),
                F.max(number).alias("max_number"),
                F.min(text).alias("min_text"),
                F.max(text).alias("max_text"),
            )
        )
    stats = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    distinct = (
        texts.unpivot([], list(df.columns), "column", "value")
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count("*").alias("distinct_values"))
    )
    return stats.join(distinct, "column", "left").fillna(0, subset=["distinct_values"])


def _category(name: Column, described: Column) -> Column:
    aggregated = F.lit(False)
    for prefix in PREFIX_SOURCES:
        aggregated = aggregated | name.startswith(prefix)
    flag_missing = name.startswith("FLAG_EXT_SOURCE_") & name.endswith("_MISSING")
    return (
        F.when(name == "SK_ID_CURR", "Identificador")
        .when(name == "TARGET", "Alvo")
        .when(name.isin(*DERIVED) | flag_missing, "Derivada")
        .when(name.startswith("FLAG_") | name.startswith("HAS_"), "Indicador")
        .when(described, "Raw Kaggle")
        .when(aggregated, "Agregado")
        .otherwise("Derivada")
    )


def _source(name: Column, table: Column) -> Column:
    out = F.lit(ENGINEERED)
    for prefix, source in reversed(PREFIX_SOURCES.items()):
        out = F.when(name.startswith(prefix), source).otherwise(out)
    return F.coalesce(table, out)


def table_catalog(
    df: DataFrame,
    dictionary: DataFrame | None = None,
    editable: Sequence[str] = (),
    categorical: Sequence[str] = (),
    drop: Sequence[str] = DROP_COLUMNS,
) -> DataFrame:
    """One row per column: position, type, category, source, description, flags, statistics.

    `dictionary` has (column, table, description), one row per column.
    """
    spark = df.sparkSession
    schema = spark.createDataFrame(
        [(f.name, i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)],
        "column string, position int, type string",
    )
    out = column_statistics(df).join(F.broadcast(schema), "column")  # one row per column: bounded
    if dictionary is None:
        out = out.withColumns({"table": F.lit(None).cast("string"), "description": F.lit(None).cast("string")})
    else:
        out = out.join(dictionary.select("column", "table", "description"), "column", "left")
    name = F.col("column")
    return out.select(
        "position",
        "column",
        "type",
        _category(name, F.col("table").isNotNull()).alias("category"),
        _source(name, F.col("table")).alias("source"),
        F.coalesce("description", name).alias("description"),
        (~name.isin(*drop)).alias("in_model"),
        name.isin(list(editable)).alias("editable"),
        name.isin(list(categorical)).alias("categorical"),
        "rows",
        "nulls",
        "distinct_values",
        "min_number",
        "max_number",
        "min_text",
        "max_text",
    )

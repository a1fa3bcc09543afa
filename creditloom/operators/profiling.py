"""Profiles of raw tables: nulls, keys, rule violations, foreign keys, rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions import flag, safe_ratio
from creditloom.operators.aggregates import rate_by_group, value_counts
from creditloom.operators.joins import orphans
from creditloom.operators.ordering import fixed_bands, quantile_bands


def _missing(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        return F.col(col).isNull() | F.isnan(col)
    return F.col(col).isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls, their count and percentage, worst first; one scan."""
    n = F.count("*")
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(_missing(df, c)).alias("nulls"),
            safe_ratio(F.count_if(_missing(df, c)) * 100, n).alias("pct"),
        )
        for c in df.columns
    ]
    return (
        df.agg(F.array(*rows).alias("rows"))
        .select(F.inline("rows"))
        .filter("nulls > 0")
        .orderBy(F.col("nulls").desc(), "column")
    )


def key_profile(df: DataFrame, key: Sequence[str], parent: str | None = None) -> DataFrame:
    """Rows, distinct keys, repeated rows and, for a parent column, rows per parent."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    out = per_key.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("keys"),
        F.sum(F.col("n") - 1).alias("duplicates"),
    )
    if parent:
        parents = df.agg(F.count_distinct(parent).alias("parents")).scalar()
        out = out.withColumn("avg_per_parent", safe_ratio(F.col("rows"), parents))
    return out


def violation_profile(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, with their percentage; one scan."""
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count_if(rule).alias("rows"),
            safe_ratio(F.count_if(rule) * 100, F.count("*")).alias("pct"),
        )
        for name, rule in rules.items()
    ]
    return df.agg(F.array(*rows).alias("rules")).select(F.inline("rules"))


def anomaly_rate_by_flag(df: DataFrame, anomaly: Column, target: str) -> DataFrame:
    return rate_by_group(df.withColumn("anomaly", flag(anomaly)), "anomaly", target)


def category_profile(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return value_counts(rows, col, normalize=True, keep_null=True)


def fk_profile(links: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Distinct child keys and orphans for each (child, child key, parent, parent key)."""
    parts = []
    for name, (child, child_key, parent, parent_key) in links.items():
        lost = orphans(child, child_key, parent, parent_key).agg(F.count("*").alias("n")).scalar()
        parts.append(
            child.agg(F.count_distinct(child_key).alias("child_keys")).select(
                F.lit(name).alias("link"), "child_keys", lost.alias("orphans")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def conditional_null_profile(df: DataFrame, conditions: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """Rows meeting a condition and, among them, rows where a column is null."""
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count_if(condition).alias("rows"),
            F.count_if(condition & F.col(col).isNull()).alias("nulls"),
        )
        for name, (condition, col) in conditions.items()
    ]
    return df.agg(F.array(*rows).alias("rules")).select(F.inline("rules"))


def amount_gap(df: DataFrame, asked: str, granted: str) -> DataFrame:
    """Mean of asked minus granted and the share of rows granted nothing."""
    return df.agg(
        F.avg(F.col(asked) - F.col(granted)).alias("mean_gap"),
        F.avg(flag(F.col(granted) == 0).cast("double")).alias("share_nothing"),
    )


def binned_rate(df: DataFrame, col: str, target: str, bins: int = 10) -> DataFrame:
    """Target rate per quantile band of a column."""
    banded = quantile_bands(df, col, bins)
    return banded.groupBy("band", "band_lo", "band_hi").agg(
        F.avg(target).alias("rate"), F.count("*").alias("n")
    )


def age_rate(df: DataFrame, age: str, target: str) -> DataFrame:
    """Target rate per five-year age band."""
    return (
        fixed_bands(df, age)
        .filter("band_lo IS NOT NULL")
        .groupBy("band_lo", "band_hi")
        .agg(F.avg(target).alias("rate"), F.count("*").alias("n"))
    )

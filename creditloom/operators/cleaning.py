"""Cleaning rules: each takes a table and returns it with the rule applied.

Rules are tolerant: one that names an absent column leaves the table unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions import cap_above, floor_below, null_when, parse_money, strip_upper, to_number
from creditloom.operators.ordering import quantile_values

# Fixed values of the domain.
EMPLOYED_SENTINEL = 365243
HORIZON_DAYS = 18250
STATUS_DOMAIN = ("C", "X", "0", "1", "2", "3", "4", "5")


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _rewrite(df: DataFrame, cols: Iterable[str], rule: Callable[[Column], Column]) -> DataFrame:
    changed = {c: rule(F.col(c)).cast(df.schema[c].dataType) for c in present(df, cols)}
    return df.withColumns(changed) if changed else df


def standardize_strings(df: DataFrame) -> DataFrame:
    return _rewrite(df, text_columns(df), strip_upper)


def null_if(df: DataFrame, col: str, condition: Callable[[Column], Column]) -> DataFrame:
    return _rewrite(df, [col], lambda c: null_when(c, condition(c)))


def null_unless(df: DataFrame, col: str, other: str, value: str) -> DataFrame:
    """Empty `col` on rows where `other` equals `value`."""
    if other not in df.columns:
        return df
    return null_if(df, col, lambda _: F.col(other) == value)


def sentinel_flag(df: DataFrame, col: str, sentinel: int, name: str) -> DataFrame:
    """0 for the sentinel, 1 for any other value, NULL when missing."""
    if col not in df.columns:
        return df
    source = F.col(col)
    return df.withColumn(name, F.when(source == sentinel, 0).when(source.isNotNull(), 1))


def age_years(df: DataFrame, col: str, name: str = "AGE_YEARS") -> DataFrame:
    if col not in df.columns:
        return df
    return df.withColumn(name, F.floor(F.abs(F.col(col)) / F.lit(365.0)).cast("int"))


def null_future(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return _rewrite(df, cols, lambda c: null_when(c, c > 0))


def null_beyond_horizon(df: DataFrame, cols: Iterable[str], horizon: int = HORIZON_DAYS) -> DataFrame:
    return _rewrite(
        df, cols, lambda c: null_when(c, (c == EMPLOYED_SENTINEL) | (c > horizon))
    )


def cap_upper(df: DataFrame, cols: Iterable[str], limit: float = 0) -> DataFrame:
    return _rewrite(df, cols, lambda c: cap_above(c, limit))


def floor_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    numeric = set(numeric_columns(df))
    return _rewrite(df, [c for c in cols if c in numeric], lambda c: floor_below(c, 0))


def cap_percentile(df: DataFrame, cols: Sequence[str], percent: float = 99.9) -> DataFrame:
    """Clip each column at its own exact percentile.

    Finding the percentiles runs jobs over these columns, all together; a column without
    any number keeps its values.
    """
    names = present(df, cols)
    if not names:
        return df
    numbers = df.select(*[to_number(F.col(c)).alias(c) for c in names])
    caps = quantile_values(numbers, names, [percent / 100.0])
    return df.withColumns({c: cap_above(to_number(F.col(c)), F.lit(cap)) for c, (cap,) in caps.items()})


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    names = present(df, cols)
    return df.fillna(0, subset=names) if names else df


def restrict_domain(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return _rewrite(df, [col], lambda c: F.when(c.isin(*values), c))


def days_late(df: DataFrame) -> DataFrame:
    if not {"DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT"} <= set(df.columns):
        return df
    return df.withColumn("DIAS_DE_ATRASO", F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; equal rows merge in each task before the shuffle."""
    return df.dropDuplicates()


def dedupe_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, parts: int | None = None
) -> DataFrame:
    """First row per key in the given order, by default that of all other columns.

    A distributed table has no file order, so "first" needs an explicit one.

    Spark keeps one row per key in each task before shuffling, so a key with very many
    copies does not gather in one task. For that it sorts a scan's whole split, and later what it
    merged into one part by packed bytes. With `parts`, rows are dealt into that many parts by key
    instead, and equal rows merge as they arrive, so a task sorts only the different rows of its part.
    """
    if not set(keys) <= set(df.columns):
        return df
    if parts:
        df = df.repartition(parts, *keys).dropDuplicates()
    order = order or [c for c in df.columns if c not in keys] or keys
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__row", F.row_number().over(first)).filter("__row = 1").drop("__row")


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stop on an empty table or a null key before a keyed load."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    seen = df.agg(F.count("*").alias("n"), F.count_if(missing).alias("bad")).first()
    if seen["n"] == 0:
        raise ValueError("table is empty")
    if seen["bad"]:
        raise ValueError(f"{seen['bad']} rows have a null key in {list(keys)}")
    return df


def money_column(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.withColumn(name, parse_money(F.col(col)))


def within_bounds(overrides: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Add (parsed, accepted) to (client, feature, value) rows.

    Only bounded features are kept; a value must be a number inside its limits. The
    bounds are a handful of parameters, so they become literals and nothing is joined.
    """
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for feature, (lo, hi) in bounds.items():
        is_it = F.col("feature") == feature
        low = F.when(is_it, F.lit(lo)).otherwise(low)
        high = F.when(is_it, F.lit(hi)).otherwise(high)
    number = to_number(F.replace(F.trim("value"), F.lit(","), F.lit(".")))
    return (
        overrides.filter(F.col("feature").isin(*bounds))
        .withColumn("parsed", number)
        .withColumn("accepted", F.coalesce(F.col("parsed").between(low, high), F.lit(False)))
    )

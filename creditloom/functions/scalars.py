"""Null-safe column expressions shared by all operators.

The data model treats NULL and NaN as one "missing" value: a comparison with a
missing value is false, a sum over nothing is 0, and clipping keeps it missing.
Spark's `least`, `greatest`, `sum` and ANSI division behave differently, so the
rules live here once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

OUTER_SPACE = r"(?U)^\s+|\s+$"
DECIMAL_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def null_when(value: Column, condition: Column) -> Column:
    """NULL where the condition holds; an unknown condition keeps the value."""
    return F.when(~F.coalesce(condition, F.lit(False)), value)


def cap_above(value: Column, limit: Column | float) -> Column:
    return F.when(value > limit, limit).otherwise(value)


def floor_below(value: Column, limit: Column | float) -> Column:
    return F.when(value < limit, limit).otherwise(value)


def flag(condition: Column) -> Column:
    """1/0 for a condition, 0 when it is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def fill_flag(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("int")


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; a zero denominator gives NULL instead of an error."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def is_infinite(value: Column) -> Column:
    return F.abs(value.cast("double")) == F.lit(float("inf"))


def row_count(values: Iterable[Column]) -> Column:
    """Number of non-null values across columns."""
    total = F.lit(0)
    for value in values:
        total = total + value.isNotNull().cast("int")
    return total


def row_mean(values: Iterable[Column]) -> Column:
    """Mean across columns that skips nulls; NULL when all are null."""
    values = list(values)
    total = F.lit(0.0)
    for value in values:
        total = total + F.coalesce(value.cast("double"), F.lit(0.0))
    return safe_ratio(total, row_count(values))


def strip_upper(text: Column) -> Column:
    """Trim any white space, upper-case, and turn an empty text into NULL."""
    return F.nullif(F.upper(F.regexp_replace(text, OUTER_SPACE, "")), F.lit(""))


def to_number(value: Column) -> Column:
    """Double or NULL; never an error."""
    return nan_to_null(value.try_cast("double"))


def parse_money(text: Column) -> Column:
    """`R$ 1.250,50` -> 1250.5; unreadable text -> NULL.

    With both separators the dot groups thousands; a lone comma is the decimal mark.
    """
    raw = F.regexp_replace(text, OUTER_SPACE, "")
    bare = F.replace(F.replace(raw, F.lit("R$"), F.lit("")), F.lit(" "), F.lit(""))
    no_groups = F.when(
        bare.contains(",") & bare.contains("."), F.replace(bare, F.lit("."), F.lit(""))
    ).otherwise(bare)
    number = F.replace(no_groups, F.lit(","), F.lit("."))
    return F.when(number.rlike(DECIMAL_TEXT), number.try_cast("double"))


def normal_token(value: Column, numeric: bool = False) -> Column:
    """Comparable token: whole-number text for numbers, lower-case words for text."""
    if numeric:
        return value.cast("double").cast("bigint").cast("string")
    return F.trim(F.regexp_replace(F.lower(value), r"[^a-z0-9]+", " "))


def parse_utc(text: Column) -> Column:
    """ISO-8601 text -> timestamp; a naive time counts as UTC, bad text -> NULL."""
    bare = F.regexp_replace(text, OUTER_SPACE, "")
    zoned = bare.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(
        bare.rlike(r"^\d{4}-\d{2}-\d{2}"),
        F.when(zoned, bare.try_cast("timestamp")).otherwise(
            F.concat(
                F.when(F.length(bare) == 10, F.concat(bare, F.lit("T00:00:00"))).otherwise(bare),
                F.lit("Z"),
            ).try_cast("timestamp")
        ),
    )


def is_fresh(moment: Column, now: Column, hours: float = 24.0) -> Column:
    """True when the moment is no older than the window; a missing moment is not fresh."""
    age_limit = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0))
    return F.coalesce(moment >= now - age_limit, F.lit(False))

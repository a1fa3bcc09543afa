"""Data-quality checks.

A check is a counter plus a rule on it. All counters of a table are computed in one
aggregate, so a suite costs one scan however many checks it has; key uniqueness adds
one grouped count. Every check is evaluated before anything is raised.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions import is_infinite, strip_upper
from creditloom.operators.cleaning import with_prefix
from creditloom.operators.joins import outside_universe, unequal_after_align
from creditloom.operators.ordering import quantile_values

PASS, FAIL, WARNING, INFO = "PASS", "FAIL", "WARNING", "INFO"
RESULT_COLUMNS = ("stage", "check", "level", "message", "observed")


class QualityError(RuntimeError):
    """All failed checks of a stage."""

    def __init__(self, stage: str, failures: Sequence[str]) -> None:
        self.stage, self.failures = stage, list(failures)
        super().__init__(f"quality checks failed for {stage}: {'; '.join(failures)}")


@dataclass(frozen=True)
class Check:
    """`observed` is an aggregate; `passes` turns it into a condition.

    `level` overrides the outcome (WARNING, INFO). `report_if` leaves the row out of the
    report when false, for information that only matters when something was counted.
    `source` replaces the suite's table by a one-row table with column `observed`.
    """

    name: str
    observed: Column | None = None
    passes: Callable[[Column], Column] = lambda seen: seen == 0
    level: str | None = None
    report_if: Callable[[Column], Column] | None = None
    source: DataFrame | None = None


def _either(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def row_count_equals(n: int | Column, name: str = "row_count") -> Check:
    return Check(name, F.count("*"), lambda seen: seen == n)


def no_rows_where(name: str, *conditions: Column) -> Check:
    """No violation; violations of several conditions add up, unknown is no violation."""
    return Check(name, reduce(lambda a, b: a + b, [F.count_if(c) for c in conditions]))


def not_all_null(col: str) -> Check:
    return Check(f"{col}_filled", F.count(col), lambda seen: seen > 0)


def upper_trimmed(col: str) -> Check:
    return Check(f"{col}_upper_trimmed", F.count_if(~F.col(col).eqNullSafe(strip_upper(F.col(col)))))


def in_domain(col: str, values: Sequence) -> Check:
    return Check(f"{col}_domain", F.count_if(~F.col(col).isin(*values)))


def capped(df: DataFrame, col: str, q: float = 0.999, slack: float = 1.001) -> Check:
    found = quantile_values(df, [col], [q])
    limit = found[col][0] * slack if col in found else None
    return Check(f"{col}_capped", F.count_if(F.col(col) > F.lit(limit)))


def no_nulls(col: str) -> Check:
    return Check(f"{col}_no_nulls", F.count_if(F.col(col).isNull()))


def prefix_rule(df: DataFrame, prefix: str, name: str, *rules: Callable[[Column], Column]) -> Check:
    """Violations of the rules over every column with the prefix."""
    cols = with_prefix(df, prefix)
    if not cols:
        return absent(f"{prefix}*")
    return no_rows_where(name, *[rule(F.col(c)) for c in cols for rule in rules])


def absent(name: str) -> Check:
    return Check(f"{name}_present", F.lit(0.0), level=WARNING)


def warn_if_absent(df: DataFrame, needs: Sequence[str], check: Callable[[], Check]) -> Check:
    """The check, or a WARNING when one of its columns is absent."""
    if set(needs) <= set(df.columns):
        return check()
    return absent("/".join(needs))


def unit_interval(col: str) -> Check:
    return Check(f"{col}_unit_interval", F.count_if(~F.col(col).between(0, 1)))


def no_infinite(df: DataFrame, name: str = "no_infinite", cols: Sequence[str] | None = None) -> Check:
    """No infinite value in the given columns, by default in all fractional ones."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not cols:
        return Check(name, F.lit(0.0))
    return no_rows_where(name, *[is_infinite(F.col(c)) for c in cols])


def n_classes(col: str, n: int) -> Check:
    return Check(f"{col}_classes", F.count_distinct(col), lambda seen: seen == n)


def all_rows(name: str, *conditions: Column) -> Check:
    """Every row must satisfy every condition; unknown is a violation."""
    bad = _either([~F.coalesce(c, F.lit(False)) for c in conditions])
    return Check(name, F.count_if(bad))


def sum_of_parts_le_total(name: str, parts: Sequence[str], total: str) -> Check:
    whole = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    return all_rows(name, whole <= F.col(total))


def info_count(name: str, condition: Column) -> Check:
    return Check(name, F.count_if(condition), level=INFO, report_if=lambda seen: seen > 0)


def info_null_rate(col: str) -> Check:
    return Check(f"{col}_null_rate", F.avg(F.col(col).isNull().cast("double")), level=INFO)


def info_mean(col: str, name: str) -> Check:
    return Check(name, F.avg(col), level=INFO)


def rate_between(col: str, low: float, high: float) -> Check:
    return Check(f"{col}_rate", F.avg(col), lambda seen: (seen > low) & (seen < high))


def flag_implies(flag: str, col: str) -> list[Check]:
    """Flag 1 needs a value, flag 0 needs none."""
    return [
        no_rows_where(f"{flag}_1_implies_{col}", (F.col(flag) == 1) & F.col(col).isNull()),
        no_rows_where(f"{flag}_0_implies_no_{col}", (F.col(flag) == 0) & F.col(col).isNotNull()),
    ]


def no_duplicate_columns(df: DataFrame) -> Check:
    extra = len(df.columns) - len(set(df.columns))
    return Check("no_duplicate_columns", F.lit(float(extra)))


def unique_key(df: DataFrame, keys: Sequence[str]) -> Check:
    """Rows beyond the first per key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    extra = counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double").alias("observed"))
    return Check(f"unique_{'_'.join(keys)}", source=extra)


def keys_in_universe(df: DataFrame, universe: DataFrame, key: str) -> Check:
    strays = outside_universe(df, universe, key).agg(F.count("*").cast("double").alias("observed"))
    return Check(f"{key}_in_universe", source=strays)


def column_unchanged(df: DataFrame, original: DataFrame, key: str, col: str) -> Check:
    diff = unequal_after_align(df, original, key, col).agg(F.count("*").cast("double").alias("observed"))
    return Check(f"{col}_unchanged", source=diff)


def require_columns(df: DataFrame, stage: str, needed: Sequence[str]) -> DataFrame:
    """Contract check on the schema alone; blocking."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise QualityError(stage, [f"columns absent: {', '.join(missing)}"])
    return df


def _result_row(stage: str, check: Check, seen: Column) -> Column:
    if check.level:
        level = F.lit(check.level)
    else:
        passed = F.coalesce(check.passes(seen), F.lit(False))
        level = F.when(passed, F.lit(PASS)).otherwise(F.lit(FAIL))
    return F.struct(
        F.lit(stage).alias("stage"),
        F.lit(check.name).alias("check"),
        level.alias("level"),
        F.concat(
            F.lit(f"{check.name}: "),
            F.coalesce(F.format_string("%.4f", F.round(seen, 4)), F.lit("none")),
        ).alias("message"),
        seen.alias("observed"),
        (check.report_if(seen) if check.report_if else F.lit(True)).alias("__shown"),
    )


def run_suite(df: DataFrame, stage: str, checks: Sequence[Check]) -> DataFrame:
    """(stage, check, level, message, observed) rows of all checks."""
    inline = [c for c in checks if c.source is None]
    parts = []
    if inline:
        counters = df.agg(*[c.observed.cast("double").alias(f"c{i}") for i, c in enumerate(inline)])
        rows = [_result_row(stage, c, F.col(f"c{i}")) for i, c in enumerate(inline)]
        parts.append(counters.select(F.inline(F.array(*rows))))
    for check in checks:
        if check.source is not None:
            row = _result_row(stage, check, F.col("observed"))
            parts.append(check.source.select(F.inline(F.array(row))))
    return reduce(DataFrame.unionByName, parts).filter("__shown").select(*RESULT_COLUMNS)


def raise_on_failure(results: DataFrame) -> DataFrame:
    """Raise with every failure of the report; the report has one row per check."""
    rows = results.collect()
    failures = [r["message"] for r in rows if r["level"] == FAIL]
    if failures:
        raise QualityError(rows[0]["stage"], failures)
    return results


def load_summary(df: DataFrame, key: str = "SK_ID_CURR", target: str = "TARGET") -> DataFrame:
    """Rows, repeated keys, target rate and infinities; an absent target blocks."""
    if target not in df.columns:
        raise QualityError("load", [f"{target} absent"])
    infinite = no_infinite(df).observed
    repeats = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1).alias("repeats"))
    return df.agg(
        F.count("*").alias("rows"),
        F.avg(target).alias("target_rate"),
        infinite.cast("bigint").alias("infinities"),
    ).withColumn("duplicate_ids", F.coalesce(repeats.scalar(), F.lit(0)))

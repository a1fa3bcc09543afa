"""Grouped and whole-table aggregates.

Aggregates merge inside each task before the shuffle, so a key that owns a large
share of the rows reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import safe_ratio, sum_or_zero
from creditloom.operators.ordering import exact_quantiles, long_values, quantile_values

FUNCTIONS = {
    "count": F.count,
    "sum": sum_or_zero,
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "nunique": F.count_distinct,
    "count_where": F.count_if,
}

# One Spark aggregate stays below this many expressions; wider requests take more scans.
PAIRS_PER_SCAN = 200


def named_agg(
    df: DataFrame,
    keys: Sequence[str],
    aggregations: Mapping[str, tuple[str | Column, str]],
    keep_null_keys: bool = False,
) -> DataFrame:
    """`out=(input, function)` aggregates; rows with a null key are left out by default.

    The input is a column or an SQL expression; `count_where` counts the rows where a
    condition holds, an unknown condition not counting.
    """
    if not keep_null_keys:
        df = df.dropna(subset=list(keys))
    exprs = []
    for out, (source, function) in aggregations.items():
        value = F.expr(source) if isinstance(source, str) else source
        exprs.append(FUNCTIONS[function](value).alias(out))
    return df.groupBy(*keys).agg(*exprs)


def value_counts(df: DataFrame, col: str, normalize: bool = False, keep_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first; `share` is of the counted rows."""
    rows = df if keep_null else df.filter(F.col(col).isNotNull())
    counts = rows.groupBy(col).agg(F.count("*").alias("n"))
    if normalize:
        total = rows.agg(F.count("*").alias("total")).scalar()
        counts = counts.withColumn("share", F.col("n") / total)
    return counts.orderBy(F.col("n").desc(), F.col(col).asc())


def rate_by_group(df: DataFrame, key: str, target: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(target).alias("rate"), F.count("*").alias("n"))


def median_by_group(df: DataFrame, key: str, col: str) -> DataFrame:
    return exact_quantiles(df, [col], [0.5], by=[key]).select(key, F.col("value").alias("median"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    return exact_quantiles(df, cols, probs)


def mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null value, the smallest one on a tie."""
    return value_counts(df, col).limit(1).select(F.col(col).alias("mode"), "n")


def correlation_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson r of each column with the target over pairwise complete rows, by |r|."""
    return _correlations(df, [(c, target) for c in cols]).select(
        F.col("a").alias("feature"), "r"
    ).orderBy(F.abs("r").desc_nulls_last(), "feature")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for every unordered pair of columns."""
    return _correlations(df, list(combinations(cols, 2)))


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    out = None
    for at in range(0, len(pairs), PAIRS_PER_SCAN):
        part = pairs[at : at + PAIRS_PER_SCAN]
        row = df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("a"),
                        F.lit(b).alias("b"),
                        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"),
                    )
                    for a, b in part
                ]
            ).alias("pairs")
        ).select(F.inline("pairs"))
        out = row if out is None else out.unionByName(row)
    return out


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, median and bias-corrected skewness per column."""
    n = F.count("value").cast("double")
    shape = (
        long_values(df, cols)
        .groupBy("feature")
        .agg(
            F.avg("value").alias("mean"),
            F.when(n > 2, F.skewness("value") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        )
    )
    medians = F.lit(None).cast("double")
    for feature, (median,) in quantile_values(df, cols, [0.5]).items():
        medians = F.when(F.col("feature") == feature, F.lit(median)).otherwise(medians)
    return shape.select("feature", "mean", medians.alias("median"), "skew")


def histogram(df: DataFrame, col: str, edges: Sequence[float] | None = None, bins: int = 10) -> DataFrame:
    """(bin, lo, hi, n): left-closed bins, the last one closed on both sides.

    Without edges the column's range is cut into equal widths. Values outside the edges
    are not counted; empty bins are reported with 0.
    """
    value = F.col(col).cast("double")
    if edges is None:
        span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
        if span["lo"] is None:
            raise ValueError(f"{col} has no values")
        lo, hi = (span["lo"], span["hi"]) if span["lo"] < span["hi"] else (span["lo"] - 0.5, span["hi"] + 0.5)
        edges = [lo + (hi - lo) * (i / bins) for i in range(bins)] + [hi]
    edges = [float(e) for e in edges]
    counts = (
        df.select(bin_of(value, edges).alias("bin")).filter("bin >= 0").groupBy("bin").agg(F.count("*").alias("n"))
    )
    frame = df.sparkSession.createDataFrame(
        [(i, edges[i], edges[i + 1]) for i in range(len(edges) - 1)], "bin int, lo double, hi double"
    )
    return frame.join(F.broadcast(counts), "bin", "left").select(  # one row per bin: bounded
        "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n")
    )


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """0-based bin among sorted edges, -1 outside them; missing stays missing."""
    reached = F.lit(0)
    for edge in edges:
        reached = reached + (value >= F.lit(edge)).cast("int")
    inside = value.between(F.lit(edges[0]), F.lit(edges[-1]))
    known = value.isNotNull() & ~F.isnan(value)
    return F.when(known, F.when(inside, F.least(reached, F.lit(len(edges) - 1)) - 1).otherwise(-1))


def coverage(sources: Mapping[str, DataFrame], spine: DataFrame, key: str) -> DataFrame:
    """Distinct clients per source and their share (in %) of the spine."""
    whole = spine.agg(F.count_distinct(key).alias("n")).scalar()
    out = None
    for name, df in sources.items():
        row = df.agg(F.count_distinct(key).alias("clients")).select(
            F.lit(name).alias("source"), "clients"
        )
        out = row if out is None else out.unionByName(row)
    return out.withColumn("pct", safe_ratio(F.col("clients") * 100, whole))


def avg_rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and their quotient, from one shuffle of the distinct keys."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(F.sum("n").alias("rows"), F.count(key).alias("keys"))
        .withColumn("avg_rows", safe_ratio(F.col("rows"), F.col("keys")))
    )


"""Population stability, monitoring checks over model runs, and the report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import is_fresh
from creditloom.operators.aggregates import bin_of
from creditloom.operators.ordering import quantile_values

# Fixed values of the monitoring contract.
PSI_WARN, PSI_FAIL = 0.10, 0.25
SMALLEST_SHARE = 1e-6
MISSING = "__MISSING__"
MIN_PR_AUC, MIN_RECALL = 0.10, 0.40
STATUS_RANK = {"ok": 0, "warn": 1, "fail": 2}
CHECK_COLUMNS = ("name", "status", "detail")


def _share(n: Column, total: Column) -> Column:
    share = n / F.greatest(total, F.lit(1)).cast("double")
    return F.greatest(share, F.lit(SMALLEST_SHARE))


def _psi_term(ref: Column, act: Column) -> Column:
    return (act - ref) * F.ln(act / ref)


def _both_counts(reference: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(feature, key, ref, act): rows of both sides, counted in one pass; a counted reference has `ref`."""
    if "ref" not in reference.columns:
        reference = reference.withColumn("ref", F.lit(1))
    rows = reference.withColumn("act", F.lit(0)).unionByName(
        actual.withColumns({"ref": F.lit(0), "act": F.lit(1)})
    )
    return rows.groupBy("feature", key).agg(F.sum("ref").alias("ref"), F.sum("act").alias("act"))


def _bins(df: DataFrame, features: Sequence[str], edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin) of every value; bin -1 where the feature has fewer than two edges."""
    columns = []
    for feature in features:
        value, cuts = F.col(feature).try_cast("double"), edges.get(feature, ())
        known = value.isNotNull() & ~F.isnan(value)
        bin_ = bin_of(value, cuts) if len(cuts) >= 2 else F.when(known, F.lit(-1))
        columns.append(bin_.alias(feature))
    return df.select(*columns).unpivot([], list(features), "feature", "bin").filter("bin IS NOT NULL")


def _tokens(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, category) of every value."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in features]
    return df.select(*texts).unpivot([], list(features), "feature", "category")


def bin_counts(reference: DataFrame, features: Sequence[str], edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin, ref): a reference counted once, for many calls of `psi_numeric`."""
    return _bins(reference, features, edges).groupBy("feature", "bin").agg(F.count("*").alias("ref"))


def category_counts(reference: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, category, ref): a reference counted once, for many calls of `psi_categorical`."""
    return _tokens(reference, features).groupBy("feature", "category").agg(F.count("*").alias("ref"))


def reference_edges(reference: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct quantile edges of the reference per feature; a feature without values has none."""
    found = quantile_values(reference, features, [i / bins for i in range(bins + 1)])
    return {feature: list(dict.fromkeys(values)) for feature, values in found.items()}


def psi_numeric(
    reference: DataFrame,
    actual: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    edges: Mapping[str, Sequence[float]] | None = None,
    counted: bool = False,
) -> DataFrame:
    """(feature, psi) over the reference's quantile bins.

    Values outside the reference range count nowhere. No values on one side gives NULL,
    fewer than two distinct edges gives 0. Both tables are binned and counted in one
    pass; only bin counts are shuffled. Edges of an earlier call can be passed in, and with
    `counted` the reference is the table that `bin_counts` made with them.
    """
    if edges is None:
        edges = reference_edges(reference, features, bins)
    counts = reference if counted else _bins(reference, features, edges)
    counted_both = _both_counts(counts, _bins(actual, features, edges), "bin")
    inside = F.col("bin") >= 0
    per_feature = counted_both.groupBy("feature").agg(
        F.sum("ref").alias("ref_rows"),
        F.sum("act").alias("act_rows"),
        F.coalesce(F.sum(F.when(inside, F.col("ref"))), F.lit(0)).alias("ref_total"),
        F.coalesce(F.sum(F.when(inside, F.col("act"))), F.lit(0)).alias("act_total"),
        F.collect_list(F.when(inside, F.struct("ref", "act"))).alias("filled"),  # one entry per bin
    )
    # a bin empty on both sides has equal shares and adds nothing
    terms = F.aggregate(
        "filled",
        F.lit(0.0),
        lambda acc, b: acc
        + _psi_term(_share(b["ref"], F.col("ref_total")), _share(b["act"], F.col("act_total"))),
    )
    flat = [f for f in features if len(edges.get(f, ())) < 2]
    psi = (
        F.when((F.col("ref_rows") == 0) | (F.col("act_rows") == 0), F.lit(None).cast("double"))
        .when(F.col("feature").isin(flat), 0.0)
        .otherwise(terms)
    )
    wanted = actual.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return wanted.join(per_feature.select("feature", psi.alias("psi")), "feature", "left")


def psi_categorical(
    reference: DataFrame, actual: DataFrame, features: Sequence[str], counted: bool = False
) -> DataFrame:
    """(feature, psi) over the categories of either side; null is its own category.

    With `counted` the reference is the table that `category_counts` made.
    """
    known = reference if counted else _tokens(reference, features)
    counts = _both_counts(known, _tokens(actual, features), "category")
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("ref_total"), F.sum("act").alias("act_total"))
    # one row per named feature: bounded
    joined = counts.join(F.broadcast(totals), "feature")
    term = _psi_term(
        _share(F.col("ref"), F.col("ref_total")), _share(F.col("act"), F.col("act_total"))
    )
    return joined.groupBy("feature").agg(
        F.when((F.max("ref_total") > 0) & (F.max("act_total") > 0), F.sum(term)).alias("psi")
    )


def psi_status(psi: Column, warn: float = PSI_WARN, fail: float = PSI_FAIL) -> Column:
    return (
        F.when(psi.isNull() | F.isnan(psi), "warn").when(psi >= fail, "fail").when(psi >= warn, "warn").otherwise("ok")
    )


def status_rank(status: Column, unknown: str = "fail") -> Column:
    rank = F.lit(STATUS_RANK[unknown])
    for name, value in STATUS_RANK.items():
        rank = F.when(status == name, value).otherwise(rank)
    return rank


def worst_status(status: Column, unknown: str = "fail") -> Column:
    """Aggregate: the worst status; an unknown status counts as `unknown`."""
    worst = F.max(status_rank(status, unknown))
    return F.when(worst == 2, "fail").when(worst == 1, "warn").otherwise("ok")


def drift_report(
    reference: DataFrame,
    actual: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    warn: float = PSI_WARN,
    fail: float = PSI_FAIL,
) -> DataFrame:
    """(feature, type, psi, status): one row per feature, a warn row for an absent column."""
    common = set(reference.columns) & set(actual.columns)
    parts = []
    for kind, names, psi in (("numeric", numeric, psi_numeric), ("categorical", categorical, psi_categorical)):
        have = [n for n in names if n in common]
        if have:
            rows = psi(reference, actual, have)
            parts.append(
                rows.select(
                    "feature",
                    F.lit(kind).alias("type"),
                    F.round("psi", 4).alias("psi"),
                    psi_status(F.col("psi"), warn, fail).alias("status"),
                )
            )
        for name in names:
            if name not in common:
                parts.append(
                    reference.sparkSession.range(1).select(
                        F.lit(name).alias("feature"),
                        F.lit(kind).alias("type"),
                        F.lit(None).cast("double").alias("psi"),
                        F.lit("warn").alias("status"),
                    )
                )
    return reduce(DataFrame.unionByName, parts)


def drift_check(report: DataFrame) -> DataFrame:
    """The drift report as one check row."""
    return report.agg(
        worst_status(F.col("status")).alias("status"), F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi")
    ).select(
        F.lit("data_drift").alias("name"),
        "status",
        F.concat(F.lit("max PSI="), F.format_string("%.4f", "max_psi")).alias("detail"),
    )


# ---------------------------------------------------------------- checks over model runs

def feature_contract(runs: DataFrame, table_columns: Sequence[str], expected: Sequence[str]) -> DataFrame:
    """Per run: recorded features the table lacks and features outside the track.

    Column names come from the schema, so the comparison stays inside each run's row.
    """
    recorded = F.coalesce("feature_columns", F.array().cast("array<string>"))
    known = F.array(*[F.lit(c) for c in table_columns]).cast("array<string>")
    track = F.array(*[F.lit(c) for c in expected]).cast("array<string>")
    out = runs.withColumns(
        {
            "missing_in_table": F.array_sort(F.array_except(recorded, known)),
            "outside_track": F.array_sort(F.array_except(recorded, track)),
        }
    )
    diverges = (F.size("missing_in_table") > 0) | (F.size("outside_track") > 0)
    return out.withColumn(
        "status", F.when(F.size(recorded) == 0, "fail").when(diverges, "warn").otherwise("ok")
    )


def baseline_check(
    runs: DataFrame, required: Sequence[str] = ("pr_auc", "recall", "fn", "fp", "threshold")
) -> DataFrame:
    """Per run: fail when a required metric is missing, warn when the metrics are poor."""
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    poor = (F.col("pr_auc") < MIN_PR_AUC) | (F.col("recall") < MIN_RECALL)
    return runs.withColumn("lacking", lacking).withColumn(
        "status", F.when(F.size("lacking") > 0, "fail").when(poor, "warn").otherwise("ok")
    )


def threshold_coherence(runs: DataFrame, threshold: float) -> DataFrame:
    """Per run: the recorded threshold equals the configured one; unreadable -> fail."""
    gap = F.abs(F.col("threshold") - F.lit(threshold))
    return runs.withColumn(
        "status", F.when(gap.isNull(), "fail").when(gap < 1e-9, "ok").otherwise("warn")
    )


def freshness(runs: DataFrame, trained_at: str, now: Column, hours: float = 24.0) -> DataFrame:
    return runs.withColumn("fresh", is_fresh(F.col(trained_at), now, hours))


def check_of(rows: DataFrame, name: str, detail: str) -> DataFrame:
    """Collapse per-run statuses into one check row with the worst of them."""
    return rows.agg(worst_status(F.col("status")).alias("status")).select(
        F.lit(name).alias("name"), "status", F.lit(detail).alias("detail")
    )


def monitoring_report(checks: Sequence[DataFrame], run_ts: Column) -> DataFrame:
    """All checks with the overall status and the run time."""
    rows = reduce(DataFrame.unionByName, [c.select(*CHECK_COLUMNS) for c in checks])
    overall = rows.agg(worst_status(F.col("status")).alias("s")).scalar()
    return rows.withColumn("overall_status", overall).withColumn("run_ts", run_ts)


def check_domain(name: Column) -> Column:
    return (
        F.when(name == "api_health", "api")
        .when(name.startswith("artifact:"), "artifacts")
        .when(name == "feature_schema", "schema")
        .when(name == "data_drift", "drift")
        .when(name == "performance_baseline", "performance")
        .otherwise("governance")
    )


def checks_by_domain(history: DataFrame) -> DataFrame:
    """Counts by domain and status over the check history, and the domain's status.

    In the domain roll-up an unknown status counts as warn.
    """
    rows = history.withColumn("domain", check_domain(F.col("name"))).withColumn("status", F.lower("status"))
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUS_RANK]
    return rows.groupBy("domain").agg(
        *counts,
        F.count("*").alias("checks"),
        worst_status(F.col("status"), unknown="warn").alias("domain_status"),
    )

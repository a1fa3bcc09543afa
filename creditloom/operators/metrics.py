"""Classification metrics of a scored table (label 0/1, probability)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions import safe_ratio
from creditloom.operators.ordering import argmax_row, running_totals

CELLS = ("tn", "fp", "fn", "tp")


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def confusion_cells(label: Column, positive: Column) -> dict[str, Column]:
    """Counts of the four cells as aggregates."""
    return {
        "tn": F.count_if((label == 0) & ~positive),
        "fp": F.count_if((label == 0) & positive),
        "fn": F.count_if((label == 1) & ~positive),
        "tp": F.count_if((label == 1) & positive),
    }


def rates(df: DataFrame, beta: float = 2.0) -> DataFrame:
    """Add recall, precision, F-beta and rejection rate to confusion counts; 0 for 0/0."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    weight = beta * beta
    return df.withColumns(
        {
            "recall": _or_zero(safe_ratio(tp, tp + fn)),
            "precision": _or_zero(safe_ratio(tp, tp + fp)),
            "f_beta": _or_zero(
                safe_ratio(tp * F.lit(1.0 + weight), tp * F.lit(1.0 + weight) + fn * F.lit(weight) + fp)
            ),
            "rejection": _or_zero(safe_ratio(tp + fp, tn + fp + fn + tp)),
        }
    )


def classification_metrics(
    df: DataFrame,
    label: str,
    score: str,
    threshold: float,
    beta: float = 2.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts and rates at `score >= threshold`, one aggregate."""
    cells = confusion_cells(F.col(label), F.col(score) >= F.lit(threshold))
    counted = df.groupBy(*by).agg(*[c.cast("bigint").alias(n) for n, c in cells.items()])
    return rates(counted, beta).withColumn("threshold", F.lit(float(threshold)))


def threshold_sweep(
    df: DataFrame, label: str, score: str, grid: Sequence[float], beta: float = 2.0
) -> DataFrame:
    """One metric row per threshold; all thresholds are counted in the same scan."""
    points = []
    for t in grid:
        cells = confusion_cells(F.col(label), F.col(score) >= F.lit(float(t)))
        points.append(
            F.struct(F.lit(float(t)).alias("threshold"), *[c.cast("bigint").alias(n) for n, c in cells.items()])
        )
    return rates(df.agg(F.array(*points).alias("points")).select(F.inline("points")), beta)


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, highest first: cumulative hits and false alarms, PR and ROC points."""
    clean = df.filter(F.col(label).isin(0, 1))
    totals = running_totals(
        clean,
        score,
        {"pos": (F.col(label) == 1).cast("bigint"), "neg": (F.col(label) == 0).cast("bigint")},
        by,
        descending=True,
    )
    return totals.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"}).withColumns(
        {
            "recall": safe_ratio(F.col("tp"), F.col("total_pos")),
            "precision": safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")),
            "fpr": safe_ratio(F.col("fp"), F.col("total_neg")),
        }
    )


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision and tie-aware ROC AUC, both from one curve."""
    curve = score_curve(df, label, score, by)
    step = safe_ratio(F.col("pos"), F.col("total_pos")) * F.col("precision")
    pairs = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / F.lit(2.0))
    area = safe_ratio(pairs, F.col("total_pos").cast("double") * F.col("total_neg"))
    return curve.groupBy(*by).agg(F.sum(step).alias("pr_auc"), F.sum(area).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_metrics(df, label, score).select("pr_auc")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_metrics(df, label, score).select("roc_auc")


def evaluate(
    df: DataFrame, label: str, score: str, threshold: float, beta: float = 2.0, by: Sequence[str] = ()
) -> DataFrame:
    """Ranking and threshold metrics side by side."""
    at_cut = classification_metrics(df, label, score, threshold, beta, by)
    ranked = ranking_metrics(df, label, score, by)
    if by:
        return ranked.join(at_cut, list(by))
    both = F.struct(*ranked.columns)
    whole = ranked.select(both.alias("r")).scalar()
    return at_cut.withColumns({c: whole[c] for c in ranked.columns})


def classification_report(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and weighted means."""
    cells = classification_metrics(df, label, score, threshold).select(*CELLS)
    tn, fp, fn, tp = (F.col(c) for c in CELLS)

    def line(name: str, hit: Column, false_alarm: Column, miss: Column) -> Column:
        p = _or_zero(safe_ratio(hit, hit + false_alarm))
        r = _or_zero(safe_ratio(hit, hit + miss))
        f1 = _or_zero(safe_ratio(hit * 2, hit * 2 + false_alarm + miss))
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f1.alias("f1"),
            (hit + miss).alias("support"),
        )

    zero, one = line("0", tn, fn, fp), line("1", tp, fp, fn)
    total = zero["support"] + one["support"]

    def mean(name: str, w0: Column, w1: Column) -> Column:
        scores = [
            (zero[m] * w0 + one[m] * w1).alias(m) for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(name).alias("class"), *scores, total.alias("support"))

    half = F.lit(0.5)
    lines = F.array(
        zero,
        one,
        mean("macro", half, half),
        mean("weighted", safe_ratio(zero["support"], total), safe_ratio(one["support"], total)),
    )
    return cells.select(F.inline(lines))


def portfolio_kpis(confusion: DataFrame) -> DataFrame:
    """Default rate before and after the model and its reduction, per confusion row.

    Rows without tn/tp get them back from fn, fp, recall, rejection and the row count.
    """
    df = confusion
    for col in ("tn", "tp", "rejection", "precision"):
        if col not in df.columns:
            df = df.withColumn(col, F.lit(None).cast("double"))
    fn, fp = (F.bround(F.col(c).cast("double")) for c in ("fn", "fp"))
    rows, recall = F.col("test_rows"), F.col("recall")
    flagged = F.bround(F.coalesce("rejection", F.lit(0.0)) * rows) - fp
    rebuilt = (
        F.when(recall >= 1.0, F.when(flagged > 0, flagged).otherwise(0.0))
        .when(recall <= 0.0, 0.0)
        .otherwise(F.bround(fn * recall / F.nullif(1.0 - recall, F.lit(0.0))))
    )
    known = F.col("tn").isNotNull() & F.col("tp").isNotNull()
    tp = F.when(known, F.bround(F.col("tp").cast("double"))).otherwise(rebuilt)
    tn = F.when(known, F.bround(F.col("tn").cast("double"))).otherwise(rows - fp - fn - tp)
    df = df.withColumns({"tp": tp.cast("bigint"), "fn": fn.cast("bigint"), "fp": fp.cast("bigint"), "tn": tn.cast("bigint")})
    base = _or_zero(safe_ratio(F.col("tp") + F.col("fn"), rows))
    after = _or_zero(safe_ratio(F.col("fn"), F.col("tn") + F.col("fn")))
    caught = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    given = _or_zero(F.col("precision").cast("double"))
    return (
        df.withColumn("precision", F.when(given <= 0, _or_zero(caught)).otherwise(given))
        .withColumn("defaults_total", F.col("tp") + F.col("fn"))
        .withColumn("approved", F.col("tn") + F.col("fn"))
        .withColumn("base_default_rate", base)
        .withColumn("post_model_default_rate", after)
        .withColumn(
            "default_reduction",
            F.when(
                F.col("base_default_rate") > 0,
                1.0 - F.col("post_model_default_rate") / F.nullif(F.col("base_default_rate"), F.lit(0.0)),
            ).otherwise(0.0),
        )
    )


def summary_of_folds(metric_rows: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each metric over fold rows."""
    lines = [
        F.struct(
            F.lit(m).alias("metric"), F.avg(m).alias("mean"), F.stddev_pop(m).alias("std"), F.count(m).alias("folds")
        )
        for m in metrics
    ]
    return metric_rows.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def compare(metric_rows: Sequence[DataFrame]) -> DataFrame:
    """Long result table of several evaluations."""
    return reduce(DataFrame.unionByName, metric_rows)


def ranked(metric_rows: DataFrame, metric: str = "pr_auc", by: Sequence[str] = ()) -> DataFrame:
    """Add the position of each metric row; one row per evaluated model, so the table is tiny."""
    best_first = Window.partitionBy(*by).orderBy(F.col(metric).desc_nulls_last(), "model")
    return metric_rows.withColumn("rank", F.row_number().over(best_first))


def best_model(metric_rows: DataFrame, metric: str = "pr_auc") -> DataFrame:
    return argmax_row(metric_rows, metric)

"""Row features, feature tracks and the long view of a client row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions import floor_below, row_count, row_mean, safe_ratio
from creditloom.operators.joins import label_column

# Feature tracks of the model contract.
DROP_COLUMNS = ("SK_ID_CURR", "TARGET")
CORE_TRACK = (
    "EXT_SOURCE_1",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
    "DAYS_BIRTH",
    "DAYS_EMPLOYED",
    "DAYS_ID_PUBLISH",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "NAME_EDUCATION_TYPE",
    "NAME_INCOME_TYPE",
)
EXTENDED_EXTRA = (
    "EXT_SOURCE_MEAN",
    "EXT_SOURCE_CNT",
    "FLAG_EMPLOYED",
    "DAYS_EMPLOYED_YEARS",
    "OCCUPATION_TYPE",
    "BUREAU_AMT_DEBT_SUM",
    "BUREAU_DAYS_CREDIT_MIN",
    "PREV_DAYS_DECISION_MIN",
    "INST_DIAS_ATRASO_MEAN",
    "INST_AMT_PAYMENT_SUM",
)
EXT_SOURCES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")


def feature_columns(columns: Sequence[str], track: str = "full", drop: Sequence[str] = DROP_COLUMNS) -> list[str]:
    """Columns of a track; a listed column the table lacks is an error."""
    if track == "full":
        return [c for c in columns if c not in drop]
    if track not in ("core", "extended"):
        raise ValueError(f"unknown feature track: {track}")
    wanted = list(CORE_TRACK) + (list(EXTENDED_EXTRA) if track == "extended" else [])
    absent = [c for c in wanted if c not in columns]
    if absent:
        raise ValueError(f"columns absent for track {track}: {absent}")
    return wanted


def select_features(df: DataFrame, track: str = "full", keep: Sequence[str] = DROP_COLUMNS) -> DataFrame:
    kept = [c for c in keep if c in df.columns]
    return df.select(*kept, *[c for c in feature_columns(df.columns, track) if c not in kept])


def enrich_application(df: DataFrame) -> DataFrame:
    """External-score summary, income ratios, log credit and years of employment.

    Each feature appears only when its inputs exist.
    """
    have = set(df.columns)
    new = {}
    scores = [c for c in EXT_SOURCES if c in have]
    if scores:
        new["EXT_SOURCE_MEAN"] = row_mean(F.col(c) for c in scores)
        new["EXT_SOURCE_CNT"] = row_count(F.col(c) for c in scores)
        new.update({f"FLAG_{c}_MISSING": F.col(c).isNull().cast("int") for c in scores})
    for ratio, amount in (("CREDIT_INCOME_RATIO", "AMT_CREDIT"), ("ANNUITY_INCOME_RATIO", "AMT_ANNUITY")):
        if {amount, "AMT_INCOME_TOTAL"} <= have:
            new[ratio] = safe_ratio(F.col(amount), F.col("AMT_INCOME_TOTAL"))
    if "AMT_CREDIT" in have:
        new["LOG_AMT_CREDIT"] = F.log1p(floor_below(F.col("AMT_CREDIT"), 0))
    if "DAYS_EMPLOYED" in have:
        new["DAYS_EMPLOYED_YEARS"] = F.abs(F.col("DAYS_EMPLOYED")) / F.lit(365.25)
    return df.withColumns(new) if new else df


def dossier(df: DataFrame, key: str, labels: Mapping[str, str] | None = None) -> DataFrame:
    """(key, feature, label, value) rows, one per column of the client row."""
    cols = [c for c in df.columns if c != key]
    texts = [F.col(c).cast("string").alias(c) for c in cols]
    rows = df.select(key, *texts).unpivot([key], cols, "feature", "value")
    return rows.select(key, "feature", label_column(F.col("feature"), labels or {}).alias("label"), "value")

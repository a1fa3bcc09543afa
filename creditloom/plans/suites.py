"""Check suites per clean table, per aggregate, and for the final modelling table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import is_infinite
from creditloom.operators import quality as q
from creditloom.operators.cleaning import EMPLOYED_SENTINEL, HORIZON_DAYS, STATUS_DOMAIN, with_prefix
from creditloom.plans.gold import CLIENT
from creditloom.plans.silver import TABLES

# The smallest column contract of each aggregation input.
REQUIRED = {
    "application": ["SK_ID_CURR", "TARGET"],
    "bureau": [
        "SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
        "AMT_CREDIT_SUM_OVERDUE", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT",
    ],
    "bureau_balance": ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"],
    "pos_cash": ["SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE", "SK_DPD"],
    "credit_card": [
        "SK_ID_CURR", "MONTHS_BALANCE", "SK_DPD", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL",
        "CNT_DRAWINGS_ATM_CURRENT",
    ],
    "previous_application": [
        "SK_ID_CURR", "SK_ID_PREV", "NAME_CONTRACT_STATUS", "AMT_APPLICATION", "AMT_CREDIT", "DAYS_DECISION",
    ],
    "installments": [
        "SK_ID_CURR", "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "AMT_INSTALMENT", "AMT_PAYMENT", "DIAS_DE_ATRASO",
    ],
}


def require_stage_columns(stage: str, df: DataFrame) -> DataFrame:
    if stage not in REQUIRED:
        raise ValueError(f"unknown stage: {stage}")
    return q.require_columns(df, stage, REQUIRED[stage])


# ---------------------------------------------------------------- clean tables

def _not_positive(df: DataFrame, col: str) -> q.Check:
    return q.warn_if_absent(df, [col], lambda: q.no_rows_where(f"{col}_not_future", F.col(col) > 0))


def _not_negative(df: DataFrame, col: str) -> q.Check:
    return q.warn_if_absent(df, [col], lambda: q.no_rows_where(f"{col}_not_negative", F.col(col) < 0))


def application_checks(df: DataFrame, expected_rows: int | Column) -> list[q.Check]:
    employed = F.col("DAYS_EMPLOYED")
    return [
        q.row_count_equals(expected_rows),
        q.warn_if_absent(
            df, ["DAYS_EMPLOYED"],
            lambda: q.no_rows_where("DAYS_EMPLOYED_clean", employed == EMPLOYED_SENTINEL, employed > 0),
        ),
        q.warn_if_absent(df, ["FLAG_EMPLOYED"], lambda: q.not_all_null("FLAG_EMPLOYED")),
        q.warn_if_absent(
            df, ["CODE_GENDER"], lambda: q.no_rows_where("CODE_GENDER_no_XNA", F.col("CODE_GENDER") == "XNA")
        ),
        q.warn_if_absent(
            df, ["FLAG_OWN_CAR", "OWN_CAR_AGE"],
            lambda: q.no_rows_where(
                "OWN_CAR_AGE_only_with_car", (F.col("FLAG_OWN_CAR") == "N") & F.col("OWN_CAR_AGE").isNotNull()
            ),
        ),
        q.warn_if_absent(df, ["NAME_EDUCATION_TYPE"], lambda: q.upper_trimmed("NAME_EDUCATION_TYPE")),
    ]


def bureau_checks(df: DataFrame) -> list[q.Check]:
    return [
        _not_positive(df, "DAYS_CREDIT"),
        q.warn_if_absent(df, ["AMT_CREDIT_SUM"], lambda: q.capped(df, "AMT_CREDIT_SUM")),
        *([_not_negative(df, "AMT_CREDIT_SUM")] if "AMT_CREDIT_SUM" in df.columns else []),
        q.warn_if_absent(df, ["CREDIT_ACTIVE"], lambda: q.upper_trimmed("CREDIT_ACTIVE")),
    ]


def bureau_balance_checks(df: DataFrame) -> list[q.Check]:
    key = ["SK_ID_BUREAU", "MONTHS_BALANCE"]
    return [
        q.warn_if_absent(df, key, lambda: q.unique_key(df, key)),
        _not_positive(df, "MONTHS_BALANCE"),
        q.warn_if_absent(df, ["STATUS"], lambda: q.in_domain("STATUS", STATUS_DOMAIN)),
    ]


def pos_cash_checks(df: DataFrame) -> list[q.Check]:
    return [_not_positive(df, "MONTHS_BALANCE"), _not_negative(df, "SK_DPD"), _not_negative(df, "SK_DPD_DEF")]


def credit_card_checks(df: DataFrame) -> list[q.Check]:
    filled = (
        "AMT_DRAWINGS_ATM_CURRENT",
        "AMT_DRAWINGS_CURRENT",
        "AMT_DRAWINGS_POS_CURRENT",
        "AMT_DRAWINGS_OTHER_CURRENT",
    )
    return [
        _not_positive(df, "MONTHS_BALANCE"),
        _not_negative(df, "SK_DPD"),
        *[q.warn_if_absent(df, [c], lambda c=c: q.no_nulls(c)) for c in filled],
    ]


def previous_application_checks(df: DataFrame) -> list[q.Check]:
    return [
        q.warn_if_absent(df, ["SK_ID_PREV"], lambda: q.unique_key(df, ["SK_ID_PREV"])),
        _not_positive(df, "DAYS_DECISION"),
        q.prefix_rule(df, "DAYS_", "DAYS_no_anomaly", lambda c: c == EMPLOYED_SENTINEL, lambda c: c > HORIZON_DAYS),
    ]


def installments_checks(df: DataFrame) -> list[q.Check]:
    return [
        q.warn_if_absent(df, ["AMT_PAYMENT"], lambda: q.no_nulls("AMT_PAYMENT")),
        q.prefix_rule(df, "DAYS_", "DAYS_not_future", lambda c: c > 0),
        q.warn_if_absent(
            df, ["DIAS_DE_ATRASO"],
            lambda: q.Check("DIAS_DE_ATRASO_created", F.lit(1.0), lambda seen: seen == 1),
        ),
    ]


SILVER_CHECKS: dict[str, Callable[[DataFrame], list[q.Check]]] = {
    "application_train": lambda df: application_checks(df, TABLES["application_train"].expected_rows),
    "application_test": lambda df: application_checks(df, TABLES["application_test"].expected_rows),
    "bureau": bureau_checks,
    "bureau_balance": bureau_balance_checks,
    "POS_CASH_balance": pos_cash_checks,
    "credit_card_balance": credit_card_checks,
    "previous_application": previous_application_checks,
    "installments_payments": installments_checks,
}


def silver_suite(table_id: str, df: DataFrame) -> DataFrame:
    if table_id not in SILVER_CHECKS:
        raise ValueError(f"unknown table: {table_id}")
    return q.run_suite(df, table_id, SILVER_CHECKS[table_id](df))


# ---------------------------------------------------------------- aggregates

def _keys(df: DataFrame, universe: DataFrame) -> list[q.Check]:
    return [q.unique_key(df, [CLIENT]), q.keys_in_universe(df, universe, CLIENT)]


def application_feature_checks(df: DataFrame) -> list[q.Check]:
    checks = []
    if "EXT_SOURCE_MEAN" in df.columns:
        checks += [
            q.unit_interval("EXT_SOURCE_MEAN"),
            q.info_count("EXT_SOURCE_MEAN_null", F.col("EXT_SOURCE_MEAN").isNull()),
        ]
    for ratio in ("CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO"):
        if ratio in df.columns:
            checks.append(q.no_infinite(df, f"{ratio}_finite", [ratio]))
    return [*checks, q.n_classes("TARGET", 2), q.unique_key(df, [CLIENT])]


def bureau_gold_checks(df: DataFrame, universe: DataFrame) -> list[q.Check]:
    return [
        *_keys(df, universe),
        q.all_rows("BUREAU_CNT_CREDITS_positive", F.col("BUREAU_CNT_CREDITS") >= 1),
        q.all_rows("HAS_BUREAU_one", F.col("HAS_BUREAU") == 1),
        q.no_rows_where("BUREAU_AMT_CREDIT_SUM_MAX_not_negative", F.col("BUREAU_AMT_CREDIT_SUM_MAX") < 0),
    ]


def bureau_balance_gold_checks(df: DataFrame, universe: DataFrame) -> list[q.Check]:
    return [
        *_keys(df, universe),
        q.unit_interval("BB_RATE_OVERDUE_MAX"),
        q.all_rows("BB_CNT_MONTHS_positive", F.col("BB_CNT_MONTHS") >= 1),
    ]


def pos_cash_gold_checks(df: DataFrame, universe: DataFrame) -> list[q.Check]:
    return [
        *_keys(df, universe),
        q.all_rows("POS_SK_DPD_MAX_not_negative", F.col("POS_SK_DPD_MAX") >= 0),
        q.unit_interval("POS_RATE_DPD"),
    ]


def credit_card_gold_checks(df: DataFrame, universe: DataFrame) -> list[q.Check]:
    return [*_keys(df, universe), q.no_infinite(df, "CC_UTILIZATION_MAX_finite", ["CC_UTILIZATION_MAX"])]


def previous_application_gold_checks(df: DataFrame, universe: DataFrame) -> list[q.Check]:
    parts = ["PREV_CNT_APPROVED", "PREV_CNT_REFUSED", "PREV_CNT_CANCELED"]
    return [
        *_keys(df, universe),
        q.sum_of_parts_le_total("PREV_status_counts", parts, "PREV_CNT_APPS"),
        q.unit_interval("PREV_APPROVAL_RATE"),
    ]


def installments_gold_checks(df: DataFrame, universe: DataFrame) -> list[q.Check]:
    paid, due = F.col("INST_AMT_PAYMENT_SUM"), F.col("INST_AMT_INSTALMENT_SUM")
    ratio = F.col("INST_PAYMENT_RATIO")
    return [
        *_keys(df, universe),
        q.all_rows("INST_amounts_not_negative", paid >= 0, due >= 0),
        q.info_count("INST_paid_over_105_pct", paid > due * F.lit(1.05)),
        *[q.unit_interval(c) for c in ("INST_RATE_ATRASO", "INST_RATE_CALOTE", "INST_RATE_UNDERPAY")],
        q.no_rows_where("INST_PAYMENT_RATIO_valid", is_infinite(ratio) | (ratio < 0)),
        q.info_count("INST_PAYMENT_RATIO_over_105_pct", ratio > F.lit(1.05)),
    ]


GOLD_CHECKS: dict[str, Callable[[DataFrame, DataFrame], list[q.Check]]] = {
    "application": lambda df, _: application_feature_checks(df),
    "bureau": bureau_gold_checks,
    "bureau_balance": bureau_balance_gold_checks,
    "pos_cash": pos_cash_gold_checks,
    "credit_card": credit_card_gold_checks,
    "previous_application": previous_application_gold_checks,
    "installments": installments_gold_checks,
}


def gold_suite(stage: str, df: DataFrame, universe: DataFrame) -> DataFrame:
    if stage not in GOLD_CHECKS:
        raise ValueError(f"unknown stage: {stage}")
    return q.run_suite(df, stage, GOLD_CHECKS[stage](df, universe))


# ---------------------------------------------------------------- modelling table

def abt_checks(abt: DataFrame, application: DataFrame, expected_rows: int | Column | None = None) -> list[q.Check]:
    """Structure and business checks of the final table against its application."""
    spine_rows = application.agg(F.count("*").alias("n")).scalar()
    checks = [] if expected_rows is None else [q.row_count_equals(expected_rows)]
    checks += [
        q.row_count_equals(spine_rows, "rows_equal_application"),
        q.unique_key(abt, [CLIENT]),
        q.no_duplicate_columns(abt),
        q.column_unchanged(abt, application, CLIENT, "TARGET"),
        q.rate_between("TARGET", 0.05, 0.12),
        q.no_infinite(abt),
    ]
    flags = with_prefix(abt, "HAS_")
    if flags:
        checks.append(q.all_rows("HAS_flags_binary", *[F.col(c).isin(0, 1) for c in flags]))
    if {"HAS_BUREAU", "BUREAU_CNT_CREDITS"} <= set(abt.columns):
        checks += q.flag_implies("HAS_BUREAU", "BUREAU_CNT_CREDITS")
    for flag in ("HAS_CREDIT_CARD", "HAS_POS_CASH", "HAS_INSTALLMENTS", "HAS_BUREAU"):
        if flag in abt.columns:
            checks.append(q.info_mean(flag, f"{flag}_coverage"))
    for col in ("EXT_SOURCE_MEAN", "CREDIT_INCOME_RATIO", "LOG_AMT_CREDIT"):
        if col in abt.columns:
            checks.append(q.info_null_rate(col))
    return checks


def abt_suite(abt: DataFrame, application: DataFrame, expected_rows: int | Column | None = None) -> DataFrame:
    return q.run_suite(abt, "abt", abt_checks(abt, application, expected_rows))

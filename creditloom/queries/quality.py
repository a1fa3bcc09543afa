"""Check suites over raw, clean and aggregated tables.

Aggregates are written first and checked as written, as a publishing run does: several
checks read the table, and none of them should repeat the aggregation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import quality as q
from creditloom.plans import silver, suites
from creditloom.queries import gold
from creditloom.queries.cleaning import clean_bureau_balance
from creditloom.queries.registry import query
from creditloom.session import materialize
from creditloom.sources import fixtures as fx


def line(stage: str, source: str, name: str, observed: str, passes: str = "o = 0", level: str | None = None,
         shown: str = "true") -> str:
    outcome = f"'{level}'" if level else f"CASE WHEN {passes} THEN 'PASS' ELSE 'FAIL' END"
    return (
        f"SELECT '{stage}' AS stage, '{name}' AS \"check\", {outcome} AS level, "
        f"concat('{name}: ', coalesce(printf('%.4f', o), 'none')) AS message, o AS observed "
        f"FROM (SELECT CAST({observed} AS DOUBLE) AS o FROM {source}) WHERE {shown}"
    )


def twin_of(stage: str, source: str, *lines: tuple) -> str:
    return " UNION ALL ".join(line(stage, source, *parts) for parts in lines)


def bad(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def repeats(*keys: str) -> tuple[str, str]:
    joined = ", ".join(keys)
    return f"unique_{'_'.join(keys)}", f"count(*) - count(DISTINCT ({joined}))"


UPPER = "upper(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'))"
RAW_ROWS = "(SELECT count(*) FROM raw_application)"

APPLICATION_LINES = (
    ("row_count", "count(*)", f"o = {RAW_ROWS}"),
    ("DAYS_EMPLOYED_clean", f"{bad('DAYS_EMPLOYED = 365243')} + {bad('DAYS_EMPLOYED > 0')}"),
    ("FLAG_EMPLOYED_filled", "count(FLAG_EMPLOYED)", "o > 0"),
    ("CODE_GENDER_no_XNA", bad("CODE_GENDER = 'XNA'")),
    ("OWN_CAR_AGE_only_with_car", bad("FLAG_OWN_CAR = 'N' AND OWN_CAR_AGE IS NOT NULL")),
    ("NAME_EDUCATION_TYPE_upper_trimmed", bad("NAME_EDUCATION_TYPE <> " + UPPER.format("NAME_EDUCATION_TYPE"))),
)


def raw_rows(spark, sf_dir):
    return fx.raw_application(spark, sf_dir).agg(F.count("*").alias("n")).scalar()


@query("qa_application", twin_of("application_train", "clean_application", *APPLICATION_LINES), "observed")
def qa_application(spark, sf_dir):
    df = silver.clean_application(fx.raw_application(spark, sf_dir))
    return q.run_suite(df, "application_train", suites.application_checks(df, raw_rows(spark, sf_dir)))


@query(
    "qa_raw_application",
    twin_of("raw", "raw_application", *[x for x in APPLICATION_LINES if x[0] != "FLAG_EMPLOYED_filled"])
    + " UNION ALL SELECT 'raw', 'FLAG_EMPLOYED_present', 'WARNING', 'FLAG_EMPLOYED_present: 0.0000', 0e0",
    "observed",
)
def qa_raw_application(spark, sf_dir):
    df = fx.raw_application(spark, sf_dir)
    return q.run_suite(df, "raw", suites.application_checks(df, raw_rows(spark, sf_dir)))


CAP = "(SELECT quantile_cont(AMT_CREDIT_SUM, 0.999e0) FROM clean_bureau) * 1.001e0"


@query(
    "qa_bureau",
    twin_of(
        "bureau", "clean_bureau",
        ("DAYS_CREDIT_not_future", bad("DAYS_CREDIT > 0")),
        ("AMT_CREDIT_SUM_capped", bad(f"AMT_CREDIT_SUM > {CAP}")),
        ("AMT_CREDIT_SUM_not_negative", bad("AMT_CREDIT_SUM < 0")),
        ("CREDIT_ACTIVE_upper_trimmed", bad("CREDIT_ACTIVE <> " + UPPER.format("CREDIT_ACTIVE"))),
    ),
    "observed",
)
def qa_bureau(spark, sf_dir):
    return suites.silver_suite("bureau", gold.clean_bureau(spark, sf_dir))


@query(
    "qa_bureau_balance",
    twin_of(
        "bureau_balance", "clean_bureau_balance",
        repeats("SK_ID_BUREAU", "MONTHS_BALANCE"),
        ("MONTHS_BALANCE_not_future", bad("MONTHS_BALANCE > 0")),
        ("STATUS_domain", bad("STATUS NOT IN ('C','X','0','1','2','3','4','5')")),
    ),
    "observed",
)
def qa_bureau_balance(spark, sf_dir):
    return suites.silver_suite("bureau_balance", clean_bureau_balance(spark, sf_dir))


MONTHLY = (
    ("MONTHS_BALANCE_not_future", bad("MONTHS_BALANCE > 0")),
    ("SK_DPD_not_negative", bad("SK_DPD < 0")),
)


@query(
    "qa_pos_cash",
    twin_of("POS_CASH_balance", "clean_pos_cash", *MONTHLY, ("SK_DPD_DEF_not_negative", bad("SK_DPD_DEF < 0"))),
    "observed",
)
def qa_pos_cash(spark, sf_dir):
    return suites.silver_suite("POS_CASH_balance", silver.clean_pos_cash(fx.raw_pos_cash(spark, sf_dir)))


@query(
    "qa_raw_pos_cash",
    twin_of("POS_CASH_balance", "raw_pos_cash", *MONTHLY, ("SK_DPD_DEF_not_negative", bad("SK_DPD_DEF < 0"))),
    "observed",
)
def qa_raw_pos_cash(spark, sf_dir):
    return suites.silver_suite("POS_CASH_balance", fx.raw_pos_cash(spark, sf_dir))


@query(
    "qa_credit_card",
    twin_of(
        "credit_card_balance", "clean_credit_card", *MONTHLY,
        ("AMT_DRAWINGS_ATM_CURRENT_no_nulls", bad("AMT_DRAWINGS_ATM_CURRENT IS NULL")),
        ("AMT_DRAWINGS_CURRENT_no_nulls", bad("AMT_DRAWINGS_CURRENT IS NULL")),
    )
    + "".join(
        f" UNION ALL SELECT 'credit_card_balance', '{c}_present', 'WARNING', '{c}_present: 0.0000', 0e0"
        for c in ("AMT_DRAWINGS_POS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT")
    ),
    "observed",
)
def qa_credit_card(spark, sf_dir):
    return suites.silver_suite("credit_card_balance", silver.clean_credit_card(fx.raw_credit_card(spark, sf_dir)))


@query(
    "qa_previous",
    twin_of(
        "previous_application", "clean_previous", repeats("SK_ID_PREV"),
        ("DAYS_DECISION_not_future", bad("DAYS_DECISION > 0")),
        ("DAYS_no_anomaly", " + ".join(bad(f"{c} {r}") for c in ("DAYS_DECISION", "DAYS_FIRST_DRAWING")
                                       for r in ("= 365243", "> 18250"))),
    ),
    "observed",
)
def qa_previous(spark, sf_dir):
    df = silver.clean_previous_application(fx.raw_previous_application(spark, sf_dir))
    return suites.silver_suite("previous_application", df)


@query(
    "qa_installments",
    twin_of(
        "installments_payments", "clean_installments",
        ("AMT_PAYMENT_no_nulls", bad("AMT_PAYMENT IS NULL")),
        ("DAYS_not_future", f"{bad('DAYS_INSTALMENT > 0')} + {bad('DAYS_ENTRY_PAYMENT > 0')}"),
        ("DIAS_DE_ATRASO_created", "count(*) * 0 + 1", "o = 1"),
    ),
    "observed",
)
def qa_installments(spark, sf_dir):
    return suites.silver_suite("installments_payments", silver.clean_installments(fx.raw_installments(spark, sf_dir)))


# ---------------------------------------------------------------- aggregates

KEYS = (
    repeats("SK_ID_CURR"),
    ("SK_ID_CURR_in_universe", bad("SK_ID_CURR NOT IN (SELECT SK_ID_CURR FROM raw_application)")),
)


def unit(c: str) -> tuple[str, str]:
    return f"{c}_unit_interval", bad(f"NOT ({c} BETWEEN 0 AND 1)")


def gold_query(name: str, stage: str, source: str, build, *lines: tuple) -> None:
    @query(name, twin_of(stage, source, *KEYS, *lines), "observed")
    def run(spark, sf_dir):
        staged = materialize(build(spark, sf_dir), stage)
        return suites.gold_suite(stage, staged, gold.universe(spark, sf_dir))


@query(
    "qa_gold_application",
    twin_of(
        "application", "application", unit("EXT_SOURCE_MEAN"),
        ("EXT_SOURCE_MEAN_null", bad("EXT_SOURCE_MEAN IS NULL"), "", "INFO", "o > 0"),
        ("CREDIT_INCOME_RATIO_finite", bad("isinf(CREDIT_INCOME_RATIO)")),
        ("ANNUITY_INCOME_RATIO_finite", bad("isinf(ANNUITY_INCOME_RATIO)")),
        ("TARGET_classes", "count(DISTINCT TARGET)", "o = 2"),
        repeats("SK_ID_CURR"),
    ),
    "observed",
)
def qa_gold_application(spark, sf_dir):
    return suites.gold_suite("application", gold.application(spark, sf_dir), gold.universe(spark, sf_dir))


gold_query(
    "qa_gold_bureau", "bureau", "agg_bureau", gold.agg_bureau,
    ("BUREAU_CNT_CREDITS_positive", bad("coalesce(BUREAU_CNT_CREDITS, 0) < 1")),
    ("HAS_BUREAU_one", bad("coalesce(HAS_BUREAU, 0) <> 1")),
    ("BUREAU_AMT_CREDIT_SUM_MAX_not_negative", bad("BUREAU_AMT_CREDIT_SUM_MAX < 0")),
)
gold_query(
    "qa_gold_bureau_balance", "bureau_balance", "agg_bureau_balance", gold.agg_bureau_balance,
    unit("BB_RATE_OVERDUE_MAX"),
    ("BB_CNT_MONTHS_positive", bad("coalesce(BB_CNT_MONTHS, 0) < 1")),
)
gold_query(
    "qa_gold_pos_cash", "pos_cash", "agg_pos_cash", gold.agg_pos_cash,
    ("POS_SK_DPD_MAX_not_negative", bad("coalesce(POS_SK_DPD_MAX, -1) < 0")),
    unit("POS_RATE_DPD"),
)
gold_query(
    "qa_gold_credit_card", "credit_card", "agg_credit_card", gold.agg_credit_card,
    ("CC_UTILIZATION_MAX_finite", bad("isinf(CC_UTILIZATION_MAX)")),
)
gold_query(
    "qa_gold_previous", "previous_application", "agg_previous", gold.agg_previous,
    ("PREV_status_counts", bad("PREV_CNT_APPROVED + PREV_CNT_REFUSED + PREV_CNT_CANCELED > PREV_CNT_APPS")),
    unit("PREV_APPROVAL_RATE"),
)
gold_query(
    "qa_gold_installments", "installments", "agg_installments", gold.agg_installments,
    ("INST_amounts_not_negative", bad("INST_AMT_PAYMENT_SUM < 0 OR INST_AMT_INSTALMENT_SUM < 0")),
    ("INST_paid_over_105_pct", bad("INST_AMT_PAYMENT_SUM > INST_AMT_INSTALMENT_SUM * 1.05e0"), "", "INFO", "o > 0"),
    unit("INST_RATE_ATRASO"), unit("INST_RATE_CALOTE"), unit("INST_RATE_UNDERPAY"),
    ("INST_PAYMENT_RATIO_valid", bad("isinf(INST_PAYMENT_RATIO) OR INST_PAYMENT_RATIO < 0")),
    ("INST_PAYMENT_RATIO_over_105_pct", bad("INST_PAYMENT_RATIO > 1.05e0"), "", "INFO", "o > 0"),
)

FLAGS = ("HAS_BUREAU", "HAS_BUREAU_BALANCE", "HAS_POS_CASH", "HAS_CREDIT_CARD", "HAS_PREVIOUS_APP", "HAS_INSTALLMENTS")


@query(
    "qa_abt",
    twin_of(
        "abt", "abt",
        ("row_count", "count(*)", f"o = {RAW_ROWS}"),
        ("rows_equal_application", "count(*)", f"o = {RAW_ROWS}"),
        repeats("SK_ID_CURR"),
        ("no_duplicate_columns", "count(*) * 0"),
        ("TARGET_unchanged", bad("(SK_ID_CURR, TARGET) NOT IN (SELECT (SK_ID_CURR, TARGET) FROM raw_application)")),
        ("TARGET_rate", "avg(TARGET)", "o > 0.05e0 AND o < 0.12e0"),
        ("no_infinite", bad("isinf(CC_UTILIZATION_MAX) OR isinf(CREDIT_INCOME_RATIO)")),
        ("HAS_flags_binary", bad(" OR ".join(f"{f} NOT IN (0, 1)" for f in FLAGS))),
        ("HAS_BUREAU_1_implies_BUREAU_CNT_CREDITS", bad("HAS_BUREAU = 1 AND BUREAU_CNT_CREDITS IS NULL")),
        ("HAS_BUREAU_0_implies_no_BUREAU_CNT_CREDITS", bad("HAS_BUREAU = 0 AND BUREAU_CNT_CREDITS IS NOT NULL")),
        *[(f"{f}_coverage", f"avg({f})", "", "INFO")
          for f in ("HAS_CREDIT_CARD", "HAS_POS_CASH", "HAS_INSTALLMENTS", "HAS_BUREAU")],
        *[(f"{c}_null_rate", f"avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0 END)", "", "INFO")
          for c in ("EXT_SOURCE_MEAN", "CREDIT_INCOME_RATIO", "LOG_AMT_CREDIT")],
    ),
    "observed",
)
def qa_abt(spark, sf_dir):
    staged = materialize(gold.abt(spark, sf_dir), "abt")
    return suites.abt_suite(staged, gold.application(spark, sf_dir), raw_rows(spark, sf_dir))


@query(
    "qa_load",
    """SELECT count(*) AS rows, avg(TARGET) AS target_rate, CAST(0 AS BIGINT) AS infinities,
         CAST(count(*) - count(DISTINCT SK_ID_CURR) AS BIGINT) AS duplicate_ids FROM application""",
    "target_rate",
)
def qa_load(spark, sf_dir):
    return q.load_summary(gold.application(spark, sf_dir))

"""Raw table -> clean table. The order of the rules matters and is kept as written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from creditloom.operators import cleaning as c

# Card drawings that are zero when missing, and capped overdue columns.
DRAWINGS = tuple(
    f"{kind}_DRAWINGS_{channel}CURRENT" for kind in ("AMT", "CNT") for channel in ("ATM_", "", "POS_", "OTHER_")
)
OPTIONAL_CAPS = (
    "CNT_CREDIT_DAY_OVERDUE",
    "CNT_CREDIT_DAY_DPD",
    "AMT_CREDIT_DAY_OVERDUE",
    "AMT_CREDIT_DAY_DPD",
)


def clean_application(df: DataFrame) -> DataFrame:
    df = c.standardize_strings(df)
    df = c.sentinel_flag(df, "DAYS_EMPLOYED", c.EMPLOYED_SENTINEL, "FLAG_EMPLOYED")
    df = c.null_if(
        df, "DAYS_EMPLOYED", lambda d: (d == c.EMPLOYED_SENTINEL) | (d > 0) | (d < -c.HORIZON_DAYS)
    )
    df = c.age_years(df, "DAYS_BIRTH")
    df = c.null_if(df, "CODE_GENDER", lambda g: g == "XNA")
    df = c.null_unless(df, "OWN_CAR_AGE", "FLAG_OWN_CAR", "N")
    return c.null_if(df, "AMT_INCOME_TOTAL", lambda a: a <= 0)


def clean_bureau(df: DataFrame) -> DataFrame:
    """The percentile cap is taken before negative amounts become zero."""
    df = c.standardize_strings(df)
    df = c.null_future(df, ["DAYS_CREDIT", "DAYS_ENDDATE_FACT"])
    df = c.null_if(df, "DAYS_CREDIT_ENDDATE", lambda d: d > c.HORIZON_DAYS)
    df = c.cap_percentile(df, ["AMT_CREDIT_SUM", *OPTIONAL_CAPS])
    return c.floor_zero(df, ["AMT_CREDIT_SUM"])


def clean_bureau_balance(
    df: DataFrame, order: Sequence[str] | None = None, parts: int | None = None
) -> DataFrame:
    """Keys are deduplicated on raw months, in `parts` parts if given, before future months are capped."""
    df = c.dedupe_key(df, ["SK_ID_BUREAU", "MONTHS_BALANCE"], order, parts)
    df = c.standardize_strings(df)
    df = c.cap_upper(df, ["MONTHS_BALANCE"])
    return c.restrict_domain(df, "STATUS", c.STATUS_DOMAIN) if "STATUS" in df.columns else df


def clean_pos_cash(df: DataFrame) -> DataFrame:
    df = c.standardize_strings(c.dedupe_rows(df))
    df = c.cap_upper(df, ["MONTHS_BALANCE"])
    return c.floor_zero(df, ["SK_DPD", "SK_DPD_DEF"])


def clean_credit_card(df: DataFrame) -> DataFrame:
    df = c.standardize_strings(c.dedupe_rows(df))
    df = c.cap_upper(df, ["MONTHS_BALANCE"])
    df = c.floor_zero(df, ["SK_DPD", *c.with_prefix(df, "AMT_", "CNT_")])
    return c.fill_zero(df, DRAWINGS)


def clean_previous_application(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    df = c.dedupe_key(df, ["SK_ID_PREV"], order)
    df = c.standardize_strings(df)
    df = c.null_future(df, ["DAYS_DECISION"])
    df = c.null_beyond_horizon(df, c.with_prefix(df, "DAYS_"))
    return c.floor_zero(df, c.with_prefix(df, "AMT_"))


def clean_installments(df: DataFrame) -> DataFrame:
    df = c.dedupe_rows(df)
    df = c.null_future(df, c.with_prefix(df, "DAYS_"))
    df = c.floor_zero(df, c.with_prefix(df, "AMT_"))
    df = c.fill_zero(df, ["AMT_PAYMENT"])
    return c.days_late(df)


@dataclass(frozen=True)
class TableSpec:
    """A raw file, its cleaner, and the row count it must have, if any."""

    table_id: str
    cleaner: Callable[[DataFrame], DataFrame]
    expected_rows: int | None = None

    @property
    def raw_name(self) -> str:
        return f"{self.table_id}.csv"

    @property
    def clean_name(self) -> str:
        return f"{self.table_id}_silver.parquet"


# The tables in processing order and the volumes they must have.
TABLES = {
    spec.table_id: spec
    for spec in (
        TableSpec("application_train", clean_application, 307_511),
        TableSpec("application_test", clean_application, 48_744),
        TableSpec("bureau", clean_bureau),
        TableSpec("bureau_balance", clean_bureau_balance),
        TableSpec("POS_CASH_balance", clean_pos_cash),
        TableSpec("credit_card_balance", clean_credit_card),
        TableSpec("previous_application", clean_previous_application),
        TableSpec("installments_payments", clean_installments),
    )
}


def table_spec(table_id: str) -> TableSpec:
    if table_id not in TABLES:
        raise ValueError(f"unknown table: {table_id}")
    return TABLES[table_id]


def clean(table_id: str, df: DataFrame) -> DataFrame:
    """Apply the registered cleaner; an unknown table is an error."""
    return table_spec(table_id).cleaner(df)

"""Clean tables -> one row per client.

Each history is aggregated per client and then cut to the client universe. Aggregating
first gives the same rows and lets every task merge its rows per client before the
shuffle; a semi join ahead of it would shuffle the raw history and gather a client that
owns much of it in one task. The cut and the left join onto the application work on one
row per client, already placed by the aggregate's shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions import fill_flag, floor_below, safe_ratio
from creditloom.operators.aggregates import named_agg
from creditloom.operators.cleaning import with_prefix
from creditloom.operators.joins import inner_bridge, left_attach, require_unique, semi_filter
from creditloom.operators.quality import QualityError

CLIENT = "SK_ID_CURR"

# Feature -> (input, aggregate), and rate -> (numerator, denominator).
BUREAU_FEATURES = {
    "BUREAU_CNT_CREDITS": ("SK_ID_BUREAU", "count"),
    "BUREAU_CNT_ACTIVE": ("CREDIT_ACTIVE = 'ACTIVE'", "count_where"),
    "BUREAU_CNT_CLOSED": ("CREDIT_ACTIVE = 'CLOSED'", "count_where"),
    "BUREAU_CNT_BAD_DEBT": ("CREDIT_ACTIVE = 'BAD DEBT'", "count_where"),
    "BUREAU_AMT_CREDIT_SUM_SUM": ("AMT_CREDIT_SUM", "sum"),
    "BUREAU_AMT_CREDIT_SUM_MEAN": ("AMT_CREDIT_SUM", "mean"),
    "BUREAU_AMT_CREDIT_SUM_MAX": ("AMT_CREDIT_SUM", "max"),
    "BUREAU_AMT_DEBT_SUM": ("AMT_CREDIT_SUM_DEBT", "sum"),
    "BUREAU_AMT_OVERDUE_SUM": ("AMT_CREDIT_SUM_OVERDUE", "sum"),
    "BUREAU_AMT_OVERDUE_MAX": ("AMT_CREDIT_SUM_OVERDUE", "max"),
    "BUREAU_CREDIT_DAY_OVERDUE_MAX": ("CREDIT_DAY_OVERDUE", "max"),
    "BUREAU_DAYS_CREDIT_MIN": ("DAYS_CREDIT", "min"),
}
CONTRACT_MONTHS = {
    "months": ("MONTHS_BALANCE", "count"),
    "overdue": ("STATUS IN ('1', '2', '3', '4', '5')", "count_where"),
    "closed": ("STATUS = 'C'", "count_where"),
    "unknown": ("STATUS = 'X'", "count_where"),
}
BALANCE_FEATURES = {
    "BB_CNT_MONTHS": ("months", "sum"),
    "BB_CNT_OVERDUE": ("overdue", "sum"),
    "BB_CNT_CLOSED": ("closed", "sum"),
    "BB_CNT_UNKNOWN": ("unknown", "sum"),
    "BB_RATE_OVERDUE_MAX": ("overdue_rate", "max"),
    "BB_RATE_OVERDUE_MEAN": ("overdue_rate", "mean"),
    "BB_CONTRACTS_WITH_OVERDUE": ("overdue > 0", "count_where"),
}
POS_FEATURES = {
    "POS_CNT_MONTHS": ("MONTHS_BALANCE", "count"),
    "POS_SK_DPD_MAX": ("SK_DPD", "max"),
    "POS_SK_DPD_MEAN": ("SK_DPD", "mean"),
    "POS_CNT_DPD_GT0": ("SK_DPD > 0", "count_where"),
    "POS_CNT_CONTRACTS": ("SK_ID_PREV", "nunique"),
}
POS_RATES = {"POS_RATE_DPD": ("POS_CNT_DPD_GT0", "POS_CNT_MONTHS")}
CARD_USAGE = "AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0)"
CARD_FEATURES = {
    "CC_CNT_MONTHS": ("MONTHS_BALANCE", "count"),
    "CC_SK_DPD_MAX": ("SK_DPD", "max"),
    "CC_SK_DPD_MEAN": ("SK_DPD", "mean"),
    "CC_CNT_DPD_GT0": ("SK_DPD > 0", "count_where"),
    "CC_AMT_BALANCE_MEAN": ("AMT_BALANCE", "mean"),
    "CC_AMT_BALANCE_MAX": ("AMT_BALANCE", "max"),
    "CC_AMT_LIMIT_MEAN": ("AMT_CREDIT_LIMIT_ACTUAL", "mean"),
    "CC_UTILIZATION_MEAN": (CARD_USAGE, "mean"),
    "CC_UTILIZATION_MAX": (CARD_USAGE, "max"),
    "CC_CNT_DRAWINGS_ATM_SUM": ("CNT_DRAWINGS_ATM_CURRENT", "sum"),
}
CARD_RATES = {"CC_RATE_DPD": ("CC_CNT_DPD_GT0", "CC_CNT_MONTHS")}
PREVIOUS_FEATURES = {
    "PREV_CNT_APPS": ("SK_ID_PREV", "count"),
    "PREV_CNT_APPROVED": ("NAME_CONTRACT_STATUS = 'APPROVED'", "count_where"),
    "PREV_CNT_REFUSED": ("NAME_CONTRACT_STATUS = 'REFUSED'", "count_where"),
    "PREV_CNT_CANCELED": ("NAME_CONTRACT_STATUS = 'CANCELED'", "count_where"),
    "PREV_AMT_APPLICATION_MEAN": ("AMT_APPLICATION", "mean"),
    "PREV_AMT_APPLICATION_MAX": ("AMT_APPLICATION", "max"),
    "PREV_AMT_CREDIT_MEAN": ("AMT_CREDIT", "mean"),
    "PREV_DAYS_DECISION_MIN": ("DAYS_DECISION", "min"),
}
PREVIOUS_RATES = {
    "PREV_APPROVAL_RATE": ("PREV_CNT_APPROVED", "PREV_CNT_APPS"),
    "PREV_REFUSAL_RATE": ("PREV_CNT_REFUSED", "PREV_CNT_APPS"),
}
INSTALMENT = {
    "due": ("AMT_INSTALMENT", "max"),
    "paid": ("AMT_PAYMENT", "sum"),
    "late": ("DIAS_DE_ATRASO", "max"),
}
INSTALMENT_FEATURES = {
    "INST_CNT_PARCELAS": ("NUM_INSTALMENT_NUMBER", "count"),
    "INST_AMT_INSTALMENT_SUM": ("due", "sum"),
    "INST_AMT_PAYMENT_SUM": ("paid", "sum"),
    "INST_AMT_GAP_SUM": ("gap", "sum"),
    "INST_DIAS_ATRASO_MEAN": ("late", "mean"),
    "INST_DIAS_ATRASO_MAX": ("late", "max"),
    "INST_CNT_ATRASO": ("late > 0", "count_where"),
    "INST_CNT_CALOTE": ("paid = 0", "count_where"),
    "INST_CNT_UNDERPAY": ("gap > 0", "count_where"),
}
INSTALMENT_RATES = {
    "INST_PAYMENT_RATIO": ("INST_AMT_PAYMENT_SUM", "INST_AMT_INSTALMENT_SUM"),
    "INST_RATE_ATRASO": ("INST_CNT_ATRASO", "INST_CNT_PARCELAS"),
    "INST_RATE_CALOTE": ("INST_CNT_CALOTE", "INST_CNT_PARCELAS"),
    "INST_RATE_UNDERPAY": ("INST_CNT_UNDERPAY", "INST_CNT_PARCELAS"),
}


def _per_client(
    df: DataFrame,
    features: Mapping[str, tuple[str, str]],
    rates: Mapping[str, tuple[str, str]],
    presence: str,
    universe: DataFrame | None,
) -> DataFrame:
    """Features per client, cut to the universe, with rates and the presence flag.

    Without a universe the later left join drops the other clients.
    """
    out = named_agg(df, [CLIENT], features)
    if universe is not None:
        out = semi_filter(out, universe, CLIENT)
    return out.withColumns(
        {**{r: safe_ratio(F.col(n), F.col(d)) for r, (n, d) in rates.items()}, presence: F.lit(1)}
    )


def aggregate_bureau(bureau: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    return _per_client(bureau, BUREAU_FEATURES, {}, "HAS_BUREAU", universe)


def aggregate_bureau_balance(
    balance: DataFrame, links: DataFrame, universe: DataFrame | None = None, check: bool = True
) -> DataFrame:
    """Months -> contract -> client; months shrink to one row per contract before the bridge join."""
    contracts = named_agg(balance, ["SK_ID_BUREAU"], CONTRACT_MONTHS).withColumn(
        "overdue_rate", safe_ratio(F.col("overdue"), F.col("months"))
    )
    bridged = inner_bridge(contracts, links, "SK_ID_BUREAU", CLIENT, check)
    return _per_client(bridged, BALANCE_FEATURES, {}, "HAS_BUREAU_BALANCE", universe)


def aggregate_pos_cash(pos: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    return _per_client(pos, POS_FEATURES, POS_RATES, "HAS_POS_CASH", universe)


def aggregate_credit_card(card: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    return _per_client(card, CARD_FEATURES, CARD_RATES, "HAS_CREDIT_CARD", universe)


def aggregate_previous_application(previous: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    return _per_client(previous, PREVIOUS_FEATURES, PREVIOUS_RATES, "HAS_PREVIOUS_APP", universe)


def aggregate_installments(payments: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Split payments collapse to one row per instalment before the client level."""
    instalments = named_agg(payments, ["SK_ID_PREV", CLIENT, "NUM_INSTALMENT_NUMBER"], INSTALMENT)
    instalments = instalments.withColumn("gap", floor_below(F.col("due") - F.col("paid"), 0.0))
    return _per_client(instalments, INSTALMENT_FEATURES, INSTALMENT_RATES, "HAS_INSTALLMENTS", universe)


def check_binary_flags(df: DataFrame) -> None:
    """`HAS_*` must be 0, 1 or null."""
    flags = with_prefix(df, "HAS_")
    if not flags:
        return
    bad = df.agg(*[F.count_if(~F.col(c).isin(0, 1)).alias(c) for c in flags]).first()
    wrong = [c for c in flags if bad[c]]
    if wrong:
        raise QualityError("abt", [f"{c} must hold only 0, 1 or null" for c in wrong])


def build_abt(application: DataFrame, aggregates: Mapping[str, DataFrame], check: bool = True) -> DataFrame:
    """Attach the aggregates; an absent history gives HAS_* = 0 and null features.

    `check` looks for repeated keys and non-binary flags with jobs of their own; sides
    that were grouped by the client key in the same plan do not need it.
    """
    if check:
        require_unique(application, [CLIENT], "application")
    out = application
    for name, side in aggregates.items():
        if check:
            check_binary_flags(side)
        out = left_attach(out, side, CLIENT, name, check)
    flags = with_prefix(out, "HAS_")
    return out.withColumns({c: fill_flag(F.col(c)) for c in flags}) if flags else out


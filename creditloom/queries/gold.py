"""Per-client aggregates and the modelling table."""

from __future__ import annotations



from creditloom.operators.features import enrich_application
from creditloom.plans import gold, silver
from creditloom.queries.cleaning import clean_bureau_balance
from creditloom.queries.registry import query
from creditloom.sources import fixtures as fx

BUREAU = (
    "BUREAU_AMT_CREDIT_SUM_SUM BUREAU_AMT_CREDIT_SUM_MEAN BUREAU_AMT_CREDIT_SUM_MAX BUREAU_AMT_DEBT_SUM "
    "BUREAU_AMT_OVERDUE_SUM BUREAU_AMT_OVERDUE_MAX"
)
BALANCE = "BB_RATE_OVERDUE_MAX BB_RATE_OVERDUE_MEAN"
POS = "POS_SK_DPD_MEAN POS_RATE_DPD"
CARD = (
    "CC_SK_DPD_MEAN CC_AMT_BALANCE_MEAN CC_AMT_BALANCE_MAX CC_AMT_LIMIT_MEAN CC_UTILIZATION_MEAN "
    "CC_UTILIZATION_MAX CC_CNT_DRAWINGS_ATM_SUM CC_RATE_DPD"
)
PREVIOUS = (
    "PREV_AMT_APPLICATION_MEAN PREV_AMT_APPLICATION_MAX PREV_AMT_CREDIT_MEAN PREV_APPROVAL_RATE PREV_REFUSAL_RATE"
)
INSTALMENTS = (
    "INST_AMT_INSTALMENT_SUM INST_AMT_PAYMENT_SUM INST_AMT_GAP_SUM INST_DIAS_ATRASO_MEAN INST_PAYMENT_RATIO "
    "INST_RATE_ATRASO INST_RATE_CALOTE INST_RATE_UNDERPAY"
)


def application(spark, sf_dir):
    return enrich_application(silver.clean_application(fx.raw_application(spark, sf_dir)))


def clean_bureau(spark, sf_dir):
    return silver.clean_bureau(fx.raw_bureau(spark, sf_dir))


def whole(spark, sf_dir):
    """No universe: the join onto the application cuts the clients."""


def universe(spark, sf_dir):
    return fx.raw_application(spark, sf_dir).select(gold.CLIENT)


@query("agg_bureau", "SELECT * FROM agg_bureau", BUREAU)
def agg_bureau(spark, sf_dir, clients=universe):
    return gold.aggregate_bureau(clean_bureau(spark, sf_dir), clients(spark, sf_dir))


@query("agg_bureau_balance", "SELECT * FROM agg_bureau_balance", BALANCE)
def agg_bureau_balance(spark, sf_dir, clients=universe):
    balance = clean_bureau_balance(spark, sf_dir)
    links = fx.raw_bureau(spark, sf_dir).select("SK_ID_BUREAU", gold.CLIENT)
    return gold.aggregate_bureau_balance(balance, links, clients(spark, sf_dir), check=False)


@query("agg_pos_cash", "SELECT * FROM agg_pos_cash", POS)
def agg_pos_cash(spark, sf_dir, clients=universe):
    return gold.aggregate_pos_cash(silver.clean_pos_cash(fx.raw_pos_cash(spark, sf_dir)), clients(spark, sf_dir))


@query("agg_credit_card", "SELECT * FROM agg_credit_card", CARD)
def agg_credit_card(spark, sf_dir, clients=universe):
    card = silver.clean_credit_card(fx.raw_credit_card(spark, sf_dir))
    return gold.aggregate_credit_card(card, clients(spark, sf_dir))


@query("agg_previous", "SELECT * FROM agg_previous", PREVIOUS)
def agg_previous(spark, sf_dir, clients=universe):
    previous = silver.clean_previous_application(fx.raw_previous_application(spark, sf_dir))
    return gold.aggregate_previous_application(previous, clients(spark, sf_dir))


@query("agg_installments", "SELECT * FROM agg_installments", INSTALMENTS)
def agg_installments(spark, sf_dir, clients=universe):
    payments = silver.clean_installments(fx.raw_installments(spark, sf_dir))
    return gold.aggregate_installments(payments, clients(spark, sf_dir))


AGGREGATES = {
    "bureau": agg_bureau,
    "bureau_balance": agg_bureau_balance,
    "pos_cash": agg_pos_cash,
    "credit_card": agg_credit_card,
    "previous_application": agg_previous,
    "installments": agg_installments,
}


@query(
    "build_abt",
    "SELECT * FROM abt",
    " ".join([
        "AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY OWN_CAR_AGE EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3",
        "EXT_SOURCE_MEAN CREDIT_INCOME_RATIO ANNUITY_INCOME_RATIO LOG_AMT_CREDIT DAYS_EMPLOYED_YEARS",
        BUREAU, BALANCE, POS, CARD, PREVIOUS, INSTALMENTS,
    ]),
)
def abt(spark, sf_dir):
    """Every side is grouped by the client key in this plan, so its keys are unique."""
    sides = {name: build(spark, sf_dir, whole) for name, build in AGGREGATES.items()}
    return gold.build_abt(application(spark, sf_dir), sides, check=False)

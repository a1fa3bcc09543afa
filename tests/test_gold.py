import pytest
from pyspark.sql import functions as F

from creditloom.operators.features import enrich_application, feature_columns
from creditloom.operators.joins import DuplicateKeyError
from creditloom.operators.quality import QualityError
from creditloom.plans import gold


@pytest.fixture()
def clients(spark):
    return spark.createDataFrame([(1,)], "SK_ID_CURR int")


@pytest.fixture()
def bureau(spark):
    return spark.createDataFrame(
        [(1, 10, "ACTIVE", 100.0, 50.0, 5.0, 2, -100), (1, 11, "CLOSED", 200.0, 0.0, 0.0, 0, -200),
         (2, 20, "BAD DEBT", 900.0, 400.0, 10.0, 4, -300)],
        "SK_ID_CURR int, SK_ID_BUREAU int, CREDIT_ACTIVE string, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double,"
        "AMT_CREDIT_SUM_OVERDUE double, CREDIT_DAY_OVERDUE int, DAYS_CREDIT int",
    )


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_bureau(spark, bureau, clients):
    row = only(gold.aggregate_bureau(bureau, clients))
    assert (row["BUREAU_CNT_CREDITS"], row["BUREAU_CNT_ACTIVE"], row["BUREAU_CNT_CLOSED"], row["BUREAU_CNT_BAD_DEBT"]) == (2, 1, 1, 0)
    assert (row["BUREAU_AMT_CREDIT_SUM_SUM"], row["BUREAU_AMT_DEBT_SUM"], row["HAS_BUREAU"]) == (300.0, 50.0, 1)


def test_sum_of_nothing_is_zero_mean_is_null(spark, clients):
    empty = spark.createDataFrame(
        [(1, 10, None, None, None, None, None, None)],
        "SK_ID_CURR int, SK_ID_BUREAU int, CREDIT_ACTIVE string, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double,"
        "AMT_CREDIT_SUM_OVERDUE double, CREDIT_DAY_OVERDUE int, DAYS_CREDIT int",
    )
    row = only(gold.aggregate_bureau(empty, clients))
    assert row["BUREAU_AMT_CREDIT_SUM_SUM"] == 0 and row["BUREAU_AMT_CREDIT_SUM_MEAN"] is None
    assert row["BUREAU_CNT_ACTIVE"] == 0


def test_bureau_balance(spark, bureau, clients):
    balance = spark.createDataFrame(
        [(10, -1, "0"), (10, -2, "1"), (11, -1, "C"), (11, -2, "X"), (20, -1, "5")],
        "SK_ID_BUREAU int, MONTHS_BALANCE int, STATUS string",
    )
    row = only(gold.aggregate_bureau_balance(balance, bureau, clients))
    assert (row["BB_CNT_MONTHS"], row["BB_CNT_OVERDUE"], row["BB_CNT_CLOSED"], row["BB_CNT_UNKNOWN"]) == (4, 1, 1, 1)
    assert (row["BB_RATE_OVERDUE_MAX"], row["BB_RATE_OVERDUE_MEAN"], row["BB_CONTRACTS_WITH_OVERDUE"]) == (0.5, 0.25, 1)


def test_bridge_must_be_many_to_one(spark, clients):
    balance = spark.createDataFrame([(10, -1, "0")], "SK_ID_BUREAU int, MONTHS_BALANCE int, STATUS string")
    links = spark.createDataFrame([(10, 1), (10, 2)], "SK_ID_BUREAU int, SK_ID_CURR int")
    with pytest.raises(DuplicateKeyError):
        gold.aggregate_bureau_balance(balance, links, clients)


def test_pos_cash(spark, clients):
    pos = spark.createDataFrame(
        [(1, 10, -1, 0), (1, 10, -2, 2), (2, 20, -1, 9)], "SK_ID_CURR int, SK_ID_PREV int, MONTHS_BALANCE int, SK_DPD int"
    )
    row = only(gold.aggregate_pos_cash(pos, clients))
    assert (row["POS_CNT_MONTHS"], row["POS_CNT_DPD_GT0"], row["POS_RATE_DPD"], row["POS_CNT_CONTRACTS"]) == (2, 1, 0.5, 1)


def test_credit_card_zero_limit(spark, clients):
    card = spark.createDataFrame(
        [(1, -1, 0, 50.0, 100.0, 1.0), (1, -2, 1, 20.0, 0.0, 2.0)],
        "SK_ID_CURR int, MONTHS_BALANCE int, SK_DPD int, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double,"
        "CNT_DRAWINGS_ATM_CURRENT double",
    )
    row = only(gold.aggregate_credit_card(card, clients))
    assert (row["CC_UTILIZATION_MAX"], row["CC_RATE_DPD"], row["CC_CNT_DRAWINGS_ATM_SUM"]) == (0.5, 0.5, 3.0)


def test_previous(spark, clients):
    previous = spark.createDataFrame(
        [(1, 10, "APPROVED", 100.0, 90.0, -10), (1, 11, "REFUSED", 200.0, 180.0, -20)],
        "SK_ID_CURR int, SK_ID_PREV int, NAME_CONTRACT_STATUS string, AMT_APPLICATION double, AMT_CREDIT double, DAYS_DECISION int",
    )
    row = only(gold.aggregate_previous_application(previous, clients))
    assert (row["PREV_CNT_APPS"], row["PREV_APPROVAL_RATE"], row["PREV_REFUSAL_RATE"]) == (2, 0.5, 0.5)
    assert row["PREV_AMT_APPLICATION_MEAN"] == 150.0


def test_installments_collapse(spark, clients):
    payments = spark.createDataFrame(
        [(1, 10, 1, 100.0, 40.0, 1.0), (1, 10, 1, 100.0, 60.0, 2.0)],
        "SK_ID_CURR int, SK_ID_PREV int, NUM_INSTALMENT_NUMBER int, AMT_INSTALMENT double, AMT_PAYMENT double, DIAS_DE_ATRASO double",
    )
    row = only(gold.aggregate_installments(payments, clients))
    assert (row["INST_CNT_PARCELAS"], row["INST_AMT_INSTALMENT_SUM"], row["INST_AMT_PAYMENT_SUM"]) == (1, 100.0, 100.0)
    assert (row["INST_CNT_ATRASO"], row["INST_CNT_UNDERPAY"], row["INST_PAYMENT_RATIO"]) == (1, 0, 1.0)


def test_abt_keeps_clients_and_missing(spark):
    application = spark.createDataFrame([(1, 0, 100.0), (2, 1, 200.0)], "SK_ID_CURR int, TARGET int, AMT_CREDIT double")
    side = spark.createDataFrame([(1, 1, 3, 9.0)], "SK_ID_CURR int, HAS_BUREAU int, BUREAU_CNT_CREDITS int, AMT_CREDIT double")
    rows = gold.build_abt(application, {"bureau": side}).orderBy("SK_ID_CURR").collect()
    assert [(r["HAS_BUREAU"], r["BUREAU_CNT_CREDITS"], r["AMT_CREDIT_bureau"]) for r in rows] == [(1, 3, 9.0), (0, None, None)]


def test_abt_rejects_duplicates_and_bad_flags(spark):
    application = spark.createDataFrame([(1, 0)], "SK_ID_CURR int, TARGET int")
    twice = spark.createDataFrame([(1, 1), (1, 1)], "SK_ID_CURR int, HAS_BUREAU int")
    with pytest.raises(DuplicateKeyError, match="bureau"):
        gold.build_abt(application, {"bureau": twice})
    for value in (257.0, 1.5):
        bad = spark.createDataFrame([(1, value)], "SK_ID_CURR int, HAS_BUREAU double")
        with pytest.raises(QualityError, match="HAS_BUREAU"):
            gold.build_abt(application, {"bureau": bad})


def test_enrich(spark):
    df = spark.createDataFrame(
        [(1, 0.2, 0.4, 100.0, 50.0, 10.0, -365.25), (2, None, 0.6, 200.0, 0.0, 20.0, -730.5)],
        "SK_ID_CURR int, EXT_SOURCE_1 double, EXT_SOURCE_2 double, AMT_CREDIT double, AMT_INCOME_TOTAL double,"
        "AMT_ANNUITY double, DAYS_EMPLOYED double",
    )
    a, b = enrich_application(df).orderBy("SK_ID_CURR").collect()
    assert a["EXT_SOURCE_MEAN"] == pytest.approx(0.3) and b["EXT_SOURCE_MEAN"] == pytest.approx(0.6)
    assert (a["EXT_SOURCE_CNT"], b["EXT_SOURCE_CNT"], b["FLAG_EXT_SOURCE_1_MISSING"]) == (2, 1, 1)
    assert a["CREDIT_INCOME_RATIO"] == 2.0 and b["CREDIT_INCOME_RATIO"] is None
    assert (a["DAYS_EMPLOYED_YEARS"], b["DAYS_EMPLOYED_YEARS"]) == (1.0, 2.0)
    assert "EXT_SOURCE_3" not in enrich_application(df).columns


def test_tracks():
    with pytest.raises(ValueError, match="absent"):
        feature_columns(["A"], "core")
    with pytest.raises(ValueError, match="unknown"):
        feature_columns(["A"], "tiny")
    assert feature_columns(["SK_ID_CURR", "TARGET", "A"]) == ["A"]


def test_hot_client_is_merged_before_the_shuffle(spark):
    """Every task sends at most one row per client, so a client with most rows is no hot spot."""
    pos = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).cast("int").alias("SK_ID_CURR"),
        (F.col("id") % 11).cast("int").alias("SK_ID_PREV"),
        F.lit(-1).alias("MONTHS_BALANCE"),
        F.lit(1).alias("SK_DPD"),
    )
    universe = spark.createDataFrame([(7,)], "SK_ID_CURR int")
    out = gold.aggregate_pos_cash(pos, universe)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan or "partial_count" in plan
    assert plan.index("Join") < plan.index("partial_"), "the universe is applied to aggregated rows"
    assert only(out)["POS_CNT_MONTHS"] == 20_000

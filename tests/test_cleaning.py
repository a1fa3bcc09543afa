import pytest
from pyspark.sql import functions as F

from creditloom import functions as fn
from creditloom.operators import cleaning as c
from creditloom.plans import silver


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).collect()]


def test_application_rules(spark):
    raw = spark.createDataFrame(
        [
            (0, 365243, -7300, " xna ", " n ", 5.0, 0.0, " higher "),
            (1, -3650, -10950, " f ", "Y", 2.0, 100.0, "School"),
            (2, 2, -14600, "M", "N", None, -1.0, None),
            (3, -20000, -18250, "F", "Y", 4.0, 200.0, "X"),
            (4, None, -21900, "M", "N", 1.0, 300.0, "  "),
        ],
        "SK_ID_CURR int, DAYS_EMPLOYED int, DAYS_BIRTH int, CODE_GENDER string, FLAG_OWN_CAR string,"
        "OWN_CAR_AGE double, AMT_INCOME_TOTAL double, NAME_EDUCATION_TYPE string",
    )
    out = silver.clean("application_train", raw)
    assert column(out, "FLAG_EMPLOYED", "SK_ID_CURR") == [0, 1, 1, 1, None]
    assert column(out, "DAYS_EMPLOYED", "SK_ID_CURR") == [None, -3650, None, None, None]
    assert column(out, "AGE_YEARS", "SK_ID_CURR") == [20, 30, 40, 50, 60]
    assert column(out, "CODE_GENDER", "SK_ID_CURR") == [None, "F", "M", "F", "M"]
    assert column(out, "OWN_CAR_AGE", "SK_ID_CURR") == [None, 2.0, None, 4.0, None]
    assert column(out, "AMT_INCOME_TOTAL", "SK_ID_CURR") == [None, 100.0, None, 200.0, 300.0]
    assert column(out, "NAME_EDUCATION_TYPE", "SK_ID_CURR") == ["HIGHER", "SCHOOL", None, "X", None]


def test_bureau_balance_dedupes_before_capping(spark):
    raw = spark.createDataFrame(
        [(1, 1, " c "), (1, 1, "C"), (2, -1, "invalid"), (3, 1, "0"), (3, 0, "1")],
        "SK_ID_BUREAU int, MONTHS_BALANCE int, STATUS string",
    )
    rows = silver.clean("bureau_balance", raw).orderBy("SK_ID_BUREAU", "STATUS").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "C"), (2, -1, None), (3, 0, "0"), (3, 0, "1")]


def test_credit_card_zeros(spark):
    raw = spark.createDataFrame(
        [(1, -1, -5.0, None, None)],
        "MONTHS_BALANCE int, SK_DPD int, AMT_BALANCE double, CNT_DRAWINGS_CURRENT double, AMT_DRAWINGS_ATM_CURRENT double",
    )
    assert tuple(silver.clean("credit_card_balance", raw).first()) == (0, 0, 0.0, 0.0, 0.0)


def test_pos_cash_keeps_missing(spark):
    raw = spark.createDataFrame(
        [(2, -1, -2), (2, -1, -2), (-1, 3, 4), (None, None, None)], "MONTHS_BALANCE int, SK_DPD int, SK_DPD_DEF int"
    )
    rows = {tuple(r) for r in silver.clean("POS_CASH_balance", raw).collect()}
    assert rows == {(0, 0, 0), (-1, 3, 4), (None, None, None)}


def test_bureau_tail_and_dates(spark):
    raw = spark.createDataFrame(
        [(" active ", 1, 2, 18251, -5.0), ("Closed", -10, -1, 10, 10.0), ("Active", -20, -2, -20, 20.0),
         ("Closed", -30, -3, -30, 1_000_000.0)],
        "CREDIT_ACTIVE string, DAYS_CREDIT int, DAYS_ENDDATE_FACT int, DAYS_CREDIT_ENDDATE int, AMT_CREDIT_SUM double",
    )
    rows = silver.clean("bureau", raw).orderBy("AMT_CREDIT_SUM").collect()
    assert tuple(rows[0]) == ("ACTIVE", None, None, None, 0.0)
    # linear interpolation between the two largest values
    assert rows[-1]["AMT_CREDIT_SUM"] == pytest.approx(20 + (1_000_000 - 20) * (0.999 * 3 - 2))


def test_previous_and_installments(spark):
    previous = spark.createDataFrame(
        [(1, 2, 365243, -1.0), (1, 2, 365243, -1.0), (2, -10, 18251, 20.0)],
        "SK_ID_PREV int, DAYS_DECISION int, DAYS_FIRST_DRAWING int, AMT_APPLICATION double",
    )
    rows = silver.clean("previous_application", previous).orderBy("SK_ID_PREV").collect()
    assert [tuple(r) for r in rows] == [(1, None, None, 0.0), (2, -10, None, 20.0)]
    payments = spark.createDataFrame(
        [(1, -8.0, -10.0, 50.0), (1, -8.0, -10.0, 50.0), (1, None, -10.0, None)],
        "SK_ID_PREV int, DAYS_ENTRY_PAYMENT double, DAYS_INSTALMENT double, AMT_PAYMENT double",
    )
    rows = silver.clean("installments_payments", payments).orderBy("AMT_PAYMENT").collect()
    assert [r["AMT_PAYMENT"] for r in rows] == [0.0, 50.0]
    assert [r["DIAS_DE_ATRASO"] for r in rows] == [None, 2.0]


def test_rules_ignore_absent_columns(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for table in silver.TABLES:
        assert silver.clean(table, df).columns == ["x"]
    with pytest.raises(ValueError, match="unknown table"):
        silver.clean("nope", df)


def test_require_keys(spark):
    with pytest.raises(ValueError, match="empty"):
        c.require_keys(spark.createDataFrame([], "k int"), ["k"])
    with pytest.raises(ValueError, match="null key"):
        c.require_keys(spark.createDataFrame([(None,)], "k int"), ["k"])


@pytest.mark.parametrize(
    "text,value",
    [("R$ 1.250,50", 1250.5), ("1250,5", 1250.5), (" 12.5 ", 12.5), ("Sem Info", None), ("", None), ("12a", None),
     (None, None), ("1d", None), ("-3", -3.0), ("nan", None), ("1.250.600,00", 1250600.0)],
)
def test_parse_money(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fn.parse_money(F.col("t")).alias("v")).first()["v"] == value


@pytest.mark.parametrize(
    "text,iso",
    [("2026-01-02T03:04:05Z", "2026-01-02 03:04:05"), ("2026-01-02T03:04:05", "2026-01-02 03:04:05"),
     ("2026-01-02T03:04:05+02:00", "2026-01-02 01:04:05"), ("2026-01-02", "2026-01-02 00:00:00"), ("bad", None),
     ("", None), ("2026-13-02T00:00:00", None)],
)
def test_parse_utc(spark, text, iso):
    df = spark.createDataFrame([(text,)], "t string")
    value = df.select(fn.parse_utc(F.col("t")).cast("string").alias("v")).first()["v"]
    assert value == iso


def test_freshness(spark):
    now = F.lit("2026-01-02 12:00:00").cast("timestamp")
    df = spark.createDataFrame(
        [("2026-01-01T12:00:00Z",), ("2026-01-01T11:59:59Z",), (None,), ("2026-01-03T00:00:00Z",)], "t string"
    )
    got = [r[0] for r in df.select(fn.is_fresh(fn.parse_utc(F.col("t")), now)).collect()]
    assert got == [True, False, False, True]


def test_null_rules(spark):
    df = spark.createDataFrame([(None, None), (5.0, 0.0), (-5.0, 2.0)], "a double, b double")
    rows = df.select(
        fn.cap_above(F.col("a"), 0).alias("cap"),
        fn.floor_below(F.col("a"), 0).alias("floor"),
        fn.flag(F.col("a") > 0).alias("flag"),
        fn.safe_ratio(F.col("a"), F.col("b")).alias("ratio"),
    ).collect()
    assert [tuple(r) for r in rows] == [(None, None, 0, None), (0.0, 5.0, 1, None), (-5.0, 0.0, 0, -2.5)]


def test_strip_upper_strips_any_space(spark):
    df = spark.createDataFrame([("\t a b ",), (" \n",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.strip_upper(F.col("t"))).collect()] == ["A B", None, None]


def test_within_bounds(spark):
    rows = spark.createDataFrame(
        [(1, "AMT_CREDIT", "10,5"), (1, "AMT_CREDIT", "0"), (1, "AMT_ANNUITY", "x"), (1, "OTHER", "1")],
        "client_id int, feature string, value string",
    )
    got = c.within_bounds(rows, {"AMT_CREDIT": (1.0, 100.0), "AMT_ANNUITY": (1.0, 10.0)}).collect()
    assert [(r["feature"], r["parsed"], r["accepted"]) for r in got] == [
        ("AMT_CREDIT", 10.5, True), ("AMT_CREDIT", 0.0, False), ("AMT_ANNUITY", None, False)
    ]

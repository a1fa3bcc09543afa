import pytest
from pyspark.sql import functions as F

from creditloom.operators import profiling as p
from creditloom.operators import quality as q
from creditloom.plans import suites


def levels(results):
    return {r["check"]: r["level"] for r in results.collect()}


def test_all_failures_are_collected(spark):
    df = spark.createDataFrame([(1, 5), (1, None)], "MONTHS_BALANCE int, SK_DPD int")
    results = suites.silver_suite("POS_CASH_balance", df)
    assert levels(results) == {
        "MONTHS_BALANCE_not_future": "FAIL", "SK_DPD_not_negative": "PASS", "SK_DPD_DEF_present": "WARNING"
    }
    bad = spark.createDataFrame([(1, -5)], "MONTHS_BALANCE int, SK_DPD int")
    with pytest.raises(q.QualityError) as error:
        q.raise_on_failure(suites.silver_suite("POS_CASH_balance", bad))
    assert len(error.value.failures) == 2


def test_absent_columns_only_warn(spark):
    df = spark.createDataFrame([(1,)], "other int")
    for table in suites.SILVER_CHECKS:
        if not table.startswith("application"):
            assert set(levels(suites.silver_suite(table, df)).values()) == {"WARNING"}
    application = levels(q.run_suite(df, "application", suites.application_checks(df, 1)))
    assert application.pop("row_count") == "PASS"
    assert set(application.values()) == {"WARNING"}


def test_unknown_names(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        suites.silver_suite("nope", df)
    with pytest.raises(ValueError):
        suites.gold_suite("nope", df, df)
    with pytest.raises(q.QualityError, match="AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT"):
        suites.require_stage_columns("bureau", df)


def test_null_is_a_failure_only_where_every_row_must_hold(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    checks = [
        q.no_rows_where("not_negative", F.col("x") < 0),
        q.all_rows("positive", F.col("x") > 0),
        q.unit_interval("x"),
        q.no_nulls("x"),
        q.not_all_null("x"),
        q.in_domain("x", [1.0]),
        q.info_count("many", F.col("x") > 5),
        q.info_null_rate("x"),
    ]
    got = {r["check"]: (r["level"], r["observed"]) for r in q.run_suite(df, "s", checks).collect()}
    assert got == {
        "not_negative": ("PASS", 0), "positive": ("FAIL", 1), "x_unit_interval": ("PASS", 0), "x_no_nulls": ("FAIL", 1),
        "x_filled": ("PASS", 1), "x_domain": ("PASS", 0), "x_null_rate": ("INFO", 0.5),
    }


def test_unique_universe_and_infinite(spark):
    df = spark.createDataFrame([(1, 0.5), (1, float("inf")), (None, 1.0), (None, 2.0)], "k int, x double")
    universe = spark.createDataFrame([(1,), (1,)], "k int")
    checks = [q.unique_key(df, ["k"]), q.keys_in_universe(df, universe, "k"), q.no_infinite(df)]
    got = {r["check"]: r["observed"] for r in q.run_suite(df, "s", checks).collect()}
    assert got == {"unique_k": 2, "k_in_universe": 2, "no_infinite": 1}


def test_cap_check(spark):
    values = [float(i) for i in range(2000)] + [1e9]
    df = spark.createDataFrame([(v,) for v in values], "AMT_CREDIT_SUM double")
    row = [r for r in suites.silver_suite("bureau", df).collect() if r["check"] == "AMT_CREDIT_SUM_capped"][0]
    assert row["level"] == "FAIL" and row["observed"] == 1  # 1998.0 * 1.001 leaves only the outlier


def test_abt_suite(spark):
    application = spark.createDataFrame([(i, int(i < 8)) for i in range(100)], "SK_ID_CURR int, TARGET int")
    abt = application.withColumns({"HAS_BUREAU": F.lit(0), "BUREAU_CNT_CREDITS": F.lit(None).cast("int")})
    got = levels(suites.abt_suite(abt, application, 100))
    assert "FAIL" not in got.values() and got["HAS_BUREAU_coverage"] == "INFO"
    changed = abt.withColumn("TARGET", F.when(F.col("SK_ID_CURR") == 3, 0).otherwise(F.col("TARGET")))
    assert levels(suites.abt_suite(changed, application))["TARGET_unchanged"] == "FAIL"
    filled = abt.withColumn("BUREAU_CNT_CREDITS", F.lit(1))
    assert levels(suites.abt_suite(filled, application))["HAS_BUREAU_0_implies_no_BUREAU_CNT_CREDITS"] == "FAIL"
    assert levels(suites.abt_suite(abt, application, 5))["row_count"] == "FAIL"


def test_load_summary(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, float("inf"))], "SK_ID_CURR int, TARGET int, x double")
    row = q.load_summary(df).first()
    assert (row["rows"], row["target_rate"], row["infinities"], row["duplicate_ids"]) == (2, 0.5, 1, 1)
    with pytest.raises(q.QualityError):
        q.load_summary(df.drop("TARGET"))


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "a", 1.0)], "k int, t string, x double")
    assert [(r["column"], r["nulls"], r["pct"]) for r in p.null_profile(df).collect()] == [("t", 1, 50.0), ("x", 1, 50.0)]
    row = p.key_profile(spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int"), ["a", "b"], "a").first()
    assert (row["rows"], row["keys"], row["duplicates"], row["avg_per_parent"]) == (3, 2, 1, 3.0)

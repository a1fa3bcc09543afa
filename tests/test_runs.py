from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from creditloom.operators.quality import QualityError, no_rows_where
from creditloom.plans import runs
from creditloom.session import shared_dir
from creditloom.sources import fixtures as fx
from creditloom.sources.publish import _claim, stage
from creditloom.sources import (
    audit_landing,
    latest_report,
    publish_if_valid,
    published_runs,
    read_csv_table,
    read_dictionary,
    read_published,
    remove_orphans,
    write_report,
)

SF = "/root/testdata/sf0.001"


def not_negative(df):
    return [no_rows_where("x_not_negative", F.col("x") < 0)]


def test_failed_run_keeps_the_last_good_version(spark):
    path = shared_dir(spark, "t")
    publish_if_valid(spark.createDataFrame([(1,)], "x int"), "t", not_negative, path, "run/1")
    with pytest.raises(QualityError):
        publish_if_valid(spark.createDataFrame([(-1,)], "x int"), "t", not_negative, path, "run/2")
    assert [r["x"] for r in read_published(spark, path).collect()] == [1]
    assert spark.read.parquet(f"{path}/runs/run_2").first()["x"] == -1  # kept for inspection
    publish_if_valid(spark.createDataFrame([(3,)], "x int"), "t", not_negative, path, "run/3")
    assert [r["x"] for r in read_published(spark, path).collect()] == [3]


def test_csv_missing_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c\n1,NaN,"x, ""y"""\n,2.5,\n')
    rows = read_csv_table(spark, str(tmp_path / "t.csv"), "a int, b double, c string").collect()
    assert [tuple(r) for r in rows] == [(1, None, 'x, "y"'), (None, 2.5, None)]
    assert dict(read_csv_table(spark, str(tmp_path / "t.csv")).dtypes) == {"a": "int", "b": "double", "c": "string"}


def test_dictionary(spark, tmp_path):
    text = "Table,Row,Description,Special\nbureau.csv,AMT,first,\nbureau.csv,AMT,second,s\n"
    text += "bureau.csv,KEY,b,\napplication_a.csv,KEY ,é one,\napplication_b.csv,KEY,two,hashed\nprev.csv,KEY,late,\n"
    (tmp_path / "d.csv").write_bytes(text.encode("latin-1"))
    rows = {r["column"]: (r["table"], r["description"], r["special"]) for r in read_dictionary(spark, str(tmp_path / "d.csv")).collect()}
    assert rows == {"AMT": ("bureau.csv", "first", ""), "KEY": ("application_b.csv", "two", "hashed")}


def test_landing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    (tmp_path / "b.csv").write_text("")
    rows = [tuple(r) for r in audit_landing(spark, ["c.csv", "a.csv"], str(tmp_path)).collect()]
    assert rows == [("c.csv", "missing"), ("b.csv", "empty")]


def test_reports(spark):
    path = shared_dir(spark, "r")
    for day in ("2026-01-02", "2026-01-01"):
        write_report(spark.createDataFrame([(day,)], "d string").withColumn("run_ts", F.lit(day).cast("timestamp")), path)
    assert [r["d"] for r in latest_report(spark, path).collect()] == ["2026-01-02"]


@pytest.fixture(scope="module")
def raw_dir(spark):
    path = shared_dir(spark, "raw")
    raws = {
        "application_train": fx.raw_application, "application_test": fx.raw_application, "bureau": fx.raw_bureau,
        "bureau_balance": fx.raw_bureau_balance, "POS_CASH_balance": fx.raw_pos_cash,
        "credit_card_balance": fx.raw_credit_card, "previous_application": fx.raw_previous_application,
        "installments_payments": fx.raw_installments,
    }
    for name, build in raws.items():
        build(spark, SF).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(f"{path}/{name}.csv")
    schemas = {name: build(spark, SF).schema for name, build in raws.items()}
    return path, schemas


def test_full_run(spark, raw_dir):
    path, schemas = raw_dir
    clean_dir, gold_dir = shared_dir(spark, "clean"), shared_dir(spark, "gold")
    n = fx.raw_application(spark, SF).count()
    outcome = runs.clean_tables(
        spark, path, clean_dir, "r1", schemas=schemas, expected_rows={"application_train": n, "application_test": n + 1}
    )
    status = {r["table_id"]: r["status"] for r in outcome.collect()}
    assert status.pop("application_test") == "failed"  # wrong volume; the others still ran
    assert set(status.values()) == {"published"}
    results = runs.build_gold(spark, clean_dir, gold_dir, "r1", n)
    assert {r["level"] for r in results.collect()} <= {"PASS", "INFO"}
    abt = read_published(spark, f"{gold_dir}/abt")
    assert abt.count() == n and {"HAS_BUREAU", "INST_PAYMENT_RATIO", "EXT_SOURCE_MEAN"} <= set(abt.columns)


def test_monitor_writes_before_it_fails(spark):
    path = shared_dir(spark, "m")
    table = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    run = spark.createDataFrame(
        [(["x"], 0.2, 0.5, 1, 1, 0.08)],
        "feature_columns array<string>, pr_auc double, recall double, fn int, fp int, threshold double",
    )
    stamp = F.lit("2026-01-01").cast("timestamp")
    report = runs.monitor(table, table, run, 0.08, ["x"], [], ["x"], stamp, path)
    assert {r["overall_status"] for r in report.collect()} == {"ok"}
    later = F.lit("2026-01-02").cast("timestamp")
    with pytest.raises(QualityError, match="data_drift"):
        runs.monitor(table, table.withColumn("x", F.col("x") + 25), run, 0.08, ["x"], [], ["x"], later, path)
    assert {r["overall_status"] for r in latest_report(spark, path).collect()} == {"fail"}


def test_retry_of_a_published_run_changes_nothing(spark):
    path = shared_dir(spark, "retry")
    good, bad = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(-1,)], "x int")
    publish_if_valid(good, "t", not_negative, path, "r:1")
    with pytest.raises(QualityError):
        publish_if_valid(bad, "t", not_negative, path, "r:1")
    assert [r["x"] for r in read_published(spark, path).collect()] == [1]
    publish_if_valid(good.selectExpr("x + 1 AS x"), "t", not_negative, path, "r_1")
    assert [r["x"] for r in read_published(spark, path).collect()] == [2]


def test_publishers_at_the_same_time_are_all_kept(spark):
    path = shared_dir(spark, "claims")
    places = [stage(spark.createDataFrame([(x,)], "x int"), path, "r") for x in (1, 2, 3)]
    record = {"run_id": "r", "published_at": "2026-01-01T00:00:00+00:00", "passes": 1, "warnings": 0}
    assert [_claim(spark, path, record | {"location": p}, version=1) for p in places] == [1, 2, 3]  # all saw an empty log
    assert published_runs(spark, path).count() == 3
    assert [r["x"] for r in read_published(spark, path).collect()] == [3]
    open(f"{path.removeprefix('file:')}/published/v000000000004.json", "w").close()  # claimed by one that died
    assert [r["x"] for r in read_published(spark, path).collect()] == [3]
    publish_if_valid(spark.createDataFrame([(5,)], "x int"), "t", not_negative, path, "r")
    assert [r["x"] for r in read_published(spark, path).collect()] == [5]
    assert {r["version"] for r in published_runs(spark, path).collect()} == {1, 2, 3, 5}


def test_old_attempts_without_a_record_go(spark):
    path = shared_dir(spark, "orphans")
    publish_if_valid(spark.createDataFrame([(1,)], "x int"), "t", not_negative, path, "a")
    with pytest.raises(QualityError):
        publish_if_valid(spark.createDataFrame([(-1,)], "x int"), "t", not_negative, path, "a")
    assert remove_orphans(spark, path) == []
    removed = remove_orphans(spark, path, timedelta(0))
    assert len(removed) == 1 and "attempt=" in removed[0]
    assert spark.read.parquet(f"{path}/runs/a").count() == 1
    assert [r["x"] for r in read_published(spark, path).collect()] == [1]


def test_dictionary_order_does_not_depend_on_splits(spark, tmp_path):
    lines = [f"{'application_a.csv' if i % 3 else 'bureau.csv'},COL_{i % 2 if i % 3 else 9},row {i} \u00e9," for i in range(400)]
    (tmp_path / "d.csv").write_bytes(("Table,Row,Description,Special\n" + "\n".join(lines) + "\n").encode("latin-1"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("256", "1000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = {r["column"]: r["description"] for r in read_dictionary(spark, str(tmp_path / "d.csv")).collect()}
            assert rows == {"COL_0": "row 398 \u00e9", "COL_1": "row 397 \u00e9", "COL_9": "row 0 \u00e9"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

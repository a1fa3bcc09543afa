"""Full runs: raw files -> published clean tables -> published modelling table -> report.

Every step writes its table under the run, checks what was written, and publishes only
after the checks passed. Steps hand over paths, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators import drift as d
from creditloom.operators.features import enrich_application
from creditloom.operators.quality import QualityError, run_suite
from creditloom.plans import gold, suites
from creditloom.plans.silver import TABLES, clean, table_spec
from creditloom.sources.publish import publish, publish_if_valid, read_published, stage
from creditloom.sources.reports import latest_report, write_report
from creditloom.sources.tables import read_csv_table

RESULT = "table_id string, status string, detail string"

# Clean table behind each aggregation stage.
STAGE_TABLES = {
    "application": "application_train",
    "bureau": "bureau",
    "bureau_balance": "bureau_balance",
    "pos_cash": "POS_CASH_balance",
    "credit_card": "credit_card_balance",
    "previous_application": "previous_application",
    "installments": "installments_payments",
}
AGGREGATORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "bureau": gold.aggregate_bureau,
    "pos_cash": gold.aggregate_pos_cash,
    "credit_card": gold.aggregate_credit_card,
    "previous_application": gold.aggregate_previous_application,
    "installments": gold.aggregate_installments,
}


def clean_table(
    spark: SparkSession,
    table_id: str,
    raw_dir: str,
    clean_dir: str,
    run_id: str,
    schema: T.StructType | str | None = None,
    expected_rows: int | None = None,
) -> DataFrame:
    """Scan, clean, write, check and publish one table; returns its check rows."""
    spec = table_spec(table_id)
    raw = read_csv_table(spark, f"{raw_dir.rstrip('/')}/{spec.raw_name}", schema)
    if table_id == "bureau_balance":
        from creditloom.operators.cleaning import require_keys

        require_keys(raw, ["SK_ID_BUREAU", "MONTHS_BALANCE"])
    checks = suites.SILVER_CHECKS[table_id]
    if expected_rows is not None:
        checks = partial(suites.application_checks, expected_rows=expected_rows)
    path = f"{clean_dir.rstrip('/')}/{spec.clean_name}"
    return publish_if_valid(clean(table_id, raw), table_id, checks, path, run_id)


def clean_tables(
    spark: SparkSession,
    raw_dir: str,
    clean_dir: str,
    run_id: str,
    table_ids: Sequence[str] = tuple(TABLES),
    schemas: Mapping[str, T.StructType | str] | None = None,
    expected_rows: Mapping[str, int] | None = None,
    at_once: int = 2,
) -> DataFrame:
    """Run every table, `at_once` together; a failing one is reported and does not stop the others."""

    def run(table_id: str) -> tuple[str, str, str]:
        try:
            clean_table(
                spark, table_id, raw_dir, clean_dir, run_id,
                (schemas or {}).get(table_id), (expected_rows or {}).get(table_id),
            )
            return table_id, "published", ""
        except Exception as error:  # noqa: BLE001 - each table reports its own failure
            return table_id, "failed", str(error)

    with ThreadPoolExecutor(at_once) as pool:
        return spark.createDataFrame(list(pool.map(run, table_ids)), RESULT)


def build_gold(
    spark: SparkSession, clean_dir: str, gold_dir: str, run_id: str, expected_rows: int | None = None
) -> DataFrame:
    """Aggregate, check and join the clean tables; publishes the modelling table.

    The first failing check stops the run. Aggregates are written once and the final join
    reads the written copies.
    """
    base = f"{gold_dir.rstrip('/')}/stages"

    def source(name: str) -> DataFrame:
        table = read_published(spark, f"{clean_dir.rstrip('/')}/{table_spec(STAGE_TABLES[name]).clean_name}")
        return suites.require_stage_columns(name, table)

    def staged(name: str, df: DataFrame, universe: DataFrame | None) -> DataFrame:
        path = f"{base}/{name}"
        location = stage(df, path, run_id)
        written = spark.read.parquet(location)
        results = run_suite(written, name, suites.GOLD_CHECKS[name](written, universe))
        publish(spark, path, run_id, location, results)
        return written

    application = staged("application", enrich_application(source("application")), None)
    clients = application.select(gold.CLIENT)
    sides = {}
    for name in STAGE_TABLES:
        if name == "application":
            continue
        if name == "bureau_balance":
            links = source("bureau").select("SK_ID_BUREAU", gold.CLIENT)
            df = gold.aggregate_bureau_balance(source(name), links, clients)
        else:
            df = AGGREGATORS[name](source(name), clients)
        sides[name] = staged(name, df, clients)
    abt = gold.build_abt(application, sides)
    return publish_if_valid(
        abt, "abt", lambda written: suites.abt_checks(written, application, expected_rows),
        f"{gold_dir.rstrip('/')}/abt", run_id,
    )


def monitor(
    reference: DataFrame,
    actual: DataFrame,
    runs: DataFrame,
    threshold: float,
    numeric: Sequence[str],
    categorical: Sequence[str],
    expected_features: Sequence[str],
    run_ts: Column,
    path: str,
    artifacts: DataFrame | None = None,
    fail_on_error: bool = True,
) -> DataFrame:
    """All checks, written as a report; a failing overall status is an error afterwards.

    `artifacts` has (file, problem) rows of a landing audit, if one was made.
    """
    checks = [
        d.check_of(d.threshold_coherence(runs, threshold), "threshold_coherence", f"threshold {threshold}"),
        d.check_of(
            d.feature_contract(runs, reference.columns, expected_features), "feature_schema", "recorded features"
        ),
        d.check_of(d.baseline_check(runs), "performance_baseline", "recorded metrics"),
        d.drift_check(d.drift_report(reference, actual, numeric, categorical)),
    ]
    if artifacts is not None:
        checks.append(
            artifacts.select(
                F.concat(F.lit("artifact:"), "file").alias("name"),
                F.lit("fail").alias("status"),
                F.col("problem").alias("detail"),
            )
        )
    report = d.monitoring_report(checks, run_ts)
    write_report(report, path)
    if fail_on_error:
        written = latest_report(reference.sparkSession, path)  # one row per check
        failed = [r["name"] for r in written.filter("status = 'fail'").select("name").collect()]
        if failed:
            raise QualityError("monitoring", [f"{name} failed" for name in failed])
    return report

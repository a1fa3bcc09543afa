"""Sources and sinks, read back from the shared folder."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from creditloom.operators.drift import check_domain
from creditloom.operators.quality import QualityError, no_rows_where
from creditloom.plans import silver, suites
from creditloom.queries.decisions import triage
from creditloom.queries.monitoring import CHECK_NAME, CHECK_STATUS, check_history
from creditloom.queries.registry import query
from creditloom.session import shared_dir
from creditloom.sources import fixtures as fx
from creditloom.sources import landing, reports, tables
from creditloom.sources.publish import publish_if_valid, published_runs, read_published


@query("read_parquet_table", "SELECT o_orderkey, o_totalprice FROM orders", "o_totalprice")
def read_parquet_table(spark, sf_dir):
    return tables.read_parquet_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query(
    "read_csv_table",
    "SELECT * FROM raw_application",
    "AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY OWN_CAR_AGE EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3",
)
def read_csv_table(spark, sf_dir):
    """Raw application written as CSV with a header and scanned back with its schema."""
    raw = fx.raw_application(spark, sf_dir)
    path = shared_dir(spark, "csv")
    writer = raw.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = tables.read_csv_table(spark, path, raw.schema)
    return back.withColumn(
        "NAME_INCOME_TYPE", F.coalesce("NAME_INCOME_TYPE", F.lit(""))
    )


@query("publish_if_valid", "SELECT * FROM clean_previous", "AMT_APPLICATION AMT_CREDIT")
def published_table(spark, sf_dir):
    path = shared_dir(spark, "publish")
    cleaned = silver.clean_previous_application(fx.raw_previous_application(spark, sf_dir))
    publish_if_valid(cleaned, "previous_application", suites.previous_application_checks, path, "run 1")
    return read_published(spark, path)


@query("publish_retry", "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, 2 AS versions FROM orders", "o_totalprice")
def publish_retry(spark, sf_dir):
    """A run, its retry with rows that fail, and a later run, which removes the failed attempt."""
    path = shared_dir(spark, "retry")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")

    def attempt(run_id, price):
        checks = lambda written: [no_rows_where("price_not_negative", F.col("o_totalprice") < 0)]
        publish_if_valid(orders.withColumn("o_totalprice", price), "orders", checks, path, run_id, timedelta(0))

    attempt("run 1", F.col("o_totalprice"))
    try:
        attempt("run 1", -F.col("o_totalprice"))
    except QualityError:
        attempt("run 2", F.col("o_totalprice") + 1)
    return read_published(spark, path).withColumn("versions", F.lit(published_runs(spark, path).count()).cast("int"))


@query(
    "write_report",
    f"""SELECT {CHECK_NAME} AS name, count(*) AS checks FROM events
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AND {CHECK_STATUS} <> 'ok' GROUP BY 1""",
)
def write_report(spark, sf_dir):
    """A report per day of check history; the latest one is read back."""
    path = shared_dir(spark, "report")
    daily = (
        check_history(spark, sf_dir)
        .filter("status <> 'ok'")
        .groupBy(F.date_trunc("day", "ts").alias("run_ts"), "name")
        .agg(F.count("*").alias("checks"))
    )
    reports.write_report(daily, path)
    return reports.latest_report(spark, path).select("name", "checks")


@query(
    "write_queues",
    "SELECT queue, count(*) AS events FROM (SELECT CASE WHEN probability < 0.08e0 * 0.4e0 THEN 'autoaprovacao_candidata' "
    "WHEN probability < 0.08e0 THEN 'mesa_analise' ELSE 'recusa_candidata' END AS queue FROM scored) GROUP BY 1",
)
def write_queues(spark, sf_dir):
    path = shared_dir(spark, "queues")
    reports.write_queues(triage(spark, sf_dir), path)
    return spark.read.json(path).groupBy("queue").agg(F.count("*").alias("events"))


@query(
    "batch_latest_per_queue",
    """SELECT queue, max(SK_ID_CURR) AS client_id FROM (
         SELECT SK_ID_CURR, 'latest' AS queue FROM scored
         UNION ALL SELECT SK_ID_CURR, CASE WHEN probability < 0.08e0 * 0.4e0 THEN 'autoaprovacao_candidata'
           WHEN probability < 0.08e0 THEN 'mesa_analise' ELSE 'recusa_candidata' END FROM scored) GROUP BY 1""",
)
def batch_latest_per_queue(spark, sf_dir):
    return reports.latest_per_queue(triage(spark, sf_dir)).select("queue", "client_id")


MANIFEST = [f"{name}.parquet" for name in fx.TABLES] + ["application_train.csv"]


@query("audit_landing")
def audit_landing(spark, sf_dir):
    """The folder of driver tables against a manifest that names one more file."""
    return landing.audit_landing(spark, MANIFEST, sf_dir)


@query(
    "read_dictionary",
    """SELECT c AS "column", t AS "table", d AS description, '' AS special FROM (
         SELECT *, row_number() OVER (PARTITION BY c ORDER BY app DESC, CASE WHEN app THEN -p ELSE p END) AS rn
         FROM (SELECT 'COL_' || o_custkey AS c, CASE o_orderkey % 4 WHEN 0 THEN 'application_{train|test}.csv' ELSE 'bureau.csv' END AS t,
                 o_orderpriority || ' \u00e9' AS d, o_orderkey AS p, o_orderkey % 4 = 0 AS app FROM orders)) WHERE rn = 1""",
)
def read_dictionary(spark, sf_dir):
    """One dictionary row per order, several for the same column, in latin-1 CSV files read back."""
    rows = fx.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 4 == 0, "application_{train|test}.csv").otherwise("bureau.csv").alias("Table"),
        F.concat(F.lit(" COL_"), F.col("o_custkey").cast("string")).alias("Row"),
        F.concat("o_orderpriority", F.lit(" \u00e9")).alias("Description"),
        F.lit(None).cast("string").alias("Special"),
        "o_orderkey",
    )
    path = shared_dir(spark, "dictionary")
    ordered = rows.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey").drop("o_orderkey")
    writer = ordered.write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).csv(path)
    return tables.read_dictionary(spark, path)


@query(
    "check_domains",
    f"""SELECT name, CASE WHEN name LIKE 'artifact:%' THEN 'artifacts' ELSE CASE name WHEN 'api_health' THEN 'api' WHEN 'feature_schema'
          THEN 'schema' WHEN 'data_drift' THEN 'drift' WHEN 'performance_baseline' THEN 'performance' ELSE 'governance' END END AS domain
        FROM (SELECT DISTINCT {CHECK_NAME} AS name FROM events)""",
)
def check_domains(spark, sf_dir):
    names = check_history(spark, sf_dir).select("name").distinct()
    return names.withColumn("domain", check_domain(F.col("name")))

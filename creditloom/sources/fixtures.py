"""The domain's raw tables, derived from the TPC-H-like driver tables.

Each raw table is a projection of whole driver tables with deterministic dirt (sentinels,
future dates, negative amounts, blanks, copies), written in SQL that Spark and DuckDB
both read, so the Spark queries and their SQL twins start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DAY_ZERO = "DATE '2001-12-01'"


def days(engine: str, moment: str) -> str:
    """Whole days from day zero to a timestamp, negative for the past."""
    if engine == "spark":
        return f"datediff(CAST({moment} AS DATE), {DAY_ZERO})"
    return f"CAST(date_diff('day', {DAY_ZERO}, CAST({moment} AS DATE)) AS INT)"


APPLICATION = {
    "SK_ID_CURR": "c_custkey",
    "TARGET": "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END",
    "AMT_INCOME_TOTAL": "c_acctbal",
    "AMT_CREDIT": "CAST(1000 + c_custkey * 37 % 5000 AS DOUBLE)",
    "AMT_ANNUITY": "CAST(100 + c_custkey * 11 % 900 AS DOUBLE)",
    "CODE_GENDER": "CASE c_custkey % 3 WHEN 0 THEN ' f' WHEN 1 THEN 'M ' ELSE 'xna' END",
    "FLAG_OWN_CAR": "CASE WHEN c_custkey % 2 = 0 THEN 'n' ELSE 'Y' END",
    "OWN_CAR_AGE": "CAST(c_custkey % 20 AS DOUBLE)",
    "DAYS_BIRTH": "-(7300 + c_custkey % 18000)",
    "DAYS_EMPLOYED": (
        "CASE WHEN c_custkey % 11 = 0 THEN 365243 WHEN c_custkey % 13 = 0 THEN 5 "
        "WHEN c_custkey % 17 = 0 THEN -20000 ELSE -(c_custkey % 9000) END"
    ),
    "DAYS_ID_PUBLISH": "-(c_custkey * 7 % 6000)",
    "NAME_INCOME_TYPE": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('  ', lower(c_mktsegment), chr(9)) END",
    "NAME_EDUCATION_TYPE": (
        "CASE c_nationkey % 4 WHEN 0 THEN ' higher education' WHEN 1 THEN 'Secondary ' "
        "WHEN 2 THEN 'incomplete higher' ELSE 'Lower secondary' END"
    ),
    "OCCUPATION_TYPE": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('job ', CAST(c_nationkey AS STRING)) END",
    "ORGANIZATION_TYPE": "concat('Trade: ', lower(c_mktsegment))",
    "EXT_SOURCE_1": "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE (c_custkey * 31 % 1000) / 1000e0 END",
    "EXT_SOURCE_2": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (c_custkey * 32 % 1000) / 1000e0 END",
    "EXT_SOURCE_3": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey * 33 % 1000) / 1000e0 END",
}


def bureau(engine: str) -> dict[str, str]:
    return {
        "SK_ID_BUREAU": "o_orderkey",
        "SK_ID_CURR": "o_custkey",
        "CREDIT_ACTIVE": "CASE o_orderstatus WHEN 'F' THEN ' closed' WHEN 'O' THEN 'Active ' ELSE 'Bad debt' END",
        "AMT_CREDIT_SUM": "CASE WHEN o_orderkey % 71 = 0 THEN -o_totalprice ELSE o_totalprice END",
        "AMT_CREDIT_SUM_DEBT": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice * 0.5e0 END",
        "AMT_CREDIT_SUM_OVERDUE": "CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice * 0.01e0 ELSE 0e0 END",
        "CREDIT_DAY_OVERDUE": "o_orderkey % 40",
        "DAYS_CREDIT": f"CASE WHEN o_orderkey % 83 = 0 THEN 3 ELSE {days(engine, 'o_orderdate')} END",
        "DAYS_CREDIT_ENDDATE": "CASE WHEN o_orderkey % 50 = 0 THEN 20000 ELSE o_orderkey % 1000 END",
        "DAYS_ENDDATE_FACT": "CASE WHEN o_orderkey % 60 = 0 THEN 5 ELSE -(o_orderkey % 700) END",
    }


BUREAU_BALANCE = {
    "SK_ID_BUREAU": "l_orderkey",
    "MONTHS_BALANCE": (
        "CASE WHEN l_orderkey % 53 = 0 THEN 2 "
        "ELSE CAST(-((2001 - year(l_shipdate)) * 12 + 12 - month(l_shipdate)) AS INT) END"
    ),
    "STATUS": (
        "CASE WHEN l_partkey % 29 = 0 THEN 'bad' WHEN l_returnflag = 'R' THEN ' 1' "
        "WHEN l_returnflag = 'N' THEN '0' WHEN l_linestatus = 'F' THEN 'c ' ELSE 'x' END"
    ),
}

MONTH = "CASE WHEN event_id % 31 = 0 THEN 1 ELSE CAST(-day(ts) AS INT) END"
DAYS_PAST_DUE = (
    "CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 37 = 0 THEN -1 "
    "WHEN event_type = 'error' THEN CAST(floor(value) AS INT) ELSE 0 END"
)

POS_CASH = {
    "SK_ID_PREV": "user_id * 10 + event_id % 7",
    "SK_ID_CURR": "user_id",
    "MONTHS_BALANCE": MONTH,
    "SK_DPD": DAYS_PAST_DUE,
    "SK_DPD_DEF": "CASE WHEN event_id % 23 = 0 THEN -2 ELSE CAST(event_id % 3 AS INT) END",
    "NAME_CONTRACT_STATUS": "concat(' ', event_type)",
}

CREDIT_CARD = {
    "SK_ID_PREV": "user_id * 10 + event_id % 7",
    "SK_ID_CURR": "user_id",
    "MONTHS_BALANCE": MONTH,
    "SK_DPD": DAYS_PAST_DUE,
    "AMT_BALANCE": "CASE WHEN event_id % 19 = 0 THEN -value ELSE value END",
    "AMT_CREDIT_LIMIT_ACTUAL": "CAST((event_id % 5) * 100 AS DOUBLE)",
    "AMT_DRAWINGS_ATM_CURRENT": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 0.5e0 END",
    "AMT_DRAWINGS_CURRENT": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END",
    "CNT_DRAWINGS_ATM_CURRENT": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 4 AS DOUBLE) END",
}


def previous_application(engine: str) -> dict[str, str]:
    return {
        "SK_ID_PREV": "o_orderkey",
        "SK_ID_CURR": "o_custkey",
        "NAME_CONTRACT_STATUS": (
            "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN ' refused' ELSE 'Canceled ' END"
        ),
        "AMT_APPLICATION": "CASE WHEN o_orderkey % 67 = 0 THEN -o_totalprice ELSE o_totalprice END",
        "AMT_CREDIT": "o_totalprice * 0.9e0",
        "DAYS_DECISION": f"CASE WHEN o_orderkey % 89 = 0 THEN 2 ELSE {days(engine, 'o_orderdate')} END",
        "DAYS_FIRST_DRAWING": (
            "CASE WHEN o_orderkey % 3 = 0 THEN 365243 WHEN o_orderkey % 47 = 0 THEN 18251 "
            "ELSE -(o_orderkey % 2000) END"
        ),
    }


def installments(engine: str) -> dict[str, str]:
    return {
        "SK_ID_PREV": "l_orderkey",
        "SK_ID_CURR": "o_custkey",
        "NUM_INSTALMENT_NUMBER": "l_linenumber",
        "AMT_INSTALMENT": "l_extendedprice",
        "AMT_PAYMENT": "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_extendedprice * (1e0 - l_discount) END",
        "DAYS_INSTALMENT": f"{days(engine, 'o_orderdate')} + 60",
        "DAYS_ENTRY_PAYMENT": f"CASE WHEN l_orderkey % 97 = 0 THEN 5 ELSE {days(engine, 'l_shipdate')} END",
    }


SCORED = {
    "SK_ID_CURR": "c_custkey",
    "TARGET": "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END",
    "probability": "(c_custkey * 7919 % 1000) / 1000e0 * 0.2e0",
    "NAME_INCOME_TYPE": "c_mktsegment",
    "NAME_EDUCATION_TYPE": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE concat('N', CAST(c_nationkey AS STRING)) END",
    "AMT_CREDIT": "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END",
    "AMT_ANNUITY": "CAST(100 + c_custkey * 11 % 900 AS DOUBLE)",
}

# One model run per order.
RUNS = {
    "run_id": "o_orderkey",
    "trained_at": "o_orderdate",
    "pr_auc": "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE (o_orderkey % 40) / 100e0 END",
    "recall": "(o_orderkey * 3 % 100) / 100e0",
    "fn": "o_custkey % 300",
    "fp": "o_custkey % 900",
    "threshold": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 0.25e0 ELSE 0.08e0 END",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer is read once, later scans are given the schema."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def with_copies(df: DataFrame, condition: str) -> DataFrame:
    return df.unionByName(df.filter(condition))


def raw_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), APPLICATION)


def raw_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), bureau("spark"))


def raw_bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "lineitem"), BUREAU_BALANCE)


def raw_pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(with_copies(table(spark, sf_dir, "events"), "event_id % 5 = 0"), POS_CASH)


def raw_credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(with_copies(table(spark, sf_dir, "events"), "event_id % 5 = 0"), CREDIT_CARD)


def raw_previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = with_copies(table(spark, sf_dir, "orders"), "o_orderkey % 5 = 0")
    return _project(copies, previous_application("spark"))


ROWS_A_PART = 250_000
"""Rows of a history that one task joins, deduplicates and sums, as long as no key has more."""


def parts_for(df: DataFrame) -> int:
    """Parts of about ROWS_A_PART rows, at least one a core; a Parquet scan is counted from its footers."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_PART))


def raw_installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides are dealt into parts that follow the rows, not the bytes: rows are narrow and pack well, and a task holds the
    join's sorts and the tables of distinct rows, instalments and clients at once, as all are grouped by the join's key.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    parts = parts_for(lines)
    lines = with_copies(lines, "l_orderkey % 5 = 0").repartition(parts, "l_orderkey")
    orders = orders.repartition(parts, "o_orderkey")
    return _project(lines.join(orders, lines.l_orderkey == orders.o_orderkey), installments("spark"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), SCORED)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), RUNS)


def twin_ctes() -> dict[str, str]:
    """The same raw tables as DuckDB SELECT statements."""

    def select(columns: dict[str, str], source: str) -> str:
        return "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in columns.items()) + f" FROM {source}"

    def copies(name: str, condition: str) -> str:
        return f"(SELECT * FROM {name} UNION ALL SELECT * FROM {name} WHERE {condition})"

    return {
        "raw_application": select(APPLICATION, "customer"),
        "raw_bureau": select(bureau("duckdb"), "orders"),
        "raw_bureau_balance": select(BUREAU_BALANCE, "lineitem"),
        "raw_pos_cash": select(POS_CASH, copies("events", "event_id % 5 = 0")),
        "raw_credit_card": select(CREDIT_CARD, copies("events", "event_id % 5 = 0")),
        "raw_previous_application": select(previous_application("duckdb"), copies("orders", "o_orderkey % 5 = 0")),
        "raw_installments": select(
            installments("duckdb"), copies("lineitem", "l_orderkey % 5 = 0") + " JOIN orders ON l_orderkey = o_orderkey"
        ),
        "scored": select(SCORED, "customer"),
        "runs": select(RUNS, "orders"),
    }

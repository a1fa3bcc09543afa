"""Cleaned tables and single cleaning rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.functions import parse_utc
from creditloom.operators import cleaning as c
from creditloom.operators.features import enrich_application, select_features
from creditloom.plans import silver
from creditloom.queries.registry import query
from creditloom.queries.twins import ratio
from creditloom.sources import fixtures as fx

MONEY = "AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_OVERDUE"
APP_DOUBLES = "AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY OWN_CAR_AGE EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3"
RATIOS = "EXT_SOURCE_MEAN CREDIT_INCOME_RATIO ANNUITY_INCOME_RATIO LOG_AMT_CREDIT DAYS_EMPLOYED_YEARS"
BOUNDS = {"AMT_CREDIT": (1.0, 4050000.0), "AMT_ANNUITY": (1.0, 258025.5)}  # fixed values: editable amounts


@query("clean_application", "SELECT * FROM clean_application", APP_DOUBLES)
def clean_application(spark, sf_dir):
    return silver.clean_application(fx.raw_application(spark, sf_dir))


@query("clean_bureau", "SELECT * FROM clean_bureau", MONEY, digits=4)
def clean_bureau(spark, sf_dir):
    return silver.clean_bureau(fx.raw_bureau(spark, sf_dir))


@query("clean_bureau_balance", "SELECT * FROM clean_bureau_balance")
def clean_bureau_balance(spark, sf_dir):
    raw = fx.raw_bureau_balance(spark, sf_dir)
    return silver.clean_bureau_balance(raw, parts=fx.parts_for(raw))


@query("clean_pos_cash", "SELECT * FROM clean_pos_cash")
def clean_pos_cash(spark, sf_dir):
    return silver.clean_pos_cash(fx.raw_pos_cash(spark, sf_dir))


@query(
    "clean_credit_card", "SELECT * FROM clean_credit_card",
    "AMT_BALANCE AMT_CREDIT_LIMIT_ACTUAL AMT_DRAWINGS_ATM_CURRENT AMT_DRAWINGS_CURRENT CNT_DRAWINGS_ATM_CURRENT",
)
def clean_credit_card(spark, sf_dir):
    return silver.clean_credit_card(fx.raw_credit_card(spark, sf_dir))


@query("clean_previous", "SELECT * FROM clean_previous", "AMT_APPLICATION AMT_CREDIT")
def clean_previous(spark, sf_dir):
    return silver.clean_previous_application(fx.raw_previous_application(spark, sf_dir))


@query("clean_installments", "SELECT * FROM clean_installments", "AMT_INSTALMENT AMT_PAYMENT")
def clean_installments(spark, sf_dir):
    return silver.clean_installments(fx.raw_installments(spark, sf_dir))


@query("enrich_application", "SELECT * FROM application", f"{APP_DOUBLES} {RATIOS}")
def enriched(spark, sf_dir):
    return enrich_application(silver.clean_application(fx.raw_application(spark, sf_dir)))


@query(
    "select_features",
    """SELECT SK_ID_CURR, TARGET, EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3, DAYS_BIRTH, DAYS_EMPLOYED,
         DAYS_ID_PUBLISH, AMT_CREDIT, AMT_ANNUITY, NAME_EDUCATION_TYPE, NAME_INCOME_TYPE FROM application""",
    "EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3 AMT_CREDIT AMT_ANNUITY",
)
def core_features(spark, sf_dir):
    return select_features(enriched(spark, sf_dir), "core")


@query(
    "safe_ratio",
    f"SELECT event_id, {ratio('value', '(event_id % 5) * 100')} AS usage FROM events",
    "usage",
)
def safe_ratio_query(spark, sf_dir):
    from creditloom.functions import safe_ratio

    events = fx.table(spark, sf_dir, "events")
    return events.select("event_id", safe_ratio(F.col("value"), (F.col("event_id") % 5) * 100).alias("usage"))


MONEY_TEXT = (
    "CASE o_orderkey % 5 WHEN 0 THEN concat('R$ ', CAST(o_custkey AS STRING), '.250,50') "
    "WHEN 1 THEN concat(CAST(o_custkey AS STRING), ',75 ') WHEN 2 THEN concat(CAST(o_custkey AS STRING), '.5') "
    "WHEN 3 THEN 'Sem Info' ELSE concat(' ', CAST(o_custkey AS STRING)) END"
)


@query(
    "parse_money",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_custkey * 1000e0 + 250.5e0 WHEN 1 THEN o_custkey + 0.75e0
         WHEN 2 THEN o_custkey + 0.5e0 WHEN 3 THEN NULL ELSE o_custkey * 1e0 END AS amount FROM orders""",
    "amount",
)
def parse_money(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{MONEY_TEXT} AS raw")
    return c.money_column(orders, "raw", "amount").select("o_orderkey", "amount")


OVERRIDE = {
    "client_id": "o_custkey",
    "scenario": "o_orderkey",
    "feature": "CASE o_orderkey % 3 WHEN 0 THEN 'AMT_CREDIT' WHEN 1 THEN 'AMT_ANNUITY' ELSE 'NAME' END",
    "value": "CASE WHEN o_orderkey % 7 = 0 THEN 'abc' WHEN o_orderkey % 11 = 0 THEN '0,5' "
    "ELSE concat(CAST(o_orderkey * 50 AS STRING), ',25') END",
}


@query(
    "within_bounds",
    f"""SELECT *, coalesce(parsed >= 1 AND parsed <= CASE feature WHEN 'AMT_CREDIT' THEN 4050000e0
          ELSE 258025.5e0 END, false) AS accepted
        FROM (SELECT *, TRY_CAST(replace(value, ',', '.') AS DOUBLE) AS parsed
              FROM (SELECT {', '.join(f'{e} AS {n}' for n, e in OVERRIDE.items())} FROM orders)
              WHERE feature <> 'NAME')""",
    "parsed",
)
def within_bounds(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in OVERRIDE.items()])
    return c.within_bounds(rows, BOUNDS)


@query(
    "cap_percentile",
    """SELECT l_orderkey, l_linenumber,
         least(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.99e0) FROM lineitem)) AS l_extendedprice,
         least(l_quantity, (SELECT quantile_cont(l_quantity, 0.99e0) FROM lineitem)) AS l_quantity
       FROM lineitem""",
    "l_extendedprice l_quantity", digits=4,
)
def cap_percentile(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    capped = c.cap_percentile(lines, ["l_extendedprice", "l_quantity"], 99.0)
    return capped.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


@query("dedupe_rows", "SELECT DISTINCT * FROM raw_installments", "AMT_INSTALMENT AMT_PAYMENT")
def dedupe_rows(spark, sf_dir):
    return c.dedupe_rows(fx.raw_installments(spark, sf_dir))


@query(
    "dedupe_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (
         PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def dedupe_key(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return c.dedupe_key(c.require_keys(lines, ["l_orderkey"]), ["l_orderkey", "l_linenumber"])


@query(
    "distinct_values",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
)
def distinct_values(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "parse_utc",
    """SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL
         ELSE CAST(epoch(date_trunc('second', ts)) - CASE event_id % 4 WHEN 2 THEN 7200 ELSE 0 END AS BIGINT)
       END AS second FROM events""",
)
def parse_utc_query(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.concat(wall, F.lit("Z")))
        .when(kind == 1, F.concat(F.lit(" "), wall))
        .when(kind == 2, F.concat(wall, F.lit("+02:00")))
        .otherwise(F.lit("yesterday"))
    )
    return events.select("event_id", F.unix_timestamp(parse_utc(text)).alias("second"))

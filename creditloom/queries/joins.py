"""Key joins, lookups, search and the column catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import joins as j
from creditloom.operators.aggregates import coverage
from creditloom.operators.catalog import table_catalog
from creditloom.operators.features import dossier
from creditloom.plans import silver
from creditloom.queries.gold import application
from creditloom.queries.registry import query
from creditloom.sources import fixtures as fx


def t(spark, sf_dir, name):
    return fx.table(spark, sf_dir, name)


@query(
    "semi_filter",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "o_totalprice",
)
def semi_filter(spark, sf_dir):
    debtors = t(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return j.semi_filter(orders, debtors, "o_custkey")


@query(
    "inner_bridge",
    """SELECT l_orderkey AS SK_ID_BUREAU, count(*) AS months, o_custkey AS SK_ID_CURR
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def inner_bridge(spark, sf_dir):
    months = (
        t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("SK_ID_BUREAU")).agg(F.count("*").alias("months"))
    )
    links = fx.raw_bureau(spark, sf_dir).select("SK_ID_BUREAU", "SK_ID_CURR")
    return j.inner_bridge(months, links, "SK_ID_BUREAU", "SK_ID_CURR")


@query(
    "left_attach",
    """SELECT c_custkey, c_acctbal, n, c_acctbal_orders FROM customer LEFT JOIN (
         SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS c_acctbal_orders FROM orders
         WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "c_acctbal c_acctbal_orders", digits=3,
)
def left_attach(spark, sf_dir):
    spine = t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    side = (
        t(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("c_acctbal"))
    )
    return j.left_attach(spine, side, "c_custkey", "orders")


@query(
    "orphans",
    """SELECT DISTINCT c_custkey AS key FROM customer
       WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 50)""",
)
def orphans(spark, sf_dir):
    bad = t(spark, sf_dir, "events").filter("event_type = 'error' AND value > 50")
    return j.orphans(t(spark, sf_dir, "customer"), "c_custkey", bad, "user_id")


@query(
    "order_orphans",
    "SELECT DISTINCT o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def order_orphans(spark, sf_dir):
    return j.orphans(t(spark, sf_dir, "orders"), "o_orderkey", t(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "outside_universe",
    """SELECT event_id, user_id FROM events
       WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)""",
)
def outside_universe(spark, sf_dir):
    known = t(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("user_id"))
    return j.outside_universe(t(spark, sf_dir, "events").select("event_id", "user_id"), known, "user_id")


@query(
    "aligned_equal",
    """SELECT SK_ID_CURR, a.AMT_INCOME_TOTAL AS AMT_INCOME_TOTAL, r.AMT_INCOME_TOTAL AS original
       FROM clean_application a JOIN raw_application r USING (SK_ID_CURR)
       WHERE a.AMT_INCOME_TOTAL IS DISTINCT FROM r.AMT_INCOME_TOTAL""",
    "AMT_INCOME_TOTAL original",
)
def aligned_equal(spark, sf_dir):
    raw = fx.raw_application(spark, sf_dir)
    cleaned = silver.clean_application(raw)
    rows = j.unequal_after_align(cleaned, raw, "SK_ID_CURR", "AMT_INCOME_TOTAL")
    return rows.withColumnRenamed("__other", "original")


DICTIONARY = [(0, "Furniture"), (1, "MACHINERY"), (2, "house-hold"), (3, "AUTOMOBILE"), (4, "Auto mobile")]
YES_NO = [(0, "N"), (1, "Y")]


def _dictionary(spark, rows):
    return spark.createDataFrame(rows, "position int, category string")


@query(
    "map_categories",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN 'Furniture' WHEN 'MACHINERY' THEN 'MACHINERY'
         WHEN 'AUTOMOBILE' THEN 'AUTOMOBILE' END AS category,
         CASE c_nationkey WHEN 0 THEN 'N' WHEN 1 THEN 'Y' END AS answer FROM customer""",
)
def map_categories(spark, sf_dir):
    customers = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    mapped = j.map_categories(customers, "c_mktsegment", _dictionary(spark, DICTIONARY), "category")
    mapped = j.map_categories(mapped, "c_nationkey", _dictionary(spark, YES_NO), "answer")
    return mapped.select("c_custkey", "category", "answer")


@query(
    "align_categories",
    """SELECT event_id, CASE WHEN event_type IN (SELECT event_type FROM events WHERE event_id % 1000 < 2)
         THEN event_type END AS event_type FROM events""",
)
def align_categories(spark, sf_dir):
    events = t(spark, sf_dir, "events").select("event_id", "event_type")
    return j.align_categories(events.filter("event_id % 1000 < 2"), events, ["event_type"])


@query(
    "label_join",
    """SELECT o_orderkey, coalesce(c.label, o_orderstatus) AS label FROM orders
       LEFT JOIN (VALUES ('F', 'Finished'), ('O', 'Open')) c(name, label) ON o_orderstatus = c.name""",
)
def label_join(spark, sf_dir):
    labels = spark.createDataFrame([("F", "Finished"), ("O", "Open")], "name string, label string")
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return j.label_join(orders, "o_orderstatus", labels).select("o_orderkey", "label")


@query(
    "lookup_clients",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
    "c_acctbal",
)
def lookup_clients(spark, sf_dir):
    ids = t(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    return j.lookup_rows(t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), ids, "c_custkey")


@query(
    "search_rows",
    """SELECT doc_id, lang, source, n_chars FROM documents WHERE lang IN ('en', 'fr') AND source IN ('src0', 'src1')
         AND contains(lower(concat_ws(' ', text, lang, source)), 'the of')""",
)
def search_rows(spark, sf_dir):
    docs = t(spark, sf_dir, "documents")
    found = j.search_rows(
        docs, " The OF ", {"lang": ["en", "fr"], "source": ["src0", "src1"]}, ["text", "lang", "source"]
    )
    return found.select("doc_id", "lang", "source", "n_chars")


@query(
    "coverage",
    """SELECT 'bureau' AS source, count(DISTINCT o_custkey) AS clients,
         count(DISTINCT o_custkey) * 100e0 / (SELECT count(DISTINCT c_custkey) FROM customer) AS pct FROM orders
       UNION ALL SELECT 'card', count(DISTINCT user_id),
         count(DISTINCT user_id) * 100e0 / (SELECT count(DISTINCT c_custkey) FROM customer) FROM events""",
    "pct",
)
def coverage_query(spark, sf_dir):
    key = "SK_ID_CURR"
    sources = {
        "bureau": t(spark, sf_dir, "orders").select(F.col("o_custkey").alias(key)),
        "card": t(spark, sf_dir, "events").select(F.col("user_id").alias(key)),
    }
    return coverage(sources, fx.raw_application(spark, sf_dir), key)


LABELS = {"TARGET": "Variável Alvo", "CODE_GENDER": "Gênero"}


@query(
    "dossier",
    """SELECT SK_ID_CURR, feature, CASE feature WHEN 'TARGET' THEN 'Variável Alvo' WHEN 'CODE_GENDER' THEN 'Gênero'
         ELSE feature END AS label, value
       FROM (SELECT SK_ID_CURR, unnest(['TARGET', 'CODE_GENDER', 'AGE_YEARS', 'NAME_INCOME_TYPE']) AS feature,
               unnest([CAST(TARGET AS VARCHAR), CODE_GENDER, CAST(AGE_YEARS AS VARCHAR), NAME_INCOME_TYPE]) AS value
             FROM clean_application)""",
)
def dossier_query(spark, sf_dir):
    clients = silver.clean_application(fx.raw_application(spark, sf_dir))
    return dossier(
        clients.select("SK_ID_CURR", "TARGET", "CODE_GENDER", "AGE_YEARS", "NAME_INCOME_TYPE"), "SK_ID_CURR", LABELS
    )


CATALOG = {
    # column: (position, Spark type, category, source, description, in_model, editable, categorical, numeric)
    "SK_ID_CURR": (1, "bigint", "Identificador", "application_train.csv", "client id", False, False, False, True),
    "TARGET": (2, "int", "Alvo", "feature engineering Gold", "TARGET", False, False, False, True),
    "AMT_CREDIT": (3, "double", "Raw Kaggle", "application_train.csv", "amount", True, True, False, True),
    "NAME_INCOME_TYPE": (4, "string", "Derivada", "feature engineering Gold", "NAME_INCOME_TYPE", True, True, True,
                         False),
    "EXT_SOURCE_MEAN": (5, "double", "Derivada", "feature engineering Gold", "EXT_SOURCE_MEAN", True, False, False,
                        True),
    "FLAG_OWN_CAR": (6, "string", "Indicador", "feature engineering Gold", "FLAG_OWN_CAR", True, False, False, False),
}


def _catalog_twin() -> str:
    parts = []
    for col, (pos, kind, category, source, text, used, edit, cat, numeric) in CATALOG.items():
        number, words = (col, "NULL") if numeric else ("NULL", col)
        parts.append(
            f"SELECT CAST({pos} AS INT) AS position, '{col}' AS \"column\", '{kind}' AS type, '{category}' AS category, "
            f"'{source}' AS source, '{text}' AS description, {used} AS in_model, {edit} AS editable, "
            f"{cat} AS categorical, count(*) AS rows, count(*) FILTER (WHERE {col} IS NULL) AS nulls, "
            f"count(DISTINCT {col}) AS distinct_values, min(CAST({number} AS DOUBLE)) AS min_number, "
            f"max(CAST({number} AS DOUBLE)) AS max_number, min(CAST({words} AS VARCHAR)) AS min_text, "
            f"max(CAST({words} AS VARCHAR)) AS max_text FROM application"
        )
    return " UNION ALL ".join(parts)


@query("table_catalog", _catalog_twin(), "min_number max_number")
def catalog(spark, sf_dir):
    dictionary = spark.createDataFrame(
        [("SK_ID_CURR", "application_train.csv", "client id"), ("AMT_CREDIT", "application_train.csv", "amount")],
        "column string, table string, description string",
    )
    return table_catalog(
        application(spark, sf_dir).select(*CATALOG),
        dictionary,
        editable=["AMT_CREDIT", "NAME_INCOME_TYPE"],
        categorical=["NAME_INCOME_TYPE"],
    )


@query(
    "category_union",
    """SELECT category, sum(r) > 0 AS in_reference, sum(a) > 0 AS in_actual FROM (
         SELECT l_returnflag || l_linestatus AS category, CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 1 ELSE 0 END AS r,
           CASE WHEN l_shipdate >= TIMESTAMP '1998-07-01' THEN 1 ELSE 0 END AS a FROM lineitem) GROUP BY category""",
)
def category_union(spark, sf_dir):
    lines = t(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("category"), "l_shipdate")
    early = F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp")
    a = lines.filter(early).select("category").distinct().withColumn("in_reference", F.lit(True))
    b = lines.filter(~early).select("category").distinct().withColumn("in_actual", F.lit(True))
    return a.join(b, "category", "full").fillna(False)


@query(
    "key_difference",
    "SELECT c_custkey AS key FROM customer EXCEPT SELECT user_id FROM events",
)
def key_difference(spark, sf_dir):
    known = t(spark, sf_dir, "events").select("user_id")
    return t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")).subtract(known)



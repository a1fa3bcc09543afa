"""Counts, quantiles, correlations, bands, ranks, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import aggregates as a
from creditloom.operators import ordering as o
from creditloom.operators import profiling as p
from creditloom.operators.scoring import top_factors
from creditloom.plans import silver
from creditloom.queries.registry import query
from creditloom.sources import fixtures as fx


def t(spark, sf_dir, name):
    return fx.table(spark, sf_dir, name)


@query(
    "value_counts",
    "SELECT o_orderpriority, count(*) AS n, count(*) * 1e0 / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY 1",
    "share",
)
def value_counts(spark, sf_dir):
    return a.value_counts(t(spark, sf_dir, "orders"), "o_orderpriority", normalize=True)


@query(
    "rate_by_group",
    "SELECT NAME_INCOME_TYPE, avg(TARGET) AS rate, count(*) AS n FROM clean_application GROUP BY 1",
    "rate",
)
def rate_by_group(spark, sf_dir):
    return a.rate_by_group(silver.clean_application(fx.raw_application(spark, sf_dir)), "NAME_INCOME_TYPE", "TARGET")


@query(
    "median_by_group",
    "SELECT TARGET, quantile_cont(AMT_CREDIT, 0.5e0) AS median FROM clean_application GROUP BY 1",
    "median",
)
def median_by_group(spark, sf_dir):
    return a.median_by_group(silver.clean_application(fx.raw_application(spark, sf_dir)), "TARGET", "AMT_CREDIT")


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


@query(
    "quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {p!r}::DOUBLE AS p, quantile_cont({c}, {p!r}::DOUBLE) AS value FROM lineitem"
        for c in ("l_extendedprice", "l_quantity", "l_discount")
        for p in PROBS
    ),
    "p value", digits=4,
)
def quantiles(spark, sf_dir):
    return a.quantiles(t(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"], PROBS)


@query(
    "mode",
    "SELECT l_suppkey AS mode, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
)
def mode(spark, sf_dir):
    return a.mode(t(spark, sf_dir, "lineitem"), "l_suppkey")


FEATURES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_EMPLOYED"]


@query(
    "corr_target",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) AS r FROM clean_application"
        for c in FEATURES
    ),
    "r",
)
def corr_target(spark, sf_dir):
    return a.correlation_with(silver.clean_application(fx.raw_application(spark, sf_dir)), FEATURES, "TARGET")


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{x}' AS a, '{y}' AS b, corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) AS r FROM clean_application"
        for i, x in enumerate(FEATURES)
        for y in FEATURES[i + 1 :]
    ),
    "r",
)
def corr_matrix(spark, sf_dir):
    return a.correlation_matrix(silver.clean_application(fx.raw_application(spark, sf_dir)), FEATURES)


@query(
    "moments",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS mean, quantile_cont({c}, 0.5e0) AS median, skewness({c}) AS skew FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
    ),
    "mean median skew",
)
def moments(spark, sf_dir):
    return a.moments(t(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"])


EDGES = [5.0, 10.0, 20.0, 40.0, 45.0]


@query(
    "histogram",
    """SELECT CAST(i - 1 AS INT) AS bin, e[i] AS lo, e[i + 1] AS hi,
         (SELECT count(*) FROM lineitem WHERE l_quantity >= e[i]
            AND (l_quantity < e[i + 1] OR (i = 4 AND l_quantity <= e[i + 1]))) AS n
       FROM (SELECT [5e0, 10e0, 20e0, 40e0, 45e0] AS e, unnest([1, 2, 3, 4]) AS i)""",
    "lo hi",
)
def histogram(spark, sf_dir):
    return a.histogram(t(spark, sf_dir, "lineitem"), "l_quantity", EDGES)


@query(
    "histogram_equal_width",
    """SELECT CAST(bin AS INT) AS bin, mn + (mx - mn) * (bin / 7e0) AS lo,
         CASE WHEN bin = 6 THEN mx ELSE mn + (mx - mn) * ((bin + 1) / 7e0) END AS hi, count(v) AS n
       FROM (SELECT min(value) AS mn, max(value) AS mx FROM events), range(7) r(bin)
       LEFT JOIN (SELECT value AS v FROM events) ON v >= mn + (mx - mn) * (bin / 7e0)
         AND (v < CASE WHEN bin = 6 THEN mx ELSE mn + (mx - mn) * ((bin + 1) / 7e0) END OR (bin = 6 AND v = mx))
       GROUP BY ALL""",
    "lo hi",
)
def histogram_equal_width(spark, sf_dir):
    return a.histogram(t(spark, sf_dir, "events"), "value", bins=7)


@query(
    "avg_rows_per_key",
    """SELECT CAST(count(*) AS BIGINT) AS rows, count(DISTINCT l_orderkey) AS keys,
         count(*) * 1e0 / count(DISTINCT l_orderkey) AS avg_rows FROM lineitem""",
    "avg_rows",
)
def avg_rows_per_key(spark, sf_dir):
    return a.avg_rows_per_key(t(spark, sf_dir, "lineitem"), "l_orderkey")


# ---------------------------------------------------------------- bands and ranks

@query(
    "quantile_bands",
    """SELECT l_orderkey, l_linenumber, l_partkey, b AS band, CASE WHEN b IS NOT NULL THEN greatest(e[b + 1], 0) END AS band_lo,
         CASE WHEN b IS NOT NULL THEN greatest(e[b + 2], 0) END AS band_hi,
         CASE WHEN b IS NULL THEN 'Não informado'
              ELSE printf('%.2f - %.2f', greatest(e[b + 1], 0e0) + 1e-9, greatest(e[b + 2], 0e0) + 1e-9) END AS band_label
       FROM (SELECT *, CASE WHEN v IS NOT NULL THEN CAST(len(list_filter(e[2:-2], lambda x: x < v)) AS INT) END AS b
             FROM (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_quantity END AS v,
                     (SELECT list_sort(list_distinct(quantile_cont(l_quantity,
                        [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])))
                      FROM lineitem WHERE l_partkey % 50 <> 0) AS e
                   FROM lineitem))""",
    "band_lo band_hi",
)
def quantile_bands(spark, sf_dir):
    quantity = F.when(F.col("l_partkey") % 50 != 0, F.col("l_quantity"))
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", quantity.alias("v"))
    return o.quantile_bands(lines, "v").drop("v")


@query(
    "fixed_bands",
    """SELECT SK_ID_CURR, CASE WHEN age BETWEEN 18 AND 102 THEN 18 + CAST(floor((age - 18) / 5) AS INT) * 5 END AS band_lo,
         CASE WHEN age BETWEEN 18 AND 102 THEN 23 + CAST(floor((age - 18) / 5) AS INT) * 5 END AS band_hi
       FROM (SELECT SK_ID_CURR, AGE_YEARS - 5 AS age FROM clean_application)""",
)
def fixed_bands(spark, sf_dir):
    clients = silver.clean_application(fx.raw_application(spark, sf_dir))
    return o.fixed_bands(clients.select("SK_ID_CURR", (F.col("AGE_YEARS") - 5).alias("age")), "age").drop("age")


@query(
    "rank_by",
    """SELECT event_id, floor(value) AS v, row_number() OVER (ORDER BY floor(value) DESC, event_id) AS rank
       FROM events WHERE event_type <> 'view'""",
    "v",
)
def rank_by(spark, sf_dir):
    events = t(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.floor("value").cast("double")).alias("v")
    )
    return o.rank_by(events, "v", "event_id")


@query(
    "percentile_of",
    "SELECT avg(CASE WHEN c_acctbal <= 1000 THEN 100e0 ELSE 0 END) AS percentile FROM customer",
    "percentile",
)
def percentile_of(spark, sf_dir):
    return o.percentile_of(t(spark, sf_dir, "customer"), "c_acctbal", 1000.0)


@query(
    "percentile_of_each",
    "SELECT l_extendedprice, 100 * max(d) AS percentile FROM (SELECT l_extendedprice, cume_dist() OVER (ORDER BY l_extendedprice) AS d FROM lineitem) GROUP BY 1",
    "l_extendedprice percentile",
)
def percentile_of_each(spark, sf_dir):
    return o.percentile_of_each(t(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(
    "running_totals",
    """SELECT l_quantity, v, sum(v) OVER (ORDER BY l_quantity) AS cum_v, CAST(sum(n) OVER () AS BIGINT) AS total_n
       FROM (SELECT l_quantity, sum(l_tax) AS v, count(*) AS n FROM lineitem GROUP BY 1)""",
    "l_quantity v cum_v", digits=4,
)
def running_totals(spark, sf_dir):
    totals = o.running_totals(
        t(spark, sf_dir, "lineitem"), "l_quantity", {"v": F.col("l_tax"), "n": F.lit(1)}
    )
    return totals.select("l_quantity", "v", "cum_v", "total_n")


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "o_totalprice",
)
def top_k(spark, sf_dir):
    return o.top_k(t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 25, ["o_orderkey"])


@query(
    "bottom_k",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10",
    "c_acctbal",
)
def bottom_k(spark, sf_dir):
    return o.bottom_k(t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 10, ["c_custkey"])


@query("argmax_row", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 1", "value")
def argmax_row(spark, sf_dir):
    return o.argmax_row(t(spark, sf_dir, "events").select("event_id", "value"), "value", ["event_id"])


@query(
    "best_within_tolerance",
    """SELECT l_suppkey, r, n FROM (SELECT l_suppkey, avg(l_discount) AS r, count(*) AS n FROM lineitem GROUP BY 1)
       WHERE r >= (SELECT max(r) FROM (SELECT avg(l_discount) AS r FROM lineitem GROUP BY l_suppkey)) - 0.002e0
       ORDER BY n, l_suppkey LIMIT 1""",
    "r",
)
def best_within_tolerance(spark, sf_dir):
    groups = t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.avg("l_discount").alias("r"), F.count("*").alias("n"))
    return o.best_within_tolerance(groups, "r", "n", 0.002, ["l_suppkey"])


@query(
    "marginal_gain",
    """SELECT l_suppkey, l_linenumber, r, c, gain, extra_cost,
         CASE WHEN gain > 0 THEN extra_cost / (gain / 0.001e0) END AS cost_per_step
       FROM (SELECT *, coalesce(r - lag(r) OVER w, 0) AS gain, coalesce(c - lag(c) OVER w, c) AS extra_cost
             FROM (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS r, max(l_extendedprice) AS c FROM lineitem
                   GROUP BY 1, 2) WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_linenumber))""",
    "r c gain extra_cost cost_per_step",
)
def marginal_gain(spark, sf_dir):
    sweep = (
        t(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_linenumber")
        .agg(F.sum("l_quantity").alias("r"), F.max("l_extendedprice").alias("c"))
    )
    return o.marginal_gain(sweep, "l_linenumber", "r", "c", ["l_suppkey"])


CONTRIBUTIONS = {
    "f_a": "(c_custkey % 7 - 3) / 10e0",
    "f_b": "(c_custkey % 5 - 2) / 8e0",
    "f_c": "c_acctbal / 10000e0",
    "f_d": "(c_nationkey - 12) / 20e0",
    "f_e": "-(c_custkey % 3) / 9e0",
    "f_f": "(c_custkey % 11) / 50e0",
}


@query(
    "top_factors",
    f"""SELECT c_custkey, kind, CAST(rn AS INT) AS rank, feature, impact_pct FROM (
          SELECT *, row_number() OVER (PARTITION BY c_custkey, kind ORDER BY abs(v) DESC, feature) AS rn,
            coalesce(100 * abs(v) / nullif(total, 0), 0) AS impact_pct
          FROM (SELECT c_custkey, feature, v, CASE WHEN v > 0 THEN 'risk' WHEN v < 0 THEN 'protective' END AS kind,
                  sum(abs(v)) OVER (PARTITION BY c_custkey) AS total
                FROM ({' UNION ALL '.join(f"SELECT c_custkey, '{n}' AS feature, {e} AS v FROM customer"
                                         for n, e in CONTRIBUTIONS.items())}))
          WHERE kind IS NOT NULL) WHERE rn <= 3""",
    "impact_pct",
)
def top_factors_query(spark, sf_dir):
    rows = t(spark, sf_dir, "customer").selectExpr("c_custkey", *[f"{e} AS {n}" for n, e in CONTRIBUTIONS.items()])
    return top_factors(rows, "c_custkey", list(CONTRIBUTIONS), 3)


# ---------------------------------------------------------------- profiles

@query(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        f"100e0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS pct FROM clean_application"
        for c in ("AMT_INCOME_TOTAL", "CODE_GENDER", "OWN_CAR_AGE", "DAYS_EMPLOYED", "NAME_INCOME_TYPE",
                  "OCCUPATION_TYPE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
    ),
    "pct",
)
def null_profile(spark, sf_dir):
    return p.null_profile(silver.clean_application(fx.raw_application(spark, sf_dir)))


@query(
    "key_profile",
    """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS duplicates,
         sum(n) * 1e0 / (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS avg_per_parent
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "avg_per_parent",
)
def key_profile(spark, sf_dir):
    return p.key_profile(t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_orderkey")


@query(
    "violation_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {rule}) AS rows, "
        f"100e0 * count(*) FILTER (WHERE {rule}) / count(*) AS pct FROM raw_bureau"
        for name, rule in (("future", "DAYS_CREDIT > 0"), ("negative", "AMT_CREDIT_SUM < 0"),
                           ("horizon", "DAYS_CREDIT_ENDDATE > 18250"))
    ),
    "pct",
)
def violation_profile(spark, sf_dir):
    rules = {
        "future": F.col("DAYS_CREDIT") > 0,
        "negative": F.col("AMT_CREDIT_SUM") < 0,
        "horizon": F.col("DAYS_CREDIT_ENDDATE") > 18250,
    }
    return p.violation_profile(fx.raw_bureau(spark, sf_dir), rules)


@query(
    "anomaly_rate",
    "SELECT CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END AS anomaly, avg(TARGET) AS rate, count(*) AS n FROM raw_application GROUP BY 1",
    "rate",
)
def anomaly_rate(spark, sf_dir):
    return p.anomaly_rate_by_flag(fx.raw_application(spark, sf_dir), F.col("DAYS_EMPLOYED") == 365243, "TARGET")


@query(
    "category_profile",
    """SELECT o_orderpriority, count(*) AS n, count(*) * 1e0 / sum(count(*)) OVER () AS share FROM orders
       WHERE o_orderstatus = 'O' GROUP BY 1""",
    "share",
)
def category_profile(spark, sf_dir):
    return p.category_profile(t(spark, sf_dir, "orders"), "o_orderpriority", F.col("o_orderstatus") == "O")


@query(
    "fk_profile",
    """SELECT 'lines_to_orders' AS link, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS child_keys,
         (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN
            (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) AS orphans
       UNION ALL SELECT 'events_to_customers', (SELECT count(DISTINCT user_id) FROM events),
         (SELECT count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer))""",
)
def fk_profile(spark, sf_dir):
    return p.fk_profile(
        {
            "lines_to_orders": (
                t(spark, sf_dir, "lineitem"), "l_orderkey",
                t(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'"), "o_orderkey",
            ),
            "events_to_customers": (t(spark, sf_dir, "events"), "user_id", t(spark, sf_dir, "customer"), "c_custkey"),
        }
    )


@query(
    "conditional_null_profile",
    """SELECT 'car_without_age' AS rule, count(*) FILTER (WHERE FLAG_OWN_CAR = 'N') AS rows,
         count(*) FILTER (WHERE FLAG_OWN_CAR = 'N' AND OWN_CAR_AGE IS NULL) AS nulls FROM clean_application
       UNION ALL SELECT 'employed_without_days', count(*) FILTER (WHERE FLAG_EMPLOYED = 1),
         count(*) FILTER (WHERE FLAG_EMPLOYED = 1 AND DAYS_EMPLOYED IS NULL) FROM clean_application""",
)
def conditional_null_profile(spark, sf_dir):
    return p.conditional_null_profile(
        silver.clean_application(fx.raw_application(spark, sf_dir)),
        {
            "car_without_age": (F.col("FLAG_OWN_CAR") == "N", "OWN_CAR_AGE"),
            "employed_without_days": (F.col("FLAG_EMPLOYED") == 1, "DAYS_EMPLOYED"),
        },
    )


@query(
    "amount_gap",
    """SELECT avg(AMT_INSTALMENT - AMT_PAYMENT) AS mean_gap, avg(CASE WHEN AMT_PAYMENT = 0 THEN 1e0 ELSE 0 END) AS share_nothing
       FROM clean_installments""",
    "mean_gap share_nothing",
)
def amount_gap(spark, sf_dir):
    return p.amount_gap(silver.clean_installments(fx.raw_installments(spark, sf_dir)), "AMT_INSTALMENT", "AMT_PAYMENT")


@query(
    "binned_rate",
    """SELECT b AS band, greatest(e[b + 1], 0) AS band_lo, greatest(e[b + 2], 0) AS band_hi, avg(late) AS rate, count(*) AS n
       FROM (SELECT *, CAST(len(list_filter(e[2:-2], lambda x: x < v)) AS INT) AS b
             FROM (SELECT l_extendedprice AS v, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS late,
                     (SELECT quantile_cont(l_extendedprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) FROM lineitem) AS e
                   FROM lineitem)) GROUP BY ALL""",
    "band_lo band_hi rate", digits=4,
)
def binned_rate(spark, sf_dir):
    lines = t(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("late")
    )
    return p.binned_rate(lines, "l_extendedprice", "late", 5)


@query(
    "age_rate",
    """SELECT 18 + CAST(floor((AGE_YEARS - 18) / 5) AS INT) * 5 AS band_lo, 23 + CAST(floor((AGE_YEARS - 18) / 5) AS INT) * 5 AS band_hi,
         avg(TARGET) AS rate, count(*) AS n FROM clean_application GROUP BY ALL""",
    "rate",
)
def age_rate(spark, sf_dir):
    return p.age_rate(silver.clean_application(fx.raw_application(spark, sf_dir)), "AGE_YEARS", "TARGET")

"""Drift, checks over model runs, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import drift as d
from creditloom.queries.registry import query
from creditloom.sources import fixtures as fx

SPLIT = "TIMESTAMP '1998-07-01'"


def halves(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp")
    return lines.filter(early), lines.filter(~early)


def numeric_psi_sql(feature: str, reference: str, actual: str) -> str:
    """Numeric PSI of one feature between two relations with column v."""
    probs = ", ".join(f"{i / 10!r}" for i in range(11))
    return f"""SELECT '{feature}' AS feature, sum((a - r) * ln(a / r)) AS psi FROM (
      SELECT greatest(count(*) FILTER (WHERE side = 1) * 1e0 / max(rn), 1e-6) AS r,
        greatest(count(*) FILTER (WHERE side = 0) * 1e0 / max(an), 1e-6) AS a
      FROM (SELECT *, count(*) FILTER (WHERE side = 1) OVER () AS rn, count(*) FILTER (WHERE side = 0) OVER () AS an
            FROM (SELECT side, least(len(list_filter(e, lambda x: x <= v)), len(e) - 1) AS bin
                  FROM (SELECT side, v, (SELECT list_sort(list_distinct(quantile_cont(v, [{probs}]))) FROM {reference}) AS e
                        FROM (SELECT 1 AS side, v FROM {reference} UNION ALL SELECT 0, v FROM {actual}))
                  WHERE v >= e[1] AND v <= e[-1]))
      GROUP BY bin)"""


def categorical_psi_sql(feature: str, reference: str, actual: str) -> str:
    return f"""SELECT '{feature}' AS feature, sum((a - r) * ln(a / r)) AS psi FROM (
      SELECT greatest(coalesce(r.n, 0) * 1e0 / (SELECT count(*) FROM {reference}), 1e-6) AS r,
        greatest(coalesce(a.n, 0) * 1e0 / (SELECT count(*) FROM {actual}), 1e-6) AS a
      FROM (SELECT coalesce(v, '__MISSING__') AS c, count(*) AS n FROM {reference} GROUP BY 1) r
      FULL JOIN (SELECT coalesce(v, '__MISSING__') AS c, count(*) AS n FROM {actual} GROUP BY 1) a USING (c))"""


def early(col: str) -> str:
    return f"(SELECT {col} AS v FROM lineitem WHERE l_shipdate < {SPLIT})"


def late(col: str) -> str:
    return f"(SELECT {col} AS v FROM lineitem WHERE l_shipdate >= {SPLIT})"


NUMERIC = ["l_extendedprice", "l_quantity", "l_discount"]
NUMERIC_SQL = " UNION ALL ".join(numeric_psi_sql(c, early(c), late(c)) for c in NUMERIC)


@query("psi_numeric", NUMERIC_SQL, "psi")
def psi_numeric(spark, sf_dir):
    return d.psi_numeric(*halves(spark, sf_dir), NUMERIC)


FLAGGED = "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_returnflag END"
STATUS = "CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN 'new' ELSE l_linestatus END"
CATEGORY_SQL = " UNION ALL ".join(
    categorical_psi_sql(name, early(expr), late(expr)) for name, expr in (("flag", FLAGGED), ("status", STATUS))
)


@query("psi_categorical", CATEGORY_SQL, "psi")
def psi_categorical(spark, sf_dir):
    sides = [h.selectExpr(f"{FLAGGED} AS flag", f"{STATUS} AS status") for h in halves(spark, sf_dir)]
    return d.psi_categorical(*sides, ["flag", "status"])


STATUS_SQL = "CASE WHEN psi IS NULL THEN 'warn' WHEN psi >= 0.25e0 THEN 'fail' WHEN psi >= 0.10e0 THEN 'warn' ELSE 'ok' END"
DRIFT_SQL = f"""SELECT feature, 'numeric' AS type, psi, {STATUS_SQL} AS status FROM ({NUMERIC_SQL})
  UNION ALL SELECT feature, 'categorical', psi, {STATUS_SQL} FROM ({CATEGORY_SQL})
  UNION ALL SELECT 'absent', 'numeric', NULL, 'warn'"""


def drift(spark, sf_dir):
    sides = [
        h.selectExpr(*NUMERIC, f"{FLAGGED} AS flag", f"{STATUS} AS status") for h in halves(spark, sf_dir)
    ]
    return d.drift_report(*sides, [*NUMERIC, "absent"], ["flag", "status"])


@query("drift_report", DRIFT_SQL, "psi", digits=4)
def drift_report(spark, sf_dir):
    return drift(spark, sf_dir)


# ---------------------------------------------------------------- checks over model runs

EXPECTED = ["EXT_SOURCE_1", "AMT_CREDIT", "DAYS_BIRTH"]
COLUMNS = ["SK_ID_CURR", "EXT_SOURCE_1", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH"]


@query(
    "feature_contract",
    """SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 4 = 2 THEN 1 ELSE 0 END AS missing,
         CASE WHEN o_orderkey % 4 = 1 THEN 1 WHEN o_orderkey % 4 = 2 THEN 1 ELSE 0 END AS outside,
         CASE o_orderkey % 4 WHEN 0 THEN 'ok' WHEN 3 THEN 'fail' ELSE 'warn' END AS status FROM orders""",
)
def feature_contract(spark, sf_dir):
    kind = F.col("o_orderkey") % 4
    recorded = (
        F.when(kind == 0, F.array(F.lit("EXT_SOURCE_1"), F.lit("DAYS_BIRTH")))
        .when(kind == 1, F.array(F.lit("AMT_CREDIT"), F.lit("AMT_ANNUITY")))
        .when(kind == 2, F.array(F.lit("AMT_CREDIT"), F.lit("GONE")))
    )
    runs = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), recorded.alias("feature_columns")
    )
    checked = d.feature_contract(runs, COLUMNS, EXPECTED)
    return checked.select(
        "run_id",
        F.size("missing_in_table").alias("missing"),
        F.size("outside_track").alias("outside"),
        "status",
    )


BASELINE_SQL = """SELECT run_id, CASE WHEN pr_auc IS NULL OR threshold IS NULL THEN 'fail'
  WHEN pr_auc < 0.10e0 OR recall < 0.40e0 THEN 'warn' ELSE 'ok' END AS status FROM runs"""


@query("baseline_check", BASELINE_SQL)
def baseline_check(spark, sf_dir):
    return d.baseline_check(fx.runs(spark, sf_dir)).select("run_id", "status")


COHERENCE_SQL = """SELECT run_id, CASE WHEN threshold IS NULL THEN 'fail' WHEN abs(threshold - 0.08e0) < 1e-9 THEN 'ok'
  ELSE 'warn' END AS status FROM runs"""


@query("threshold_coherence", COHERENCE_SQL)
def threshold_coherence(spark, sf_dir):
    return d.threshold_coherence(fx.runs(spark, sf_dir), 0.08).select("run_id", "status")


@query(
    "freshness",
    """SELECT run_id, coalesce(trained_at >= TIMESTAMP '2001-07-15 12:00:00' - INTERVAL 24 HOUR, false) AS fresh FROM runs""",
)
def freshness(spark, sf_dir):
    now = F.lit("2001-07-15 12:00:00").cast("timestamp")
    return d.freshness(fx.runs(spark, sf_dir), "trained_at", now).select("run_id", "fresh")


WORST = "CASE max(CASE status WHEN 'ok' THEN 0 WHEN 'warn' THEN 1 ELSE 2 END) WHEN 0 THEN 'ok' WHEN 1 THEN 'warn' ELSE 'fail' END"


@query(
    "monitoring_report",
    f"""WITH c AS (SELECT 'performance_baseline' AS name, {WORST} AS status, 'all runs' AS detail FROM ({BASELINE_SQL})
          UNION ALL SELECT 'threshold_coherence', {WORST}, 'all runs' FROM ({COHERENCE_SQL})
          UNION ALL SELECT 'data_drift', {WORST}, 'max PSI=' || printf('%.4f', max(round(psi, 4))) FROM ({DRIFT_SQL}))
        SELECT name, status, detail, (SELECT {WORST} FROM c) AS overall_status,
          (SELECT max(o_orderdate) FROM orders) AS run_ts FROM c""",
)
def monitoring_report(spark, sf_dir):
    runs = fx.runs(spark, sf_dir)
    checks = [
        d.check_of(d.baseline_check(runs), "performance_baseline", "all runs"),
        d.check_of(d.threshold_coherence(runs, 0.08), "threshold_coherence", "all runs"),
        d.drift_check(drift(spark, sf_dir)),
    ]
    stamp = runs.agg(F.max("trained_at").alias("t")).scalar()
    return d.monitoring_report(checks, stamp)


CHECK_NAME = (
    "CASE event_id % 6 WHEN 0 THEN 'api_health' WHEN 1 THEN concat('artifact:', event_type) WHEN 2 THEN 'feature_schema' "
    "WHEN 3 THEN 'data_drift' WHEN 4 THEN 'performance_baseline' ELSE 'threshold_coherence' END"
)
CHECK_STATUS = "CASE WHEN value > 60 THEN 'FAIL' WHEN value > 20 THEN 'warn' WHEN event_id % 50 = 0 THEN 'odd' ELSE 'ok' END"


def check_history(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").selectExpr(f"{CHECK_NAME} AS name", f"{CHECK_STATUS} AS status", "ts")


@query(
    "checks_by_domain",
    f"""SELECT CASE WHEN name LIKE 'artifact:%' THEN 'artifacts' ELSE CASE name WHEN 'api_health' THEN 'api' WHEN 'feature_schema'
          THEN 'schema' WHEN 'data_drift' THEN 'drift' WHEN 'performance_baseline' THEN 'performance' ELSE 'governance' END END AS domain,
          count(*) FILTER (WHERE lower(status) = 'ok') AS ok, count(*) FILTER (WHERE lower(status) = 'warn') AS warn,
          count(*) FILTER (WHERE lower(status) = 'fail') AS fail, count(*) AS checks,
          CASE max(CASE lower(status) WHEN 'ok' THEN 0 WHEN 'fail' THEN 2 ELSE 1 END) WHEN 0 THEN 'ok' WHEN 1 THEN 'warn'
            ELSE 'fail' END AS domain_status
        FROM (SELECT {CHECK_NAME} AS name, {CHECK_STATUS} AS status FROM events) GROUP BY 1""",
)
def checks_by_domain(spark, sf_dir):
    return d.checks_by_domain(check_history(spark, sf_dir))

"""Decisions on scored clients: triage, audit, segments, benchmark, what-if."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import scoring as s
from creditloom.queries import gold
from creditloom.queries.registry import query
from creditloom.sources import fixtures as fx

T = 0.08
ACTION = (
    "CASE WHEN probability < 0.08e0 * 0.4e0 THEN 'autoaprovacao_candidata' WHEN probability < 0.08e0 THEN 'mesa_analise' "
    "ELSE 'recusa_candidata' END"
)
BAND = "CASE WHEN probability < 0.08e0 * 0.4e0 THEN 'Baixo risco' WHEN probability < 0.08e0 THEN 'Risco moderado' ELSE 'Alto risco' END"
PREDICTION = "CASE WHEN probability >= 0.08e0 THEN 1 ELSE 0 END"
DECISION = f"""{PREDICTION} AS prediction, 0.08e0 AS threshold, {BAND} AS risk_band,
  CASE WHEN probability >= 0.08e0 THEN 'Reprovado (Risco de Inadimplência)' ELSE 'Aprovado (Pagador Saudável)' END AS label,
  {ACTION} AS action, CASE {ACTION} WHEN 'autoaprovacao_candidata' THEN 'Autoaprovação candidata (humano confirma política)'
    WHEN 'mesa_analise' THEN 'Encaminhar à mesa de crédito (zona cinzenta)' ELSE 'Recusa candidata (parecer + auditoria XAI)'
  END AS action_label, true AS human_in_the_loop"""
EMITTED = "2026-01-01 00:00:00"


@query(
    "triage",
    f"""SELECT 'credit_decision_triage' AS event_type, TIMESTAMP '{EMITTED}' AS emitted_at, SK_ID_CURR AS client_id, probability,
          {DECISION} FROM scored""",
    "probability threshold",
)
def triage(spark, sf_dir):
    return s.triage(fx.scored(spark, sf_dir), "SK_ID_CURR", "probability", T, F.lit(EMITTED).cast("timestamp"))


@query(
    "risk_bands",
    f"SELECT {BAND} AS risk_band, count(*) AS clients, avg(probability) AS mean_p FROM scored GROUP BY 1",
    "mean_p",
)
def risk_bands(spark, sf_dir):
    rows = s.decide(fx.scored(spark, sf_dir), "probability", T)
    return rows.groupBy("risk_band").agg(F.count("*").alias("clients"), F.avg("probability").alias("mean_p"))


@query(
    "audit_outcome",
    f"""SELECT SK_ID_CURR, CASE WHEN {PREDICTION} = 1 THEN CASE WHEN TARGET = 1 THEN 'TP' ELSE 'FP' END
          ELSE CASE WHEN TARGET = 1 THEN 'FN' ELSE 'TN' END END AS outcome FROM scored""",
)
def audit_outcome(spark, sf_dir):
    rows = s.decide(fx.scored(spark, sf_dir), "probability", T)
    return rows.select("SK_ID_CURR", s.audit_outcome(F.col("prediction"), F.col("TARGET")).alias("outcome"))


PROBS = "[" + ", ".join(f"{i / 10!r}" for i in range(11)) + "]"


@query(
    "segment_risk",
    f"""SELECT 'NAME_INCOME_TYPE' AS attribute, NAME_INCOME_TYPE AS segment, avg(probability) AS mean_risk, count(*) AS clients
          FROM scored GROUP BY 2
        UNION ALL SELECT 'NAME_EDUCATION_TYPE', coalesce(NAME_EDUCATION_TYPE, 'Não informado'), avg(probability), count(*)
          FROM scored GROUP BY 2
        UNION ALL SELECT 'AMT_CREDIT', CASE WHEN b IS NULL THEN 'Não informado'
            ELSE printf('%.2f - %.2f', greatest(e[b + 1], 0e0) + 1e-9, greatest(e[b + 2], 0e0) + 1e-9) END, avg(probability), count(*)
          FROM (SELECT *, CASE WHEN AMT_CREDIT IS NOT NULL THEN len(list_filter(e[2:-2], lambda x: x < AMT_CREDIT)) END AS b
                FROM (SELECT *, (SELECT quantile_cont(AMT_CREDIT, {PROBS}) FROM scored) AS e FROM scored)) GROUP BY 2""",
    "mean_risk",
)
def segment_risk(spark, sf_dir):
    return s.segment_risk(
        fx.scored(spark, sf_dir), "probability", ["NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE"], ["AMT_CREDIT"]
    )


def _benchmark(feature: str) -> str:
    marks = ", ".join(
        f"(SELECT quantile_cont({feature}, {p}) FROM scored) AS p{int(p * 100)}" for p in (0.5, 0.75, 0.9)
    )
    return (
        f"SELECT SK_ID_CURR, '{feature}' AS feature, CAST({feature} AS DOUBLE) AS client_value, {marks}, "
        f"100 * cume_dist() OVER (ORDER BY {feature}) AS percentile, (SELECT count(*) FROM scored) AS sample_size, "
        f"(SELECT avg(TARGET) FROM scored) AS portfolio_default_rate FROM scored WHERE {feature} IS NOT NULL"
    )


@query(
    "portfolio_benchmark",
    f"{_benchmark('AMT_CREDIT')} UNION ALL {_benchmark('AMT_ANNUITY')}",
    "client_value p50 p75 p90 percentile portfolio_default_rate",
)
def portfolio_benchmark(spark, sf_dir):
    portfolio = fx.scored(spark, sf_dir)
    return s.portfolio_benchmark(portfolio, portfolio, "SK_ID_CURR", ["AMT_CREDIT", "AMT_ANNUITY"], "TARGET")


# ---------------------------------------------------------------- what-if

CLIENT_COLUMNS = ["SK_ID_CURR", "AMT_CREDIT", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "NAME_INCOME_TYPE",
                  "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "LOG_AMT_CREDIT"]
SCENARIOS = """SELECT c_custkey AS client_id, 'AMT_CREDIT' AS feature, '9000.5' AS value FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, 'AMT_INCOME_TOTAL', '0' FROM customer WHERE c_custkey % 4 = 0
  UNION ALL SELECT c_custkey, 'NAME_INCOME_TYPE', 'WORKING' FROM customer WHERE c_custkey % 5 = 0
  UNION ALL SELECT c_custkey, 'NO_SUCH_FEATURE', '1' FROM customer WHERE c_custkey % 6 = 0"""
APPLIED = f"""SELECT SK_ID_CURR, AMT_CREDIT, AMT_ANNUITY, AMT_INCOME_TOTAL, NAME_INCOME_TYPE,
  AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0) AS CREDIT_INCOME_RATIO, AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0) AS ANNUITY_INCOME_RATIO,
  ln(1 + greatest(AMT_CREDIT, 0)) AS LOG_AMT_CREDIT FROM (
    SELECT SK_ID_CURR, CASE WHEN SK_ID_CURR % 3 = 0 THEN 9000.5e0 ELSE AMT_CREDIT END AS AMT_CREDIT, AMT_ANNUITY,
      CASE WHEN SK_ID_CURR % 4 = 0 THEN 0e0 ELSE AMT_INCOME_TOTAL END AS AMT_INCOME_TOTAL,
      CASE WHEN SK_ID_CURR % 5 = 0 THEN 'WORKING' ELSE NAME_INCOME_TYPE END AS NAME_INCOME_TYPE FROM application)"""


def scenarios(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer")
    rows = None
    for feature, value, step in (
        ("AMT_CREDIT", "9000.5", 3), ("AMT_INCOME_TOTAL", "0", 4), ("NAME_INCOME_TYPE", "WORKING", 5),
        ("NO_SUCH_FEATURE", "1", 6),
    ):
        part = customers.filter(F.col("c_custkey") % step == 0).select(
            F.col("c_custkey").alias("client_id"), F.lit(feature).alias("feature"), F.lit(value).alias("value")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


def whatif_pair(spark, sf_dir):
    clients = gold.application(spark, sf_dir).select(*CLIENT_COLUMNS)
    asked = scenarios(spark, sf_dir)
    return clients, s.recalculate(s.apply_overrides(clients, asked, "SK_ID_CURR")), asked


@query(
    "whatif",
    APPLIED,
    "AMT_CREDIT AMT_ANNUITY AMT_INCOME_TOTAL CREDIT_INCOME_RATIO ANNUITY_INCOME_RATIO LOG_AMT_CREDIT",
)
def whatif(spark, sf_dir):
    return whatif_pair(spark, sf_dir)[1]


@query(
    "override_diff",
    f"""SELECT * FROM (
          SELECT o.SK_ID_CURR, 'AMT_CREDIT' AS feature, CAST(o.AMT_CREDIT AS VARCHAR) AS original, CAST(a.AMT_CREDIT AS VARCHAR) AS applied
            FROM application o JOIN ({APPLIED}) a USING (SK_ID_CURR)
          UNION ALL SELECT o.SK_ID_CURR, 'AMT_INCOME_TOTAL', CAST(o.AMT_INCOME_TOTAL AS VARCHAR), CAST(a.AMT_INCOME_TOTAL AS VARCHAR)
            FROM application o JOIN ({APPLIED}) a USING (SK_ID_CURR)
          UNION ALL SELECT o.SK_ID_CURR, 'NAME_INCOME_TYPE', o.NAME_INCOME_TYPE, a.NAME_INCOME_TYPE
            FROM application o JOIN ({APPLIED}) a USING (SK_ID_CURR))
        WHERE original IS DISTINCT FROM applied""",
)
def override_diff(spark, sf_dir):
    changes = s.override_diff(*whatif_pair(spark, sf_dir), "SK_ID_CURR")
    rows = changes.select("SK_ID_CURR", F.explode("overrides").alias("feature", "change"))
    return rows.select("SK_ID_CURR", "feature", "change.original", "change.applied")

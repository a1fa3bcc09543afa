"""Classification metrics over scored clients, and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import metrics as m
from creditloom.operators import sampling as s
from creditloom.queries.registry import query
from creditloom.sources import fixtures as fx

T = 0.08
RATES = "recall precision f_beta rejection threshold"


def cells_sql(t: str) -> str:
    return (
        f"count(*) FILTER (WHERE TARGET = 0 AND probability < {t}) AS tn, "
        f"count(*) FILTER (WHERE TARGET = 0 AND probability >= {t}) AS fp, "
        f"count(*) FILTER (WHERE TARGET = 1 AND probability < {t}) AS fn, "
        f"count(*) FILTER (WHERE TARGET = 1 AND probability >= {t}) AS tp"
    )


RATES_SQL = (
    "coalesce(tp * 1e0 / nullif(tp + fn, 0), 0) AS recall, coalesce(tp * 1e0 / nullif(tp + fp, 0), 0) AS precision, "
    "coalesce(tp * 5e0 / nullif(tp * 5e0 + fn * 4e0 + fp, 0), 0) AS f_beta, "
    "coalesce((tp + fp) * 1e0 / nullif(tn + fp + fn + tp, 0), 0) AS rejection"
)


@query(
    "confusion",
    f"SELECT *, {RATES_SQL}, 0.08e0 AS threshold FROM (SELECT {cells_sql('0.08e0')} FROM scored)",
    RATES,
)
def confusion(spark, sf_dir):
    return m.classification_metrics(fx.scored(spark, sf_dir), "TARGET", "probability", T)


GRID = [round(0.01 * i, 2) for i in range(1, 11)]


@query(
    "threshold_sweep",
    " UNION ALL ".join(
        f"SELECT {t!r}::DOUBLE AS threshold, *, {RATES_SQL} FROM (SELECT {cells_sql(f'{t!r}::DOUBLE')} FROM scored)"
        for t in GRID
    ),
    RATES,
)
def threshold_sweep(spark, sf_dir):
    return m.threshold_sweep(fx.scored(spark, sf_dir), "TARGET", "probability", GRID)


RANKING_SQL = """SELECT sum(pos * 1e0 / p_all * tp / (tp + fp)) AS pr_auc,
  sum(neg * (tp - pos + pos / 2e0) / (p_all * 1e0 * n_all)) AS roc_auc FROM curve"""


@query("ranking_metrics", RANKING_SQL, "pr_auc roc_auc")
def ranking_metrics(spark, sf_dir):
    return m.ranking_metrics(fx.scored(spark, sf_dir), "TARGET", "probability")


@query("avg_precision", f"SELECT pr_auc FROM ({RANKING_SQL})", "pr_auc")
def avg_precision(spark, sf_dir):
    return m.average_precision(fx.scored(spark, sf_dir), "TARGET", "probability")


@query("roc_auc", f"SELECT roc_auc FROM ({RANKING_SQL})", "roc_auc")
def roc_auc(spark, sf_dir):
    return m.roc_auc(fx.scored(spark, sf_dir), "TARGET", "probability")


@query(
    "score_curve",
    """SELECT probability, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
         CAST(p_all AS BIGINT) AS total_pos, CAST(n_all AS BIGINT) AS total_neg,
         tp * 1e0 / p_all AS recall, tp * 1e0 / (tp + fp) AS precision, fp * 1e0 / n_all AS fpr FROM curve""",
    "probability recall precision fpr",
)
def score_curve(spark, sf_dir):
    return m.score_curve(fx.scored(spark, sf_dir), "TARGET", "probability")


@query(
    "evaluate",
    f"""SELECT *, {RATES_SQL}, 0.08e0 AS threshold FROM (SELECT {cells_sql('0.08e0')} FROM scored), ({RANKING_SQL})""",
    f"{RATES} pr_auc roc_auc",
)
def evaluate(spark, sf_dir):
    return m.evaluate(fx.scored(spark, sf_dir), "TARGET", "probability", T)


@query(
    "ranking_by_segment",
    """SELECT seg AS NAME_INCOME_TYPE, sum(pos * 1e0 / p_all * tp / (tp + fp)) AS pr_auc,
         sum(neg * (tp - pos + pos / 2e0) / (p_all * 1e0 * n_all)) AS roc_auc
       FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY seg) AS p_all,
               sum(neg) OVER (PARTITION BY seg) AS n_all
             FROM (SELECT NAME_INCOME_TYPE AS seg, probability, sum(TARGET) AS pos, sum(1 - TARGET) AS neg
                   FROM scored GROUP BY 1, 2)
             WINDOW w AS (PARTITION BY seg ORDER BY probability DESC ROWS UNBOUNDED PRECEDING)) GROUP BY 1""",
    "pr_auc roc_auc",
)
def ranking_by_segment(spark, sf_dir):
    return m.ranking_metrics(fx.scored(spark, sf_dir), "TARGET", "probability", ["NAME_INCOME_TYPE"])


@query(
    "label_scores",
    """SELECT sum(pos * 1e0 / p_all * tp / (tp + fp)) AS pr_auc, sum(neg * (tp - pos + pos / 2e0) / (p_all * 1e0 * n_all)) AS roc_auc
       FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all
             FROM (SELECT n_chars, sum(quality) AS pos, sum(1 - quality) AS neg FROM labels JOIN documents USING (doc_id)
                   GROUP BY 1) WINDOW w AS (ORDER BY n_chars DESC ROWS UNBOUNDED PRECEDING))""",
    "pr_auc roc_auc",
)
def label_scores(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labelled = fx.table(spark, sf_dir, "labels").select("doc_id", "quality").join(documents, "doc_id")
    return m.ranking_metrics(labelled, "quality", "n_chars")


@query(
    "class_report",
    """WITH c AS (SELECT tn * 1e0 AS tn, fp * 1e0 AS fp, fn * 1e0 AS fn, tp * 1e0 AS tp FROM (SELECT """
    + cells_sql("0.08e0")
    + """ FROM scored)), s AS (
         SELECT '0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1,
           CAST(tn + fp AS BIGINT) AS support FROM c
         UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), CAST(tp + fn AS BIGINT) FROM c)
       SELECT * FROM s UNION ALL SELECT 'macro', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM s
       UNION ALL SELECT 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM s""",
    "precision recall f1",
)
def class_report(spark, sf_dir):
    return m.classification_report(fx.scored(spark, sf_dir), "TARGET", "probability", T)


@query(
    "portfolio_kpis",
    f"""SELECT NAME_INCOME_TYPE, tn, fp, fn, tp, tn + fp + fn + tp AS test_rows, tp + fn AS defaults_total, tn + fn AS approved,
          (tp + fn) * 1e0 / (tn + fp + fn + tp) AS base_default_rate, fn * 1e0 / (tn + fn) AS post_model_default_rate,
          1 - (fn * 1e0 / (tn + fn)) / ((tp + fn) * 1e0 / (tn + fp + fn + tp)) AS default_reduction
        FROM (SELECT NAME_INCOME_TYPE, {cells_sql('0.08e0')} FROM scored GROUP BY 1)""",
    "base_default_rate post_model_default_rate default_reduction",
)
def portfolio_kpis(spark, sf_dir):
    counts = m.classification_metrics(
        fx.scored(spark, sf_dir), "TARGET", "probability", T, by=["NAME_INCOME_TYPE"]
    ).withColumn("test_rows", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))
    return m.portfolio_kpis(counts).select(
        "NAME_INCOME_TYPE", "tn", "fp", "fn", "tp", "test_rows", "defaults_total", "approved",
        "base_default_rate", "post_model_default_rate", "default_reduction",
    )


@query(
    "fold_summary",
    """WITH f AS (SELECT NAME_INCOME_TYPE, avg(TARGET) AS r FROM scored GROUP BY 1)
       SELECT 'r' AS metric, avg(r) AS mean, stddev_pop(r) AS std, count(r) AS folds FROM f""",
    "mean std",
)
def fold_summary(spark, sf_dir):
    rows = fx.scored(spark, sf_dir).groupBy("NAME_INCOME_TYPE").agg(F.avg("TARGET").alias("r"))
    return m.summary_of_folds(rows, ["r"])


# ---------------------------------------------------------------- sampling

ORDERED = (
    "SELECT SK_ID_CURR, TARGET, row_number() OVER (PARTITION BY TARGET ORDER BY md5('42|' || SK_ID_CURR::VARCHAR)) AS rn, "
    "count(*) OVER (PARTITION BY TARGET) AS size FROM scored"
)


@query(
    "stratified_split",
    f"""SELECT SK_ID_CURR, TARGET, CASE WHEN rn <= demo THEN 'demo'
          WHEN rn <= demo + floor((size - demo) * (0.15e0 / 0.95e0) + 0.5e0) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, floor(size * 0.05e0 + 0.5e0) AS demo FROM ({ORDERED}))""",
)
def stratified_split(spark, sf_dir):
    clients = fx.scored(spark, sf_dir).select("SK_ID_CURR", "TARGET")
    return s.stratified_split(clients, train=0.8, test=0.15, demo=0.05)


@query(
    "sample_n",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7|' || o_orderkey::VARCHAR) LIMIT 5000""",
    "o_totalprice",
)
def sample_n(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return s.sample_n(orders, 5000, "o_orderkey", seed=7)


@query(
    "sample_fraction",
    """SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey::VARCHAR)) AS rn,
         count(*) OVER () AS n FROM orders) WHERE rn <= floor(n * 0.1e0 + 0.5e0)""",
)
def sample_fraction(spark, sf_dir):
    return s.sample_fraction(fx.table(spark, sf_dir, "orders").select("o_orderkey"), 0.1, "o_orderkey")


@query(
    "undersample",
    f"""SELECT SK_ID_CURR, TARGET FROM ({ORDERED})
        WHERE TARGET = 1 OR rn <= (SELECT count(*) FROM scored WHERE TARGET = 1)""",
)
def undersample(spark, sf_dir):
    return s.undersample(fx.scored(spark, sf_dir).select("SK_ID_CURR", "TARGET"))


@query(
    "folds",
    "SELECT SK_ID_CURR, TARGET, CAST("
    + " + ".join(f"CASE WHEN rn > floor(size * {i} / 5) THEN 1 ELSE 0 END" for i in range(1, 5))
    + f" AS INT) AS fold FROM ({ORDERED})",
)
def folds(spark, sf_dir):
    return s.k_fold(fx.scored(spark, sf_dir).select("SK_ID_CURR", "TARGET"), 5)


@query(
    "class_weight",
    """SELECT count(*) FILTER (WHERE TARGET = 0) AS n_neg, count(*) FILTER (WHERE TARGET = 1) AS n_pos,
         count(*) FILTER (WHERE TARGET = 0) * 1e0 / greatest(count(*) FILTER (WHERE TARGET = 1), 1) AS weight FROM scored""",
    "weight",
)
def class_weight(spark, sf_dir):
    return s.class_weight(fx.scored(spark, sf_dir))

"""Fitted models over the fixture modelling table. Fitted values have no SQL twin.

The label of the fixture is the sign of the account balance, so income features are
left out of every model.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from creditloom.operators import metrics, models
from creditloom.operators import scoring as s
from creditloom.operators.ordering import argmax_row, best_within_tolerance, marginal_gain
from creditloom.operators.sampling import k_fold, undersample
from creditloom.operators.scoring import segment_risk, top_factors
from creditloom.plans import decision, silver, training
from creditloom.queries import gold
from creditloom.queries.decisions import scenarios
from creditloom.queries.registry import query
from creditloom.session import materialize, shared_dir
from creditloom.sources import fixtures as fx

T = 0.08
LEAKY = ("AMT_INCOME_TOTAL", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO")
FRACTIONS = {"train": 0.75, "test": 0.2, "demo": 0.05}

# The linear model and gbt_scores have their full settings. Few trees: these queries show the job, not the best model.
LOGISTIC = models.LOGISTIC
FOREST = replace(models.FOREST, params={"numTrees": 10, "maxDepth": 5, "minInstancesPerNode": 5})
BOOSTED = replace(models.BOOSTED, params={**models.BOOSTED.params, "maxIter": 5, "maxDepth": 3})


def clients(spark, sf_dir):
    """Key and label of each row of the modelling table, which has one row per application."""
    return gold.application(spark, sf_dir).select(models.KEY, models.LABEL)


def split(spark, sf_dir):
    """Written once, with its split: the cuts come from the applications alone."""
    return training.split_table(gold.abt(spark, sf_dir), keys=clients(spark, sf_dir), **FRACTIONS)


def scored_by(spec, spark, sf_dir):
    table = split(spark, sf_dir)
    model = models.fit(training.part(table, "train"), spec, training.model_features(table, "extended", LEAKY))
    return models.score(training.part(table, "test"), model, T).select(
        "SK_ID_CURR", "TARGET", "probability", "prediction"
    )


@query("lr_scores")
def lr_scores(spark, sf_dir):
    return scored_by(LOGISTIC, spark, sf_dir)


@query("rf_scores")
def rf_scores(spark, sf_dir):
    return scored_by(FOREST, spark, sf_dir)


@query("gbt_scores")
def gbt_scores(spark, sf_dir):
    return scored_by(models.BOOSTED, spark, sf_dir)


@query("train_run")
def train_run(spark, sf_dir):
    record = training.train_run(gold.abt(spark, sf_dir), FOREST, T, "full", LEAKY, keys=clients(spark, sf_dir), **FRACTIONS)[2]
    return record.drop("trained_at")


@query("importance")
def importance(spark, sf_dir):
    table = split(spark, sf_dir)
    model = models.fit(training.part(table, "train"), FOREST, training.model_features(table, "full", LEAKY))
    return models.feature_importance(table, model)


@query("contributions")
def contributions(spark, sf_dir):
    table = split(spark, sf_dir)
    model = models.fit(training.part(table, "train"), LOGISTIC, training.model_features(table, "core", LEAKY))
    each = models.contributions(training.part(table, "test"), model)
    return top_factors(each, "SK_ID_CURR", [c for c in each.columns if c != "SK_ID_CURR"])


@query("compare_models")
def compare_models(spark, sf_dir):
    table = split(spark, sf_dir)
    tracks = {t: training.model_features(table, t, LEAKY) for t in ("core", "full")}
    rows = models.compare_models(
        training.part(table, "train"), training.part(table, "test"), [LOGISTIC, FOREST, BOOSTED], tracks, T
    )
    return metrics.ranked(rows, by=["track"])


@query("tree_sweep")
def tree_sweep(spark, sf_dir):
    table = split(spark, sf_dir)
    specs = [replace(BOOSTED, name=f"boosted_{n}", params={**BOOSTED.params, "maxIter": n}) for n in (2, 4, 8)]
    features = training.model_features(table, "core", LEAKY)
    rows = models.sweep(training.part(table, "train"), training.part(table, "test"), specs, features, T)
    return marginal_gain(rows.withColumn("sweep", F.lit("trees")), "setting", "pr_auc", "fit_seconds", ["sweep"]).drop("sweep")


# (depth, learning rate) of the tree grid
GRID = [(3, 0.05), (4, 0.05), (5, 0.05), (4, 0.03)]


@query(
    "grid_search",
    f"""WITH sizes AS (
          SELECT TARGET, n - h AS rest FROM (
            SELECT TARGET, count(*) AS n, floor(count(*) * CAST({FRACTIONS["demo"]} AS DOUBLE) + 0.5) AS h
            FROM clean_application GROUP BY TARGET)),
        tests AS (
          SELECT TARGET, CAST(floor(rest * (CAST({FRACTIONS["test"]} AS DOUBLE)
                   / (CAST({FRACTIONS["train"]} AS DOUBLE) + CAST({FRACTIONS["test"]} AS DOUBLE))) + 0.5) AS BIGINT) AS n FROM sizes)
        SELECT max_depth, step_size, (SELECT n FROM tests WHERE TARGET = 0) AS negatives,
               (SELECT n FROM tests WHERE TARGET = 1) AS positives, true AS in_range, true AS best_found, true AS chosen_near
        FROM (VALUES {", ".join(f"({d}, CAST({r} AS DOUBLE))" for d, r in GRID)}) AS grid(max_depth, step_size)""",
    "step_size",
)
def grid_search(spark, sf_dir):
    """What holds for any fit of the grid: rows of each class, metrics in range, the best setting and the one with fewest misses near it."""
    table = split(spark, sf_dir)
    specs = [
        replace(BOOSTED, name=f"depth_{d}_rate_{r}", params={**BOOSTED.params, "maxDepth": d, "stepSize": r}) for d, r in GRID
    ]
    features = training.model_features(table, "core", LEAKY)
    rows = materialize(models.sweep(training.part(table, "train"), training.part(table, "test"), specs, features, T), "grid")
    best = argmax_row(rows, "pr_auc", ["setting"]).select(F.col("pr_auc").alias("best_pr_auc"))
    chosen = best_within_tolerance(rows, "pr_auc", "fn", ties=["setting"]).select(
        F.struct(F.col("pr_auc"), F.col("fn")).alias("chosen")
    )
    top, near = best.scalar(), chosen.scalar()
    place = F.struct(*[F.array(*[F.lit(g[i]) for g in GRID])[F.col("setting")].alias(n) for i, n in enumerate(("max_depth", "step_size"))])
    return rows.select(
        place["max_depth"].alias("max_depth"), place["step_size"].alias("step_size"),
        (F.col("tn") + F.col("fp")).alias("negatives"), (F.col("fn") + F.col("tp")).alias("positives"),
        (F.col("pr_auc").between(0, 1) & F.col("roc_auc").between(0, 1)).alias("in_range"),
        (F.col("pr_auc") <= top).alias("best_found"),
        ((near["pr_auc"] >= top - 0.001) & ((F.col("pr_auc") < top - 0.001) | (F.col("fn") >= near["fn"]))).alias("chosen_near"),
    )


@query("weight_sweep")
def weight_sweep(spark, sf_dir):
    table = split(spark, sf_dir)
    specs = [replace(LOGISTIC, name=f"logistic_w{w}", positive_weight=w) for w in (1.0, 5.0, 10.0)]
    features = training.model_features(table, "core", LEAKY)
    return models.sweep(training.part(table, "train"), training.part(table, "test"), specs, features, T)


@query("undersampled_model")
def undersampled_model(spark, sf_dir):
    table = split(spark, sf_dir)
    features = training.model_features(table, "core", LEAKY)
    train, test = training.part(table, "train"), training.part(table, "test")
    few = materialize(undersample(train), "undersampled")
    weighted = models.evaluation_row(test, models.fit(train, LOGISTIC, features), T, sample="weighted")
    balanced = models.evaluation_row(test, models.fit(few, LOGISTIC, features), T, sample="undersampled")
    return metrics.compare([weighted, balanced])


@query("cross_validation")
def cross_validation(spark, sf_dir):
    abt = materialize(k_fold(gold.abt(spark, sf_dir), 5, keys=clients(spark, sf_dir)), "folds")
    features = training.model_features(abt.drop("fold"), "core", LEAKY)
    rows = models.cross_validate(abt, LOGISTIC, features, T)
    return metrics.summary_of_folds(rows, ["pr_auc", "roc_auc", "f_beta"])


@query("portfolio_scores")
def portfolio_scores(spark, sf_dir):
    """Mean risk per segment of a portfolio scored by a fitted model."""
    table = split(spark, sf_dir)
    model = models.fit(training.part(table, "train"), LOGISTIC, training.model_features(table, "core", LEAKY))
    portfolio = materialize(models.score(table.drop("split"), model, T), "portfolio")
    return segment_risk(portfolio, "probability", ["NAME_INCOME_TYPE", "OCCUPATION_TYPE"], ["AMT_CREDIT"])


@query("decide_clients")
def decide_clients(spark, sf_dir):
    """Decisions with factors for every client that has events, under the what-if scenarios."""
    table = split(spark, sf_dir)
    model = models.fit(training.part(table, "train"), LOGISTIC, training.model_features(table, "core", LEAKY))
    ids = fx.table(spark, sf_dir, "events").select(F.col("user_id").alias("SK_ID_CURR"))
    return decision.decide_clients(
        table.drop("split"), ids, scenarios(spark, sf_dir), model, T, F.lit("2026-01-01").cast("timestamp")
    )


EVERY_CLIENT = "SELECT SK_ID_CURR, {} FROM clean_application"


def _core(spark, sf_dir):
    """A linear model on the train part, and the whole table."""
    table = split(spark, sf_dir)
    return models.fit(training.part(table, "train"), LOGISTIC, training.model_features(table, "core", LEAKY)), table.drop("split")


@query("model_reload", EVERY_CLIENT.format("true AS same, true AS decided"))
def model_reload(spark, sf_dir):
    """Every client scored by a model in memory and by the same model saved and loaded: the scores are equal."""
    model, table = _core(spark, sf_dir)
    path = shared_dir(spark, "model")
    models.save(model, path, T)
    again, threshold = models.load(spark, path)
    here = models.score(table, model, T).select("SK_ID_CURR", F.col("probability").alias("here"))
    loaded = models.score(table, again, threshold).select("SK_ID_CURR", "probability", "prediction")
    return loaded.join(here, "SK_ID_CURR").select(
        "SK_ID_CURR", (F.col("here") == F.col("probability")).alias("same"),
        (F.col("prediction") == (F.col("probability") >= T).cast("int")).alias("decided"),
    )


@query("contributions_add_up", EVERY_CLIENT.format("true AS adds_up"))
def contributions_add_up(spark, sf_dir):
    """A client's contributions differ from its log-odds by the same constant for every client."""
    model, table = _core(spark, sf_dir)
    each = models.contributions(table, model)
    names = [c for c in each.columns if c != "SK_ID_CURR"]
    total = each.select("SK_ID_CURR", sum((F.col(c) for c in names), F.lit(0.0)).alias("total"))
    odds = models.score(table, model, T).select("SK_ID_CURR", F.ln(F.col("probability") / (1 - F.col("probability"))).alias("odds"))
    both = materialize(odds.join(total, "SK_ID_CURR").select("SK_ID_CURR", (F.col("odds") - F.col("total")).alias("rest")), "odds")
    constant = both.agg(F.avg("rest")).first()[0]
    return both.select("SK_ID_CURR", (F.abs(F.col("rest") - constant) < 1e-6).alias("adds_up"))


@query("importance_total", "SELECT CAST(1 AS DOUBLE) AS total, true AS in_range", "total")
def importance_total(spark, sf_dir):
    """The importances of all features of a forest are shares."""
    table = split(spark, sf_dir)
    model = models.fit(training.part(table, "train"), FOREST, training.model_features(table, "full", LEAKY))
    found = models.feature_importance(table, model, top=len(model.features))
    return found.agg(F.sum("importance").alias("total"), F.bool_and(F.col("importance").between(0, 1)).alias("in_range"))


MOST = 3
TEXTS = ("NAME_INCOME_TYPE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE")


@query(
    "category_index",
    f"""SELECT feature, value, n, CAST(least(row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1, {MOST}) AS INT) AS position
        FROM ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM clean_application WHERE {c} IS NOT NULL GROUP BY 2" for c in TEXTS)})""",
)
def category_index(spark, sf_dir):
    return models.category_index(silver.clean_application(fx.raw_application(spark, sf_dir)), TEXTS, MOST)


ASKED = {
    "AMT_CREDIT": "CASE c_custkey % 5 WHEN 0 THEN ' 9000,5' WHEN 1 THEN 'abc' WHEN 2 THEN '99999999' WHEN 3 THEN 'Sem Info' END",
    "NAME_INCOME_TYPE": "CASE WHEN c_custkey % 2 = 0 THEN 'working ' END",
    "AGE_YEARS": "CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE '40' END",
    "NO_SUCH_FEATURE": "'1'",
}
EVERY_ASKED = " UNION ALL ".join(
    f"SELECT c_custkey AS client_id, '{feature}' AS feature, {value} AS value FROM customer WHERE c_custkey % 4 <> 1"
    for feature, value in ASKED.items()
)


@query(
    "screen_overrides",
    f"""SELECT client_id, feature, CASE WHEN feature = 'AMT_CREDIT' THEN replace(trim(value), ',', '.') ELSE value END AS value,
          CASE WHEN feature = 'NO_SUCH_FEATURE' THEN 'unknown feature' WHEN value IS NULL THEN 'no value'
               WHEN value IN ('abc', 'true') THEN 'unreadable value' WHEN value = '99999999' THEN 'out of bounds' END AS reason
        FROM ({EVERY_ASKED}) WHERE value IS DISTINCT FROM 'Sem Info'""",
)
def screen_overrides(spark, sf_dir):
    return _screened(spark, sf_dir)[1]


def _screened(spark, sf_dir):
    clients = gold.application(spark, sf_dir)
    fx.table(spark, sf_dir, "customer").createOrReplaceTempView("asking_customers")
    asked = spark.sql(EVERY_ASKED.replace("FROM customer", "FROM asking_customers"))
    return asked, s.screen_overrides(clients, asked, "SK_ID_CURR", decision.AMOUNT_BOUNDS)


@query(
    "decided_with_rejects",
    f"""SELECT c_custkey AS client_id, 2 + CAST(c_custkey % 2 = 1 AS INT) + CAST(c_custkey % 5 IN (1, 2, 4) AS INT)
          - CAST(c_custkey % 3 <> 0 AS INT) AS rejected, true AS decided FROM customer WHERE c_custkey % 4 <> 1""",
)
def decided_with_rejects(spark, sf_dir):
    """Decisions under scenarios with unreadable and out-of-range values: how many each client has, and that all are decided."""
    model, table = _core(spark, sf_dir)
    asked, _ = _screened(spark, sf_dir)
    ids = asked.select(F.col("client_id").alias("SK_ID_CURR"))
    found = decision.decide_clients(table, ids, asked, model, T, F.lit("2026-01-01").cast("timestamp"))
    return found.select(
        "client_id", F.coalesce(F.size("rejected_overrides"), F.lit(0)).alias("rejected"),
        (F.col("prediction") == (F.col("probability") >= T).cast("int")).alias("decided"),
    )

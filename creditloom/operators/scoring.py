"""Decisions on scored clients: bands, triage, audit, segments, what-if, factors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import floor_below, is_infinite, null_when, safe_ratio
from creditloom.operators.joins import label_column
from creditloom.operators.ordering import long_values, order_bucket, quantile_bands, quantile_values, running_totals
from creditloom.session import materialize

# Fixed values of the decision contract.
LOW_SHARE = 0.4
BANDS = ("Baixo risco", "Risco moderado", "Alto risco")
ACTIONS = ("autoaprovacao_candidata", "mesa_analise", "recusa_candidata")
UNKNOWN = "Não informado"
NO_INFORMATION = "Sem Info"  # fixed value: the answer that leaves a feature as it is
DECISIONS = ("Aprovado (Pagador Saudável)", "Reprovado (Risco de Inadimplência)")
ACTION_LABELS = {
    "autoaprovacao_candidata": "Autoaprovação candidata (humano confirma política)",
    "mesa_analise": "Encaminhar à mesa de crédito (zona cinzenta)",
    "recusa_candidata": "Recusa candidata (parecer + auditoria XAI)",
}
# Columns an event carries when the scored row has them.
EXPLANATIONS = ("top_risk_factors", "top_positive_factors", "applied_overrides", "rejected_overrides")


def _three_way(probability: Column, threshold: Column, names: Sequence[str]) -> Column:
    return (
        F.when(probability < threshold * F.lit(LOW_SHARE), names[0])
        .when(probability < threshold, names[1])
        .when(probability.isNotNull(), names[2])
    )


def risk_band(probability: Column, threshold: Column) -> Column:
    return _three_way(probability, threshold, BANDS)


def triage_action(probability: Column, threshold: Column) -> Column:
    return _three_way(probability, threshold, ACTIONS)


def queue_of(action: Column) -> Column:
    """Queue folder of an action; an unknown action goes to the analysis desk."""
    return F.when(action.isin(*ACTIONS), action).otherwise(ACTIONS[1])


def decide(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """Add prediction and risk band."""
    cut = F.lit(float(threshold))
    return df.withColumns(
        {
            "threshold": cut,
            "prediction": (F.col(score) >= cut).cast("int"),
            "risk_band": risk_band(F.col(score), cut),
        }
    )


def triage(df: DataFrame, client: str, score: str, threshold: float, emitted_at: Column) -> DataFrame:
    """One auditable event per scored client; a person always confirms.

    Factors and overrides go along when the row has them.
    """
    scored = decide(df, score, threshold)
    action = triage_action(F.col(score), F.col("threshold"))
    return scored.select(
        F.lit("credit_decision_triage").alias("event_type"),
        emitted_at.alias("emitted_at"),
        F.col(client).alias("client_id"),
        F.col(score).alias("probability"),
        "prediction",
        "threshold",
        "risk_band",
        F.when(F.col("prediction") == 1, DECISIONS[1]).otherwise(DECISIONS[0]).alias("label"),
        action.alias("action"),
        label_column(action, ACTION_LABELS).alias("action_label"),
        F.lit(True).alias("human_in_the_loop"),
        *[c for c in EXPLANATIONS if c in df.columns],
    )


def audit_outcome(prediction: Column, target: Column) -> Column:
    return (
        F.when((prediction == 0) & (target == 0), "TN")
        .when((prediction == 1) & (target == 1), "TP")
        .when((prediction == 0) & (target == 1), "FN")
        .when((prediction == 1) & (target == 0), "FP")
    )


def segment_risk(
    scored: DataFrame, score: str, categories: Sequence[str], amounts: Sequence[str] = ()
) -> DataFrame:
    """(attribute, segment, mean_risk, clients) for every attribute, riskiest first.

    Category attributes share one scan; an amount is cut into quantile bands.
    """
    parts = []
    if categories:
        texts = [F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in categories]
        parts.append(
            scored.select(F.col(score).alias("p"), *texts).unpivot(["p"], list(categories), "attribute", "segment")
        )
    for amount in amounts:
        banded = quantile_bands(scored.select(F.col(score).alias("p"), amount), amount)
        parts.append(banded.select("p", F.lit(amount).alias("attribute"), F.col("band_label").alias("segment")))
    rows = reduce(DataFrame.unionByName, parts)
    return (
        rows.groupBy("attribute", "segment")
        .agg(F.avg("p").alias("mean_risk"), F.count("p").alias("clients"))
        .orderBy("attribute", F.col("mean_risk").desc_nulls_last(), "segment")
    )


def portfolio_benchmark(
    portfolio: DataFrame, clients: DataFrame, key: str, features: Sequence[str], label: str | None = None
) -> DataFrame:
    """(key, feature, client_value, p50, p75, p90, percentile) for the given clients, with the portfolio's size and default rate.

    The percentile is the share of portfolio values up to the client's, for any value. `sample_size` counts
    all portfolio rows; `portfolio_default_rate`, only with `label`, is the mean of the labels that are
    not null. Null client values, and features without any value in the portfolio, have no row.

    All features are read together, so the number of scans does not depend on theirs. Values of
    buckets in which no client's value lies are counted as one row per bucket, so what is shuffled is
    the buckets and the values around the clients'; those of the clients join the running total with weight 0.
    """
    marks = [(f, *map(float, values)) for f, values in quantile_values(portfolio, features, [0.5, 0.75, 0.9]).items()]
    marks = portfolio.sparkSession.createDataFrame(marks, "feature string, p50 double, p75 double, p90 double")
    mine = long_values(clients, features, [key])
    asked = mine.select("feature", "value").distinct().withColumn("bucket", order_bucket(F.col("value")))
    around = asked.select("feature", "bucket", F.lit(True).alias("near")).distinct()
    numbers = long_values(portfolio, features).withColumn("bucket", order_bucket(F.col("value")))
    # bounded by the number of buckets a feature
    counted = numbers.join(F.broadcast(around), ["feature", "bucket"], "left").groupBy(
        "feature", "bucket", F.when(F.col("near"), F.col("value")).alias("at")
    )
    counted = counted.agg(F.count("*").alias("n"), F.min("value").alias("value")).select("feature", "value", "n")
    lookup = materialize(counted.union(asked.select("feature", "value", F.lit(0).cast("long"))), "benchmark")
    totals = running_totals(lookup, "value", {"n": F.col("n")}, ["feature"])
    places = totals.select("feature", "value", (F.col("cum_n") / F.col("total_n") * 100).alias("percentile"))
    rates = [F.count("*").alias("sample_size")]
    if label is not None:
        rates.append(F.avg(label).alias("portfolio_default_rate"))
    overall = portfolio.agg(*rates).first()  # one row
    return (
        mine.join(places, ["feature", "value"])
        .join(F.broadcast(marks), "feature")
        .select(
            key, "feature", F.col("value").alias("client_value"), "p50", "p75", "p90", "percentile",
            F.lit(overall["sample_size"]).cast("long").alias("sample_size"),
            *([F.lit(overall["portfolio_default_rate"]).cast("double").alias("portfolio_default_rate")] if label else []),
        )
    )


# ---------------------------------------------------------------- what-if

def apply_overrides(df: DataFrame, scenarios: DataFrame, key: str) -> DataFrame:
    """Replace values by (client_id, feature, value) scenario rows.

    Features the table lacks and values that the feature's type cannot hold, null among
    them, change nothing; `rejected_overrides` lists them. Of several values for one feature
    the largest number counts, among texts the largest text. The scenario table becomes one row per client, holding at most one entry
    per feature, and is joined once.
    """
    features = [c for c in df.columns if c != key]
    asked = (
        scenarios.filter(F.col("feature").isin(*features))
        .groupBy(F.col("client_id").alias(key), "feature")
        .agg(F.max_by("value", F.struct(F.col("value").try_cast("double"), "value")).alias("value"))
    )
    wide = asked.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("__new")
    )
    joined = df.join(wide, key, "left")
    changed = {}
    for field in df.schema.fields:
        if field.name != key:
            new = F.try_element_at("__new", F.lit(field.name)).try_cast(field.dataType)
            changed[field.name] = F.coalesce(new, F.col(field.name))
    return joined.withColumns(changed).select(*df.columns)


def _unreadable(df: DataFrame, key: str) -> Column:
    """Why a scenario row's value is none for the table, or null."""
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name != key}
    readable = F.lit(False)
    for name, kind in kinds.items():
        readable = F.when(F.col("feature") == name, F.col("value").try_cast(kind).isNotNull()).otherwise(readable)
    return (
        F.when(~F.coalesce(F.col("feature").isin(*kinds), F.lit(False)), "unknown feature")
        .when(F.col("value").isNull(), "no value")
        .when(~readable, "unreadable value")
    )


def rejected_overrides(df: DataFrame, scenarios: DataFrame, key: str) -> DataFrame:
    """The scenario rows that `apply_overrides` cannot apply, with a reason."""
    return scenarios.withColumn("reason", _unreadable(df, key)).filter("reason IS NOT NULL")


def screen_overrides(
    df: DataFrame, scenarios: DataFrame, key: str, bounds: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """The scenario rows with a `reason` against each that cannot be applied, null for the others.

    A bounded amount may be written with a decimal comma, which is replaced, and must lie within its bounds.
    The answer that stands for no information leaves the client's value as it is, so its rows go.
    """
    rows = scenarios.filter(~F.coalesce(F.trim("value") == NO_INFORMATION, F.lit(False)))
    amount = F.col("feature").isin(*bounds)
    rows = rows.withColumn("value", F.when(amount, F.replace(F.trim("value"), F.lit(","), F.lit("."))).otherwise(F.col("value")))
    outside = F.lit(False)
    for feature, (low, high) in bounds.items():
        number = F.col("value").try_cast("double")
        outside = F.when(F.col("feature") == feature, ~(number.between(low, high) & ~F.isnan(number))).otherwise(outside)
    return rows.withColumn("reason", F.coalesce(_unreadable(df, key), F.when(outside, "out of bounds")))


def recalculate(df: DataFrame) -> DataFrame:
    """Derived features after an override, where they and their inputs exist."""
    have = set(df.columns)
    new = {}
    for ratio, amount in (("CREDIT_INCOME_RATIO", "AMT_CREDIT"), ("ANNUITY_INCOME_RATIO", "AMT_ANNUITY")):
        if {ratio, amount, "AMT_INCOME_TOTAL"} <= have:
            value = safe_ratio(F.col(amount), F.col("AMT_INCOME_TOTAL"))
            new[ratio] = null_when(value, is_infinite(value))
    if {"AMT_CREDIT", "LOG_AMT_CREDIT"} <= have:
        new["LOG_AMT_CREDIT"] = F.log1p(floor_below(F.col("AMT_CREDIT"), 0))
    return df.withColumns(new) if new else df


def override_diff(original: DataFrame, scored: DataFrame, scenarios: DataFrame, key: str) -> DataFrame:
    """(key, overrides): map feature -> (original, applied) for overrides that changed a value."""
    features = [c for c in original.columns if c != key and c in scored.columns]
    asked = scenarios.filter(F.col("feature").isin(*features)).groupBy(F.col("client_id").alias(key)).agg(
        F.collect_set("feature").alias("__asked")  # at most one entry per column
    )

    def texts(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in features]).alias(name))

    both = asked.join(texts(original, "o"), key).join(texts(scored, "s"), key)
    entries = F.array(
        *[
            F.when(
                F.array_contains("__asked", F.lit(c)) & ~F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}")),
                F.struct(
                    F.lit(c).alias("feature"),
                    F.struct(F.col(f"o.{c}").alias("original"), F.col(f"s.{c}").alias("applied")).alias("change"),
                ),
            )
            for c in features
        ]
    )
    return both.select(key, F.map_from_entries(F.array_compact(entries)).alias("overrides"))


# ---------------------------------------------------------------- factors

def factor_arrays(df: DataFrame, contributions: Sequence[str], k: int = 5) -> DataFrame:
    """Add the k strongest factors of each sign as arrays of (feature, impact_pct).

    A client's contributions sit in one row, so they are ordered inside the row and
    nothing is shuffled. Equal contributions keep the column order.
    """
    items = F.array(
        *[
            F.struct(F.coalesce(F.abs(F.col(c)), F.lit(0.0)).alias("size"), F.lit(-i).alias("turn"),
                     F.lit(c).alias("feature"), F.signum(F.col(c)).alias("sign"))
            for i, c in enumerate(contributions)
        ]
    )
    rows = df.withColumn("__items", items).withColumn(
        "__total", F.aggregate("__items", F.lit(0.0), lambda acc, x: acc + x["size"])
    )
    out = {}
    for name, sign in (("top_risk_factors", 1.0), ("top_positive_factors", -1.0)):
        best = F.slice(F.sort_array(F.filter("__items", lambda x: x["sign"] == sign), asc=False), 1, k)
        out[name] = F.transform(
            best,
            lambda x: F.struct(
                x["feature"].alias("feature"),
                F.coalesce(x["size"] / F.nullif(F.col("__total"), F.lit(0.0)) * 100, F.lit(0.0)).alias("impact_pct"),
            ),
        )
    return rows.withColumns(out).drop("__items", "__total")


def top_factors(df: DataFrame, key: str, contributions: Sequence[str], k: int = 5) -> DataFrame:
    """(key, kind, rank, feature, impact_pct): the factor arrays as rows."""
    ranked = factor_arrays(df.select(key, *contributions), contributions, k)

    def rows_of(name: str, kind: str) -> Column:
        return F.transform(
            name,
            lambda f, i: F.struct(
                F.lit(kind).alias("kind"),
                (i + 1).cast("int").alias("rank"),
                f["feature"].alias("feature"),
                f["impact_pct"].alias("impact_pct"),
            ),
        )

    lists = [rows_of("top_risk_factors", "risk"), rows_of("top_positive_factors", "protective")]
    return ranked.select(key, F.inline(F.concat(*lists)))

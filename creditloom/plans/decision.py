"""Score clients in bulk: look up, override, recompute, score, explain, decide."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators import models
from creditloom.operators.joins import lookup_rows, map_categories
from creditloom.operators.scoring import (
    apply_overrides,
    factor_arrays,
    override_diff,
    recalculate,
    screen_overrides,
    triage,
)
from creditloom.session import materialize

# The amounts that may be edited, with their limits.
AMOUNT_BOUNDS = {"AMT_CREDIT": (1.0, 4050000.0), "AMT_ANNUITY": (1.0, 258025.5)}


def normalise_categories(df: DataFrame, model: models.FittedModel) -> DataFrame:
    """Every category as the model learned it, whatever its case, accents or spaces; others become null.

    The model's labels are bounded per column, as fitting bounds them.
    """
    out = df
    for col in model.categorical:
        labels = df.sparkSession.createDataFrame(list(enumerate(model.labels[col])), "position int, category string")
        out = map_categories(out, col, labels, col)
    return out.select(*df.columns)


def decide_clients(
    holdout: DataFrame,
    ids: DataFrame,
    scenarios: DataFrame,
    model: models.FittedModel,
    threshold: float,
    emitted_at: Column,
    k: int = 5,
    bounds: Mapping[str, tuple[float, float]] = AMOUNT_BOUNDS,
) -> DataFrame:
    """One decision event per wanted client, with its overrides and, for a linear model, factors.

    Overrides that cannot be read, or leave the bounds of their amount, are not applied; an event
    lists its client's with the reason, in `rejected_overrides`. Categories are brought to those that
    the model knows before scoring. An id without a row in the holdout is an error. The recomputed rows are written once,
    as scoring, explaining and comparing all read them.
    """
    key = models.KEY
    original = lookup_rows(holdout, ids, key)
    screened = materialize(screen_overrides(original, scenarios, key, bounds), "overrides")
    scenarios = screened.filter("reason IS NULL").drop("reason")
    rejected = screened.filter("reason IS NOT NULL").groupBy(F.col("client_id").alias(key)).agg(
        F.sort_array(F.collect_list(F.struct("feature", "value", "reason"))).alias("rejected_overrides")
    )
    changed = recalculate(apply_overrides(original, scenarios, key))
    changed = materialize(normalise_categories(changed, model), "scenario")
    events = models.score(changed, model, threshold).select(key, "probability")
    events = events.join(
        override_diff(original, changed, scenarios, key).withColumnRenamed("overrides", "applied_overrides"), key, "left"
    )
    events = events.join(rejected, key, "left")
    if model.spec.kind == "lr":
        parts = models.contributions(changed, model)
        names = [c for c in parts.columns if c != key]
        events = events.join(
            factor_arrays(parts, names, k).select(key, "top_risk_factors", "top_positive_factors"), key, "left"
        )
    return triage(events, key, "probability", threshold, emitted_at)

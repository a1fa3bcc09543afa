"""Modelling table -> split -> model -> evaluation and run record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators import models
from creditloom.operators.cleaning import text_columns
from creditloom.operators.features import DROP_COLUMNS, feature_columns
from creditloom.operators.joins import align_categories
from creditloom.operators.metrics import evaluate
from creditloom.operators.quality import QualityError
from creditloom.operators.sampling import stratified_split
from creditloom.session import materialize

FRACTIONS = {"train": 0.8, "test": 0.199, "demo": 0.001}


def split_table(abt: DataFrame, seed: int = 42, keys: DataFrame | None = None, **fractions: float) -> DataFrame:
    """The modelling table with its split, written once for the jobs that follow.

    Without `keys` (see `stratified_split`) the table is read several times and should be a written one.
    """
    if models.LABEL not in abt.columns:
        raise QualityError("load", [f"{models.LABEL} absent"])
    return materialize(stratified_split(abt, seed=seed, keys=keys, **(fractions or FRACTIONS)), "split")


def part(split: DataFrame, name: str) -> DataFrame:
    return split.filter(F.col("split") == name).drop("split")


def model_features(abt: DataFrame, track: str, exclude: Sequence[str] = ()) -> list[str]:
    names = feature_columns([c for c in abt.columns if c != "split"], track, DROP_COLUMNS)
    return [c for c in names if c not in exclude]


def run_record(
    metrics: DataFrame, features: Sequence[str], trained_at: Column, sizes: Column
) -> DataFrame:
    """One model-run row in the shape the monitoring checks read."""
    return metrics.select(
        trained_at.alias("trained_at"),
        F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        *metrics.columns,
        sizes.alias("rows"),
    )


def train_run(
    abt: DataFrame,
    spec: models.ModelSpec,
    threshold: float,
    track: str = "full",
    exclude: Sequence[str] = (),
    trained_at: Column | None = None,
    keys: DataFrame | None = None,
    **fractions: float,
) -> tuple[models.FittedModel, DataFrame, DataFrame]:
    """Fit on the train part; returns the model, the scored demo part and the run record."""
    split = split_table(abt, keys=keys, **fractions)
    features = model_features(split, track, exclude)
    train = part(split, "train")
    categories = [c for c in text_columns(train) if c in features]
    test = align_categories(train, part(split, "test"), categories)
    model = models.fit(train, spec, features)
    metrics = evaluate(models.score(test, model, threshold), models.LABEL, "probability", threshold)
    counts = split.groupBy().pivot("split", list(FRACTIONS)).count()
    sizes = counts.select(F.struct(*FRACTIONS).alias("rows")).scalar()
    record = run_record(metrics, model.features, trained_at if trained_at is not None else F.now(), sizes)
    demo = models.score(part(split, "demo"), model, threshold)
    return model, demo, record

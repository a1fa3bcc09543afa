"""Spark ML training, scoring and linear contributions."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.operators.cleaning import numeric_columns, text_columns
from creditloom.operators.metrics import evaluate
from creditloom.operators.quality import QualityError
from creditloom.session import materialize, shared_dir

LABEL, KEY = "TARGET", "SK_ID_CURR"
MOST_CATEGORIES = 1000
"""Categories of a column with an index of their own; rarer ones share one."""


@dataclass(frozen=True)
class ModelSpec:
    """`kind` is lr, rf or gbt; `positive_weight` 0 balances the classes."""

    name: str
    kind: str
    params: Mapping[str, Any] = field(default_factory=dict)
    positive_weight: float = 1.0


# The evaluated models with their full-size settings.
LOGISTIC = ModelSpec("logistic", "lr", {"maxIter": 1000}, positive_weight=0.0)
FOREST = ModelSpec("forest", "rf", {"numTrees": 200, "maxDepth": 12, "minInstancesPerNode": 50}, positive_weight=0.0)
BOOSTED = ModelSpec(
    "boosted", "gbt",
    {"maxIter": 300, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
)


@dataclass(frozen=True)
class FittedModel:
    spec: ModelSpec
    stages: PipelineModel
    numeric: list[str]
    categorical: list[str]
    fills: dict[str, str]
    seconds: float
    labels: dict[str, list[str]] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def _prepared(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fills: Mapping[str, str]) -> DataFrame:
    return df.withColumns(
        {
            **{c: F.col(c).cast("double") for c in numeric},
            **{c: F.coalesce(F.col(c).cast("string"), F.lit(fills.get(c, ""))) for c in categorical},
        }
    )


def _encoder(numeric: Sequence[str], labels: Mapping[str, Sequence[str]], kind: str) -> list:
    """Median imputation, category indexes, and for linear models one-hot and scaling.

    A category without a label, too rare or not seen, gets the index after the last label.
    """
    categorical = list(labels)
    stages: list = []
    inputs = [f"{c}__num" for c in numeric]
    if numeric:
        stages.append(
            Imputer(strategy="median", relativeError=0.001, inputCols=list(numeric), outputCols=inputs)
        )
    if categorical:
        indexed = [f"{c}__idx" for c in categorical]
        stages += [
            StringIndexerModel.from_labels(labels[c], c, index, handleInvalid="keep") for c, index in zip(categorical, indexed)
        ]
        if kind == "lr":
            hot = [f"{c}__hot" for c in categorical]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"))
            inputs = inputs + hot
        else:
            inputs = inputs + indexed
    if kind == "lr":
        stages.append(VectorAssembler(inputCols=inputs, outputCol="assembled"))
        stages.append(StandardScaler(inputCol="assembled", outputCol="features", withMean=False, withStd=True))
    else:
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


def _classifier(spec: ModelSpec, max_bins: int, seed: int):
    common = {"labelCol": LABEL, "featuresCol": "features", "weightCol": "__weight", **spec.params}
    if spec.kind == "lr":
        return LogisticRegression(standardization=False, **common)
    if spec.kind == "rf":
        return RandomForestClassifier(seed=seed, maxBins=max_bins, **common)
    if spec.kind == "gbt":
        return GBTClassifier(seed=seed, maxBins=max_bins, **common)
    raise ValueError(f"unknown model kind: {spec.kind}")


def _weight(df: DataFrame, spec: ModelSpec) -> Column:
    if spec.positive_weight:
        return F.when(F.col(LABEL) == 1, float(spec.positive_weight)).otherwise(1.0)
    rate = df.agg(F.avg(LABEL).alias("r")).scalar()
    return F.when(F.col(LABEL) == 1, 0.5 / rate).otherwise(0.5 / (1.0 - rate))


def category_index(df: DataFrame, cols: Sequence[str], most: int = MOST_CATEGORIES) -> DataFrame:
    """(feature, value, n, position) of every category of the columns, by falling frequency, ties by value.

    The `most` frequent categories of a column have positions from 0; all others share position
    `most`. Categories are counted per (column, category) before the shuffle and stay distributed, so a column may have
    millions of them: each task passes on its first `most`, and only those are ordered.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, value string, n long, position int")
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        .unpivot([], list(cols), "feature", "value")
        .filter("value IS NOT NULL")
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    first = Window.partitionBy("feature").orderBy(F.col("n").desc(), "value")
    top = counts.withColumn("position", F.row_number().over(first)).filter(F.col("position") <= most)
    # at most `most` rows a column
    found = counts.join(F.broadcast(top.select("feature", "value", "position")), ["feature", "value"], "left")
    return found.withColumn("position", F.coalesce(F.col("position") - 1, F.lit(most)).cast("int"))


def _category_labels(df: DataFrame, cols: Sequence[str], most: int) -> dict[str, list[str]]:
    """The categories with an index of their own, most frequent first: at most `most` a column."""
    top = category_index(df, cols, most).filter(F.col("position") < most)
    labels: dict[str, list[str]] = {c: [] for c in cols}
    for row in sorted(top.collect(), key=lambda r: r["position"]):
        labels[row["feature"]].append(row["value"])
    return labels


def _inputs(
    train: DataFrame, features: Sequence[str], most_categories: int
) -> tuple[list[str], dict[str, list[str]], dict[str, str]]:
    """Numeric columns, indexed categories and fill of each text column; columns without any value are left out."""
    texts = set(text_columns(train))
    filled = train.agg(*[F.count(c).alias(c) for c in features]).first()
    numeric = [c for c in features if c not in texts and filled[c]]
    labels = _category_labels(train, [c for c in features if c in texts and filled[c]], most_categories)
    return numeric, labels, {c: found[0] for c, found in labels.items()}


def _max_bins(labels: Mapping[str, Sequence[str]]) -> int:
    """A tree needs a bin per category."""
    return max([32, *[len(found) + 2 for found in labels.values()]])


def fit(
    train: DataFrame, spec: ModelSpec, features: Sequence[str], seed: int = 42, most_categories: int = MOST_CATEGORIES
) -> FittedModel:
    """Fit one model; columns without any value in `train` are left out.

    Of a column's categories the `most_categories` frequent ones are indexed, which bounds what the
    driver and the model hold; rarer ones share an index with unseen ones. `train` should be a
    written table: each stage reads it again. Trees read their encoded rows three times before they keep them, so
    these are written once.
    """
    numeric, labels, fills = _inputs(train, features, most_categories)
    categorical = list(labels)
    data = _prepared(train, numeric, categorical, fills).withColumn("__weight", _weight(train, spec))
    started = time.perf_counter()
    rows = data.select(LABEL, "__weight", *numeric, *categorical)
    encoder, classifier = _encoder(numeric, labels, spec.kind), _classifier(spec, _max_bins(labels), seed)
    if spec.kind == "lr":
        stages = Pipeline(stages=[*encoder, classifier]).fit(rows)
    else:
        encoded = Pipeline(stages=encoder).fit(rows)
        kept = materialize(encoded.transform(rows).select(LABEL, "__weight", "features"), "encoded-train")
        context = train.sparkSession.sparkContext
        if spec.kind == "gbt" and not context.getCheckpointDir():  # else no round's lineage is ever cut
            context.setCheckpointDir(shared_dir(train.sparkSession, "rounds"))
        stages = PipelineModel([*encoded.stages, classifier.fit(kept)])
    return FittedModel(spec, stages, numeric, categorical, fills, time.perf_counter() - started, labels)


def require_features(df: DataFrame, model: FittedModel) -> None:
    """Stop if the table lacks a feature, or holds text where the model was fitted on numbers."""
    numbers = {*numeric_columns(df), *[f.name for f in df.schema.fields if f.dataType.typeName() == "boolean"]}
    problems = [f"{c} absent" for c in model.features if c not in df.columns]
    problems += [f"{c} is not a number" for c in model.numeric if c in df.columns and c not in numbers]
    if problems:
        raise QualityError("score", problems)


def transform(df: DataFrame, model: FittedModel) -> DataFrame:
    require_features(df, model)
    return model.stages.transform(_prepared(df, model.numeric, model.categorical, model.fills))


def score(df: DataFrame, model: FittedModel, threshold: float) -> DataFrame:
    """Add the default probability and the decision at the threshold (>=)."""
    out = transform(df, model).withColumn("__p", vector_to_array("probability")[1])
    return out.select(
        *df.columns, F.col("__p").alias("probability"), (F.col("__p") >= threshold).cast("int").alias("prediction")
    )


def save(model: FittedModel, path: str, threshold: float = 0.5) -> None:
    """Keep a model for scoring: its stages, and a record of its features, categories, fills and threshold.

    The stages are written to a folder of their own first; the record that names the folder is
    appended last. A failed save leaves the model before it in force.
    """
    location = f"{path.rstrip('/')}/stages/{uuid.uuid4().hex}"
    model.stages.save(location)
    kept = {f: getattr(model, f) for f in ("numeric", "categorical", "fills", "seconds", "labels")}
    spec = {**asdict(model.spec), "params": dict(model.spec.params)}
    contract = json.dumps({"location": location, "threshold": threshold, "spec": spec, **kept})
    record = [(datetime.now(timezone.utc), contract)]
    rows = SparkSession.active().createDataFrame(record, "saved_at timestamp, contract string")
    rows.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/saved")


def load(spark: SparkSession, path: str) -> tuple[FittedModel, float]:
    """The model saved last and its threshold; `score` takes both."""
    saved = spark.read.schema("saved_at timestamp, contract string").json(f"{path.rstrip('/')}/saved")
    kept = json.loads(saved.agg(F.max_by("contract", "saved_at").alias("c")).first()["c"])
    stages = PipelineModel.load(kept.pop("location"))
    threshold = kept.pop("threshold")
    return FittedModel(spec=ModelSpec(**kept.pop("spec")), stages=stages, **kept), threshold


def _vector_names(rows: DataFrame, col: str) -> list[str]:
    """Original feature of each position of a vector column, from its metadata."""
    groups = rows.schema[col].metadata["ml_attr"]["attrs"]
    attrs = sorted((a for kind in groups.values() for a in kind), key=lambda a: a["idx"])
    return [a["name"].split("__")[0] for a in attrs]


def feature_importance(df: DataFrame, model: FittedModel, top: int = 20) -> DataFrame:
    """(feature, importance): impurity importance of trees, |coefficient| of the linear model."""
    final = model.stages.stages[-1]
    if model.spec.kind == "lr":
        names = _vector_names(transform(df, model), "assembled")
        weights = [abs(float(w)) for w in final.coefficients]
    else:
        names = model.features
        weights = [float(w) for w in final.featureImportances.toArray()]
    totals: dict[str, float] = {}
    for name, weight in zip(names, weights):
        totals[name] = totals.get(name, 0.0) + weight
    rows = df.sparkSession.createDataFrame(list(totals.items()), "feature string, importance double")
    return rows.orderBy(F.col("importance").desc(), "feature").limit(top)


def contributions(df: DataFrame, model: FittedModel, key: str = KEY) -> DataFrame:
    """(key, one column per feature): coefficient * (x - mean) of a linear model.

    A category's one-hot positions add up to its feature. Everything happens inside the
    row; the means are those of the training table, kept by the scaler.
    """
    if model.spec.kind != "lr":
        raise ValueError("contributions need a linear model")
    rows = transform(df, model)
    assembled = vector_to_array("assembled")
    scaler, linear = model.stages.stages[-2], model.stages.stages[-1]
    scale = [1.0 / s if s else 0.0 for s in scaler.std]
    weights = [float(w) * s for w, s in zip(linear.coefficients, scale)]
    means = [float(m) for m in scaler.mean]
    names = _vector_names(rows, "assembled")
    rows = rows.select(key, assembled.alias("x"))
    parts: dict[str, list[Column]] = {}
    for i, (name, w, m) in enumerate(zip(names, weights, means)):
        parts.setdefault(name, []).append((F.get("x", F.lit(i)) - F.lit(m)) * F.lit(w))
    return rows.select(key, *[reduce(lambda a, b: a + b, cols).alias(name) for name, cols in parts.items()])


# ---------------------------------------------------------------- experiments

def evaluation_row(
    test: DataFrame, model: FittedModel, threshold: float, **tags: Any
) -> DataFrame:
    """Metrics of one fitted model with its name, fit time and tags."""
    metrics = evaluate(score(test, model, threshold), LABEL, "probability", threshold)
    labels = {"model": F.lit(model.spec.name), **{k: F.lit(v) for k, v in tags.items()}}
    return metrics.withColumns({**labels, "fit_seconds": F.lit(model.seconds)})


def compare_models(
    train: DataFrame,
    test: DataFrame,
    specs: Sequence[ModelSpec],
    tracks: Mapping[str, Sequence[str]],
    threshold: float,
) -> DataFrame:
    """One metric row per model and feature track."""
    rows = [
        evaluation_row(test, fit(train, spec, features), threshold, track=track)
        for track, features in tracks.items()
        for spec in specs
    ]
    return reduce(DataFrame.unionByName, rows)


@dataclass(frozen=True)
class Encoded:
    """Train and test rows as (label, features), written once for any number of fits."""

    linear: bool
    train: DataFrame
    test: DataFrame
    max_bins: int


def encode(
    train: DataFrame, test: DataFrame, features: Sequence[str], linear: bool, most_categories: int = MOST_CATEGORIES
) -> Encoded:
    """Impute, index and for linear models scale by the training rows, and write both parts.

    Trees share one encoding, whatever their kind.
    """
    numeric, labels, fills = _inputs(train, features, most_categories)
    columns = [*numeric, *labels]
    stages = _encoder(numeric, labels, "lr" if linear else "tree")
    encoder = Pipeline(stages=stages).fit(_prepared(train, numeric, list(labels), fills).select(*columns))

    def written(df: DataFrame, purpose: str) -> DataFrame:
        rows = encoder.transform(_prepared(df, numeric, list(labels), fills).select(LABEL, *columns))
        return materialize(rows.select(LABEL, "features"), purpose)

    return Encoded(linear, written(train, "encoded-train"), written(test, "encoded-test"), _max_bins(labels))


def fit_settings(
    encoded: Encoded, specs: Sequence[ModelSpec], threshold: float, parallelism: int = 2, seed: int = 42
) -> DataFrame:
    """One metric row per setting, numbered as given, of classifiers fitted on the same encoded rows.

    At most `parallelism` fits run at a time. The scores of all settings are written in one table and
    measured together, so the test rows are ranked in one pass.
    """
    spark = encoded.train.sparkSession
    wrong = [spec.name for spec in specs if (spec.kind == "lr") != encoded.linear]
    if wrong:
        raise ValueError(f"rows are encoded for another kind of model than {', '.join(wrong)}")

    def one(spec: ModelSpec):
        rows = encoded.train.withColumn("__weight", _weight(encoded.train, spec))
        started = time.perf_counter()
        model = _classifier(spec, encoded.max_bins, seed).fit(rows)
        return model, time.perf_counter() - started

    with ThreadPool(max(1, min(parallelism, len(specs)))) as pool:
        fitted = pool.map(inheritable_thread_target(spark)(one), specs)
    scored = [
        model.transform(encoded.test).select(
            F.lit(i).alias("setting"), LABEL, vector_to_array("probability")[1].alias("probability")
        )
        for i, (model, _) in enumerate(fitted)
    ]
    scores = materialize(reduce(DataFrame.unionByName, scored), "setting-scores")
    metrics = evaluate(scores, LABEL, "probability", threshold, by=["setting"])
    named = [(i, spec.name, seconds) for i, (spec, (_, seconds)) in enumerate(zip(specs, fitted))]
    settings = spark.createDataFrame(named, "setting int, model string, fit_seconds double")
    return settings.join(metrics, "setting", "left")


def sweep(
    train: DataFrame, test: DataFrame, specs: Sequence[ModelSpec], features: Sequence[str], threshold: float,
    parallelism: int = 2,
) -> DataFrame:
    """One metric row per setting (grid, number of trees, class weight).

    Rows are encoded once for all linear models and once for all trees, whatever the number of settings.
    """
    rows = []
    for linear in (True, False):
        places = [i for i, spec in enumerate(specs) if (spec.kind == "lr") == linear]
        if places:
            found = fit_settings(encode(train, test, features, linear), [specs[i] for i in places], threshold, parallelism)
            place = F.get(F.array(*map(F.lit, places)), F.col("setting"))
            rows.append(found.withColumn("setting", place))
    return reduce(DataFrame.unionByName, rows)


def sweep_folds(
    folded: DataFrame, specs: Sequence[ModelSpec], features: Sequence[str], threshold: float, k: int = 5,
    parallelism: int = 2,
) -> DataFrame:
    """One metric row per setting and fold of a table with column `fold`.

    Each fold's rows are encoded by the other folds alone, once for all settings.
    """
    rows = []
    for fold in range(k):
        inside, outside = (folded.filter(c).drop("fold") for c in (F.col("fold") == fold, F.col("fold") != fold))
        rows.append(sweep(outside, inside, specs, features, threshold, parallelism).withColumn("fold", F.lit(fold)))
    return reduce(DataFrame.unionByName, rows)


def cross_validate(
    folded: DataFrame, spec: ModelSpec, features: Sequence[str], threshold: float, k: int = 5
) -> DataFrame:
    """One metric row per fold of a table with column `fold`."""
    rows = []
    for fold in range(k):
        model = fit(folded.filter(F.col("fold") != fold), spec, features)
        rows.append(evaluation_row(folded.filter(F.col("fold") == fold), model, threshold, fold=fold))
    return reduce(DataFrame.unionByName, rows)

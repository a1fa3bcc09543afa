"""Quality by co-training: a text view and a metadata view teach each other and score together."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import SPACE, text_of, words
from creditloom.session import materialize

VIEWS = ("text", "meta")
TEXT_BITS, META_BITS = 1 << 12, 1 << 8
HELD_OUT = 5
"""One labelled document of a class in HELD_OUT calibrates; the others train."""
BIN, BINS = 0.02, 2500
"""Width of a bin of margins, and how many there are on each side of 0; the last holds the rest."""
SHARES = 1 << 30
TEXT_INPUTS = ["word_share", "symbols", "upper", "digits", "others", "space", "distinct"]
META_INPUTS = ["tag_count", "log_chars", "log_words", "log_lines"]


@dataclass
class CoTrained:
    """The fitted views with their calibrations (slope, offset of the log-odds) and the prior's log-odds."""

    views: dict[str, LogisticRegressionModel] = field(default_factory=dict)
    calibration: dict[str, tuple[float, float]] = field(default_factory=dict)
    prior: float = 0.0
    exchanged: dict[str, int] = field(default_factory=dict)


def document_features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = ("lang", "source")
) -> DataFrame:
    """The raw inputs of both views, one row per row, written once for all rounds and the scores.

    id, counts of hashed words and tags as sparse vectors (small in Parquet: bucket numbers and counts
    are dictionary-coded), shares of character classes, and lengths. Null and empty texts count as empty.
    """
    text = text_of(text_col)
    read = docs.select(
        F.col(id_col).cast("long").alias("id"), text.alias("t"), words(text).alias("words"),
        F.array(
            *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("\0"))) for c in meta_cols]
        ).alias("tags"),
    )
    n, w = F.greatest(F.length("t"), F.lit(1)), F.greatest(F.size("words"), F.lit(1))

    def share(char_class: str) -> Column:
        return (F.length("t") - F.length(F.regexp_replace("t", f"{char_class}+", ""))) / n

    lines = F.length("t") - F.length(F.replace(F.col("t"), F.lit("\n"), F.lit(""))) + 1
    found = read.select(
        "id", "words", "tags",
        share(r"[#*$%&<>|]").alias("symbols"), share("[A-Z]").alias("upper"), share("[0-9]").alias("digits"),
        share(f"[^A-Za-z0-9#*$%&<>|{SPACE}]").alias("others"), share(f"[{SPACE}]").alias("space"),
        (F.size(F.array_distinct("words")) / w).alias("distinct"),
        F.log1p(F.length("t").cast("double")).alias("log_chars"), F.log1p(w.cast("double")).alias("log_words"),
        F.log1p(lines.cast("double")).alias("log_lines"),
    )
    hashed = PipelineModel(
        [
            HashingTF(inputCol="words", outputCol="word_count", numFeatures=TEXT_BITS),
            HashingTF(inputCol="tags", outputCol="tag_count", numFeatures=META_BITS, binary=True),
        ]
    ).transform(found)
    return materialize(hashed.drop("words", "tags"), "features")


def _vectors(features: DataFrame) -> DataFrame:
    """id, text and meta vectors."""
    stages = PipelineModel(
        [
            Normalizer(inputCol="word_count", outputCol="word_share"),
            VectorAssembler(inputCols=TEXT_INPUTS, outputCol="text"),
            VectorAssembler(inputCols=META_INPUTS, outputCol="meta"),
        ]
    )
    return stages.transform(features).select("id", *VIEWS)


def co_train(
    docs: DataFrame, labels: DataFrame, rounds: int = 3, max_labelled: int = 4000, pool: int = 4000, step: float = 0.1,
    label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    meta_cols: tuple[str, ...] = ("lang", "source"), features: DataFrame | None = None,
) -> CoTrained:
    """Fit both views, with pseudo-labels from all unlabelled documents.

    The text view sees words, hashed, and shares of characters; the metadata view the tags in
    `meta_cols` and the lengths. After every round but the last both views score all unlabelled documents, and
    each gives the other its most confident pseudo-labels: `step` of all unlabelled documents, split by
    the classes' share of the labels, down to a margin found by counting documents per bin of margins
    (inside the last bin a hash of the identifier decides). Then each view's margin is calibrated by a
    logistic fit on labelled documents that no view was trained on.

    Only the rows that are fitted are a sample, by a hash of the identifier: at most `max_labelled`
    labelled documents, half of them of each class, and about `pool` pseudo-labelled ones for each
    view. Weights restore the shares that classes and pseudo-labels have in the whole tables, so a
    rare class is seen and a larger table is fitted like a smaller one.

    Labels: null ones are none; for several of one document the lowest holds. Documents without
    identifier are not used. `features` are the documents' `document_features`, made here if not
    given. With fewer than two classes no view is fitted and every score is the
    prior (one half without labels).
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("id")
    ).agg((F.min(F.col(label_col).cast("double")) > 0).cast("double").alias("y"))
    if features is None:
        features = document_features(docs, id_col, text_col, meta_cols)
    present = features.select("id").where("id is not null").distinct()
    ids = materialize(present.join(known, "id", "left"), "ids")
    sizes = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    unlabelled, good = sizes.get(None, 0), sizes.get(1.0, 0)
    total = good + sizes.get(0.0, 0)
    model = CoTrained(prior=math.log((good + 0.5) / (total - good + 0.5)))
    if good in (0, total):
        return model

    share = {1.0: good / total, 0.0: 1 - good / total}
    chosen = []
    for y in share:
        rows = [r["id"] for r in _hashed(ids.where(F.col("y") == y), max(2, max_labelled // 2), sizes[y]).collect()]
        chosen += [(i, y, sizes[y] / len(rows), n % HELD_OUT == 1) for n, i in enumerate(rows)]
    scale = len(chosen) / total
    chosen = spark.createDataFrame([(i, y, w * scale, held) for i, y, w, held in chosen], "id long, y double, w double, held boolean")

    def with_vectors(rows: DataFrame, purpose: str) -> DataFrame:
        found = _vectors(features.join(F.broadcast(rows), "id", "left_semi").dropDuplicates(["id"]))
        return materialize(found.join(F.broadcast(rows), "id").repartition(4, "id"), purpose)

    sample = with_vectors(chosen, "sample")
    check, train = sample.where("held"), sample.where("not held").drop("held")
    trained = {view: train for view in VIEWS}
    state = ids.where("y is null").select("id", *[F.lit(None).cast("double").alias(f"y_{view}") for view in VIEWS])
    for turn in range(rounds):
        model.views = {view: _fit(trained[view], view) for view in VIEWS}
        if turn == rounds - 1 or not unlabelled:
            break
        rows = _vectors(features)
        for view in VIEWS:
            rows = _margins(rows, model.views[view], view)
        margins = rows.where("id is not null").groupBy("id").agg(*[F.min(f"m_{view}").alias(f"m_{view}") for view in VIEWS])
        scored = materialize(state.join(margins, "id"), "margins")
        wanted = {y: max(1, round(step * unlabelled * share[y])) for y in share}
        given = {
            other: _confident(scored.where(F.col(f"y_{other}").isNull()), f"m_{view}", wanted)
            for view, other in (VIEWS, VIEWS[::-1])
        }
        state = materialize(
            scored.select("id", *[F.coalesce(f"y_{view}", given[view]).alias(f"y_{view}") for view in VIEWS]), "pseudo-labels"
        )
        for view in VIEWS:
            pseudo = state.where(F.col(f"y_{view}").isNotNull()).select("id", F.col(f"y_{view}").alias("y"))
            n = model.exchanged[view] = pseudo.count()
            if n:
                part = min(1.0, pool / n)
                fitted = pseudo.where(_draw("id", 7) < part * SHARES).withColumn("w", F.lit(scale / part))
                trained[view] = train.unionByName(with_vectors(fitted, f"pseudo-{view}"))
    for view in VIEWS:
        model.calibration[view] = _calibrate(check, model.views[view], model.prior)
    return model


def _draw(id_: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(id_, F.lit(seed)), F.lit(SHARES))


def _hashed(ids: DataFrame, n: int, size: int) -> DataFrame:
    """The first n of `size` identifiers by hash; few more than n are looked at."""
    near = ids.where(_draw("id", 5) < min(1.0, (2 * n + 100) / max(1, size)) * SHARES)
    return near.orderBy(_draw("id", 5), "id").limit(n)


def _confident(free: DataFrame, margin: str, wanted: dict[float, int]) -> Column:
    """The pseudo-label of a row with this margin, null for all but about the wanted numbers of each class."""
    side = F.least(F.floor(F.abs(margin) / BIN), F.lit(BINS)).cast("int")
    counts = free.where(F.col(margin) != 0).groupBy((F.col(margin) > 0).cast("double").alias("y"), side.alias("bin"))
    per_bin = {(r["y"], r["bin"]): r["n"] for r in counts.agg(F.count("*").alias("n")).collect()}
    label = F.lit(None).cast("double")
    for y, left in wanted.items():
        part = 1.0
        edge = 0
        for edge, n in sorted(((b, n) for (at, b), n in per_bin.items() if at == y), reverse=True):
            part = min(1.0, left / n)
            left -= n
            if left <= 0:
                break
        sure = (side > edge) | ((side == edge) & (_draw("id", 8) < part * SHARES))
        label = F.when((F.col(margin) > 0 if y else F.col(margin) < 0) & sure, F.lit(y)).otherwise(label)
    return label


def _fit(train: DataFrame, view: str) -> LogisticRegressionModel:
    rows = train.select("y", "w", view).coalesce(4)
    return LogisticRegression(featuresCol=view, labelCol="y", weightCol="w", regParam=0.01, maxIter=25).fit(rows)


def _margins(rows: DataFrame, model: LogisticRegressionModel, view: str) -> DataFrame:
    """The rows with the log-odds that a fitted view gives them, as m_ and the view."""
    fitted = model.copy().setRawPredictionCol(f"{view}_raw").setProbabilityCol("").setPredictionCol("")
    return fitted.transform(rows).withColumn(f"m_{view}", vector_to_array(f"{view}_raw")[1])


def _calibrate(check: DataFrame, model: LogisticRegressionModel, prior: float) -> tuple[float, float]:
    view = model.getFeaturesCol()
    rows = VectorAssembler(inputCols=[f"m_{view}"], outputCol="x").transform(
        _margins(check, model, view).select(f"m_{view}", "y", "w")
    )
    if rows.select("y").distinct().count() < 2:
        return 0.0, prior
    fitted = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=0.001, maxIter=25).fit(rows)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def score(
    docs: DataFrame, model: CoTrained, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
    meta_cols: tuple[str, ...] = ("lang", "source"), features: DataFrame | None = None,
) -> DataFrame:
    """The calibrated probability of quality of every document by each view and by both together.

    The views count as independent given the class: their log-odds add up, less the prior's. Reads
    `features` if given, else the text once; nothing is shuffled. Null and empty texts have zero features and
    are scored by what remains. Every row is scored by itself, repeated ones too.

    Returns doc_id, text_score, meta_score, score, kept (score at least `threshold`).
    """
    if features is None:
        features = document_features(docs, id_col, text_col, meta_cols)
    rows = _vectors(features)
    odds = {view: F.lit(model.prior) for view in VIEWS}
    for view, fitted in model.views.items():
        slope, offset = model.calibration[view]
        rows = _margins(rows, fitted, view)
        odds[view] = F.col(f"m_{view}") * slope + offset
    both = odds["text"] + odds["meta"] - F.lit(model.prior)

    def chance(x: Column) -> Column:
        return 1 / (1 + F.exp(-x))

    scored = rows.select(
        F.col("id").alias("doc_id"), chance(odds["text"]).alias("text_score"),
        chance(odds["meta"]).alias("meta_score"), chance(both).alias("score"),
    )
    return scored.withColumn("kept", F.col("score") >= threshold)

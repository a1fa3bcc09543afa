"""Language identification by averaged subword embeddings and a linear softmax."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import text_of

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
SIZES = (2, 3, 4)
"""Lengths of the subwords; the whole word in its marks is one more."""
CACHE = 200_000
"""Words whose sums a task keeps; beyond that it starts anew at the next batch."""
FOLDS = 5
"""One sampled document of a language in FOLDS calibrates; the others train."""
SHARES = 1 << 30


@dataclass
class LanguageModel:
    """Languages in code-point order, an embedding per bucket, the softmax, and what calibrates it."""

    languages: list[str] = field(default_factory=list)
    embeddings: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0
    least: float = 0.0
    used: dict[str, int] = field(default_factory=dict)


def buckets_of(word: str, buckets: int) -> list[int]:
    """The buckets of a word's subwords."""
    marked = f"<{word}>"
    parts = [marked[i : i + n] for n in SIZES for i in range(len(marked) - n + 1)]
    return [zlib.crc32(p.encode()) % buckets for p in [*parts, marked + "\0"]]


def is_held_out(id_col: str, folds: int = 5) -> Column:
    """Whether a document is kept out of learning; a null identifier counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def fit_language(
    docs: DataFrame, learn_from: Column, per_language: int = 500, max_documents: int = 4000, max_languages: int = 400,
    buckets: int = 1 << 15, width: int = 16, epochs: int = 6, rate: float = 0.5, target: float = 0.99, seed: int = 12,
    text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
) -> LanguageModel:
    """Learn languages from a bounded sample of the tagged documents for which `learn_from` holds.

    A text is the average of the embeddings of all its subwords: the runs of 2 to 4 letters of each of its
    words, marked at both ends, and the words themselves, in lower case, hashed to `buckets`. A softmax of a linear map of
    the average gives the language. Both are trained by stochastic gradient descent, a document a step, at a falling
    rate. One sampled document in five is not trained on: it sets the temperature that makes the scores fit how often they are right,
    and `least`, the smallest score from which on `target` of these documents are right.

    The sample is by a hash of identifier and text: at most `per_language` documents of each language
    and about `max_documents` in all, of the `max_languages` most frequent tags. Whole texts are
    read, as numbers of subwords per bucket, in Spark; only these reach the driver. Repeated rows count
    once. Documents without tag, with a null text or without letters are not learned from. Without any
    document to learn from no language is known.
    """
    tagged = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")), F.lit(SHARES)).alias("draw"),
    )
    counted = tagged.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n"))
    counts = {r["lang"]: r["n"] for r in counted.orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    if not counts:
        return LanguageModel()
    each = max(2, min(per_language, max_documents // len(counts)))
    limits = docs.sparkSession.createDataFrame(
        [(lang, int(SHARES * min(1.0, (1.2 * each + 20) / max(1, n)))) for lang, n in counts.items()], "lang string, below long"
    )
    near = tagged.join(F.broadcast(limits), "lang").where("draw < below").dropDuplicates(["lang", "draw"])
    rows = near.select("lang", "draw", "text").mapInArrow(
        lambda batches: _count_buckets(batches, buckets), "lang string, draw long, ids binary, counts binary"
    )
    by_lang: dict[str, list] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["draw"])):
        if len(by_lang.setdefault(r["lang"], [])) < each:
            by_lang[r["lang"]].append((np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["counts"], "<f4")))
    model = LanguageModel(sorted(by_lang), used={lang: len(d) for lang, d in by_lang.items()})
    if not by_lang:
        return model
    train, check = [], []
    for y, lang in enumerate(model.languages):
        for i, doc in enumerate(by_lang[lang]):
            (check if i % FOLDS == FOLDS - 1 else train).append((y, *doc))
    _descend(model, train, buckets, width, epochs, rate, np.random.default_rng(seed))
    _calibrate(model, check or train, target)
    return model


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every document by its whole text alone.

    A map over the rows: nothing is shuffled, each task keeps the sums of the words it has met.
    Null texts, texts without a letter, and all texts if no language is known, give `und` with score 0.
    Every row is predicted by itself, repeated ones too; other columns are ignored.

    Returns doc_id, lang_pred, score (the calibrated chance that it is right) and accepted (the score
    reaches the model's `least`; false for `und`).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(
        lambda batches: _predict(batches, model), f"doc_id {kind}, lang_pred string, score double, accepted boolean"
    )


def words_of(text: str) -> list[str]:
    """The words of a text in lower case; none if it has no letter."""
    found = WORD.findall(text.lower())
    return found if any(c.isalpha() for word in found for c in word) else []


def _count_buckets(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, ids, counts = [], [], []
        for at, text in enumerate(batch.column("text")):
            words, n = np.unique(np.array(words_of(text.as_py()), dtype=object), return_counts=True)
            if not len(words):
                continue
            parts = [buckets_of(w, buckets) for w in words]
            every = np.bincount(
                np.concatenate(parts), weights=np.repeat(n, [len(p) for p in parts]), minlength=buckets
            )
            used = np.flatnonzero(every)
            keep.append(at)
            ids.append(used.astype("<i4").tobytes())
            counts.append(every[used].astype("<f4").tobytes())
        yield pa.record_batch(
            {
                "lang": batch.column("lang").take(pa.array(keep, pa.int64())),
                "draw": batch.column("draw").take(pa.array(keep, pa.int64())),
                "ids": pa.array(ids, pa.binary()),
                "counts": pa.array(counts, pa.binary()),
            }
        )


def _descend(model: LanguageModel, train: list, buckets: int, width: int, epochs: int, rate: float, draw) -> None:
    """Stochastic gradient descent on embeddings and softmax, each language weighing the same."""
    k = len(model.languages)
    model.embeddings = draw.uniform(-1 / width, 1 / width, (buckets, width))
    model.weights, model.bias = np.zeros((k, width)), np.zeros(k)
    sizes = np.bincount([y for y, *_ in train], minlength=k)
    weight = len(train) / (np.maximum(sizes, 1) * np.count_nonzero(sizes))
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for at in draw.permutation(len(train)):
            y, ids, counts = train[at]
            pace = rate * min(4.0, weight[y]) * (1 - step / steps)
            step += 1
            part = counts / counts.sum()
            average = part @ model.embeddings[ids]
            wrong = _softmax(model.weights @ average + model.bias)
            wrong[y] -= 1
            back = model.weights.T @ wrong
            model.weights -= pace * np.outer(wrong, average)
            model.bias -= pace * 0.1 * wrong
            model.embeddings[ids] -= pace * len(ids) ** 0.5 * np.outer(part, back)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _calibrate(model: LanguageModel, check: list, target: float) -> None:
    """Temperature of least log-loss, and the smallest score from which on `target` of the documents are right."""
    y = np.array([c[0] for c in check])
    average = np.stack([(counts / counts.sum()) @ model.embeddings[ids] for _, ids, counts in check])
    logits = average @ model.weights.T + model.bias
    at = np.arange(len(y))
    grid = 2.0 ** np.arange(-6, 6.01, 0.25)
    loss = [-np.log(np.maximum(_softmax(logits / t)[at, y], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    chance = _softmax(logits / model.temperature)
    score, right = chance.max(axis=1), chance.argmax(axis=1) == y
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / (1 + at)
    last = np.append(np.diff(score[order]) != 0, True)
    fine = np.flatnonzero((share >= target) & last)
    model.least = float(score[order][fine[-1]]) if len(fine) else 1.0


class _WordSums(dict):
    """Word -> row of the sum of its subwords' embeddings and their number."""

    def __init__(self, embeddings: np.ndarray):
        super().__init__()
        self.embeddings = embeddings
        self.sums = np.zeros((1024, embeddings.shape[1] + 1))

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.sums):
            self.sums = np.vstack([self.sums, np.zeros_like(self.sums)])
        ids = buckets_of(word, len(self.embeddings))
        self.sums[at, :-1] = self.embeddings[ids].sum(axis=0)
        self.sums[at, -1] = len(ids)
        self[word] = at
        return at


def _predict(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    known = _WordSums(model.embeddings) if model.languages else None
    for batch in batches:
        rows = batch.num_rows
        languages, score = np.full(rows, UNKNOWN, dtype=object), np.zeros(rows)
        if known is not None:
            if len(known) > CACHE:
                known = _WordSums(model.embeddings)
            totals = np.zeros((rows, known.sums.shape[1]))
            for i, text in enumerate(batch.column("text")):
                words = words_of(text.as_py())
                if words:
                    at = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                    rows_of, n = np.unique(at, return_counts=True)
                    totals[i] = n @ known.sums[rows_of]
            read = np.flatnonzero(totals[:, -1])
            average = totals[read, :-1] / totals[read, -1:]
            chance = _softmax((average @ model.weights.T + model.bias) / model.temperature)
            languages[read] = np.array(model.languages, dtype=object)[chance.argmax(axis=1)]
            score[read] = chance.max(axis=1)
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "lang_pred": pa.array(languages, pa.string()),
                "score": pa.array(score),
                "accepted": pa.array((score >= model.least) & (languages != UNKNOWN), pa.bool_()),
            }
        )

"""Grouping of spelling variants by blocked Gram matrices of letter counts."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import attach_by_leaf, text_of
from creditloom.session import materialize

LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)
"""Latin-1 bytes: letters in lower case (only A-Z are changed), everything else a space."""
HELD = 500_000
"""Words that a task counts before it sends them on."""
MEMBERS = 1024
"""Words of a block, on average; fewer where words are long, so that a block has at most CODES letters."""
CODES = 1 << 20
LEAVES = 64


def count_words(
    docs: DataFrame, min_length: int = 5, min_count: int = 3, drop_one_in: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """How often each word of at least `min_length` letters occurs in all texts, if `min_count` times or more.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. With `drop_one_in`
    m, a run whose crc32 of `identifier:run` is divisible by m loses the letter at crc32 modulo its
    length, which plants misspellings; the length counts afterwards. A null identifier is written as
    an empty text, null and empty texts have no words, repeated rows count each time. Texts are read whole; every task
    counts its words before they are shuffled. Other columns are ignored.

    Returns word, n.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_of(text_col).alias("text"))
    counted = rows.mapInArrow(lambda batches: _count(batches, min_length, drop_one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _count(batches: Iterator[pa.RecordBatch], min_length: int, drop_one_in: int | None) -> Iterator[pa.RecordBatch]:
    total: Counter[bytes] = Counter()
    for batch in batches:
        for id_, text in zip(batch.column("id"), batch.column("text")):
            found = Counter(text.as_py().encode("latin-1", "replace").translate(LETTERS).split())
            start = zlib.crc32(f"{id_.as_py()}:".encode())
            for word, n in found.items():
                if len(word) < min_length:
                    continue
                if drop_one_in:
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if h % drop_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                total[word] += n
            if len(total) >= HELD:
                yield _counts(total)
                total.clear()
    yield _counts(total)


def _counts(total: Counter[bytes]) -> pa.RecordBatch:
    return pa.record_batch(
        {"word": pa.array([w.decode("latin-1") for w in total], pa.string()), "n": pa.array(total.values(), pa.int64())}
    )


def group_variants(counts: DataFrame, ratio: int = 2, classes: int | None = None) -> DataFrame:
    """Each word's form, the most frequent word at one edit, and the root at the end of its forms.

    Words are near if one inserted, deleted or replaced letter turns one into the other. A cell holds
    the words of one length with equal numbers of letters in each of `classes` classes, and is cut into blocks of some
    hundred words. An edit leads from a cell to itself or to a cell one letter longer with one more in one class, or one with one letter
    moved between classes; only blocks of such cells meet. For two blocks the product of their letter-count
    matrices gives all squared distances; pairs at most two apart are looked at letter by letter.
    Every pair of near words is found, once. A pair of blocks sends on one row per word that has a near word there: their number
    and the best one. A hot cell is many blocks in many tasks; `classes` grows with
    the number of words (a quarter of its binary digits), so cells stay small.

    A word's form is its near word of largest n (ties: the first in code-point order) if that n is at
    least `ratio` times its own, else null. The root is reached by following forms; paths are halved in
    rounds, as n at least doubles at each step there are few. `ratio` must exceed 1. Words of `counts` are
    letters up to U+00FF, each once, n not null; an empty table gives an empty result.

    Returns word, form, root, n, n_near, form_n.
    """
    if ratio <= 1:
        raise ValueError("ratio must exceed 1, or forms could lead in circles")
    counts = materialize(counts.select("word", "n"), "vocabulary")
    if classes is None:
        classes = max(1, counts.count().bit_length() // 4)
    blocks = materialize(_blocks(counts, classes), "blocks")
    near = _block_pairs(blocks, classes).mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    found = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    has_form = -F.col("b.less") >= F.col("n") * ratio
    formed = materialize(
        counts.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("b.best")).alias("form"), F.when(has_form, -F.col("b.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _cells(batches: Iterator[pa.RecordBatch], classes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [
            np.bincount(np.frombuffer(w.as_py().encode("latin-1"), np.uint8) % classes, minlength=classes).tolist()
            for w in batch.column("word")
        ]
        yield pa.record_batch(
            {"cell": pa.array(cells, pa.list_(pa.int32())), "word": batch.column("word"), "n": batch.column("n")}
        )


def _blocks(counts: DataFrame, classes: int) -> DataFrame:
    """cell, part and the sorted words with their n: one row per block."""
    celled = counts.mapInArrow(lambda batches: _cells(batches, classes), "cell array<int>, word string, n long")
    celled = celled.withColumn("leaf", F.pmod(F.xxhash64("word"), F.lit(LEAVES)).cast("int"))
    size = F.greatest(F.lit(1), F.least(F.lit(MEMBERS), F.floor(F.lit(CODES) / F.greatest(F.lit(1), F.max(F.length("word"))))))
    cells = celled.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    placed = attach_by_leaf(celled, cells, ["cell"])
    part = F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int")
    return placed.groupBy("cell", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("members"))


def _block_pairs(blocks: DataFrame, classes: int) -> DataFrame:
    """The members of each two blocks that can hold near words, as `a` and `b`; same: a block with itself."""
    ids = blocks.select("cell", "part")

    def moved(*steps: tuple[int, int]):
        return F.transform("cell", lambda x, i: x + sum((F.when(i == at, by).otherwise(0) for at, by in steps), F.lit(0)))

    to = [F.col("cell")] + [moved((i, 1)) for i in range(classes)]
    to += [moved((i, -1), (j, 1)) for j in range(classes) for i in range(j)]
    wanted = ids.select(F.col("cell").alias("from"), F.col("part").alias("a_part"), F.explode(F.array(*to)).alias("cell"))
    pairs = wanted.join(ids, "cell").where("cell <> from or a_part <= part").withColumnRenamed("part", "b_part")
    left = blocks.select(F.col("cell").alias("from"), F.col("part").alias("a_part"), F.col("members").alias("a"))
    right = blocks.select("cell", F.col("part").alias("b_part"), F.col("members").alias("b"))
    same = ((F.col("from") == F.col("cell")) & (F.col("a_part") == F.col("b_part"))).alias("same")
    return pairs.join(left, ["from", "a_part"]).join(right, ["cell", "b_part"]).select("a", "b", same)


def _block(members: pa.StructScalar) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words, n, the words' letters as a matrix, and their letter counts."""
    rows = members.as_py()
    words, n = [r["word"] for r in rows], np.array([r["n"] for r in rows], dtype=np.int64)
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    places = (np.arange(len(words))[:, None] * 256 + codes).ravel()
    letters = np.bincount(places, minlength=256 * len(words)).reshape(len(words), 256)
    return words, n, codes, letters.astype(np.float32 if codes.shape[1] < 2000 else np.float64)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[], [], [], []]
        for a, b, same in zip(batch.column("a"), batch.column("b"), batch.column("same")):
            a, b = _block(a), _block(b)
            used = np.flatnonzero(a[3].any(axis=0) | b[3].any(axis=0))
            left, right = a[3][:, used], b[3][:, used]
            apart = np.square(left).sum(axis=1)[:, None] + np.square(right).sum(axis=1)[None, :] - 2 * (left @ right.T)
            i, j = np.nonzero(apart <= 2)
            edited = _one_edit(a[2], b[2], i, j)
            i, j = i[edited], j[edited]
            _best(a, b, i, j, out)
            if not same.as_py():
                _best(b, a, j, i, out)
        yield pa.record_batch(
            {
                "word": pa.array(out[0], pa.string()), "n_near": pa.array(out[1], pa.int64()),
                "best_n": pa.array(out[2], pa.int64()), "best": pa.array(out[3], pa.string()),
            }
        )


def _one_edit(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows differ by one edit; words of b are as long as those of a or one letter longer."""
    out = np.zeros(len(i), dtype=bool)
    size, step = a.shape[1], max(1, (8 << 20) // max(1, b.shape[1]))
    for at in range(0, len(i), step):
        x, y = a[i[at : at + step]], b[j[at : at + step]]
        if y.shape[1] == size:
            out[at : at + step] = (x != y).sum(axis=1) == 1
        else:
            head = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
            tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            out[at : at + step] = head + tail >= size
    return out


def _best(own: tuple, other: tuple, i: np.ndarray, j: np.ndarray, out: list[list]) -> None:
    """Append the words at i with the number of their near words at j and the best of these."""
    order = np.lexsort((np.arange(len(other[0])), -other[1]))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    first = np.full(len(own[0]), len(order))
    np.minimum.at(first, i, rank[j])
    near = np.bincount(i, minlength=len(own[0]))
    for at in np.flatnonzero(near):
        best = order[first[at]]
        out[0].append(own[0][at])
        out[1].append(near[at])
        out[2].append(other[1][best])
        out[3].append(other[0][best])


def _roots(steps: DataFrame) -> DataFrame:
    """word, root of every word with a form: each round doubles the steps that are taken at once."""
    steps = materialize(steps, "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialize(
            steps.join(on, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")

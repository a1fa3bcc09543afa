"""Stupid-backoff scores from n-gram count tables that are partitioned by hash."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import text_of

BATCH_BYTES = 8 << 20
"""Text of the documents that are scored together, and that a bucket of the count tables stands for."""
BITS = 48
"""Bits of an n-gram's hash inside its bucket."""
ODD = np.uint64(0x9E3779B97F4A7C15)
TOKENS = np.uint64(0)
"""The key that counts all words."""


def backoff_scores(
    docs: DataFrame, order: int = 3, alpha: float = 0.4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The stupid-backoff score of every document under the n-grams of all others.

    Words are runs of characters other than white space, A-Z in lower case. A word scores c(n-gram) /
    c(context) of the longest n-gram up to `order` that occurs in another document, times `alpha` for
    each order that was left; a word that no other document has scores alpha ** order over all other
    words. Counts are of the whole corpus without the document itself, so that a text does not vouch
    for itself; copies in other documents do.

    Documents fall into batches of about 8 MB by hash. A batch sends its distinct n-grams, hashed,
    with their counts to the buckets of the count tables, ranges of the hash; a bucket sums up the
    counts of each n-gram over all batches, joins the sums to the n-grams of each batch and returns
    them; the batch takes off each document's own counts and sums the logarithms per document. An
    n-gram that a third of all documents have is one row per batch, so no bucket is hot, and batches
    and buckets grow in number, not in size, with the corpus. Hashes of 48 bits inside a bucket of some
    million n-grams travel as sorted differences, compressed. The text is shuffled once, the n-grams
    once, nothing reaches the driver but the size of the text.

    Null and empty texts have no words and score 0. Repeated rows are documents of their own. An
    empty table gives an empty result. Other columns are ignored.

    Returns doc_id, n_words, log10_score (the sum), log10_per_word (null without words) and
    n_order_0 .. n_order_N: words by the longest n-gram found.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    parts = max(1, math.ceil(size / BATCH_BYTES))
    partitions = max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    batched = docs.select(
        F.pmod(F.xxhash64(id_col, text), F.lit(parts)).cast("int").alias("batch"),
        F.col(id_col).alias("doc_id"), text.alias("text"),
    ).repartition(partitions, "batch")
    asked = batched.groupBy("batch").applyInArrow(
        lambda table: _ask(table, order, parts), "bucket int, batch int, grams binary, counts binary"
    )
    asked = asked.repartition(partitions, "bucket")
    answered = asked.groupBy("bucket").applyInArrow(_count, "batch int, bucket int, totals binary")
    answered = answered.repartition(partitions, "batch")
    found = ", ".join(f"n_order_{n} long" for n in range(order + 1))
    return batched.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(
        lambda texts, totals: _score(texts, totals, order, alpha),
        f"doc_id {kind}, n_words long, log10_score double, log10_per_word double, {found}",
    )


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _grams(table: pa.Table, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per document, and for each order the hash of the n-gram that ends at each word, 0 if none."""
    hashes = WordHashes()
    texts = table.column("text")
    parts = [
        np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        for words in (t.as_py().encode().translate(LOWER).split() for t in texts)
    ]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    words = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = [_mix(words + np.uint64(1))]
    for n in range(2, order + 1):
        longer = np.zeros_like(words)
        longer[1:] = _mix(_mix(grams[-1][:-1] + np.uint64(n)) + words[1:])
        grams.append(np.where(place >= n - 1, longer, TOKENS))
    return sizes, grams


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams with counts; first the key of all words."""
    every = np.concatenate(grams)
    found, n = np.unique(every[every != TOKENS], return_counts=True)
    return np.concatenate([[TOKENS], found]).astype(np.uint64), np.concatenate([[len(grams[0])], n])


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers by their first bytes, their second bytes and so on, so that equal bytes stand together."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _ask(table: pa.Table, order: int, parts: int) -> pa.Table:
    found, n = _distinct(_grams(table, order)[1])
    bucket = ((found >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    used, at = np.unique(bucket, return_index=True)
    at = np.append(at, len(found))
    start = (bucket << np.uint64(32)) // np.uint64(parts) << np.uint64(32)
    inside = (found - start) >> np.uint64(max(0, 64 - BITS - (parts - 1).bit_length()))
    zero = np.uint64(0)
    batch = table.column("batch")[0].as_py()
    return pa.table(
        {
            "bucket": pa.array(used, pa.int32()),
            "batch": pa.array([batch] * len(used), pa.int32()),
            "grams": pa.array([_pack(np.diff(inside[a:b], prepend=zero)) for a, b in zip(at, at[1:])], pa.binary()),
            "counts": pa.array([_pack(n[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
        }
    )


def _count(table: pa.Table) -> pa.Table:
    """A bucket's count table, joined to the n-grams of every batch."""
    grams = [np.cumsum(_unpack(b.as_py()), dtype=np.uint64) for b in table.column("grams")]
    sizes = [len(g) for g in grams]
    grams = np.concatenate(grams)
    counts = np.concatenate([_unpack(b.as_py()) for b in table.column("counts")])
    order = np.argsort(grams)
    ordered = grams[order]
    first = np.append(True, ordered[1:] != ordered[:-1])
    totals = np.add.reduceat(counts[order], np.flatnonzero(first))
    each = np.empty(len(grams), dtype="<u8")
    each[order] = totals[np.cumsum(first) - 1]
    at = np.concatenate([[0], np.cumsum(sizes)])
    return pa.table(
        {
            "batch": table.column("batch"),
            "bucket": table.column("bucket"),
            "totals": pa.array([_pack(each[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
        }
    )


def _score(texts: pa.Table, answers: pa.Table, order: int, alpha: float) -> pa.Table:
    sizes, grams = _grams(texts, order)
    found, _ = _distinct(grams)
    answers = answers.sort_by("bucket")
    totals = np.concatenate([_unpack(b.as_py()) for b in answers.column("totals")]).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    others = np.zeros((order, len(doc)), dtype=np.int64)
    for n, gram in enumerate(grams):
        at = np.searchsorted(found, gram)
        pairs, inverse, own = np.unique(doc * len(found) + at, return_inverse=True, return_counts=True)
        others[n] = np.where(gram != TOKENS, totals[at] - own[inverse], 0)
    words = totals[0] - sizes[doc]
    used = np.zeros(len(doc), dtype=np.int64)
    score = order * math.log10(alpha) - np.log10(np.maximum(words, 1))
    for n in range(1, order + 1):
        here = others[n - 1] > 0
        context = words if n == 1 else np.append(0, others[n - 2][:-1])
        used[here] = n
        score[here] = (order - n) * math.log10(alpha) + np.log10(others[n - 1][here] / context[here])
    total = np.bincount(doc, weights=score, minlength=len(sizes))
    out = {
        "doc_id": texts.column("doc_id"),
        "n_words": pa.array(sizes),
        "log10_score": pa.array(total),
        "log10_per_word": pa.array(total / np.maximum(sizes, 1), mask=sizes == 0),
    }
    for n in range(order + 1):
        out[f"n_order_{n}"] = pa.array(np.bincount(doc[used == n], minlength=len(sizes)))
    return pa.table(out)

"""Line deduplication: Bloom filters for once-seen and twice-seen lines, exact counts of the suspects."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import text_of
from creditloom.session import materialize

BLANK = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
CHUNK = 1 << 16
"""Bits of a filter's piece; a position inside takes two bytes."""
BITS_PER_LINE = 16
MIN_BITS, MAX_BITS = 1 << 16, 1 << 26
SALTS = 64


def line_dedup(
    docs: DataFrame, min_docs: int = 10, min_key: int = 1, keep_first: bool = False,
    max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text", payload: list[str] | None = None,
) -> DataFrame:
    """Drop the lines that at least `min_docs` documents share.

    A text is cut at newlines; a line's key is the line without white space at both ends, A-Z in
    lower case. Keys of at least `min_key` code points found in `min_docs` documents lose all their
    lines everywhere, or with `keep_first` all but the first line in the document with the smallest
    (identifier, text hash). Other lines stay, joined by newlines.

    1. Each task puts its lines into two Bloom filters: seen in a document, and seen in a second one.
       Filters meet piece by piece: a bit is twice-seen if it is so in one task, or once-seen in two.
    2. With the merged twice-seen filter, only lines that may occur in two documents are written
       with the SHA-256 of their key, and counted exactly; the others are never shuffled.
    3. The numbers of the lines to drop return to their documents.

    The filter has 16 bits a line, `max_bits` at most, the bound of what is sent to the tasks
    (8 MB by default). Beyond, more lines are suspected and counted; the result is the same. Counts
    are combined before the shuffle, and a line of very many documents returns by salted keys.

    Null and empty texts are one empty line, which has no key. Rows count as documents of their own,
    also when repeated. `payload` names the columns to carry in the struct `row` (all by default).

    Returns row, n_lines, n_dropped, kept_text.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    lines = F.size(F.split("text", "\n"))
    total = keyed.agg(F.sum(lines.cast("long"))).first()[0] or 0
    bits = min(max_bits, max(MIN_BITS, 1 << (BITS_PER_LINE * total - 1).bit_length())) if total else MIN_BITS
    seen_twice = spark.sparkContext.broadcast(_twice_seen(keyed, bits, min_key))

    suspects = materialize(
        keyed.mapInArrow(
            lambda batches: _suspects(batches, seen_twice.value, min_key),
            "id long, hash long, key binary, lines array<int>",
        ),
        "suspect-lines",
    )
    counted = suspects.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("id", "hash")).alias("first"))
    common = counted.where(F.col("n") >= min_docs).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    hit = suspects.withColumn("salt", F.pmod("hash", F.lit(SALTS)).cast("int")).join(common, ["key", "salt"])
    if keep_first:
        here = F.struct("id", "hash").eqNullSafe(F.col("first"))
        hit = hit.withColumn("lines", F.when(here, F.slice("lines", 2, F.size("lines"))).otherwise(F.col("lines")))
    dropped = hit.groupBy("id", "hash").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("dropped"))

    rows = docs.select(
        F.struct(*[F.col(c) for c in (docs.columns if payload is None else payload)]).alias("row"),
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"),
    ).alias("d")
    same = F.col("d.id").eqNullSafe(F.col("x.id")) & (F.col("d.hash") == F.col("x.hash"))
    joined = rows.join(dropped.alias("x"), same, "left")
    parts = F.split("d.text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "x.dropped")
    kept = F.when(F.col("x.dropped").isNull(), F.col("d.text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    )
    return joined.select(
        "d.row",
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("x.dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )


def _keys(text: str, min_key: int) -> dict[bytes, list[int]]:
    """The keys of a text with the numbers of their lines."""
    found: dict[bytes, list[int]] = {}
    for n, line in enumerate(text.encode().translate(LOWER).split(b"\n")):
        key = line.strip(BLANK)
        if key and (min_key < 2 or len(key.decode()) >= min_key):
            found.setdefault(key, []).append(n)
    return found


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _twice_seen(keyed: DataFrame, bits: int, min_key: int) -> np.ndarray:
    """The bytes of the filter of lines that may be in two documents."""
    pieces = keyed.select("text").mapInArrow(
        lambda batches: _filters(batches, bits, min_key), "piece int, once binary, twice binary"
    )
    parts = min(bits // CHUNK, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    merged = pieces.repartition(parts, "piece").mapInArrow(_merged, "piece int, twice binary")
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():
        out[row["piece"] * (CHUNK // 8) : (row["piece"] + 1) * (CHUNK // 8)] = np.frombuffer(row["twice"], np.uint8)
    return out


def _filters(batches: Iterator[pa.RecordBatch], bits: int, min_key: int) -> Iterator[pa.RecordBatch]:
    """A task's two filters, as the set positions of each piece."""
    once, twice = np.zeros(bits, dtype=bool), np.zeros(bits, dtype=bool)
    for batch in batches:
        hashes = [xxhash.xxh3_64_intdigest(k) for t in batch.column(0) for k in _keys(t.as_py(), min_key)]
        keys, n = np.unique(np.array(hashes, dtype=np.uint64), return_counts=True)
        a, b = _positions(keys, bits)
        again = (n > 1) | (once[a] & once[b])
        for at in (a, b):
            twice[at[again]] = True
        for at in (a, b):
            once[at] = True
    once, twice = np.flatnonzero(once), np.flatnonzero(twice)
    edges = np.arange(0, bits + 1, CHUNK)
    once_at, twice_at = np.searchsorted(once, edges), np.searchsorted(twice, edges)
    used = np.flatnonzero(np.diff(once_at))

    def packed(found, at):
        return pa.array([(found[at[p] : at[p + 1]] % CHUNK).astype("<u2").tobytes() for p in used], pa.binary())

    yield pa.record_batch(
        [pa.array(used, pa.int32()), packed(once, once_at), packed(twice, twice_at)], ["piece", "once", "twice"]
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for piece, once_at, twice_at in zip(*(c.to_pylist() for c in batch.columns)):
            once, twice = filters.setdefault(piece, (np.zeros(CHUNK, bool), np.zeros(CHUNK, bool)))
            at = np.frombuffer(once_at, "<u2")
            twice[at[once[at]]] = True
            once[at] = True
            twice[np.frombuffer(twice_at, "<u2")] = True
    for piece, (_, twice) in filters.items():
        if twice.any():
            bits = np.packbits(twice, bitorder="little").tobytes()
            yield pa.record_batch([pa.array([piece], pa.int32()), pa.array([bits])], ["piece", "twice"])


def _suspects(batches: Iterator[pa.RecordBatch], twice: np.ndarray, min_key: int) -> Iterator[pa.RecordBatch]:
    """The keys of each document that the filter can't rule out."""
    names = ["id", "hash", "key", "lines"]
    for batch in batches:
        owners, keys, numbers = [], [], []
        for row, text in enumerate(batch.column(2)):
            for key, lines in _keys(text.as_py(), min_key).items():
                owners.append(row)
                keys.append(key)
                numbers.append(lines)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        hit = np.ones(len(hashes), dtype=bool)
        for at in _positions(hashes, len(twice) * 8):
            hit &= (twice[at >> 3] >> (at & 7) & 1).astype(bool)
        hit = np.flatnonzero(hit)
        rows = pa.array(np.array(owners, dtype=np.int64)[hit])
        yield pa.record_batch(
            [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array([hashlib.sha256(keys[i]).digest() for i in hit], pa.binary()),
                pa.array([numbers[i] for i in hit], pa.list_(pa.int32())),
            ],
            names,
        )

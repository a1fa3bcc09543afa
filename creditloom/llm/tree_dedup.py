"""Exact deduplication by a tree merge of sorted digest runs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import attach_by_leaf, text_of
from creditloom.session import materialize

KEY = ["digest", "bytes", "hash"]
RUN = "place int, digest string, bytes int, hash long, keep_id long, group_size long"
EXTREME = {"smallest": np.iinfo(np.int64).max, "largest": np.iinfo(np.int64).min}
"""What stands for a null identifier, as it never wins."""


def tree_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    fan_in: int | None = None, rounds: int = 2,
) -> DataFrame:
    """One row per document with the identifier that stays for its text.

    Leaves: every document belongs to one of `fan_in ** rounds` leaves by a hash of its identifier,
    and each leaf makes a run of its digests, sorted, equal ones merged: SHA-256 of the whole text,
    checked by length and a second 64-bit hash that must agree as well. Rounds: in round k the
    `fan_in` places whose numbers differ in digit k only exchange runs, each taking the part of the
    digest range that its own digit k stands for; a place brings the runs it gets into one order
    (Spark's sorter, which spills runs and merges them), and one pass over that order keeps the best
    identifier and the number of copies of each verified digest, a batch in memory at a time. After the
    last round each place holds its slice of the digest range for the whole table, so no task ever sees
    more than its leaf's or its slice's rows, and a text shared by a third of the table is one row per
    place from the first round on. The results return to the documents by leaf (`attach_by_leaf`).

    `fan_in` is by default the least number whose power reaches the session's shuffle partitions.

    Null texts count as empty. Null identifiers are never chosen before others; a group of nulls
    only has a null keep_id. Of rows repeated with identifier and text exactly one is kept. Columns
    other than the two named are ignored. An empty table gives an empty result.

    Returns doc_id, keep_id, group_size (rows of equal text), kept, text_sha256.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    if fan_in is None:
        wanted = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fan_in = max(2, math.ceil(wanted ** (1 / rounds)))
    places = fan_in**rounds

    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("hash"),
    ).withColumn("leaf", F.pmod(F.xxhash64("id"), F.lit(places)).cast("int"))
    rows = materialize(rows.groupBy("leaf", *KEY, "id").agg(F.count("*").alias("copies")), "digests")

    runs = rows.select(F.col("leaf").alias("place"), *KEY, F.col("id").alias("keep_id"), F.col("copies").alias("group_size"))
    runs = _merged(runs, places, keep)
    for k in range(rounds):
        runs = _merged(_exchange(runs, k, fan_in, places), places, keep)
    found = attach_by_leaf(rows, runs.drop("place"), KEY)
    found = found.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _exchange(runs: DataFrame, k: int, fan_in: int, places: int) -> DataFrame:
    """Give every row to the place whose digit k is that of the row's slice."""
    slice_of = F.pmod(F.conv(F.substring("digest", 1, 12), 16, 10).cast("long"), F.lit(places))
    step = fan_in**k
    moved = F.col("place") + (_digit(slice_of, step, fan_in) - _digit(F.col("place"), step, fan_in)) * step
    return runs.withColumn("place", moved.cast("int"))


def _digit(number: Column, step: int, fan_in: int) -> Column:
    return F.floor(number / F.lit(step)) % F.lit(fan_in)


def _merged(runs: DataFrame, places: int, keep: str) -> DataFrame:
    """One sorted run per place, equal digests merged."""
    ordered = runs.repartition(places, "place").sortWithinPartitions("place", *KEY)
    return ordered.mapInArrow(lambda batches: _merge(batches, keep), RUN)


def _merge(batches: Iterator[pa.RecordBatch], keep: str) -> Iterator[pa.RecordBatch]:
    """Merge equal neighbours of a sorted stream; a batch's last digest waits for the next batch."""
    best = np.minimum if keep == "smallest" else np.maximum
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if waiting is None else pa.concat_batches([waiting, batch.cast(waiting.schema)])
        first = np.zeros(rows.num_rows, dtype=bool)
        first[0] = True
        for name in ("place", *KEY):
            column = rows.column(name)
            first[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(first)
        ids = rows.column("keep_id")
        unnamed = np.logical_and.reduceat(ids.is_null().to_numpy(zero_copy_only=False), starts)
        kept = best.reduceat(ids.fill_null(EXTREME[keep]).to_numpy(), starts)
        sizes = np.add.reduceat(rows.column("group_size").to_numpy(), starts)
        keys = rows.select(["place", *KEY]).take(pa.array(starts))
        merged = pa.record_batch(
            [*keys.columns, pa.array(kept, pa.int64(), mask=unnamed), pa.array(sizes, pa.int64())],
            names=[*keys.schema.names, "keep_id", "group_size"],
        )
        yield merged[:-1]
        waiting = merged[-1:]
    if waiting is not None:
        yield waiting

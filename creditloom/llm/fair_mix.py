"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import text_of, word_count
from creditloom.session import materialize

BINS = 4096
"""Bins per look at the finish times; what reaches the driver is a row per bin."""
FEW = 1000
"""Copies in a bin that are ordered directly."""
LOOKS = 5
ORDER = ["finish", "mix_source", "mix_key", "mix_tie", "epoch"]


def fair_mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_copies: int = 3,
    seed: str = "", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    payload: list[str] | None = None,
) -> DataFrame:
    """How many copies of each document a mix with the sources' weights takes.

    A document's size is its number of words. Sources in code point order (null last) weigh
    `weights`, repeating, and share `share` of all words; a source's target stops at `max_copies`
    times its size and the excess goes to the others by weight. Each source queues its documents
    in the order of md5(seed + doc_id), up to `max_copies` times over, and a copy's virtual finish
    time is the source's words up to and with it, divided by the source's target. Copies of all
    sources are taken in the order of finish times until the budget is full; the copy that would
    pass it, and all after it, are left out.

    No global sort runs: words per (source, 4,096 slices of the shuffle order) give every slice its
    start, rows are ordered inside their slice only, and the cut in the global order is found by
    counting words per bin of finish time, then within the bin that holds the cut, until few
    copies are left to order. A source with a third of all rows is split over its slices.

    Null and empty texts have size 0 and are never taken. A null source is a source of its own.
    Rows that agree in identifier and text are interchangeable; each counts. An empty table or one
    without words takes nothing. `payload` names the columns to carry (all by default); columns
    called like the result's are not touched, as the input row is kept in the struct `row`.

    Returns row (struct of payload), size, source_size, target (double), copies (int), taken.
    """
    text = text_of(text_col)
    source = F.col(source_col).cast("string")
    rows = docs.select(
        F.struct(*[F.col(c) for c in (docs.columns if payload is None else payload)]).alias("row"),
        word_count(text).alias("size"),
        F.concat(F.when(source.isNull(), "1").otherwise("0"), F.coalesce(source, F.lit(""))).alias("mix_source"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("mix_key"),
        F.xxhash64(text).alias("mix_tie"),
    ).withColumn("slice", F.conv(F.substring("mix_key", 1, 3), 16, 10).cast("int"))

    per_slice = materialize(
        rows.groupBy("mix_source", "slice").agg(F.sum("size").alias("slice_size")), "mix-slices"
    )
    by_slice = Window.partitionBy("mix_source").orderBy("slice")
    before = F.sum("slice_size").over(by_slice.rowsBetween(Window.unboundedPreceding, -1))
    starts = per_slice.select("mix_source", "slice", F.coalesce(before, F.lit(0)).alias("start")).join(
        targets(per_slice, weights, share, max_copies), "mix_source"
    )
    in_slice = Window.partitionBy("mix_source", "slice").orderBy("mix_key", "mix_tie", "size")
    upto = F.col("start") + F.sum("size").over(in_slice.rowsBetween(Window.unboundedPreceding, 0))
    timed = rows.join(starts, ["mix_source", "slice"]).withColumn("upto", upto).drop("slice", "start")
    timed = materialize(timed, "mix-times")

    cut = _cut(timed, max_copies, share)
    copies = sum(
        (
            F.when(F.struct(*_place(F.lit(e))) < cut, 1).otherwise(0) if cut is not None else F.lit(1)
            for e in range(max_copies)
        ),
        F.lit(0),
    )
    copies = F.when((F.col("size") > 0) & (F.col("target") > 0), copies).otherwise(0).cast("int")
    return timed.select(
        "row", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_copies: int) -> DataFrame:
    """mix_source, source_size, target: the weighted shares of all words under the sources' caps.

    Sources in the order of cap per weight: those that the level of the remaining sources reaches
    are full, and the highest level of all is the common level of the others. One row per source.
    """
    per_source = sizes.groupBy("mix_source").agg(F.sum("slice_size").alias("source_size"))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        (F.row_number().over(Window.orderBy("mix_source")) - 1) % len(weights) + 1,
    )
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = per_source.select(
        "*",
        weight.alias("weight"),
        (F.col("source_size") * max_copies).alias("cap"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("budget"),
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), "mix_source")
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a running sum taken off the whole: a frame to the end would be added up anew for every source
    left = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    level = capped.withColumn("level", (F.col("budget") - full) / left)
    common = F.max("level").over(everything)
    return level.select(
        "mix_source", "source_size", F.least(F.col("cap").cast("double"), common * F.col("weight")).alias("target")
    )


def _place(epoch: Column) -> list[Column]:
    """A copy's place in the global order: finish time, then ties."""
    finish = (epoch * F.col("source_size") + F.col("upto")) / F.col("target")
    return [
        finish.alias("finish"), F.col("mix_source"), F.col("mix_key"), F.col("mix_tie"),
        epoch.cast("int").alias("epoch"),
    ]


def _cut(timed: DataFrame, max_copies: int, share: float) -> Column | None:
    """The place of the first copy that the budget leaves out, as a literal; None if all fit."""
    usable = timed.where((F.col("size") > 0) & (F.col("target") > 0))
    copies = usable.withColumn("e", F.explode(F.array(*[F.lit(e) for e in range(max_copies)]))).select(
        *_place(F.col("e")), "size"
    )
    total, most = timed.agg(F.sum("size")).first()[0], copies.agg(F.max("finish")).first()[0]
    if most is None:
        return None
    left, low, width = total * share, 0.0, most
    for _ in range(LOOKS):
        number = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit(width) * BINS), F.lit(BINS - 1))
        binned = copies.withColumn("bin", F.greatest(number, F.lit(0)))
        sums = binned.groupBy("bin").agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy("bin").collect()
        at = None
        for b in sums:
            if b["size"] > left:
                at = b
                break
            left -= b["size"]
        if at is None:
            return None
        copies = binned.where(F.col("bin") == at["bin"]).drop("bin")
        low, width = low + width * at["bin"] / BINS, width / BINS
        if at["n"] <= FEW:
            break
    running = F.sum("size").over(Window.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0))
    first = copies.withColumn("running", running).where(F.col("running") > left).orderBy(*ORDER).first()
    return F.struct(*[F.lit(first[c]).alias(c) for c in ORDER])


def mixed_documents(mixed: DataFrame) -> DataFrame:
    """The mix itself: the carried row once per copy taken."""
    return mixed.where(F.col("copies") > 0).select(
        "row", F.explode(F.sequence(F.lit(1), "copies")).alias("nth")
    ).select("row.*")

"""Deterministic samples, splits and folds by the md5 order of a unique key.

Rows are never sorted or shuffled as a whole. Counting rows per leading hash digits
tells which digits each cut falls on; only those rows are counted again by more digits,
until few are left to order. Membership is then a comparison with the cut hash, in a
pass without any shuffle. Class sizes do not matter: no task ever holds a whole class.
Finding the cuts runs jobs over the key and the label.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_DIGITS, MORE_DIGITS, ALL_DIGITS = 2, 3, 32
SMALL = 100_000

Cuts = Callable[[int], Sequence[int]]


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


OUTSIDE = "other"


def class_name(df: DataFrame, label: str, classes: Sequence) -> Column:
    """The class of a row as text, compared in the label's own type; OUTSIDE for all others."""
    kind = df.schema[label].dataType
    out = F.lit(OUTSIDE)
    for c in classes:
        out = F.when(F.col(label) == F.lit(c).cast(kind), str(c)).otherwise(out)
    return out


def cut_hashes(
    df: DataFrame, key: str, seed: int, cuts: Cuts, label: str | None = None, classes: Sequence = (0, 1)
) -> dict[str, list[str]]:
    """Per class, the hash of the row at each cut.

    `cuts` gives the wanted row counts for a class size. A cut of 0 gives '', so no hash is
    below or equal to it; a cut beyond the class gives its last row. Without a label all
    rows are one class, named ''. The classes are a parameter, so a label with many values
    cannot flood the driver: it receives a few thousand counts per class at most. Rows of
    other labels, null included, are an error, as no cut would hold for them.
    """
    group = F.lit("") if label is None else class_name(df, label, classes)
    rows = df.select(group.alias("c"), hash_order(key, seed).alias("h"))

    def counts(rows: DataFrame, digits: int) -> dict[str, list[tuple[str, int]]]:
        found: dict[str, list[tuple[str, int]]] = {}
        for r in rows.groupBy("c", F.substring("h", 1, digits).alias("p")).agg(F.count("*").alias("n")).collect():
            found.setdefault(r["c"], []).append((r["p"], r["n"]))
        return {c: sorted(slices) for c, slices in found.items()}

    def inside(places: Sequence[tuple[str, str]], digits: int) -> DataFrame:
        return rows.filter(F.concat("c", F.lit(":"), F.substring("h", 1, digits)).isin(*{f"{c}:{p}" for c, p in places}))

    first = counts(rows, FIRST_DIGITS)
    if OUTSIDE in first:
        raise ValueError(f"{sum(n for _, n in first[OUTSIDE])} rows have a {label} other than {list(classes)}")
    wanted = {c: [min(cut, sum(n for _, n in slices)) for cut in cuts(sum(n for _, n in slices))]
              for c, slices in first.items()}
    # open[(class, cut)] = (prefix, rows of the class before the prefix, rows in it)
    found: dict[tuple[str, int], tuple[str, int, int]] = {
        (c, cut): ("", 0, sum(n for _, n in first[c])) for c, cs in wanted.items() for cut in cs if cut > 0
    }
    digits, sliced = FIRST_DIGITS, first
    while True:
        for (c, cut), (prefix, before, _) in found.items():
            slices = [(p, n) for p, n in sliced[c] if p.startswith(prefix)]
            sums = list(accumulate(n for _, n in slices))
            at = bisect_left(sums, cut - before)
            found[c, cut] = (slices[at][0], before + sums[at] - slices[at][1], slices[at][1])
        if digits == ALL_DIGITS or all(n <= SMALL for _, _, n in found.values()):
            break
        places = [(c, prefix) for (c, _), (prefix, _, _) in found.items()]
        near = inside(places, digits)
        digits = min(digits + MORE_DIGITS, ALL_DIGITS)
        sliced = counts(near, digits)
    hashes = {(c, 0): "" for c in wanted}
    if digits == ALL_DIGITS:
        hashes.update({place: prefix for place, (prefix, _, _) in found.items()})
    elif found:
        near = inside([(c, prefix) for (c, _), (prefix, _, _) in found.items()], digits)
        order = Window.partitionBy("c", "p").orderBy("h")
        ranked = near.withColumn("p", F.substring("h", 1, digits)).withColumn("r", F.row_number().over(order))
        exact = {f"{c}:{p}:{cut - before}": (c, cut) for (c, cut), (p, before, _) in found.items()}
        hits = ranked.select(F.concat_ws(":", "c", "p", "r").alias("id"), "h").filter(F.col("id").isin(*exact))
        hashes.update({exact[r["id"]]: r["h"] for r in hits.collect()})
    return {c: [hashes[c, cut] for cut in cs] for c, cs in wanted.items()}


def _share(size: int, fraction: float) -> int:
    return math.floor(size * fraction + 0.5)


def _by_class(found: dict[str, list[str]], name: Column, pick: Callable[[list[str]], Column]) -> Column:
    """`pick` applied to the cuts of the row's class."""
    out = F.lit(None)
    for c, hashes in found.items():
        out = F.when(name == c, pick(hashes)).otherwise(out)
    return out


def stratified_split(
    df: DataFrame,
    key: str = "SK_ID_CURR",
    label: str = "TARGET",
    train: float = 0.8,
    test: float = 0.199,
    demo: float = 0.001,
    seed: int = 42,
    classes: Sequence = (0, 1),
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add `split`: the demo holdout first, then train and test of the rest, per class.

    The cuts are found in `keys`, which must hold the key and label of each row of `df`, no more and no less; by
    default `df` itself. A table that is costly to make need not be written first for it.
    """
    if abs(train + test + demo - 1.0) > 1e-6:
        raise ValueError(f"fractions must sum to 1, got {train + test + demo:.6f}")

    def cuts(size: int) -> list[int]:
        held = _share(size, demo)
        return [held, held + _share(size - held, test / (train + test))]

    found = cut_hashes(df if keys is None else keys, key, seed, cuts, label, classes)
    position = hash_order(key, seed)
    return df.withColumn(
        "split",
        _by_class(
            found, class_name(df, label, classes),
            lambda h: F.when(position <= h[0], "demo").when(position <= h[1], "test").otherwise("train"),
        ),
    )


def sample_n(df: DataFrame, n: int, key: str = "SK_ID_CURR", seed: int = 42) -> DataFrame:
    """Exactly n rows, or all of them when there are fewer."""
    found = cut_hashes(df, key, seed, lambda size: [n])
    return df.filter(hash_order(key, seed) <= found[""][0]) if found else df


def sample_fraction(df: DataFrame, fraction: float, key: str = "SK_ID_CURR", seed: int = 42) -> DataFrame:
    """The given share of rows, rounded to whole rows."""
    found = cut_hashes(df, key, seed, lambda size: [_share(size, fraction)])
    return df.filter(hash_order(key, seed) <= found[""][0]) if found else df


def undersample(df: DataFrame, key: str = "SK_ID_CURR", label: str = "TARGET", seed: int = 42) -> DataFrame:
    """All positives and an equal number of negatives."""
    positives = df.filter(F.col(label) == 1)
    return positives.unionByName(sample_n(df.filter(F.col(label) == 0), positives.count(), key, seed))


def k_fold(
    df: DataFrame,
    k: int = 5,
    key: str = "SK_ID_CURR",
    label: str = "TARGET",
    seed: int = 42,
    classes: Sequence = (0, 1),
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add `fold`: equal parts of each class in hash order, the cuts found in `keys` as for the split."""
    found = cut_hashes(df if keys is None else keys, key, seed, lambda size: [size * i // k for i in range(1, k)], label, classes)
    position = hash_order(key, seed)

    def number(hashes: list[str]) -> Column:
        out = F.lit(0)
        for h in hashes:
            out = out + (position > h).cast("int")
        return out

    return df.withColumn("fold", _by_class(found, class_name(df, label, classes), number).cast("int"))


def class_weight(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """Negatives per positive, guarding an empty positive class."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos")
    ).withColumn("weight", F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1)).cast("double"))

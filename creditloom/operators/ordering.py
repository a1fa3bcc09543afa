"""Exact order statistics that never sort a whole column in one task.

Every operator here first counts rows per *bucket*. A bucket is a fixed monotone
function of the value (logarithmic steps, relative width 1/STEPS), so any task on
any attempt computes the same bucket, and the number of buckets is bounded by the
range of a double (about 2 * 710 * STEPS) however many rows there are. A bucket that
holds many values, as when all values lie close together, is cut further into equal
widths between its own smallest and largest value, in proportion to its weight: about
CELLS cells in total. Cell totals give each cell's starting rank; only then are the
rows that matter looked at closely, with equal values collapsed to one counted row
first, so a value shared by a third of the table costs one row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.session import materialize

STEPS = 128.0
CELLS = 8192
SMALL = 1_000_000
PART_BITS = 33
"""`monotonically_increasing_id` counts a partition's rows in its lower bits."""


def order_bucket(value: Column) -> Column:
    """Weakly increasing in `value`; `+ 0.0` folds negative zero into zero."""
    return F.signum(value) * F.floor(F.log1p(F.abs(value)) * F.lit(STEPS)).cast("double") + F.lit(0.0)


def cell_in_bucket(value: Column, low: Column, high: Column, weight: Column, total: Column) -> Column:
    """Weakly increasing cell number of a value inside its bucket [low, high]."""
    cells = F.ceil(weight / total * F.lit(CELLS))
    return F.when(high > low, F.floor((value - low) / (high - low) * cells)).otherwise(F.lit(0)).cast("int")


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, value) rows of the numeric columns, missing values left out."""
    doubles = [F.col(c).try_cast("double").alias(c) for c in cols]
    if len(cols) == 1:
        rows = df.select(*by, F.lit(cols[0]).alias("feature"), doubles[0].alias("value"))
    else:
        rows = df.select(*by, *doubles).unpivot(list(by), list(cols), "feature", "value")
    keep = F.col("value").isNotNull() & ~F.isnan("value")
    for key in by:
        keep = keep & F.col(key).isNotNull()
    return rows.filter(keep)


def _holding(ranks: Column, start: Column, n: Column) -> Column:
    return F.filter(ranks, lambda r: (r >= start) & (r < start + n))


def _interpolated(at: Mapping[int, float], total: int, p: float) -> float:
    place = float(p) * (total - 1)
    low, high = at[math.floor(place)], at[math.ceil(place)]
    return low if low == high else low + (high - low) * (place - math.floor(place))


@dataclass(frozen=True)
class Span:
    """A closed value range that holds wanted ranks: `n` rows, the first of rank `start`."""

    feature: str
    bucket: float
    low: float
    high: float
    start: int
    n: int


class QuantileSearch:
    """Exact quantiles of several columns by narrowing value ranges.

    The first pass counts rows per bucket and keeps the buckets that hold a wanted rank;
    a range that still holds more than SMALL rows of different values is cut into CELLS
    equal widths and counted again. Each pass scans the needed columns and shuffles only
    counts. What comes to the driver is at most two ranges per wanted quantile.
    """

    def __init__(self, df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> None:
        self.probs = [float(p) for p in probs]
        self.df, self.cols = df, list(cols)
        self.rows = self._bucketed(df)
        before = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("feature")
        several = 1 + (F.col("low") < F.col("high")).cast("int")
        places = [F.lit(p) * (F.col("total") - 1) for p in self.probs]
        ranks = F.array(*[f(place).cast("bigint") for place in places for f in (F.floor, F.ceil)])
        found = (
            self.rows.groupBy("feature", "bucket")
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .withColumn("total", F.sum("n").over(whole))
            .withColumn("distinct_at_least", F.sum(several).over(whole))
            .filter(F.size(_holding(ranks, F.col("start"), F.col("n"))) > 0)
            .collect()
        )
        self.totals = {r["feature"]: r["total"] for r in found}
        self.distinct_at_least = {r["feature"]: r["distinct_at_least"] for r in found}
        self.spans = [Span(r["feature"], r["bucket"], r["low"], r["high"], r["start"], r["n"]) for r in found]

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return long_values(df, self.cols).withColumn("bucket", order_bucket(F.col("value")))

    def _ranks(self, feature: str) -> list[int]:
        places = [p * (self.totals[feature] - 1) for p in self.probs]
        return sorted({f(place) for place in places for f in (math.floor, math.ceil)})

    def _rows_of(self, spans: Sequence[Span]) -> DataFrame:
        """Rows inside the ranges, with the range and the ranks wanted from it.

        The ranges also go to the scan as a plain filter, which drops most rows, and
        whole row groups where the file is ordered, before anything is computed.
        """
        near = reduce(or_, [F.col(s.feature).try_cast("double").between(F.lit(s.low), F.lit(s.high)) for s in spans])
        table = [
            (i, s.feature, s.bucket, s.low, s.high, s.start,
             [r for r in self._ranks(s.feature) if s.start <= r < s.start + s.n])
            for i, s in enumerate(spans)
        ]
        small = self.rows.sparkSession.createDataFrame(
            table, "span int, feature string, bucket double, low double, high double, start bigint, ranks array<bigint>"
        )
        inside = F.col("value").between(F.col("low"), F.col("high"))
        return self._bucketed(self.df.filter(near)).join(F.broadcast(small), ["feature", "bucket"]).filter(inside)

    def _narrow(self, spans: Sequence[Span]) -> list[Span]:
        keys = ["span", "start", "ranks"]
        cell = cell_in_bucket(F.col("value"), F.col("low"), F.col("high"), F.lit(1.0), F.lit(1.0))
        before = Window.partitionBy("span").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        found = (
            self._rows_of(spans)
            .groupBy(*keys, cell.alias("cell"))
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0)))
            .filter(F.size(_holding(F.col("ranks"), F.col("start"), F.col("n"))) > 0)
            .collect()
        )
        return [
            Span(spans[r["span"]].feature, spans[r["span"]].bucket, r["low"], r["high"], r["start"], r["n"])
            for r in found
        ]

    def _pick(self, spans: Sequence[Span]) -> list[tuple[str, int, float]]:
        """(feature, rank, value) of the wanted ranks in small ranges."""
        upto = Window.partitionBy("span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        counted = (
            self._rows_of(spans)
            .groupBy("span", "start", "ranks", "value")
            .agg(F.count("*").alias("n"))
            .withColumn("start", F.col("start") + F.sum("n").over(upto) - F.col("n"))
        )
        hits = counted.select(
            "span", "value", F.explode(_holding(F.col("ranks"), F.col("start"), F.col("n"))).alias("rank")
        )
        return [(spans[r["span"]].feature, r["rank"], r["value"]) for r in hits.collect()]

    def values(self) -> dict[str, list[float]]:
        """Quantile values per column in the order of the probabilities; no rows, no entry."""
        spans = self.spans
        while heavy := [s for s in spans if s.n > SMALL and s.low < s.high]:
            spans = [s for s in spans if s not in heavy] + self._narrow(heavy)
        at: dict[str, dict[int, float]] = {feature: {} for feature in self.totals}
        for s in spans:
            if s.low == s.high:
                at[s.feature].update({r: s.low for r in self._ranks(s.feature) if s.start <= r < s.start + s.n})
        mixed = [s for s in spans if s.low < s.high]
        if mixed:
            for feature, rank, value in self._pick(mixed):
                at[feature][rank] = value
        return {f: [_interpolated(at[f], self.totals[f], p) for p in self.probs] for f in at}


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact linear-interpolated quantiles; runs jobs, as `approxQuantile` does."""
    return QuantileSearch(df, cols, probs).values()


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles as (by..., feature, p, value) rows."""
    if by:
        return _grouped_quantiles(df, cols, probs, by)
    values = quantile_values(df, cols, probs)
    rows = [(feature, float(p), v) for feature, vs in values.items() for p, v in zip(probs, vs)]
    return df.sparkSession.createDataFrame(rows, "feature string, p double, value double")


def _grouped_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str]
) -> DataFrame:
    """Quantiles per group, for any number of groups: nothing comes to the driver."""
    keys = [*by, "feature"]
    rows = long_values(df, cols, by).withColumn("bucket", order_bucket(F.col("value")))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        rows.groupBy(*keys, "bucket")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    )
    places = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    ranks = F.array(*[f(place).cast("bigint") for place in places for f in (F.floor, F.ceil)])
    wanted = counts.withColumn(
        "ranks", _holding(F.array_distinct(ranks), F.col("start"), F.col("n"))
    ).filter(F.size("ranks") > 0)
    near = rows.groupBy(*keys, "bucket", "value").agg(F.count("*").alias("c")).join(wanted, [*keys, "bucket"])
    near = near.withColumn(
        "cell", cell_in_bucket(F.col("value"), F.col("low"), F.col("high"), F.lit(1.0), F.lit(1.0))
    )
    here = [*keys, "bucket", "cell"]
    ahead = Window.partitionBy(*keys, "bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        near.groupBy(*here, "start", "total", "ranks")
        .agg(F.sum("c").alias("m"))
        .withColumn("start", F.col("start") + F.coalesce(F.sum("m").over(ahead), F.lit(0)))
        .withColumn("ranks", _holding(F.col("ranks"), F.col("start"), F.col("m")))
        .filter(F.size("ranks") > 0)
        .select(*here, "start", "total", "ranks")
    )
    upto = Window.partitionBy(*here).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    near = near.select(*here, "value", "c").join(cells, here)
    near = near.withColumn("start", F.col("start") + F.sum("c").over(upto) - F.col("c"))
    hits = near.select(
        *keys, "total", "value", F.explode(_holding(F.col("ranks"), F.col("start"), F.col("c"))).alias("rank")
    )
    at_rank = hits.groupBy(*keys).agg(
        F.max("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"),
    )
    points = []
    for p in probs:
        place = F.lit(float(p)) * (F.col("total") - 1)
        low = F.col("at")[F.floor(place).cast("bigint")]
        high = F.col("at")[F.ceil(place).cast("bigint")]
        points.append(
            F.struct(
                F.lit(float(p)).alias("p"),
                F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias("value"),
            )
        )
    return at_rank.select(*keys, F.inline(F.array(*points)))


def running_totals(
    df: DataFrame,
    value: str,
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Per distinct value: each measure summed (`m`) and summed up to it (`cum_m`).

    Cumulative work is split into one ordered run per bucket plus the bucket offsets.
    """
    def order(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    names = list(measures)
    where = [*by, "__bucket", "__cell"]
    rows = df.filter(F.col(value).isNotNull()).withColumn(
        "__bucket", order_bucket(F.col(value).cast("double"))
    )
    per_value = rows.groupBy(*by, "__bucket", value).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
    spans = rows.groupBy(*by, "__bucket").agg(
        F.count("*").alias("__n"),
        F.min(F.col(value).cast("double")).alias("__low"),
        F.max(F.col(value).cast("double")).alias("__high"),
    )
    spans = spans.withColumn("__all", F.sum("__n").over(Window.partitionBy(*by)))
    if not by:
        spans = F.broadcast(spans)  # bounded by the number of buckets
    cell = cell_in_bucket(
        F.col(value).cast("double"), F.col("__low"), F.col("__high"), F.col("__n"), F.col("__all")
    )
    placed = per_value.join(spans, [*by, "__bucket"]).select(
        *by, "__bucket", cell.alias("__cell"), value, *names
    )
    before = (
        Window.partitionBy(*by)
        .orderBy(order("__bucket"), order("__cell"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = placed.groupBy(*where).agg(*[F.sum(m).alias(f"__{m}") for m in names])
    offsets = offsets.select(
        *where,
        *[F.coalesce(F.sum(f"__{m}").over(before), F.lit(0)).alias(f"__off_{m}") for m in names],
        *[F.sum(f"__{m}").over(Window.partitionBy(*by)).alias(f"total_{m}") for m in names],
    )
    if not by:
        offsets = F.broadcast(offsets)  # bounded by the number of buckets plus CELLS
    inside = Window.partitionBy(*where).orderBy(order(value)).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(offsets, where).select(
        *by,
        value,
        *names,
        *[(F.col(f"__off_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in names],
        *[f"total_{m}" for m in names],
    )


def rank_by(df: DataFrame, metric: str, key: str, descending: bool = True) -> DataFrame:
    """Position of every row in the metric's order, ties by the unique `key`.

    Spark samples (metric, key) pairs, range-partitions the rows by the pair and sorts each part. As the
    key is part of the range, a value that a third of the rows share is spread over a third of the parts, beside any
    close neighbours. The table is read twice, for the sample and for the shuffle; the sorted rows are written
    with their place in their part, and the parts' sizes, one number a part, become starting ranks. Rows without a
    metric get no rank and are left out.
    """
    order = F.col(metric).desc() if descending else F.col(metric).asc()
    rows = df.filter(F.col(metric).isNotNull()).repartitionByRange(order, F.col(key)).sortWithinPartitions(order, key)
    placed = materialize(rows.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("__part", F.shiftright("__at", PART_BITS))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__part").agg(F.count("*").alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    within = F.col("__at").bitwiseAND(F.lit((1 << PART_BITS) - 1)) + 1
    # one row per part of the shuffle
    return placed.join(F.broadcast(starts), "__part").select(*df.columns, (F.col("__start") + within).alias("rank"))


def percentile_of(df: DataFrame, feature: str, value: float) -> DataFrame:
    """Share (in %) of non-null values at or below one value."""
    return df.agg((F.avg((F.col(feature) <= value).cast("double")) * 100).alias("percentile"))


def percentile_of_each(df: DataFrame, feature: str) -> DataFrame:
    """(value, percentile) for every distinct value of the feature."""
    totals = running_totals(df, feature, {"n": F.lit(1)})
    return totals.select(feature, (F.col("cum_n") / F.col("total_n") * 100).alias("percentile"))


# ---------------------------------------------------------------- bands

def band_edges(df: DataFrame, col: str, most: int) -> list[float]:
    """Distinct quantile edges of min(most, distinct values) bands; one edge or none when flat.

    The first pass of the search proves how many distinct values there are at least, as
    each occupied bucket holds one, or two when its smallest and largest differ. Only when
    that falls short of `most` are distinct values counted.
    """
    search = QuantileSearch(df, [col], [i / most for i in range(most + 1)])
    if col not in search.totals:
        return []
    if search.distinct_at_least[col] < most:
        distinct = search.rows.agg(F.count_distinct("value").alias("n")).first()["n"]
        if distinct < most:
            search = QuantileSearch(df, [col], [i / distinct for i in range(distinct + 1)])
    return list(dict.fromkeys(search.values()[col]))


def quantile_bands(df: DataFrame, col: str, most: int = 10, missing: str = "Não informado") -> DataFrame:
    """Add (band, band_lo, band_hi, band_label): right-closed bands between quantiles.

    Repeated edges collapse. A single distinct value gives one band; a null gets the
    `missing` label and no band.
    """
    edges = band_edges(df, col, most)
    value = F.col(col).cast("double")
    known = value.isNotNull() & ~F.isnan(value)
    if len(edges) < 2:
        lo = hi = F.when(known, value)
        band = F.when(known, F.lit(0))
    else:
        above = F.lit(0)
        for edge in edges[1:-1]:
            above = above + (value > F.lit(edge)).cast("int")
        band = F.when(known, above)
        marks = F.array(*[F.lit(e) for e in edges])
        lo, hi = F.get(marks, band), F.get(marks, band + 1)
    out = df.withColumn("band", band.cast("int"))
    out = out.withColumn("band_lo", floor_at_zero(lo)).withColumn("band_hi", floor_at_zero(hi))
    label = F.concat(F.format_string("%.2f", "band_lo"), F.lit(" - "), F.format_string("%.2f", "band_hi"))
    return out.withColumn("band_label", F.when(F.col("band").isNull(), missing).otherwise(label))


def floor_at_zero(value: Column) -> Column:
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def fixed_bands(df: DataFrame, col: str, width: int = 5, start: int = 18, stop: int = 103) -> DataFrame:
    """Add (band_lo, band_hi): left-closed bands of equal width; outside -> NULL."""
    value = F.col(col)
    inside = (value >= start) & (value < stop)
    lo = F.lit(start) + F.floor((value - start) / F.lit(float(width))).cast("int") * width
    return df.withColumn("band_lo", F.when(inside, lo)).withColumn(
        "band_hi", F.when(inside, lo + width)
    )


# ---------------------------------------------------------------- top rows

def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(k)


def bottom_k(df: DataFrame, metric: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(metric).asc_nulls_last(), *ties).limit(k)


def argmax_row(df: DataFrame, metric: str, ties: Sequence[str] = ()) -> DataFrame:
    return top_k(df.filter(F.col(metric).isNotNull()), metric, 1, ties)


def best_within_tolerance(
    df: DataFrame, metric: str, cost: str, tolerance: float = 0.001, ties: Sequence[str] = ()
) -> DataFrame:
    """Cheapest row among those whose metric is within `tolerance` of the best."""
    best = df.agg(F.max(metric).alias("best")).scalar()
    return df.filter(F.col(metric) >= best - F.lit(tolerance)).orderBy(F.col(cost).asc(), *ties).limit(1)


def marginal_gain(
    df: DataFrame, order: str, metric: str, cost: str, by: Sequence[str], per: float = 0.001
) -> DataFrame:
    """Step-to-step gain and extra cost along a sweep, one sweep per `by` group.

    A sweep has one row per setting, so a group is as small as the grid.
    """
    along = Window.partitionBy(*by).orderBy(order)
    gain = F.coalesce(F.col(metric) - F.lag(metric).over(along), F.lit(0.0))
    extra = F.coalesce(F.col(cost) - F.lag(cost).over(along), F.col(cost))
    return (
        df.withColumn("gain", gain)
        .withColumn("extra_cost", extra)
        .withColumn(
            "cost_per_step",
            F.when(F.col("gain") > 0, F.col("extra_cost") / (F.col("gain") / F.lit(per))),
        )
    )

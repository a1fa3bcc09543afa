import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.operators import aggregates as a
from creditloom.operators import ordering as o
from creditloom.operators import sampling as s
from creditloom.session import materialize

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def quantiles(df, cols=("v",), by=()):
    rows = o.exact_quantiles(df, list(cols), PROBS, by).collect()
    return {(*[r[k] for k in by], r["feature"], r["p"]): r["value"] for r in rows}


SHAPES = {
    "uniform": [random.Random(1).uniform(-50, 50) for _ in range(3000)],
    "heavy_tail": [random.Random(2).paretovariate(0.7) * 1000 for _ in range(3000)],
    "one_value": [4.25] * 500,
    "hot_value": [7.0] * 2000 + [random.Random(3).gauss(7, 1) for _ in range(1000)],
    "narrow_band": [1.7e9 + i % 997 for i in range(3000)],
    "tiny": [1e-12 * i for i in range(100)],
    "mixed_sign_zero": [-0.0, 0.0, -3.0, 3.0, 1e300, -1e300],
    "single": [3.5],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_are_exact(spark, shape):
    values = SHAPES[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    got = quantiles(df)
    for p in PROBS:
        assert got["v", p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_by_repeated_narrowing(spark, shape, monkeypatch):
    """With tiny limits every range is cut several times; the values stay exact."""
    monkeypatch.setattr(o, "SMALL", 3)
    monkeypatch.setattr(o, "CELLS", 4)
    values = SHAPES[shape]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    got = o.quantile_values(df, ["v"], [0.0, 0.5, 1.0])["v"]
    assert got == pytest.approx([float(np.quantile(values, p)) for p in (0.0, 0.5, 1.0)], rel=1e-12, abs=1e-300)


def test_quantiles_by_group_and_empty(spark):
    rows = [(g, float(v)) for g in (0, 1) for v in range(50 * (g + 1))] + [(None, 1.0), (2, None)]
    got = quantiles(spark.createDataFrame(rows, "g int, v double"), by=["g"])
    assert got[0, "v", 0.5] == 24.5 and got[1, "v", 0.5] == 49.5
    assert all(key[0] in (0, 1) for key in got)
    assert quantiles(spark.createDataFrame([(None,)], "v double")) == {}


def test_partition_count_does_not_matter(spark):
    df = spark.createDataFrame([(float(v),) for v in SHAPES["hot_value"]], "v double")
    assert quantiles(df.repartition(1)) == quantiles(df.repartition(13))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("shape", ["uniform", "hot_value", "narrow_band"])
def test_running_totals(spark, shape, descending):
    values = SHAPES[shape]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    rows = o.running_totals(df, "v", {"n": F.lit(1)}, descending=descending).collect()
    ordered = sorted(set(values), reverse=descending)
    got = {r["v"]: (r["n"], r["cum_n"], r["total_n"]) for r in rows}
    seen = 0
    for v in ordered:
        n = values.count(v)
        seen += n
        assert got[v] == (n, seen, len(values))


def test_rank_with_a_value_shared_by_most_rows(spark):
    rows = [(i, 5.0 if i % 3 else float(i % 7)) for i in range(900)]
    got = {r["k"]: r["rank"] for r in o.rank_by(spark.createDataFrame(rows, "k long, v double"), "v", "k").collect()}
    expected = {k: i + 1 for i, (k, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == expected


def test_rank_spreads_a_heavy_value_beside_close_ones(spark, monkeypatch):
    written = []
    monkeypatch.setattr(o, "materialize", lambda df, name: written.append(materialize(df, name)) or written[-1])
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # at this size Spark would merge all parts
    rows = spark.range(60_000).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN 5.0D ELSE 5.0D + (id % 1000 - 500) * 1e-12D END AS v")
    ranked = o.rank_by(rows.repartition(6), "v", "k", descending=False).cache()
    want = Window.orderBy("v", "k")
    assert ranked.withColumn("want", F.row_number().over(want)).filter("rank <> want").isEmpty() and ranked.count() == 60_000
    # of the parts that were sorted, none holds much more than its share
    parts = written[0].groupBy(F.shiftright("__at", o.PART_BITS)).count().agg(F.max("count")).first()[0]
    assert parts < 3 * 60_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked.unpersist()
    spark.conf.set(merging, "true")
    assert o.rank_by(rows.limit(0), "v", "k").count() == 0


def test_quantile_bands(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)] + [(0, None)], "k int, v double")
    rows = {r["k"]: r for r in o.quantile_bands(df, "v").collect()}
    assert rows[0]["band"] is None and rows[0]["band_label"] == "Não informado"
    assert rows[1]["band"] == 0 and rows[100]["band"] == 9
    assert rows[10]["band"] == 0 and rows[11]["band"] == 1  # edge 10.9
    counts = {}
    for r in rows.values():
        counts[r["band"]] = counts.get(r["band"], 0) + 1
    assert [counts[b] for b in range(10)] == [10] * 10


def test_bands_of_few_values(spark):
    three = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (9.0,)], "v double")
    # q = 3 distinct values: edges at 0, 1/3, 2/3, 1 are 1, 2, 2, 9 and the repeat collapses
    assert sorted(r["band"] for r in o.quantile_bands(three, "v").collect()) == [0, 0, 0, 1]
    one = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert {(r["band"], r["band_label"]) for r in o.quantile_bands(one, "v").collect()} == {(0, "4.00 - 4.00")}
    close = spark.createDataFrame([(1e9 + i,) for i in range(30)], "v double")
    assert len(o.band_edges(close, "v", 10)) == 11
    none = spark.createDataFrame([(None,)], "v double")
    assert o.quantile_bands(none, "v").first()["band_label"] == "Não informado"


def test_fixed_bands(spark):
    df = spark.createDataFrame([(17,), (18,), (22,), (23,), (102,), (103,), (None,)], "age int")
    assert [r["band_lo"] for r in o.fixed_bands(df, "age").collect()] == [None, 18, 18, 23, 98, None, None]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 2.1, None)], "v double")
    rows = a.histogram(df, "v", [0.0, 1.0, 2.0]).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [1, 3]
    flat = spark.createDataFrame([(3.0,)] * 4, "v double")
    rows = a.histogram(flat, "v", bins=4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 0, 4, 0] and (rows[0]["lo"], rows[-1]["hi"]) == (2.5, 3.5)


def test_moments_skew_is_bias_corrected(spark):
    values = [1.0, 2.0, 2.0, 3.0, 10.0]
    row = a.moments(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    n, m = len(values), np.mean(values)
    g1 = np.mean((np.array(values) - m) ** 3) / np.std(values) ** 3
    assert row["skew"] == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2))
    assert row["median"] == 2.0


# ---------------------------------------------------------------- samples

def test_split_shares_and_determinism(spark):
    df = spark.range(5000).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") % 10 == 0).cast("int").alias("TARGET"))
    one = s.stratified_split(df.repartition(3), train=0.7, test=0.2, demo=0.1)
    two = s.stratified_split(df.repartition(9), train=0.7, test=0.2, demo=0.1)
    counts = {(r["TARGET"], r["split"]): r["count"] for r in one.groupBy("TARGET", "split").count().collect()}
    assert counts == {(1, "train"): 350, (1, "test"): 100, (1, "demo"): 50, (0, "train"): 3150, (0, "test"): 900, (0, "demo"): 450}
    assert one.exceptAll(two).isEmpty()
    with pytest.raises(ValueError, match="sum to 1"):
        s.stratified_split(df, train=0.7, test=0.2, demo=0.2)


def test_sample_sizes(spark):
    df = spark.range(1000).withColumnRenamed("id", "SK_ID_CURR")
    assert s.sample_n(df, 137).count() == 137
    assert s.sample_n(df, 5000).count() == 1000
    assert s.sample_n(df, 0).count() == 0
    assert s.sample_fraction(df, 0.25).count() == 250


def test_cuts_by_more_digits(spark, monkeypatch):
    """With a tiny limit the cuts are found digit by digit, down to the whole hash."""
    df = spark.range(2000).withColumnRenamed("id", "SK_ID_CURR")
    ordered = [r["SK_ID_CURR"] for r in df.orderBy(s.hash_order("SK_ID_CURR", 42)).collect()]
    for small in (5, 0):
        monkeypatch.setattr(s, "SMALL", small)
        assert {r["SK_ID_CURR"] for r in s.sample_n(df, 777).collect()} == set(ordered[:777])


def test_undersample_and_folds(spark):
    df = spark.range(1000).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") < 80).cast("int").alias("TARGET"))
    counts = {r["TARGET"]: r["count"] for r in s.undersample(df).groupBy("TARGET").count().collect()}
    assert counts == {0: 80, 1: 80}
    folds = s.k_fold(df, 5).groupBy("TARGET", "fold").count().collect()
    assert len(folds) == 10 and {r["count"] for r in folds} == {16, 184}

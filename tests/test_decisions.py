import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import drift as d
from creditloom.operators import joins as j
from creditloom.operators import metrics as m
from creditloom.operators import scoring as s
from creditloom.session import materialize


def scores(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], "y int, p double")


def test_triage_boundaries(spark):
    df = spark.createDataFrame([(1, 0.02), (2, 0.05), (3, 0.08), (4, 0.20)], "id int, p double")
    rows = s.triage(df, "id", "p", 0.08, F.lit("2026-01-01").cast("timestamp")).orderBy("client_id").collect()
    assert [r["action"] for r in rows] == [
        "autoaprovacao_candidata", "mesa_analise", "recusa_candidata", "recusa_candidata"
    ]
    assert [r["prediction"] for r in rows] == [0, 0, 1, 1] and all(r["human_in_the_loop"] for r in rows)
    queues = spark.createDataFrame([("odd",), (None,), ("recusa_candidata",)], "a string").select(s.queue_of(F.col("a")))
    assert [r[0] for r in queues.collect()] == ["mesa_analise", "mesa_analise", "recusa_candidata"]


def test_ranking_metrics_with_ties(spark):
    pairs = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.3), (0, 0.1)]
    row = m.ranking_metrics(scores(spark, pairs), "y", "p").first()
    assert row["pr_auc"] == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5)
    wins = [(a > b) + 0.5 * (a == b) for y, a in pairs if y for z, b in pairs if not z]
    assert row["roc_auc"] == pytest.approx(np.mean(wins))


def test_metrics_and_zero_division(spark):
    row = m.classification_metrics(scores(spark, [(1, 0.1), (0, 0.1)]), "y", "p", 0.5).first()
    assert (row["tp"], row["fp"], row["precision"], row["recall"], row["f_beta"], row["rejection"]) == (0, 0, 0, 0, 0, 0)
    row = m.classification_metrics(scores(spark, [(1, 0.5), (0, 0.6), (1, 0.1)]), "y", "p", 0.5).first()
    assert (row["tp"], row["fp"], row["fn"]) == (1, 1, 1)
    assert row["f_beta"] == pytest.approx(5 * 0.5 * 0.5 / (4 * 0.5 + 0.5))


def test_sweep_equals_single_thresholds(spark):
    df = scores(spark, [(i % 3 == 0, (i * 37 % 100) / 100) for i in range(200)])
    swept = m.threshold_sweep(df, "y", "p", [0.1, 0.5]).orderBy("threshold").collect()
    for row in swept:
        one = m.classification_metrics(df, "y", "p", row["threshold"]).first().asDict()
        assert row.asDict() == one


def test_portfolio_kpis(spark):
    df = spark.createDataFrame(
        [(700, 200, 30, 70, 1000, 0.7, 0.0, 0.27)],
        "tn int, fp int, fn int, tp int, test_rows int, recall double, precision double, rejection double",
    )
    row = m.portfolio_kpis(df).first()
    assert row["approved"] == 730 and row["base_default_rate"] == pytest.approx(0.1)
    assert row["post_model_default_rate"] == pytest.approx(30 / 730) and row["precision"] == pytest.approx(70 / 270)
    assert row["default_reduction"] == pytest.approx(1 - (30 / 730) / 0.1)


def test_portfolio_kpis_rebuilds_old_records(spark):
    df = spark.createDataFrame(
        [(1492, 15816, 0.69798, 61195, 0.3148), (0, 10, 1.0, 100, 0.3), (5, 10, 0.0, 100, 0.1)],
        "fn int, fp int, recall double, test_rows int, rejection double",
    )
    a, b, c = m.portfolio_kpis(df).orderBy(F.col("test_rows").desc(), "fn").collect()
    assert (a["tp"], a["tn"]) == (3448, 40439)
    assert (b["tp"], b["tn"]) == (20, 70)
    assert (c["tp"], c["tn"]) == (0, 85)


def test_psi(spark):
    ref = spark.createDataFrame([(float(i % 100), "a" if i % 10 else "b") for i in range(1000)], "x double, c string")
    assert d.psi_numeric(ref, ref, ["x"]).first()["psi"] == pytest.approx(0.0, abs=1e-12)
    shifted = ref.withColumn("x", F.col("x") + 40)
    assert d.psi_numeric(ref, shifted, ["x"]).first()["psi"] > 0.25
    half = ref.withColumn("c", F.when(F.monotonically_increasing_id() % 2 == 0, "a").otherwise("b"))
    assert d.psi_categorical(ref, half, ["c"]).first()["psi"] > 0.1
    edges = d.reference_edges(ref, ["x"])
    counted = d.psi_numeric(d.bin_counts(ref, ["x"], edges), shifted, ["x"], edges=edges, counted=True)
    assert counted.first()["psi"] == pytest.approx(d.psi_numeric(ref, shifted, ["x"]).first()["psi"])
    counted = d.psi_categorical(d.category_counts(ref, ["c"]), half, ["c"], counted=True)
    assert counted.first()["psi"] == pytest.approx(d.psi_categorical(ref, half, ["c"]).first()["psi"])
    empty = ref.filter("x < 0")
    assert d.psi_numeric(ref, empty, ["x"]).first()["psi"] is None
    flat = ref.withColumn("x", F.lit(1.0))
    assert d.psi_numeric(flat, ref, ["x"]).first()["psi"] == 0.0


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, 800), rng.normal(0.3, 1.2, 500)
    edges = np.unique(np.percentile(a, np.linspace(0, 100, 11)))
    pa, pb = (np.histogram(v, edges)[0] for v in (a, b))
    pa, pb = np.clip(pa / pa.sum(), 1e-6, None), np.clip(pb / pb.sum(), 1e-6, None)
    expected = float(np.sum((pb - pa) * np.log(pb / pa)))
    frames = [spark.createDataFrame([(float(x),) for x in v], "x double") for v in (a, b)]
    assert d.psi_numeric(*frames, ["x"]).first()["psi"] == pytest.approx(expected, rel=1e-9)


def test_psi_with_a_bin_the_other_side_lacks(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    act = ref.filter("x >= 50")
    counts = np.histogram(np.arange(100), np.percentile(np.arange(100), np.linspace(0, 100, 11)))[0] / 100
    got = np.histogram(np.arange(50, 100), np.percentile(np.arange(100), np.linspace(0, 100, 11)))[0] / 50
    a, b = np.clip(counts, 1e-6, None), np.clip(got, 1e-6, None)
    assert d.psi_numeric(ref, act, ["x"]).first()["psi"] == pytest.approx(float(np.sum((b - a) * np.log(b / a))))


def test_statuses(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.25,), (None,), (float("nan"),)], "psi double")
    assert [r[0] for r in df.select(d.psi_status(F.col("psi"))).collect()] == ["ok", "warn", "fail", "warn", "warn"]
    odd = spark.createDataFrame([("ok",), ("odd",)], "status string")
    assert odd.agg(d.worst_status(F.col("status"))).first()[0] == "fail"
    assert odd.agg(d.worst_status(F.col("status"), "warn")).first()[0] == "warn"


def test_run_checks(spark):
    runs = spark.createDataFrame(
        [(["a"], 0.2, 0.5, 1, 1, 0.08), ([], 0.05, 0.5, 1, 1, 0.25), (["a", "z"], None, 0.5, 1, 1, None)],
        "feature_columns array<string>, pr_auc double, recall double, fn int, fp int, threshold double",
    )
    assert [r["status"] for r in d.feature_contract(runs, ["a", "b"], ["a"]).collect()] == ["ok", "fail", "warn"]
    assert [r["status"] for r in d.baseline_check(runs).collect()] == ["ok", "warn", "fail"]
    assert [r["status"] for r in d.threshold_coherence(runs, 0.08).collect()] == ["ok", "warn", "fail"]


def test_top_factors(spark):
    df = spark.createDataFrame([(1, 0.5, -0.2, 0.3, 0.0), (2, 0.0, 0.0, 0.0, 0.0)], "id int, a double, b double, c double, z double")
    rows = [tuple(r) for r in s.top_factors(df, "id", ["a", "b", "c", "z"]).collect()]
    assert [(r[1], r[2], r[3], round(r[4], 6)) for r in rows] == [
        ("risk", 1, "a", 50.0), ("risk", 2, "c", 30.0), ("protective", 1, "b", 20.0)
    ]


def test_whatif_and_diff(spark):
    df = spark.createDataFrame(
        [(1, 100000.0, 200000.0, 12000.0, 0.0, 0.0, 0.0), (2, 50.0, 10.0, 5.0, 5.0, 10.0, 1.0)],
        "SK_ID_CURR int, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, CREDIT_INCOME_RATIO double,"
        "ANNUITY_INCOME_RATIO double, LOG_AMT_CREDIT double",
    )
    asked = spark.createDataFrame(
        [(1, "AMT_CREDIT", "250000"), (1, "NOPE", "1"), (1, "AMT_ANNUITY", "12000")], "client_id int, feature string, value string"
    )
    out = s.recalculate(s.apply_overrides(df, asked, "SK_ID_CURR"))
    row = out.filter("SK_ID_CURR = 1").first()
    assert (row["CREDIT_INCOME_RATIO"], row["ANNUITY_INCOME_RATIO"]) == (2.5, 0.12)
    assert row["LOG_AMT_CREDIT"] == pytest.approx(np.log1p(250000))
    changes = {r["SK_ID_CURR"]: r["overrides"] for r in s.override_diff(df, out, asked, "SK_ID_CURR").collect()}
    assert list(changes) == [1] and list(changes[1]) == ["AMT_CREDIT"]
    assert tuple(changes[1]["AMT_CREDIT"]) == ("200000.0", "250000.0")


def test_map_categories(spark):
    dictionary = spark.createDataFrame([(0, "N"), (1, "Y"), (2, "Higher / Education"), (3, "1")], "position int, category string")
    texts = spark.createDataFrame([("higher education",), ("y",), ("??",), (None,), ("zzz",)], "v string")
    assert [r["c"] for r in j.map_categories(texts, "v", dictionary, "c").collect()] == ["Higher / Education", "Y", None, None, None]
    numbers = spark.createDataFrame([(1.0,), (0.0,), (7.0,), (None,)], "v double")
    assert [r["c"] for r in j.map_categories(numbers, "v", dictionary, "c").collect()] == ["Y", "N", None, None]


def test_joins(spark):
    left = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, v double")
    right = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0)], "k int, v double")
    assert not j.aligned_equal(left, right, "k", "v") and j.aligned_equal(left, left, "k", "v")
    with pytest.raises(KeyError, match="9"):
        j.lookup_rows(left, spark.createDataFrame([(9,), (1,)], "k int"), "k")
    assert j.lookup_rows(left, spark.createDataFrame([(1,), (1,)], "k int"), "k").count() == 1
    assert j.search_rows(left, "  ", None, ["v"]).count() == 3
    assert j.align_categories(left.filter("k = 1"), left, ["v"]).filter("v IS NOT NULL").count() == 1


def test_alignment_of_many_columns_reads_the_known_values_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(j, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    train = spark.createDataFrame([("a", "x", 1, True), ("b", None, 2, True)], "c string, d string, n int, f boolean")
    other = spark.createDataFrame([("a", "z", 2, False), ("q", "x", 3, True), (None, None, None, None)], train.schema)
    got = j.align_categories(train, other, ["c", "d", "n", "f"])
    assert got.schema == other.schema and written == ["categories"]
    assert {tuple(r) for r in got.collect()} == {("a", None, 2, None), (None, "x", None, True), (None,) * 4}
    assert j.align_categories(train, other, []).collect() == other.collect()


def test_segment_risk_keeps_missing_group(spark):
    df = spark.createDataFrame([("a", 0.1, 1.0), ("a", 0.3, 2.0), (None, 0.5, None)], "seg string, p double, amt double")
    rows = {(r["attribute"], r["segment"]): (round(r["mean_risk"], 6), r["clients"]) for r in s.segment_risk(df, "p", ["seg"], ["amt"]).collect()}
    assert rows["seg", "Não informado"] == (0.5, 1) and rows["seg", "a"] == (0.2, 2)
    assert rows["amt", "Não informado"] == (0.5, 1)


def test_benchmark_answers_for_any_value(spark):
    portfolio = spark.createDataFrame([(i, float(10 * i)) for i in range(1, 11)], "id int, x double")
    clients = spark.createDataFrame([(1, 10.0), (2, 55.0), (3, 5.0), (4, 1000.0), (5, None), (6, 55.0)], "id int, x double")
    got = {r["id"]: r["percentile"] for r in s.portfolio_benchmark(portfolio, clients, "id", ["x"]).collect()}
    assert got == {1: 10.0, 2: 50.0, 3: 0.0, 4: 100.0, 6: 50.0}


def test_benchmark_of_several_features_with_rate_and_size(spark):
    rows = [(i, float(i % 50), 1e6 + i * 1e-3, 7 if i % 3 else None, None if i % 10 == 0 else i % 2, None) for i in range(300)]
    portfolio = spark.createDataFrame(rows, "id int, a double, b double, c int, y int, e double")
    clients = spark.createDataFrame([(1, 3.0, 1e6, 7, 0, 1.0), (2, 3.5, 1e6 + 0.1, 8, 1, 2.0), (None, 1.0, 1.0, 1, 1, 1.0)], portfolio.schema)
    got = s.portfolio_benchmark(portfolio, clients, "id", ["a", "b", "c", "e"], "y").collect()
    share = lambda c, v: 100 * np.mean([r[c] <= v for r in rows if r[c] is not None])
    assert {(r["id"], r["feature"]): pytest.approx(r["percentile"]) for r in got} == {
        (i, f): share(c, v) for i, values in ((1, (3.0, 1e6, 7)), (2, (3.5, 1e6 + 0.1, 8))) for c, (f, v) in enumerate(zip("abc", values), 1)
    }
    assert {(r["sample_size"], round(r["portfolio_default_rate"], 9)) for r in got} == {(300, round(np.mean([r[4] for r in rows if r[4] is not None]), 9))}
    empty = s.portfolio_benchmark(portfolio.limit(0), clients, "id", ["a", "b"], "y")
    assert empty.count() == 0


def test_unreadable_overrides_are_listed(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "id int, x double, c string")
    rows = [(1, "x", "abc"), (1, "x", "3.5"), (1, "c", None), (1, "nope", "1"), (1, None, "1")]
    scenarios = spark.createDataFrame(rows, "client_id int, feature string, value string")
    found = {(r["feature"], r["value"]): r["reason"] for r in s.rejected_overrides(df, scenarios, "id").collect()}
    assert found == {
        ("x", "abc"): "unreadable value", ("c", None): "no value", ("nope", "1"): "unknown feature",
        (None, "1"): "unknown feature",
    }


def test_booleans_match_yes_and_no(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, own boolean")
    words = spark.createDataFrame([(0, "Y"), (1, "N")], "position int, category string")
    got = {r["id"]: (r["own"], r["flag"]) for r in j.map_categories(df, "own", words, "flag").collect()}
    assert got == {1: (True, "Y"), 2: (False, "N"), 3: (None, None)}

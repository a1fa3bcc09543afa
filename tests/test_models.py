import pytest
from pyspark.sql import functions as F

from creditloom.operators import models
from creditloom.operators.quality import QualityError
from creditloom.plans import training

SPECS = [
    models.ModelSpec("lr", "lr", {"maxIter": 20}, 0.0),
    models.ModelSpec("rf", "rf", {"numTrees": 5, "maxDepth": 3}, 0.0),
    models.ModelSpec("gbt", "gbt", {"maxIter": 3, "maxDepth": 2}),
]


@pytest.fixture(scope="module")
def table(spark):
    """The label follows x, c carries a little, n is empty, some values are missing."""
    i = F.col("id")
    return spark.range(800).select(
        i.alias("SK_ID_CURR"),
        ((i * 37 % 100) < 20).cast("int").alias("TARGET"),
        F.when(i % 11 != 0, (i * 37 % 100) + (i % 13)).cast("double").alias("x"),
        (i % 17).cast("double").alias("noise"),
        F.lit(None).cast("double").alias("n"),
        F.when(i % 9 != 0, F.when((i * 37 % 100) < 30, "low").otherwise("high")).alias("c"),
    )


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_models_learn(spark, table, spec):
    split = training.split_table(table, train=0.7, test=0.25, demo=0.05)
    features = training.model_features(split, "full")
    assert features == ["x", "noise", "n", "c"]
    model = models.fit(training.part(split, "train"), spec, features)
    assert model.features == ["x", "noise", "c"]  # n has no value
    row = models.evaluation_row(training.part(split, "test"), model, 0.5).first()
    assert row["roc_auc"] > 0.85 and row["model"] == spec.name
    top = models.feature_importance(split, model).first()["feature"]
    assert top in ("x", "c")


def test_gbt_scores_fits_every_round(spark, monkeypatch):
    from creditloom.queries import models as registered

    fitted = []
    monkeypatch.setattr(registered, "scored_by", lambda spec, *_: fitted.append(spec))
    registered.gbt_scores(spark, "anywhere")
    assert fitted == [models.BOOSTED] and fitted[0].params["maxIter"] == 300 and fitted[0].params["maxDepth"] == 5


def test_settings_share_one_encoding(spark, table, monkeypatch):
    specs = [SPECS[0], SPECS[2], models.ModelSpec("lr_5", "lr", {"maxIter": 20}, 5.0)]
    train, test = table.filter("SK_ID_CURR % 4 > 0"), table.filter("SK_ID_CURR % 4 = 0")
    features, encodings = ["x", "noise", "n", "c"], []
    encode = models.encode
    monkeypatch.setattr(models, "encode", lambda *a: encodings.append(a[3]) or encode(*a))
    rows = {r["setting"]: r for r in models.sweep(train, test, specs, features, 0.4).collect()}
    assert encodings == [True, False]  # once for the linear models, once for the trees
    for i, spec in enumerate(specs):
        alone = models.evaluation_row(test, models.fit(train, spec, features), 0.4).first()
        assert rows[i]["model"] == spec.name and rows[i]["fit_seconds"] > 0
        for metric in ("pr_auc", "roc_auc", "tn", "fp", "fn", "tp", "f_beta"):
            assert rows[i][metric] == pytest.approx(alone[metric], abs=1e-9)
    with pytest.raises(ValueError, match="gbt"):
        models.fit_settings(encode(train, test, features, True), [SPECS[2]], 0.4)


def test_sweep_over_folds(spark, table):
    folded = table.withColumn("fold", (F.col("SK_ID_CURR") % 2).cast("int"))
    rows = models.sweep_folds(folded, SPECS[:1], ["x", "c"], 0.4, k=2).orderBy("fold").collect()
    alone = models.cross_validate(folded, SPECS[0], ["x", "c"], 0.4, k=2).orderBy("fold").collect()
    assert [r["fold"] for r in rows] == [0, 1]
    assert [r["pr_auc"] for r in rows] == pytest.approx([r["pr_auc"] for r in alone])


def test_contributions_add_up_to_the_log_odds(spark, table):
    model = models.fit(table, SPECS[0], ["x", "noise", "c"])
    parts = models.contributions(table, model)
    total = parts.select("SK_ID_CURR", (F.col("x") + F.col("noise") + F.col("c")).alias("t"))
    scored = models.score(table, model, 0.5).select(
        "SK_ID_CURR", F.ln(F.col("probability") / (1 - F.col("probability"))).alias("z")
    )
    spread = scored.join(total, "SK_ID_CURR").agg(F.stddev(F.col("z") - F.col("t")).alias("s")).first()["s"]
    assert spread < 1e-6  # equal up to the constant (the log-odds at the means)


def test_train_run_and_save(spark, table, tmp_path):
    model, demo, record = training.train_run(table, SPECS[1], 0.5, train=0.7, test=0.2, demo=0.1)
    row = record.first()
    assert row["feature_columns"] == ["x", "noise", "c"] and sum(row["rows"]) == 800
    assert demo.count() == row["rows"]["demo"]
    models.save(models.fit(table, SPECS[0], ["x"]), str(tmp_path / "m"))
    models.save(model, str(tmp_path / "m"), 0.3)
    again, threshold = models.load(spark, str(tmp_path / "m"))
    assert threshold == 0.3 and again.spec == model.spec and again.labels == model.labels == {"c": ["high", "low"]}
    left, right = (models.score(table, m, threshold) for m in (model, again))
    assert left.exceptAll(right).isEmpty() and right.count() == 800
    with pytest.raises(QualityError, match="noise absent"):
        models.score(table.drop("noise"), again, threshold)
    with pytest.raises(QualityError, match="x is not a number"):
        models.score(table.withColumn("x", F.lit("a")), again, threshold)


def test_rare_categories_share_an_index(spark, table):
    rows = table.withColumn("many", F.concat(F.lit("c"), F.least(F.col("SK_ID_CURR") % 40, F.col("SK_ID_CURR") % 7).cast("string")))
    index = models.category_index(rows, ["many", "c"], 3).collect()
    counts = {(r["feature"], r["value"]): r["n"] for r in index}
    for name in ("many", "c"):
        order = sorted((v for f, v in counts if f == name), key=lambda v: (-counts[name, v], v))
        assert {r["value"]: r["position"] for r in index if r["feature"] == name} == {v: min(i, 3) for i, v in enumerate(order)}
    for spec in SPECS:
        model = models.fit(rows, spec, ["x", "many", "c"], most_categories=3)
        assert {c: len(x) for c, x in model.labels.items()} == {"many": 3, "c": 2}
        unseen = models.score(rows.limit(1).withColumn("many", F.lit("nowhere")), model, 0.5).first()["probability"]
        rare = models.score(rows.limit(1).withColumn("many", F.lit("c6")), model, 0.5).first()["probability"]
        assert unseen == rare
    wide = spark.range(30_000).selectExpr("CAST(id AS STRING) AS t", "CAST(id % 2 AS INT) AS TARGET", "CAST(id % 3 AS DOUBLE) AS x")
    assert len(models.fit(wide, SPECS[0], ["x", "t"], most_categories=50).labels["t"]) == 50


def test_decide_clients(spark, table):
    from creditloom.plans.decision import decide_clients

    model = models.fit(table, SPECS[0], ["x", "noise", "c"])
    ids = spark.createDataFrame([(1,), (2,), (2,)], "SK_ID_CURR long")
    asked = [(2, "x", "1.0"), (2, "c", " Low"), (2, "noise", "abc"), (1, "x", "900"), (1, "x", "nan"), (1, "c", "Sem Info")]
    asked = spark.createDataFrame(asked, "client_id long, feature string, value string")
    bounds = {"x": (0.0, 100.0)}
    rows = decide_clients(table, ids, asked, model, 0.3, F.lit("2026-01-01").cast("timestamp"), bounds=bounds).orderBy("client_id").collect()
    assert [r["client_id"] for r in rows] == [1, 2]
    assert rows[0]["applied_overrides"] is None
    assert [tuple(r) for r in rows[0]["rejected_overrides"]] == [("x", "900", "out of bounds"), ("x", "nan", "out of bounds")]
    assert [tuple(r) for r in rows[1]["rejected_overrides"]] == [("noise", "abc", "unreadable value")]
    assert rows[1]["applied_overrides"]["x"]["applied"] == "1.0"
    assert rows[1]["probability"] > 0.5 and rows[1]["action"] == "recusa_candidata"
    assert rows[1]["top_risk_factors"][0]["feature"] in ("x", "c")
    absent = spark.createDataFrame([(10**9,)], "SK_ID_CURR long")
    with pytest.raises(KeyError):
        decide_clients(table, absent, asked, model, 0.3, F.lit("2026-01-01").cast("timestamp"))


def test_split_compares_labels_in_their_type_and_refuses_others(spark):
    from creditloom.operators.sampling import k_fold, stratified_split

    df = spark.range(1000).selectExpr("id AS k", "CAST(id % 2 AS DOUBLE) AS y")
    assert stratified_split(df, "k", "y").filter("split IS NULL").isEmpty()
    assert k_fold(df, 5, "k", "y").groupBy("fold").count().count() == 5
    for odd in ("CAST(NULL AS DOUBLE)", "2.0D"):
        with pytest.raises(ValueError, match="1 rows"):
            stratified_split(df.union(spark.range(1).selectExpr("-1L", odd)), "k", "y")

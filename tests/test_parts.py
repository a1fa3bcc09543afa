import re

from pyspark.sql import functions as F

from creditloom.sources import fixtures as fx


def test_instalments_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    """A task's share of the join does not grow with the table, and every row and copy comes through."""
    keys = spark.range(1, 1001).withColumnRenamed("id", "o_orderkey")
    keys.selectExpr("o_orderkey", "o_orderkey % 7 AS o_custkey", "DATE '2001-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    lines = keys.selectExpr("o_orderkey AS l_orderkey", "explode(array(1, 2)) AS l_linenumber", "1e0 AS l_extendedprice", "0e0 AS l_discount", "DATE '2001-02-01' AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(fx, "ROWS_A_PART", 100)
    rows = fx.raw_installments(spark, str(tmp_path))
    shares = rows.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in shares) == 2400 and max(r["count"] for r in shares) < 400
    assert fx.parts_for(spark.range(450)) == 5 and fx.parts_for(spark.range(1)) == spark.sparkContext.defaultParallelism


def test_balances_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    """A task's share of the months does not grow with the table, and a month with very many copies is not sorted in one task."""
    from creditloom.queries.cleaning import clean_bureau_balance

    lines = spark.range(1200).selectExpr(
        "CASE WHEN id < 400 THEN 53 ELSE id END AS l_orderkey", "add_months(DATE '1990-01-01', CAST(id % 100 AS INT)) AS l_shipdate",
        "1L AS l_partkey", "'R' AS l_returnflag", "'F' AS l_linestatus",
    )
    lines.unionByName(lines.withColumn("l_returnflag", F.lit("N"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(fx, "ROWS_A_PART", 100)
    clean = clean_bureau_balance(spark, str(tmp_path))
    shares = clean.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in shares) == 801 and max(r["count"] for r in shares) < 100
    assert clean.select("STATUS").distinct().collect() == [("1",)]  # " 1" comes before "0"
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Sort") < plan.index("HashAggregate") < plan.index("Exchange")


def test_modelling_table_is_dealt_by_rows(spark, tmp_path, monkeypatch):
    """Every query over the modelling table gets the instalments and the contracts' months in parts that follow the rows."""
    from creditloom.queries import gold

    spark.range(20).selectExpr(
        "id AS c_custkey", "CONCAT('c', id) AS c_name", "CAST(id % 5 AS INT) AS c_nationkey", "CAST(id AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.range(1, 201).selectExpr(
        "id AS o_orderkey", "id % 20 AS o_custkey", "'F' AS o_orderstatus", "CAST(id AS DOUBLE) AS o_totalprice",
        "TIMESTAMP '2001-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    orders.selectExpr(
        "o_orderkey AS l_orderkey", "1L AS l_partkey", "explode(array(1, 2, 3)) AS l_linenumber", "1e0 AS l_extendedprice", "0e0 AS l_discount",
        "'R' AS l_returnflag", "'F' AS l_linestatus", "add_months(o_orderdate, l_linenumber) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(20).selectExpr(
        "id AS event_id", "TIMESTAMP '2001-01-02' AS ts", "id AS user_id", "'click' AS event_type", "1e0 AS value", "'' AS props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(fx, "ROWS_A_PART", 10)
    table = gold.abt(spark, str(tmp_path))
    plan = table._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#.*?, (\d+)\), REPARTITION_BY_NUM", plan)
    assert sorted(dealt) == [("SK_ID_BUREAU", "60"), ("l_orderkey", "60"), ("o_orderkey", "60")]
    rows = table.agg(F.count("*"), F.sum("INST_CNT_PARCELAS"), F.sum("BB_CNT_MONTHS")).first()
    assert tuple(rows) == (20, 600, 594)  # the months of orders 53, 106 and 159 are one and the same


def test_cuts_from_keys_need_no_read_of_the_table(spark, tmp_path):
    """The split and the folds are those of the whole table, which is read once, to write it."""
    from creditloom.operators.sampling import k_fold
    from creditloom.plans import training

    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        read.add(1)
        return x

    keys = spark.range(500).selectExpr("id AS SK_ID_CURR", "CAST(id % 4 = 0 AS INT) AS TARGET")
    table = keys.withColumn("x", counted(F.col("TARGET")))
    parts = {"train": 0.7, "test": 0.2, "demo": 0.1}
    found = training.split_table(table, keys=keys, **parts).select("SK_ID_CURR", "split")
    assert found.count() == 500 and read.value == 500
    assert found.exceptAll(training.split_table(keys, **parts).select("SK_ID_CURR", "split")).isEmpty()
    folds = k_fold(table, 5, keys=keys).select("SK_ID_CURR", "fold")
    assert folds.exceptAll(k_fold(keys, 5).select("SK_ID_CURR", "fold")).isEmpty()


def test_trees_encode_their_rows_once(spark, monkeypatch):
    from creditloom.operators import models

    written = []
    keep = models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, name: written.append(df.columns) or keep(df, name))
    table = spark.range(200).selectExpr("id AS SK_ID_CURR", "CAST(id % 3 = 0 AS INT) AS TARGET", "CAST(id % 5 AS DOUBLE) AS x", "CAST(id % 2 AS STRING) AS c")
    for kind, most in (("rf", {"numTrees": 2, "maxDepth": 2}), ("gbt", {"maxIter": 2, "maxDepth": 2}), ("lr", {"maxIter": 5})):
        model = models.fit(table, models.ModelSpec(kind, kind, most), ["x", "c"])
        assert models.score(table, model, 0.5).filter("probability BETWEEN 0 AND 1").count() == 200
    assert written == [["TARGET", "__weight", "features"]] * 2

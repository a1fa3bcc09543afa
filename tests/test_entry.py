import pytest

import __spark_entry__ as contract
from creditloom.sources.fixtures import TABLES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_twin(spark, con, name):
    from check_twins import differences

    df = contract.queries()[name](spark, SF)
    relation = con.sql(contract.oracle_sql()[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert differences(df.toPandas(), relation.df(), df.dtypes, types) is None

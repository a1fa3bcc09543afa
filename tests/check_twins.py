"""Run registered queries next to their DuckDB twins and print the differences.

    python tests/check_twins.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from creditloom.queries import QUERIES, TWINS, load_all  # noqa: E402
from creditloom.session import local_session  # noqa: E402
from creditloom.sources.fixtures import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].astype(object)
    out = out.map(lambda v: v.tolist() if hasattr(v, "tolist") and getattr(v, "ndim", 0) else v)
    out = out.map(lambda v: None if not isinstance(v, (list, dict)) and pd.isna(v) else v)
    out = out.map(lambda v: float(v) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
    out = out.map(lambda v: str(pd.Timestamp(v)) if hasattr(v, "year") else v)
    rows = sorted(map(repr, out.itertuples(index=False, name=None)))
    return pd.DataFrame({"row": rows})


SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(spark_df, twin_df, spark_types, twin_types) -> str | None:
    if sorted(spark_df.columns) != sorted(twin_df.columns):
        return f"columns {sorted(set(spark_df.columns) ^ set(twin_df.columns))}"
    if len(spark_df) != len(twin_df):
        return f"rows {len(spark_df)} vs {len(twin_df)}"
    kinds = [
        f"{c}:{a}/{twin_types[c]}" for c, a in spark_types if a in SAME and SAME[a] != twin_types[c]
    ]
    left, right = canonical(spark_df)["row"], canonical(twin_df)["row"]
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, e.g.\n    {wrong[0][0]}\n    {wrong[0][1]}"
    return f"types {' '.join(kinds)}" if kinds else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    load_all()
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = df.toPandas()
            took = time.time() - start
            if name in TWINS:
                relation = con.sql(TWINS[name])
                types = dict(zip(relation.columns, map(str, relation.types)))
                problem = differences(got, relation.df(), df.dtypes, types)
            else:
                problem = None if len(got) else "no rows"
        except Exception as error:  # noqa: BLE001
            took, problem, got = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        bad += problem is not None and not problem.startswith("types")
        kind = "sql" if name in TWINS else "rows"
        print(f"{'ok  ' if problem is None else 'DIFF'} {name:28s} {kind:4s} {len(got):7d} rows {took:6.2f}s {problem or ''}",
              flush=True)
    print(f"{len(names)} queries, {bad} wrong")


if __name__ == "__main__":
    main()

"""Name -> Spark query, and name -> SQL twin."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.queries.twins import nudge, twin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

MODULES = ("cleaning", "gold", "joins", "statistics", "quality", "metrics", "monitoring", "decisions", "sinks",
           "models", "streams")

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, as sums of doubles depend on the order of their terms.

    The nudge moves rounding boundaries away from short fractions such as halves, which
    would otherwise flip on the last bit. The twins round the same way.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    shift = nudge(digits)
    return df.withColumns({c: F.round(F.col(c) + shift, digits) for c in doubles}) if doubles else df


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = DIGITS):
    """Register a query; `doubles` lists the twin's columns to round like the query's."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(function(spark, sf_dir), digits)
        if sql is not None:
            TWINS[name] = twin(sql, doubles.split(), digits)
        return function

    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"creditloom.queries.{module}")

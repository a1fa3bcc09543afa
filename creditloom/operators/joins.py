"""Key joins: semi, anti, bridge, one-to-one attach, dictionary lookups.

The side that only answers "does the key exist" is reduced to distinct keys first, so a
key repeated many times there is merged before the shuffle. Spark splits a skewed key
on the other side at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions import normal_token
from creditloom.operators.cleaning import numeric_columns
from creditloom.session import materialize

# Tokens that stand for yes and no.
YES_TOKENS = ("y", "yes", "true")
NO_TOKENS = ("n", "no", "false")


class DuplicateKeyError(ValueError):
    """A side that must hold one row per key holds several."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; null keys are equal to each other."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise DuplicateKeyError(f"{name} holds duplicate {', '.join(keys)}")
    return df


def semi_filter(df: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the universe."""
    return df.join(universe.select(key).distinct(), key, "left_semi")


def inner_bridge(child: DataFrame, links: DataFrame, on: str, parent: str, check: bool = True) -> DataFrame:
    """Add the parent key to each child row through a distinct (child key, parent key) map."""
    pairs = links.select(on, parent).distinct()
    if check:
        require_unique(pairs, [on], "bridge")
    return child.join(pairs, on, "inner")


def left_attach(
    spine: DataFrame, side: DataFrame, key: str, name: str, check: bool = True
) -> DataFrame:
    """One-to-one left join; a clashing column of the side gets the suffix `_<name>`."""
    if check:
        require_unique(side, [key], name)
    clashes = {c: f"{c}_{name}" for c in side.columns if c != key and c in spine.columns}
    return spine.join(side.withColumnsRenamed(clashes), key, "left")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null child keys that no parent row has."""
    keys = child.select(F.col(child_key).alias("key")).filter("key IS NOT NULL").distinct()
    return keys.join(parent.select(F.col(parent_key).alias("key")).distinct(), "key", "left_anti")


def outside_universe(df: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    return df.join(universe.select(key).distinct(), key, "left_anti")


def unequal_after_align(left: DataFrame, right: DataFrame, key: str, col: str) -> DataFrame:
    """Rows of `left` whose value differs from `right` on the same key (NULL equals NULL)."""
    there = right.select(key, F.col(col).alias("__other"))
    return left.select(key, col).join(there, key, "left").filter(~F.col(col).eqNullSafe(F.col("__other")))


def aligned_equal(left: DataFrame, right: DataFrame, key: str, col: str) -> bool:
    return unequal_after_align(left, right, key, col).isEmpty()


def map_categories(df: DataFrame, col: str, dictionary: DataFrame, name: str) -> DataFrame:
    """Replace a value by the dictionary category with the same normalised token.

    `dictionary` has (position, category). A number 1 or 0, or a boolean, also matches a
    yes/no category, ahead of an equal token. The first position wins; no match gives NULL.
    """
    boolean = isinstance(df.schema[col].dataType, T.BooleanType)
    value = F.col(col).cast("int") if boolean else F.col(col)
    numeric = boolean or col in numeric_columns(df)
    token = normal_token(F.col("category"))
    options = dictionary.select("category", "position", token.alias("__token"), F.lit(1).alias("__turn"))
    if numeric:
        for digit, words in (("1", YES_TOKENS), ("0", NO_TOKENS)):
            alias = dictionary.filter(token.isin(*words)).select(
                "category", "position", F.lit(digit).alias("__token"), F.lit(0).alias("__turn")
            )
            options = options.unionByName(alias)
    chosen = (
        options.filter("__token <> ''")
        .groupBy("__token")
        .agg(F.min(F.struct("__turn", "position", "category")).alias("pick"))
        .select("__token", F.col("pick.category").alias("__category"))
    )
    keyed = df.withColumn("__token", normal_token(value, numeric))
    joined = keyed.join(chosen, "__token", "left")
    return joined.select(*[c for c in df.columns if c != name], F.col("__category").alias(name))


def align_categories(train: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values of `other` that never occur in `train` become NULL.

    One pass over `train` writes its distinct (column, value) pairs; each column then joins to its
    own, which Spark broadcasts if their written size allows.
    """
    if not cols:
        return other
    texts = train.select(*[F.col(c).cast("string").alias(c) for c in cols])
    pairs = texts.unpivot([], list(cols), "__feature", "__known").filter("__known IS NOT NULL").distinct()
    known = materialize(pairs, "categories")
    out = other
    for col in cols:
        mine = known.filter(F.col("__feature") == col).select("__known")
        joined = out.join(mine, F.col(col).cast("string") == F.col("__known"), "left")
        out = joined.withColumn(col, F.when(F.col("__known").isNotNull(), F.col(col))).drop("__known")
    return out


def label_column(col: Column, labels: Mapping[str, str]) -> Column:
    """Business label of a technical name, or the name itself."""
    if not labels:
        return col
    pairs = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(pairs[col], col)


def label_join(df: DataFrame, col: str, labels: DataFrame, name: str = "label") -> DataFrame:
    """Label from a (name, label) table, falling back to the technical name."""
    side = labels.select(F.col("name").alias("__name"), F.col("label").alias("__label"))
    joined = df.join(side, F.col(col) == F.col("__name"), "left")
    return joined.withColumn(name, F.coalesce("__label", F.col(col))).drop("__name", "__label")


def lookup_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of the wanted ids; an id without a row is an error. The ids are read once."""
    wanted = materialize(ids.select(key).distinct(), "wanted")
    absent = wanted.join(df.select(key), key, "left_anti").agg(F.count("*").alias("n"), F.min(key).alias("first")).first()
    if absent["n"]:
        raise KeyError(f"{absent['n']} of {key} not found, the first is {absent['first']}")
    return df.join(wanted, key, "left_semi")


def search_rows(
    df: DataFrame,
    query: str = "",
    in_lists: Mapping[str, Sequence[str]] | None = None,
    cols: Sequence[str] = (),
) -> DataFrame:
    """Rows that match every non-empty value list and contain the text, ignoring case."""
    out = df
    for col, values in (in_lists or {}).items():
        if values:
            out = out.filter(F.col(col).isin(*values))
    needle = query.strip().lower()
    if not needle:
        return out
    haystack = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))
    return out.filter(haystack.contains(needle))


def first_by_position(df: DataFrame, key: str, prefer: Column, position: str) -> DataFrame:
    """One row per key: the last preferred row, else the first row."""
    order = Window.partitionBy(key).orderBy(prefer.desc(), F.when(prefer, F.col(position)).desc(), F.col(position).asc())
    return df.withColumn("__row", F.row_number().over(order)).filter("__row = 1").drop("__row")

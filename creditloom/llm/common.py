"""Column expressions and joins that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
"""The characters that separate words, as the inside of a regular expression's class."""


def text_of(column: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than SPACE."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words; long, 0 for an empty text."""
    return F.size(words(text)).cast("long")


def attach_by_leaf(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Join a row per group back to the rows, when one group may hold a third of them.

    `rows` carry a column `leaf`, a function of the row's identity with a few hundred values.
    Groups first meet the distinct (leaf, key) pairs, at most one per leaf and group, and the
    rows then join on (leaf, key): a hot group is spread over as many keys as there are leaves.
    """
    leaves = rows.select("leaf", *keys).distinct()
    return rows.join(leaves.join(groups, keys), ["leaf", *keys])

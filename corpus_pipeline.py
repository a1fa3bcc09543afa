"""The corpus pipeline: stages over documents, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.divergence import quality_rules
from creditloom.llm.fair_mix import fair_mix, mixed_documents
from creditloom.llm.line_dedup import line_dedup
from creditloom.llm.odd_sketch import near_duplicates
from creditloom.llm.queries import bpe_digests
from creditloom.session import materialize, recorded, remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
left_by_last: list[str] = []


def clearing(stage: Stage) -> Stage:
    """The stage, which first deletes the intermediate tables of the stage before, as its output is written by then.

    Tables that `docs` still reads, as when it was not written, stay.
    """

    @wraps(stage)
    def cleared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if left_by_last:
            read = docs.inputFiles()
            remove(spark, [folder for folder in left_by_last if not any(folder in file for file in read)])
            left_by_last.clear()
        with recorded() as folders:
            result = stage(spark, docs, sf_dir)
        left_by_last.extend(folders)
        return result

    return cleared


@clearing
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, row by row; null and empty texts go."""
    return quality_rules(docs).where("kept").select("row.*")


@clearing
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more share; n_chars follows the text.

    Every row stays, repeated ones and null identifiers too; a null text becomes an empty one.
    """
    found = line_dedup(docs, payload=[c for c in docs.columns if c not in ("text", "n_chars")])
    return found.select("row.*", F.col("kept_text").alias("text"), F.length("kept_text").cast("long").alias("n_chars"))


@clearing
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest identifier; of rows repeated as a whole, one.

    Rows of one identifier, null ones too, are told apart by a hash of identifier and text. Those that agree in
    both are one; null and empty texts are equal, and kept once per identifier. Which rows stay is decided on hashes; the rows
    are shuffled once, by hash, repeated ones combined before.
    """
    row = F.struct(*docs.columns).alias("row")
    hashed = docs.select(F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("row_hash"), "doc_id", "text", row)
    found = near_duplicates(hashed, id_col="row_hash").select(F.col("doc_id").alias("row_hash"), "component_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_hash"))
    stay = found.join(hashed.select("row_hash", "doc_id").distinct(), "row_hash").groupBy("component_id").agg(first.alias("f"))
    unique = hashed.select("row_hash", "row").dropDuplicates(["row_hash"])
    return unique.join(stay.select(F.col("f.row_hash").alias("row_hash")), "row_hash", "left_semi").select("row.*")


@clearing
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words, or beyond the budget, are not taken.

    Repeated rows and null identifiers are documents of their own; null sources are one source.
    """
    return mixed_documents(fair_mix(docs))


@clearing
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the digests of ids and decoded text, one row per row; null texts are encoded as empty."""
    return bpe_digests(docs)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("mix", mix), ("encode", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

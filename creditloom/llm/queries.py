"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import byte_bpe, warc
from creditloom.llm.backoff import backoff_scores
from creditloom.llm.cotrain import co_train, document_features, score
from creditloom.llm.divergence import quality_rules
from creditloom.llm.fair_mix import fair_mix
from creditloom.llm.language import fit_language, is_held_out, predict_language
from creditloom.llm.line_dedup import line_dedup
from creditloom.llm.odd_sketch import near_duplicates
from creditloom.llm.pii_crf import KINDS, personal_data
from creditloom.llm.spelling import count_words, group_variants
from creditloom.llm.tree_dedup import tree_dedup
from creditloom.llm.whitening import fit_whitening, whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            TWINS[name] = sql
        return function

    return keep


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register("op1_skip_chain_pii")
def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(documents(spark, sf_dir))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


@register("op2_stupid_backoff")
def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(documents(spark, sf_dir))


@register("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir)).drop("ids")


def bpe_digests(docs: DataFrame) -> DataFrame:
    vocabulary = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(byte_bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN))


@register("op4_warc_derivatives")
def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derivatives(warc.responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return records.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "source_digest",
        F.octet_length("block").cast("long").alias("n_bytes"), "block_digest",
        F.sha2("record", 256).alias("record_sha256"),
    )


@register("op5_cotraining")
def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    features = document_features(docs)
    model = co_train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), features=features)
    return score(docs, model, features=features)


@register("op6_divergence")
def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), payload=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_divergence", 6).alias("char_divergence"), F.round("word_divergence", 6).alias("word_divergence"),
    )


@register(
    "op7_tree_dedup",
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
)
def op7_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_dedup(documents(spark, sf_dir), keep="largest")


@register(
    "op8_line_dedup",
    r"""
    WITH lines AS (
      SELECT doc_id, n, line,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)),
    common AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
    FROM lines LEFT JOIN common USING (key) GROUP BY doc_id
    """,
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(documents(spark, sf_dir), min_docs=10, payload=["doc_id"])
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op9_odd_sketch")
def op9_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@register(
    "op10_fair_mix",
    r"""
    WITH sized AS (
      SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src, md5(CAST(doc_id AS VARCHAR)) AS key,
             CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '')) AS BIGINT) AS size
      FROM documents),
    per_source AS (
      SELECT src, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS weight
      FROM sized GROUP BY src),
    levels AS (
      SELECT *, 3 * source_size AS cap,
             ((SELECT sum(size) FROM sized)
              - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, src
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY 3 * source_size / weight, src
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM per_source),
    targets AS (
      SELECT src, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM levels),
    queued AS (
      SELECT doc_id, src, key, size, source_size, target,
             sum(size) OVER (PARTITION BY src ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto
      FROM sized JOIN targets USING (src)),
    copies AS (
      SELECT doc_id, src, key, size, e, (e * source_size + upto) / target AS finish
      FROM queued, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0),
    filled AS (
      SELECT doc_id, size, sum(size) OVER (ORDER BY finish, src, key, e ROWS UNBOUNDED PRECEDING)
                           <= (SELECT sum(size) FROM sized) AS fits
      FROM copies),
    taken AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM filled WHERE fits GROUP BY doc_id)
    SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken
    FROM queued LEFT JOIN taken USING (doc_id)
    """,
)
def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = fair_mix(documents(spark, sf_dir), payload=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@register("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(documents(spark, sf_dir), min_length=5, min_count=3, drop_one_in=97))


@register("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_language(docs, learn_from=~is_held_out("doc_id"))
    found = predict_language(docs, model)
    return found.select("doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted")


@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(vectors, fit_whitening(vectors))

"""WARC derivatives: metadata and plain-text conversion records of response records."""

from __future__ import annotations

import html
import html.entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

CRLF = "\r\n"
HIDDEN = (
    r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script[ \t\r\n]*>|\z)|style\b.*?(?:</style[ \t\r\n]*>|\z)"
    r"|title\b.*?(?:</title[ \t\r\n]*>|\z))"
)
BREAKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main"
    r"|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^<>]*>"
)
TAG = r"<[a-zA-Z/!?][^<>]*>"
NO_BREAK_SPACE = re.compile(r"&(?:nbsp;?|#0*160(?![0-9]);?|#[xX]0*[aA]0(?![0-9a-fA-F]);?)")
LONG_NUMBER = re.compile(r"&#[0-9]{8,}")
REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)[;=]?")
LINK = re.compile(r"<[aA](?=[ \t\r\n\f/])")
ATTRIBUTE = re.compile(
    r"""[ \t\r\n\f/]*([^ \t\r\n\f/<>=][^ \t\r\n\f/<>=]*)"""
    r"""(?:[ \t\r\n\f]*=[ \t\r\n\f]*(?:"([^"]*)"|'([^']*)'|((?!["'])[^ \t\r\n\f>]+)))?"""
)
CLOSE = re.compile(r"[ \t\r\n\f/]*>")


def responses(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Response records of crawled pages.

    The record id is made from page, address and payload, so a rerun names the same record. Null
    addresses become about:blank, null payloads empty.

    Returns page_id, record_id, target_uri, date, http (array of header lines), payload, digest.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("about:blank")), r"[\x00-\x20]+", "")
    return pages.select(
        F.col(id_col).alias("page_id"),
        _record_id("response", F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), url, payload)).alias(
            "record_id"
        ),
        url.alias("target_uri"),
        F.lit(date).alias("date"),
        F.array(
            F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
            F.concat(F.lit("Content-Length: "), F.octet_length(payload)),
        ).alias("http"),
        payload.alias("payload"),
        _digest(payload).alias("digest"),
    )


def derivatives(source: DataFrame) -> DataFrame:
    """Two records for each response: metadata, and the page's text as a conversion.

    Both refer to the response (WARC-Refers-To and its target and date) and to each other (the
    conversion is WARC-Concurrent-To the metadata). Metadata fields are the source's payload digest
    and header lines, the title, the language and the outlinks as they stand; the conversion repeats
    the digest and content type of its source and has its own block digest. Text: comments, scripts,
    styles and the title go, block elements break lines, other tags vanish, named and numeric character
    references are resolved (no-break spaces become spaces), white space is collapsed. Outlinks are the
    first href of every link, with or without quotes. Tags left open never swallow text beyond the next "<"; an open comment or
    script hides the rest, as in a browser.

    Everything is a projection of the row, references and outlinks in Arrow batches: nothing is shuffled. Null or empty payloads give an empty
    conversion. Equal response rows give equal records.

    Returns page_id, record_type, record_id, refers_to, target_uri, content_type, source_digest,
    source_headers, block, block_digest, record (the whole record as text, without the final blank
    lines that `write_warc` adds).
    """
    shown = F.regexp_replace("payload", HIDDEN, " ")
    title = F.regexp_extract("payload", r"(?is)<title\b[^<>]*>(.*?)</title", 1)
    lang = F.regexp_extract("payload", r"(?is)<html\b[^<>]*\blang=[\"']?([A-Za-z-]+)", 1)
    read = source.select(
        "page_id", "record_id", "target_uri", "date", "http", "digest", lang.alias("lang"),
        _resolved(title).alias("title"), _links(shown).alias("links"), _resolved(_untagged(shown)).alias("text"),
    )
    fields = F.concat(
        F.array(F.concat(F.lit("source-digest: "), F.col("digest"))),
        F.transform("http", lambda h: F.concat(F.lit("source-header: "), h)),
        _field("title", _squeeze(F.col("title"))),
        _field("language", F.lower("lang")),
        F.transform("links", lambda x: F.concat(F.lit("outlink: "), _squeeze(x))),
    )
    meta, text = F.concat(F.array_join(fields, CRLF), F.lit(CRLF)), _plain(F.col("text"))
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("record_type"), _record_id("metadata", F.col("record_id")).alias("id"),
            F.lit("application/warc-fields").alias("content_type"), meta.alias("block"),
            F.lit("").alias("beside"),
        ),
        F.struct(
            F.lit("conversion").alias("record_type"), _record_id("conversion", F.col("record_id")).alias("id"),
            F.lit("text/plain; charset=utf-8").alias("content_type"), text.alias("block"),
            _record_id("metadata", F.col("record_id")).alias("beside"),
        ),
    )
    each = read.select(
        "page_id", "record_id", "target_uri", "date", "http", "digest", F.explode(kinds).alias("r")
    ).select(
        "page_id", "r.record_type", F.col("r.id").alias("record_id"), F.col("record_id").alias("refers_to"),
        "target_uri", "date", "r.content_type", F.col("digest").alias("source_digest"),
        F.col("http").alias("source_headers"), "r.beside", "r.block", _digest(F.col("r.block")).alias("block_digest"),
    )
    head = [
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("target_uri")), ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Refers-To-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Date", F.col("date")),
        ("WARC-Concurrent-To", F.when(F.col("beside") != "", F.col("beside"))),
        ("WARC-Source-Payload-Digest", F.col("source_digest")), ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")), ("Content-Length", F.octet_length("block").cast("string")),
    ]
    lines = F.concat_ws(CRLF, F.lit("WARC/1.1"), *[F.concat(F.lit(f"{name}: "), value) for name, value in head])
    return each.withColumn("record", F.concat(lines, F.lit(CRLF * 2), "block")).drop("date", "beside")


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one per task; Spark's line separator ends each record."""
    records.select("record").write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


def _record_id(kind: str, of: Column) -> Column:
    h = F.md5(F.concat(F.lit(f"{kind}|"), of))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _field(name: str, value: Column) -> Column:
    return F.when(value == "", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit(f"{name}: "), value)))


def _unescape(text: str) -> str:
    """The text with character references resolved; numbers too long for int() are cut, as no character has them."""
    if "&" not in text:
        return text
    text = LONG_NUMBER.sub(lambda m: f"&#{(m[0][2:].lstrip('0') or '0')[:8]}", text)
    return html.unescape(NO_BREAK_SPACE.sub(" ", text))


def _address(value: str) -> str:
    """An attribute's value: names without a semicolon stay before letters, digits and =, as in ?a=1&copy=2."""

    def one(m: re.Match) -> str:
        name = m[0]
        if name[1] == "#" or name[-1] == ";":
            return _unescape(name)
        return _unescape(name) if name[-1] != "=" and name[1:] in html.entities.html5 else name

    return REFERENCE.sub(one, value) if "&" in value else value


def _hrefs(page: str) -> list[str]:
    """The first href of every link; a tag ends at the first > or < outside of quotes."""
    found, link = [], LINK.search(page)
    while link:
        at, href = link.end(), None
        while attribute := ATTRIBUTE.match(page, at):
            at = attribute.end()
            if href is None and attribute[1].lower() == "href":
                href = next((v for v in attribute.groups()[1:] if v is not None), "")
        if href is not None and CLOSE.match(page, at):
            found.append(_address(href))
        link = LINK.search(page, at)
    return found


@F.arrow_udf(StringType())
def _resolved(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else _unescape(t) for t in text.to_pylist()], pa.string())


@F.arrow_udf(ArrayType(StringType()))
def _links(shown: pa.Array) -> pa.Array:
    return pa.array([[] if t is None else _hrefs(t) for t in shown.to_pylist()], pa.list_(pa.string()))


def _squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\x00-\x20]+", " "))


def _untagged(shown: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(shown, BREAKS, "\n"), TAG, "")


def _plain(text: Column) -> Column:
    text = F.regexp_replace(text, r"[\x00-\x09\x0B-\x1F][\x00-\x09\x0B-\x20]*| [\x00-\x09\x0B-\x20]+", " ")
    return F.regexp_replace(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")

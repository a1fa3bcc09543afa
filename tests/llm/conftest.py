import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("id", "row", "size", "hash", "kept", "digest", "n", "bucket", "label", "words", "batch", "leaf", "html", "t", "stays",
           "row_hash", "text_hash", "nth")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns of clashing names."""

    def build(rows):
        full = [(*r, *("en", "s")[len(r) - 2 :], len(r[1] or "")) if len(r) < 4 else (*r, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", *[f"'clash' AS {c}" for c in CLASHES]).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd():
    """Rows that every operator must bear: nulls, empty and long texts, repeated rows."""
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (4, "word"), (None, "no identifier here"), (None, None),
        (5, "é日本   x\x1cy \U0001f600 " * 40), (6, "long words and lines\n" * 20_000), (7, "x" * 300_000),
    ]

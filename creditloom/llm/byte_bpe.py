"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file."""

from __future__ import annotations

import base64
import re
import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import text_of

BPE, NORMAL, UNKNOWN = 2, 1, 2
"""Values of the model format: the model type, and the piece types."""
LONG_TOKEN = 64
CACHE = 200_000
"""Pre-tokens up to LONG_TOKEN characters are remembered, CACHE of them in a task at most."""
APART = chr(0x100 + 0xFF)
LATIN = 0x180
BEYOND_LATIN = re.compile(f"[^\\x00-{chr(LATIN - 1)}]")
CLASS = r"\\(?:p\{\w+\}|[sS])"
CHUNK = 1_000_000
"""Characters that are cut into pre-tokens at once."""
SLICE = 1 << 20
"""Bytes of text whose results a task holds at once, beside those of one text."""
TO_LETTERS = {b: 0x100 + b for b in range(256)}
"""Every byte is a letter of its own from U+0100 on, so that no piece has a space or a control."""


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file ("base64 rank" lines), by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[r] for r in range(len(ranks))]


def letters(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_LETTERS)


def serialise(vocabulary: list[bytes]) -> bytes:
    """A sentencepiece BPE model: byte-mapped pieces scored by negative rank, identity normalisation.

    Piece ids are ranks; the unknown piece that the format demands comes last and never occurs,
    as all single bytes are pieces.
    """
    pieces = [_piece(letters(token), -float(rank), NORMAL) for rank, token in enumerate(vocabulary)]
    pieces.append(_piece("<unk>", 0.0, UNKNOWN))
    trainer = _number(3, BPE) + _number(4, len(pieces)) + _number(40, len(vocabulary))
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43))
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(_block(1, p) for p in pieces) + _block(2, trainer) + _block(3, normaliser)


def _piece(text: str, score: float, kind: int) -> bytes:
    return _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def latin_pattern(pattern: str) -> str:
    """The pattern with its classes written out for code points below LATIN, where they are short."""

    def ranges(name: str) -> str:
        chosen = [c for c in range(LATIN) if regex.match(name, chr(c))]
        runs = [(c, c) for c in chosen]
        for c in reversed(range(1, len(runs))):
            if runs[c][0] == runs[c - 1][1] + 1:
                runs[c - 1 : c + 1] = [(runs[c - 1][0], runs[c][1])]
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)

    inside = re.sub(r"\[[^]]*\]", lambda m: re.sub(CLASS, lambda c: ranges(c[0]), m[0]), pattern)
    return re.sub(CLASS, lambda c: f"[{ranges(c[0])}]", inside)


class Encoder:
    """Text to ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        self.latin = re.compile(latin_pattern(pattern))
        self.edge = regex.compile(r"\S(?=\s)")
        self.known: dict[str, bytes] = {}

    def _encode(self, tokens: list[str]) -> dict[str, bytes]:
        """Ids of new tokens; they are mapped to letters together, apart at a byte that UTF-8 never has."""
        mapped = np.frombuffer(b"\xff".join(map(str.encode, tokens)), np.uint8).astype("<u4") + 0x100
        ids = self.pieces.encode(mapped.tobytes().decode("utf-32-le").split(APART), num_threads=1)
        return {t: array("I", i).tobytes() for t, i in zip(tokens, ids)}

    def _chunks(self, text: str) -> Iterator[str]:
        """Cuts before white space that follows other characters.

        Holds for patterns in which no match runs from another character into white space, as that of byte-level BPE.
        """
        start = 0
        while len(text) - start > CHUNK:
            edge = self.edge.search(text, start + CHUNK)
            if edge is None:
                break
            yield text[start : edge.end()]
            start = edge.end()
        yield text[start:]

    def __call__(self, text: str) -> bytes:
        packed = []
        for chunk in self._chunks(text):
            tokens = (self.pattern if BEYOND_LATIN.search(chunk) else self.latin).findall(chunk)
            distinct = set(tokens)
            new = [t for t in distinct if t not in self.known]
            if len(self.known) + len(new) > CACHE:
                self.known.clear()
                new = list(distinct)
            if new:
                self.known.update(self._encode(new))
            packed.append(b"".join([self.known[t] for t in tokens]))
            for t in new:
                if len(t) > LONG_TOKEN:
                    del self.known[t]
        return b"".join(packed)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose rows after the first have less than SLICE bytes in the second column."""
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)) // SLICE
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def _decoder(vocabulary: list[bytes]) -> Callable[[bytes | None], bytes]:
    bytes_of = vocabulary.__getitem__
    return lambda ids: b"".join(map(bytes_of, np.frombuffer(ids or b"", dtype="<u4").tolist()))


def encode(
    docs: DataFrame, vocabulary: list[bytes], pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every whole text.

    The text is cut by `pattern`; each match is encoded on its own by the sentencepiece model.
    Null and empty texts have no ids. Long texts are cut into pre-tokens a chunk at a time, at
    places that no pre-token spans. Repeated rows and null identifiers keep their own result rows;
    columns other than the two named are ignored. The model, whose size is that of the vocabulary,
    is made once on the driver and sent to the tasks; nothing is shuffled.
    """
    model = docs.sparkSession.sparkContext.broadcast(serialise(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value, pattern)
        for part in (part for batch in batches for part in _slices(batch)):
            ids = pa.array([encoder(t.as_py()) for t in part.column(1)], pa.binary())
            yield pa.record_batch([part.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Adds `decoded`: the bytes that the ids of `encode` stand for. Null ids count as none."""
    tokens = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(tokens.value)
        for part in (part for batch in batches for part in _slices(batch)):
            decoded = pa.array([decoder(i.as_py()) for i in part.column(1)], pa.binary())
            yield pa.record_batch([part.column(0), part.column(1), decoded], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def round_trip(
    docs: DataFrame, vocabulary: list[bytes], pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `encode` followed by `decode`, made in one Python worker a task instead of two."""
    context = docs.sparkSession.sparkContext
    model, tokens = context.broadcast(serialise(vocabulary)), context.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(model.value, pattern), _decoder(tokens.value)
        for part in (part for batch in batches for part in _slices(batch)):
            ids = [encoder(t.as_py()) for t in part.column(1)]
            columns = [part.column(0), pa.array(ids, pa.binary()), pa.array(map(decoder, ids), pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded bytes, and the ids."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )

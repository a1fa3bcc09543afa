"""Personal data: base patterns, and a skip-chain conditional random field over what looks similar."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import text_of
from creditloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
NONE = 0
"""Label of a mention that is nothing; label i is KINDS[i - 1]."""
LABELS = len(KINDS) + 1
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
MENTION = re.compile(r"[^\s@]{1,64}@[^\s@]{1,255}|[+(]?[0-9](?:[ ().\-/]{0,3}[0-9]){6,}")
"""What may be personal data though no base pattern takes it."""
FORMS = 256
"""Forms of a mention that the model tells apart; other forms fall together by hash."""
NEAR = 200
"""Characters between neighbours in the chain."""
SETTLED = 1e-4
"""Largest change of a message, in log units, after which no more are sent."""
MENTION_SCHEMA = "n int, label array<int>, start array<int>, end array<int>, form array<int>, same array<long>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, label, end) of the base patterns, leftmost and non-overlapping per kind."""
    found = []
    if "@" in text:
        found += [(s, 1, e) for s, e in _emails(text)]
    if DIGIT.search(text):
        found += [(m.start(), 2, m.end()) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        found += [(m.start(), 3, m.end()) for m in CARD.finditer(text) if _card(m[0])]
        if "+" in text:
            found += [(m.start(), 4, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ back to where its local part begins; a match's end bounds the next one's start."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        tail = DOMAIN.match(text, at) if start < at else None
        if tail:
            done = tail.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _octet(part: str) -> bool:
    """Whether a run of digits is below 256; int() takes no more than 4,300 digits."""
    significant = part.lstrip("0")
    return len(significant) <= 3 and int(significant or "0") < 256


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def _card(span: str) -> bool:
    digits = _digits(span)
    if not 12 <= len(digits) <= 19:
        return False
    doubled = (2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _form(span: str) -> int:
    """The form of a mention: its separators and how many digits it has."""
    if "@" in span:
        seen = "@" + "".join(sorted({c for c in span.split("@")[1] if not c.isalnum()}))
    else:
        runs = "".join("0" if c.isdigit() else c for c in span)
        seen = re.sub("0+", "0", runs) if len(runs) < 25 else "long"
        seen += f"/{len(_digits(span))}"
    return xxhash.xxh64_intdigest(seen) % FORMS


def _same(span: str) -> int:
    """Mentions of one thing agree here: the local part of an address, the last seven digits."""
    key = span.split("@")[0].strip("._%+-").lower() if "@" in span else _digits(span)[-7:]
    return xxhash.xxh64_intdigest(key) >> 1


def mentions(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, label, end, form, same) of base spans, and of mentions that no base span touches."""
    base = base_spans(text)
    nodes = list(base)
    if "@" in text or DIGIT.search(text):
        at = reach = 0
        for m in MENTION.finditer(text):
            while at < len(base) and base[at][0] < m.end():
                reach = max(reach, base[at][2])
                at += 1
            if reach <= m.start():
                nodes.append((m.start(), NONE, m.end()))
    return [(s, k, e, _form(text[s:e]), _same(text[s:e])) for s, k, e in sorted(nodes)]


def personal_data(
    docs: DataFrame, rounds: int = 200, certain: float = 0.9, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The base spans of every whole text, and those a skip-chain CRF adds.

    Nodes are the base spans, whose labels are given, and other mentions: words with an @ and runs
    of seven or more digits. Factors: a node's form (separators, number of digits) with its label;
    neighbours in the text within NEAR characters; and skip edges between successive mentions, however
    distant, of the same thing (equal local part, equal last seven digits), which share a potential: from
    every base span to each other mention of its key, and between successive mentions that are none.
    The factors are trained piecewise, each from counts over all documents: forms and neighbours with
    mentions as negatives, unless a skip edge ties them to a base span, skip edges by how often
    successive base spans of one key agree. Loopy belief propagation then gives the marginals, the
    nodes of a batch of documents side by side, until messages no longer change, at most `rounds`
    times; a mention whose likeliest kind has a marginal over `certain` becomes a span of that kind.
    As a base span's label is given, its messages are the same in each round: they enter as counts of
    base labels by document and key, so work is linear, also in a text that repeats one number all over.

    Null and empty texts have no spans. Each row is read by itself, repeated ones too; null
    identifiers and columns of any other names do no harm. An empty table gives an empty result.

    Returns doc_id, base and spans: arrays of struct<kind, start, end> in code points, end
    exclusive, by start, then kind.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        _read, f"doc_id {kind}, {MENTION_SCHEMA}"
    )
    found = materialize(found, "mentions")
    counts = found.where("n > 0").drop("doc_id").mapInArrow(_evidence, "factor int, a int, b int, n long")
    rows = counts.groupBy("factor", "a", "b").agg(F.sum("n").alias("n")).collect()
    model = _potentials([(r["factor"], r["a"], r["b"], r["n"]) for r in rows])
    span = "array<struct<kind:string,start:int,end:int>>"
    return found.mapInArrow(
        lambda batches: _label(batches, model, rounds, certain), f"doc_id {kind}, base {span}, spans {span}"
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [mentions(t.as_py()) for t in batch.column(1)]
        ints = pa.list_(pa.int32())

        def column(i, kind):
            return pa.array([[node[i] for node in nodes] for nodes in found], kind)

        yield pa.record_batch(
            [
                batch.column(0), pa.array([len(nodes) for nodes in found], pa.int32()), column(1, ints),
                column(0, ints), column(2, ints), column(3, ints), column(4, pa.list_(pa.int64())),
            ],
            ["doc_id", "n", "label", "start", "end", "form", "same"],
        )


class Graph:
    """The nodes of a batch of documents and the edges between them."""

    def __init__(self, batch: pa.RecordBatch):
        def flat(name):
            return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)

        sizes = batch.column(batch.schema.get_field_index("n")).to_numpy(zero_copy_only=False)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.label, self.start, self.end, self.form, self.same = map(flat, ("label", "start", "end", "form", "same"))
        next_ = np.arange(1, len(self.doc))
        near = (self.doc[1:] == self.doc[:-1]) & (self.start[1:] - self.end[:-1] <= NEAR)
        self.chain = np.stack([next_[near] - 1, next_[near]])
        order = np.lexsort((self.start, self.same, self.doc))
        self.skip = self._links(order[self.label[order] == NONE])
        self.agree = self._links(order[self.label[order] != NONE])
        first = np.ones(len(order), dtype=bool)
        first[1:] = (self.doc[order[1:]] != self.doc[order[:-1]]) | (self.same[order[1:]] != self.same[order[:-1]])
        key = np.empty(len(order), dtype=np.int64)
        key[order] = np.cumsum(first) - 1
        given = self.label != NONE
        by_key = np.zeros((int(first.sum()), LABELS))
        np.add.at(by_key, (key[given], self.label[given]), 1)
        self.known = by_key[key]
        """Base spans of each label that share the node's document and key."""

    def _links(self, order: np.ndarray) -> np.ndarray:
        """Successive ones of the nodes, sorted by document and key, that share both."""
        a, b = order[:-1], order[1:]
        equal = (self.doc[a] == self.doc[b]) & (self.same[a] == self.same[b])
        return np.stack([a[equal], b[equal]])


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per factor: 0 form and label, 1 neighbours, 2 base spans on a skip edge."""
    form = np.zeros((FORMS, LABELS), dtype=np.int64)
    chain, skip = (np.zeros((LABELS, LABELS), dtype=np.int64) for _ in range(2))
    for batch in batches:
        g = Graph(batch)
        sure = (g.label != NONE) | (g.known.sum(axis=1) == 0)
        np.add.at(form, (g.form[sure], g.label[sure]), 1)
        a, b = g.chain[:, sure[g.chain].all(axis=0)]
        np.add.at(chain, (g.label[a], g.label[b]), 1)
        a, b = g.agree
        np.add.at(skip, (g.label[a], g.label[b]), 1)
    for factor, counts in enumerate((form, chain, skip)):
        a, b = np.nonzero(counts)
        yield pa.record_batch(
            [
                pa.array(np.full(len(a), factor), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                pa.array(counts[a, b], pa.int64()),
            ],
            ["factor", "a", "b", "n"],
        )


def _potentials(rows: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log potentials of the three factors; unseen ones stay near 0."""
    form, chain, skip = np.zeros((FORMS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    for factor, a, b, n in rows:
        (form, chain, skip)[factor][a, b] = n
    prior = (form.sum(axis=0) + 1) / (form.sum() + LABELS)
    form = np.log((form + prior) / (form.sum(axis=1, keepdims=True) + 1))
    expected = np.outer(chain.sum(axis=1) + 1, chain.sum(axis=0) + 1) / (chain.sum() + LABELS)
    chain = np.log((chain + 1) / (expected + 1))
    agree = np.log((np.trace(skip) + 1) / (skip.sum() - np.trace(skip) + 1))
    return form, chain, np.eye(LABELS) * max(0.0, agree)


def _marginals(g: Graph, model: tuple[np.ndarray, ...], rounds: int) -> np.ndarray:
    """Sum-product messages along all edges in both directions, damped by half, until they settle."""
    form, chain, skip = model
    own = form[g.form] + g.known @ skip
    given = g.label != NONE
    own[given] = -50.0
    own[given, g.label[given]] = 0.0
    beside = g.chain[:, (~given)[g.chain].any(axis=0)]
    a = np.concatenate([beside[0], g.skip[0]])
    b = np.concatenate([beside[1], g.skip[1]])
    kind = np.repeat([0, 1], [beside.shape[1], g.skip.shape[1]])
    pair = np.stack([chain, skip])[kind]
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
    sent = np.zeros((len(source), LABELS))

    def belief():
        total = own.copy()
        np.add.at(total, target, sent)
        return total

    for _ in range(rounds if len(a) else 0):
        out = (belief()[source] - sent[back])[:, :, None] + pair
        top = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        change = np.abs(new - sent).max()
        sent = (sent + new) / 2
        if change < SETTLED:
            break
    total = belief()
    total = np.exp(total - total.max(axis=1, keepdims=True))
    return total / total.sum(axis=1, keepdims=True)


def _label(batches, model, rounds: int, certain: float) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        g = Graph(batch)
        label = g.label.copy()
        if len(label):
            p = _marginals(g, model, rounds)
            best = p[:, 1:].argmax(axis=1) + 1
            new = (label == NONE) & (p[np.arange(len(p)), best] > certain)
            label[new] = best[new]
        base, spans = ([[] for _ in range(batch.num_rows)] for _ in range(2))
        for i in np.flatnonzero(label):
            found = (int(g.start[i]), int(label[i]), int(g.end[i]))
            spans[g.doc[i]].append(found)
            if g.label[i]:
                base[g.doc[i]].append(found)

        def column(lists):
            return pa.array(
                [[{"kind": KINDS[k - 1], "start": s, "end": e} for s, k, e in sorted(x)] for x in lists], span
            )

        yield pa.record_batch([batch.column(0), column(base), column(spans)], ["doc_id", "base", "spans"])

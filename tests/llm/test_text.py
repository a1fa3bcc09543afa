"""Byte-level BPE, personal data, quality rules and backoff scores against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from creditloom.llm import byte_bpe
from creditloom.llm.backoff import backoff_scores
from creditloom.llm.divergence import CHAR_CLASSES, quality_rules
from creditloom.llm.pii_crf import KINDS, base_spans, personal_data
from creditloom.llm.queries import bpe_digests

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokens(vocabulary):
    ranks = {token: rank for rank, token in enumerate(vocabulary)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_comes_back(make, odd, tokens):
    random.seed(5)
    letters = [chr(c) for c in [*range(0x250), 0x301, 0x3042, 0x200B, 0x2028, 0xFFFD, 0x1F600, 0x10FFFF]]
    rows = odd[:-1] + [(20 + i, "".join(random.choices(letters, k=200))) for i in range(60)]
    rows += [(90, "don't  we'll\r\n\n x's 12³ <|endoftext|> " * 30), (91, "y" * 5000)]
    want = []
    for i, text in rows:
        ids = tokens.encode_ordinary(text or "")
        packed = b"".join(t.to_bytes(4, "little") for t in ids)
        want.append((i, len(ids), *(hashlib.sha256(b).hexdigest() for b in (packed, (text or "").encode()))))
    got = bpe_digests(make(rows)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert bpe_digests(make([])).count() == 0


def test_bpe_cuts_long_texts_at_safe_places(vocabulary, tokens, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 50)
    monkeypatch.setattr(byte_bpe, "CACHE", 30)
    encode = byte_bpe.Encoder(byte_bpe.serialise(vocabulary), public_tokenizers.PATTERN)
    random.seed(6)
    for _ in range(200):
        text = "".join(random.choices("ab é\n\t'st1 ", k=400))
        ids = [int.from_bytes(encode(text)[i : i + 4], "little") for i in range(0, len(encode(text)), 4)]
        assert ids == tokens.encode_ordinary(text)


def test_bpe_in_one_step_equals_encode_then_decode(make, odd, vocabulary):
    docs = make(odd)
    two = byte_bpe.decode(byte_bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary)
    one = byte_bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN)
    assert one.schema == two.schema
    rows = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in one.collect())
    assert rows == Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in two.collect())
    assert Counter((i, decoded) for i, _, decoded in rows.elements()) == Counter((i, (t or "").encode()) for i, t in odd)


def test_bpe_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE", 10)
    for lengths in ([], [0], [0, 0, 0], [25], [3, 4, 5, 30, 0, 0, 9, 1], [1] * 57):
        batch = pa.record_batch([pa.array(range(len(lengths))), pa.array(["x" * n for n in lengths], pa.string())], ["i", "t"])
        parts = list(byte_bpe._slices(batch))
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(lengths)))
        assert all(sum(map(len, p.column(1).to_pylist()[1:])) < byte_bpe.SLICE for p in parts)


def luhn(span):
    digits = [int(c) for c in span if c.isdigit()][::-1]
    return 12 <= len(digits) <= 19 and sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(digits)) % 10 == 0


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) < 256 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", luhn),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= sum(c.isdigit() for c in s) <= 15),
}


def base(text):
    found = [
        (m.start(), k, m.end())
        for k, (pattern, good) in enumerate(PATTERNS.values())
        for m in re.finditer(pattern, text or "")
        if good(m[0])
    ]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def test_personal_data_base(make, odd):
    random.seed(7)
    bits = ["a.b@c-d.ef", "@", "x@y", "1.2.3.4", "999.1.1.1.7", "4111 1111 1111 1111", "+1 (743) 555-3824", "+", "é", "-"]
    bits += ["4111111111111111", "0", "12", " ", ".", "\n", "a@b.c_d@e.f", "+49-30-1234567", "5105-1051-0510-5100"]
    rows = odd + [(i, "".join(random.choices(bits, k=12))) for i in range(20, 320)]
    got = personal_data(make(rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, tuple(base(t))) for i, t in rows)
    assert Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.base)) for r in got) == want
    assert all(set(r.base) <= set(r.spans) for r in got)
    assert personal_data(make([])).count() == 0


def test_very_long_numbers_are_no_address():
    long = "9" * 5000
    assert not base_spans(f"{long}.1.1.1") and not base_spans(f"1.1.1.{long}")
    zeros = "0" * 5000
    assert base_spans(f"at {zeros}7.1.1.255") == [(3, 2, 5012)] == base_spans(f"at {zeros}7.1.1.255, 1.1.256.1")


def test_skip_edges_carry_labels(make):
    """A number that repeats a known one in another shape becomes a span; a lone one like it does not."""
    rows = [(i, f"call +1 (743) 555-{1000 + i} or again +1 (743) 555-{1000 + i}") for i in range(1200)]
    rows += [(5000 + i, f"order 743 555 {1000 + i} shipped") for i in range(60)]
    rows += [(9000, "call +1 (743) 555-9999 now " + "and so on " * 60 + "as said 743 555 9999 thanks")]
    got = {r.doc_id: r for r in personal_data(make(rows)).collect()}
    text = rows[-1][1]
    added = [s for s in got[9000].spans if s not in got[9000].base]
    assert [(s.kind, text[s.start : s.end]) for s in added] == [("phone", "743 555 9999")]
    assert all(not got[5000 + i].spans for i in range(60))


def test_labels_reach_all_mentions_of_a_thing(make):
    """One known number and 2, 5 and 20 reformatted mentions, near and far; look-alikes of no known one stay clean."""
    rows = [(i, f"call +1 (743) 555-{1000 + i} or again +1 (743) 555-{1000 + i}") for i in range(1200)]
    rows += [(5000 + i, f"order 743 555 {1000 + i} shipped") for i in range(60)]
    for n in (2, 5, 20):
        rows += [(9000 + n, "call +1 (743) 555-9999 now " + ("and so on " * 30 + "as said 743 555 9999 thanks ") * n)]
        rows += [(9100 + n, "and 743 555 9999 again " * n + "call +1 (743) 555-9999 now")]
        rows += [(9200 + n, "and 743 555 9999 again " * n + "call +1 (743) 555-8888 now")]
    got = {r.doc_id: r for r in personal_data(make(rows)).collect()}
    for n in (2, 5, 20):
        assert [len(got[k + n].spans) - len(got[k + n].base) for k in (9000, 9100, 9200)] == [n, n, 0]
    assert all(not got[5000 + i].spans for i in range(60))


def quality_base(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


def prose(n, seed=0):
    words = "the of and to in that is for it on some words make a sentence of plain prose here now".split()
    return " ".join(random.Random(seed).choices(words, k=n))


def test_quality_base(make, odd):
    random.seed(8)
    rows = odd + [(i, prose(random.randrange(5, 200), i) + "\n" * (i % 3) + prose(30, i % 5)) for i in range(20, 90)]
    rows += [(100, "a b c d e f g h i " * 12), (101, "x " * 7), (102, "x " * 8), (103, "x " * 9), (104, "# $\n# $\n|")]
    got = quality_rules(make(rows), payload=["doc_id"]).collect()
    want = Counter()
    for i, text in rows:
        b = quality_base(text)
        want[(i, *b, b[0] < 20 or 100 * b[4] > 30 * b[0])] += 1
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.row.doc_id, *(r[c] for c in cols)) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    assert quality_rules(make([])).count() == 0


def divergence_brute(a, b):
    p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
    half = [(x + y) / 2 for x, y in zip(p, q)]
    return sum(x / 2 * math.log2(x / m) for side in (p, q) for x, m in zip(side, half) if x)


def test_quality_divergence(make):
    rows = [(i, prose(120, i), "en", "s") for i in range(60)]
    odd_one = " ".join(f"T{i}X|" for i in range(120))
    rows += [(100, odd_one, "en", "s"), (101, prose(120, 101), None, "s"), (102, odd_one[:150], "en", "s")]
    got = {r.row.doc_id: r for r in quality_rules(make(rows), payload=["doc_id"]).collect()}
    assert [i for i, r in got.items() if not r.kept] == [100]
    assert got[101].word_divergence is None and got[102].char_divergence is None

    def used(text):
        names = ("the", "of", "and", "to", "in", "that", "is", "for", "it", "on")
        hits = [text.split().count(n) for n in names]
        return [*hits, len(text.split()) - sum(hits)]

    reference = [sum(c) for c in zip(*(used(t) for i, t, lang, _ in rows if lang == "en"))]
    for i in (0, 17, 100):
        text = next(t for j, t, *_ in rows if j == i)
        assert got[i].word_divergence == pytest.approx(divergence_brute(used(text), reference))


def test_junk_without_a_language_is_no_reference(make):
    """Junk is found under any tag, though rows of no language consist of junk only; clean text stays."""
    clean = [(i, prose(120, i), "en", "s") for i in range(60)]
    clean += [(60 + i, prose(120, 60 + i), lang, "s") for i, lang in enumerate((None, "", "xx", "it"))]
    russian = " ".join("и в не на что это слово текст мир дом".split()[k] for k in random.Random(3).choices(range(10), k=90))
    clean += [(70, russian, "ru", "s")]
    symbols = [" ".join(f"T{k}X|{i}" for k in range(120)) for i in range(9)]
    lower = [" ".join(random.Random(i).choices(["qz", "vlo", "brem", "tik", "osk", "un", "pla"], k=120)) for i in range(4)]
    junk = [(100 + i, t, (None, "xx", "en", "it")[i % 4], "s") for i, t in enumerate(symbols)]
    junk += [(200 + i, t, (None, "xx", "", "en")[i], "s") for i, t in enumerate(lower)]
    repeated = [(300 + i, "A|1 B|2 C|3 " * 400, "en", "s") for i in range(30)]
    got = {r.row.doc_id: r for r in quality_rules(make(clean + junk + repeated), payload=["doc_id"]).collect()}
    assert {i for i, r in got.items() if r.kept} == {i for i, *_ in clean}

    def classes(text):
        bins = [len(re.findall(c, text)) for c in CHAR_CLASSES.values()]
        return [*bins, len(text) - sum(bins)]

    reference = [sum(c) for c in zip(*(classes(t) for _, t, lang, _ in clean + junk if lang == "en"))]
    for i, text in ((0, clean[0][1]), (60, clean[60][1]), (100, symbols[0])):
        assert got[i].char_divergence == pytest.approx(divergence_brute(classes(text), reference))
    assert got[100].word_divergence is None and got[100].nearest_word_divergence > 0.1
    alone = quality_rules(make([(1, symbols[0], None, "s"), (2, prose(90), None, "s")])).collect()
    assert [r.char_divergence for r in alone] == [None, None]


def backoff_brute(rows, order, alpha):
    texts = [[w.lower() for w in WORD.findall(t or "")] for _, t in rows]

    def grams(w, n):
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

    total = {n: sum((grams(w, n) for w in texts), Counter()) for n in range(1, order + 1)}
    out = []
    for (i, _), w in zip(rows, texts):
        own = {n: grams(w, n) for n in total}
        words = sum(map(len, texts)) - len(w)
        score, used = 0.0, [0] * (order + 1)
        for at in range(len(w)):
            for n in range(min(order, at + 1), -1, -1):
                g = tuple(w[at - n + 1 : at + 1])
                here = total[n][g] - own[n][g] if n else 1
                if here:
                    below = max(1, words) if n < 2 else total[n - 1][g[:-1]] - own[n - 1][g[:-1]]
                    score += math.log10(alpha ** (order - n) * here / below)
                    used[n] += 1
                    break
        out.append((i, len(w), round(score, 6), *used))
    return Counter(out)


@pytest.mark.parametrize("order", [1, 3])
def test_backoff(make, odd, order, monkeypatch):
    from creditloom.llm import backoff

    monkeypatch.setattr(backoff, "BATCH_BYTES", 100_000)
    random.seed(9)
    rows = odd + [(i, " ".join(random.choices("The a cat dog sat on mat É 日".split(), k=i % 40))) for i in range(20, 120)]
    got = backoff_scores(make(rows), order=order).collect()
    found = [f"n_order_{n}" for n in range(order + 1)]
    assert Counter((r.doc_id, r.n_words, round(r.log10_score, 6), *(r[c] for c in found)) for r in got) == (
        backoff_brute(rows, order, 0.4)
    )
    assert backoff_scores(make([])).count() == 0

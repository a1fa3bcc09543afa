"""Exact, line and near deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from creditloom.llm import odd_sketch
from creditloom.llm.graph import components
from creditloom.llm.line_dedup import line_dedup
from creditloom.llm.odd_sketch import near_duplicates
from creditloom.llm.tree_dedup import _merge, tree_dedup

SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize(("keep", "fan_in", "rounds"), [("largest", 3, 2), ("smallest", 2, 4), ("smallest", None, 1)])
def test_tree_dedup(make, odd, keep, fan_in, rounds):
    rows = odd + [(i, f"copy {i % 7}") for i in range(10, 80)] + [(100 + i, "hot") for i in range(50)]
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    best = max if keep == "largest" else min
    got = tree_dedup(make(rows), keep=keep, fan_in=fan_in, rounds=rounds).collect()
    assert len(got) == len(rows)
    assert Counter(r.text_sha256 for r in got) == Counter(sha(t) for _, t in rows)
    for text, ids in groups.items():
        mine = [r for r in got if r.text_sha256 == sha(text)]
        keep_id = best([i for i in ids if i is not None], default=None)
        assert {(r.keep_id, r.group_size) for r in mine} == {(keep_id, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [keep_id]


def test_sorted_runs_are_merged_across_batches():
    """The pass over a sorted stream, cut into batches of any size, against a dictionary."""
    rng = random.Random(5)
    rows = sorted(
        ((rng.randrange(2), rng.choice("abcdef"), 1, rng.randrange(2), rng.choice([None, *range(9)]), rng.randrange(1, 4)) for _ in range(200)),
        key=lambda r: r[:4],
    )
    names = ["place", "digest", "bytes", "hash", "keep_id", "group_size"]
    types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    for keep, best in (("smallest", min), ("largest", max)):
        wanted = {}
        for *key, i, n in rows:
            ids, size = wanted.get(tuple(key), ([], 0))
            wanted[tuple(key)] = (ids + [i] * (i is not None), size + n)
        wanted = [(*key, best(ids, default=None), n) for key, (ids, n) in wanted.items()]
        for step in (1, 2, 7, 200):
            cut = [rows[at : at + step] for at in range(0, len(rows), step)] + [[]]
            batches = [
                pa.record_batch([pa.array([r[c] for r in part], t) for c, t in enumerate(types)], names=names) for part in cut
            ]
            got = [tuple(r.values()) for b in _merge(iter(batches), keep) for r in b.to_pylist()]
            assert got == wanted


def test_rounds_merge_sorted_runs(make):
    """Spark can't drop the order that a merge needs: each of leaves and rounds has its sort."""
    plan = tree_dedup(make([(1, "a"), (2, "a")]), fan_in=2, rounds=2)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.split("\n")]
    merges = [n for n, line in enumerate(lines) if line.startswith("MapInArrow")]
    assert len(merges) >= 3 and all(any(x.startswith("Sort [place") for x in lines[n + 1 : n + 4]) for n in merges)


def test_tree_dedup_of_nothing(make):
    assert tree_dedup(make([])).count() == 0


def line_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def line_brute(rows, min_docs):
    seen = Counter(k for _, t in rows for k in {line_key(x) for x in (t or "").split("\n")})
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        stay = [x for x in parts if not (line_key(x) and seen[line_key(x)] >= min_docs)]
        out.append((i, len(parts), len(parts) - len(stay), "\n".join(stay)))
    return Counter(out)


@pytest.mark.parametrize("max_bits", [1 << 16, 1 << 26])
def test_line_dedup(make, odd, max_bits):
    random.seed(3)
    pool = [f"Line {i} É" for i in range(40)]
    rows = odd + [
        (i, "\n".join(random.choice([x, " " + x.upper() + "\r", "", "\t", f"own {i}"]) for x in random.sample(pool, 9)))
        for i in range(10, 90)
    ]
    got = line_dedup(make(rows), min_docs=10, max_bits=max_bits, payload=["doc_id"])
    found = Counter((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect())
    assert found == line_brute(rows, 10)


def test_line_dedup_keeps_first(make):
    got = line_dedup(make([(3, "a\nb"), (1, "A \nx\na"), (2, "a")]), min_docs=2, keep_first=True)
    assert {r.row.doc_id: r.kept_text for r in got.collect()} == {1: "A \nx", 2: "", 3: "b"}
    assert "row" in got.columns and got.select("row.kept").first()[0] == "clash"


def test_line_dedup_short_keys_and_nothing(make):
    got = line_dedup(make([(1, "éé\nabc"), (2, "éé\nabc")]), min_docs=2, min_key=3)
    assert {r.kept_text for r in got.collect()} == {"éé"}
    assert line_dedup(make([])).count() == 0


def sets(rows):
    out = []
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        n = max(1, len(w) - 4) if w else 0
        out.append((i, frozenset(tuple(w[k : k + 5]) for k in range(n))))
    return out


def near_brute(rows):
    found = sets(rows)
    root = list(range(len(found)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(found):
        for y, (_, b) in enumerate(found[:x]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[top(x)] = top(y)
    least = defaultdict(list)
    for x, (i, _) in enumerate(found):
        least[top(x)].append(i)
    low = {k: min([i for i in v if i is not None], default=None) for k, v in least.items()}
    return Counter((i, len(a), low[top(x)] if a else i) for x, (i, a) in enumerate(found))


def near_rows():
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = random.choices(vocabulary, k=80)
    rows = []
    for _ in range(12):
        base = random.choices(vocabulary, k=random.choice([5, 30, 150, 400]))
        for _ in range(random.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(random.randrange(1 + len(base) // 40)):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            rows.append((len(rows) + 20, " ".join(copy)))
    for _ in range(90):
        rows.append((len(rows) + 20, " ".join(random.choices(vocabulary, k=30) + passage)))
    long = random.choices(vocabulary, k=300)
    for _ in range(60):
        copy = list(long)
        for at in random.sample(range(300), 8):
            copy[at] = random.choice(vocabulary)
        rows.append((len(rows) + 20, " ".join(copy).title()))
    return rows


@pytest.mark.parametrize(("few", "members"), [(64, 1024), (0, 1024), (0, 3)])
def test_near_duplicates(make, odd, monkeypatch, few, members):
    monkeypatch.setattr(odd_sketch, "FEW", few)
    monkeypatch.setattr(odd_sketch, "MEMBERS", members)
    rows = odd + near_rows()
    got = near_duplicates(make(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_bucket_of_copies(make, monkeypatch):
    """A bucket compared in blocks: copies with up to a tenth of their words changed, most further from each other than from the first."""
    monkeypatch.setattr(odd_sketch, "FEW", 0)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(9000)]
    base = rng.choices(vocabulary, k=390)
    rows = [(0, " ".join(base))]
    for i in range(1, 260):
        copy = list(base)
        for at in rng.sample(range(390), int(39 * rng.random())):
            copy[at] = rng.choice(vocabulary)
        rows.append((i, " ".join(copy)))
    rng.shuffle(rows)
    got = near_duplicates(make(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows)


def test_differing_bits_of_signed_words():
    words = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, (40, 16), dtype=np.int64)
    one, other = np.arange(40), np.roll(np.arange(40), 1)
    wanted = [sum(bin((int(a) ^ int(b)) & (1 << 64) - 1).count("1") for a, b in zip(words[x], words[y])) for x, y in zip(one, other)]
    assert odd_sketch._apart(words, one, other).tolist() == wanted


def test_near_duplicates_of_nothing(make):
    assert near_duplicates(make([])).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (3, 3), (7, 9), (20, 21)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20} | {100 + i: 100 for i in range(41)}

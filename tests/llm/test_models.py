"""Spelling variants, language identification and whitening against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import language, spelling
from creditloom.llm.language import fit_language, is_held_out, predict_language
from creditloom.llm.queries import QUERIES
from creditloom.llm.spelling import count_words, group_variants
from creditloom.llm.whitening import fit_whitening, whiten

SF = "/root/testdata/sf0.001"


def words_brute(rows, min_length, min_count, modulus):
    total = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{word}".encode())
            if modulus and h % modulus == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def near_words(words):
    """Words at one edit, by the strings that one deletion leaves and by replaced places."""
    keys = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            keys[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for same in keys.values():
        for w in same:
            near[w] |= same - {w}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def variants_brute(counts, ratio=2):
    near, form = near_words(counts), {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def variants(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def spelled_rows():
    random.seed(11)
    base = ["".join(random.choices("abcdeéßÿ", k=random.choice([4, 5, 6, 9, 40]))) for _ in range(150)]
    rows = []
    for i in range(20, 400):
        words = random.choices(base, k=8)
        for k, w in enumerate(words):
            if random.random() < 0.5:
                at = random.randrange(len(w))
                words[k] = random.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "Z" + w[at + 1 :], w[::-1]])
        rows.append((i, random.choice([" ", ", ", "1", "日"]).join(words)))
    return rows


@pytest.mark.parametrize(("members", "classes"), [(1024, None), (5, 3), (5, 1), (1024, 6)])
def test_spelling_variants(make, odd, monkeypatch, members, classes):
    monkeypatch.setattr(spelling, "MEMBERS", members)
    rows = odd + spelled_rows()
    counts = count_words(make(rows), min_count=2, drop_one_in=7)
    brute = words_brute(rows, 5, 2, 7)
    assert {r.word: r.n for r in counts.collect()} == brute
    expected = variants_brute(brute)
    assert variants(group_variants(counts, classes=classes).collect()) == expected
    assert sum(1 for v in expected.values() if v[0]) > 50


def test_spelling_of_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    brute = words_brute([(r.doc_id, r.text) for r in docs.collect()], 5, 3, 97)
    assert variants(QUERIES["op11_spelling_variants"](spark, SF).collect()) == variants_brute(brute)


def test_spelling_ties_chains_and_nothing(spark, make):
    chain = [("aaaab", 2), ("aaaac", 5), ("aaacc", 11), ("aaccc", 30), ("zzzzz", 9), ("zzzzy", 9), ("zzzz", 4), ("x" * 3000, 7), ("x" * 2999, 1)]
    got = variants(group_variants(spark.createDataFrame(chain, "word string, n long")).collect())
    assert got == variants_brute(dict(chain))
    assert got["aaaab"][1] == "aaccc" and got["zzzz"][0] == "zzzzy" and got["zzzzz"][0] is None
    assert group_variants(count_words(make([]))).count() == 0
    with pytest.raises(ValueError):
        group_variants(spark.createDataFrame(chain, "word string, n long"), ratio=1)


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_language"](spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = [r.lang_pred == truth[r.doc_id].lang for r in held]
    assert len(held) > 150 and np.mean(right) > 0.97
    sure = [r.lang_pred == truth[r.doc_id].lang for r in held if r.accepted]
    assert len(sure) > 0.8 * len(held) and np.mean(sure) > 0.98
    assert abs(np.mean([r.score for r in held]) - np.mean(right)) < 0.03


def tongues(n, seed):
    draw = random.Random(seed)
    letters = {"aa": "abcde", "bb": "vwxyz", "cc": "αβγδε"}
    return [
        (i, " ".join("".join(draw.choices(letters[lang], k=5)) for _ in range(30)), lang, None)
        for i, lang in ((k, draw.choice(sorted(letters))) for k in range(n))
    ]


def test_language_depends_on_text_alone(make, odd):
    rows = tongues(300, 1)
    learned = make(odd + rows + rows[:40])
    model = fit_language(learned.withColumn("lang", F.when(F.col("doc_id") >= 8, F.col("lang"))), ~is_held_out("doc_id"))
    assert model.languages == ["aa", "bb", "cc"]
    unseen = tongues(90, 2)
    assert {r.doc_id: r.lang_pred for r in predict_language(make(unseen), model).collect()} == {i: lang for i, _, lang, _ in unseen}
    mixed = "abc bca " * 3 + "vwxyz zyxwv " * 40
    tail = {r.doc_id: r.lang_pred for r in predict_language(make([(1, mixed), (2, "½ 12 _ ²"), (3, "12 a")]), model).collect()}
    assert tail[1] == "bb" and tail[2] == "und" and tail[3] == "aa"
    strange = predict_language(make(odd), model).collect()
    assert len(strange) == len(odd)
    assert {(r.lang_pred, r.score, r.accepted) for r in strange if r.doc_id in (1, 2, 3)} == {("und", 0.0, False)}


def test_language_learns_only_from_the_chosen(make):
    rows = tongues(200, 3)
    wrong = [(i, t, "no" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows]
    model = fit_language(make(wrong), ~is_held_out("doc_id"), per_language=20)
    assert model.languages == ["aa", "bb", "cc"] and set(model.used.values()) == {20}


def test_language_without_tags(make, odd):
    for rows in ([], [(1, "some text", None, None), (2, None, None, None)]):
        docs = make(rows).withColumn("lang", F.lit(None).cast("string"))
        got = predict_language(docs, fit_language(docs, ~is_held_out("doc_id"))).collect()
        assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)
    one = fit_language(make([(i, f"word{i} here") for i in range(20)]), ~is_held_out("doc_id"))
    assert one.languages == ["en"] and one.least == 1.0


def test_sgd_gradient_step():
    """One step of one document moves the embeddings and weights as the definition says."""
    model = language.LanguageModel(["a", "b"])
    ids, counts = np.array([1, 5]), np.array([3.0, 1.0])
    start = np.random.default_rng(0).uniform(-1 / 3, 1 / 3, (8, 3))
    language._descend(model, [(1, ids, counts)], 8, 3, 1, 0.1, np.random.default_rng(0))
    average = 0.75 * start[1] + 0.25 * start[5]
    assert np.allclose(model.weights, 0.1 * np.outer([-0.5, 0.5], average))
    assert np.allclose(model.embeddings, start)


def whitening_brute(rows, scale=256):
    whole = {}
    for at, (_, v) in enumerate(rows):
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            whole[at] = tuple(int(np.floor(scale * float(c))) for c in v)
    fit = sorted(set(whole.values()))
    x, n = np.array(fit, dtype=float), len(fit)
    sums = [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    values, axes = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    return whole, n, sums, mean, values[::-1], axes[:, ::-1]


def check_whitening(got, rows, components=4):
    whole, n, sums, mean, values, axes = whitening_brute(rows)
    k = min(components, int((values > 1e-10 * values[0]).sum()))
    by_row = defaultdict(list)
    for r in sorted(got, key=lambda r: r.component):
        by_row[r.vec_id].append(r)
    expected = defaultdict(list)
    for at, x in whole.items():
        expected[rows[at][0]].append(x)
    assert {i: len(r) for i, r in by_row.items()} == {i: k * len(x) for i, x in expected.items()}
    ids = [i for i, x in expected.items() if len(x) == 1]
    sample = np.array([[r.whitened for r in by_row[i]] for i in ids])
    brute = (np.array([expected[i][0] for i in ids], dtype=float) - mean) @ axes[:, :k] / np.sqrt(values[:k])
    sign = np.sign((sample * brute).sum(axis=0))
    assert np.abs(sample * sign - brute).max() < 1e-9
    for i in ids:
        assert {r.deviation for r in by_row[i]} == {sum((n * c - s) ** 2 for c, s in zip(expected[i][0], sums))}
        assert all(abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-10 for r in by_row[i])
    assert {r.n for r in got} == {n} and all(r.identity_error < 1e-9 for r in got)


SHAPE = "vec_id long, embedding array<float>, label int"


def vectors_of(spark, rows):
    clash = [f"'clash' AS {c}" for c in ("v", "key", "dims", "n", "component")]
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SHAPE).selectExpr("*", *clash).repartition(3)


@pytest.mark.parametrize("block", [6, 24])
def test_whitening(spark, block):
    draw = np.random.default_rng(5)
    data = draw.standard_normal((400, 20)) * np.linspace(2, 0.3, 20)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(200)]
    rows += [(2000, None), (2001, [None] * 20), (2002, [float("nan")] + [0.0] * 19), (2003, [float("inf")] * 20), (None, rows[3][1])]
    vectors = vectors_of(spark, rows)
    fitted = fit_whitening(vectors, block=block)
    assert np.all(fitted.residuals < 1e-11 * fitted.eigenvalues)
    check_whitening(whiten(vectors, fitted).collect(), rows)


def test_whitening_of_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op13_whitening"](spark, SF).collect(), rows)


def test_whitening_of_odd_tables(spark):
    draw = np.random.default_rng(6)
    flat = [(i, [float(c) for c in (a, 2 * a, b, 0)]) for i, (a, b) in enumerate(draw.integers(-9, 9, (60, 2)))]
    check_whitening((lambda v: whiten(v, fit_whitening(v)))(vectors_of(spark, flat)).collect(), flat)
    big = [(i, [float(c) for c in v]) for i, v in enumerate(draw.standard_normal((30, 3)) * 1e13)]
    got = (lambda v: whiten(v, fit_whitening(v)))(vectors_of(spark, big)).collect()
    assert len(got) == 90 and all(r.deviation is None for r in got)
    huge = vectors_of(spark, [(1, [1e38, 0.0]), (2, [-1e38, 0.5]), (3, [0.25, 0.0])])
    assert whiten(huge, fit_whitening(huge)).count() == 6 - 3 * (fit_whitening(huge).components.shape[1] == 1)
    ragged = flat + [(900, [1.0]), (901, []), (902, [1.0, 2.0])]
    got = (lambda v: whiten(v, fit_whitening(v)))(vectors_of(spark, ragged)).collect()
    assert {r.vec_id for r in got} == {i for i, _ in flat}
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]):
        nothing = vectors_of(spark, rows)
        assert fit_whitening(nothing) is None and whiten(nothing, None).collect() == []


def test_whitening_of_equal_eigenvalues(spark):
    """A spectrum without gaps at the end of the wanted ones: the block grows, the result is whole."""
    axes = [(i, [float(3 * s * (j == i // 2)) for j in range(10)]) for i, s in enumerate([1, -1] * 10)]
    vectors = vectors_of(spark, axes)
    fitted = fit_whitening(vectors, block=5, rounds=2)
    assert np.allclose(fitted.eigenvalues, fitted.eigenvalues[0])
    got = whiten(vectors, fitted).collect()
    assert len(got) == 80 and all(r.identity_error < 1e-9 for r in got)

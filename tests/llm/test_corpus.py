"""WARC derivatives, co-training, mixing, and the pipeline."""

import functools
import gzip
import hashlib
import math
import random
import re
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser
from pathlib import Path

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import cotrain, warc
from creditloom.llm.cotrain import co_train, document_features, score
from creditloom.llm.fair_mix import fair_mix, mixed_documents, targets

SF = "/root/testdata/sf0.001"
PAGE = (
    '<!DOCTYPE html><HTML lang="fr"><head><title>A &amp;\n B</title><script>if (a<b) "</p>";</script>'
    "<style>p{}</style></head><body><!-- <script> --><p>One<b> two</b><br>three &lt;3 <a class=x href='/q?a=1&amp;b'>link"
    "</a></P>\n\n <ul><li>4 < 5</li></ul></body></html>"
)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/", PAGE), (2, None, None), (3, "http://b/", ""), (3, "http://b/", ""), (None, "x y", "é" * 50_000),
        (4, "http://c/", "<" * 50_000), (5, "http://d/", "open <!-- never closed <p>text"), (6, "u", "WARC/1.1\r\n\r\n\r\n"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS record", "2 AS http")


def test_derivatives(pages):
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 16
    first = {r.record_type: r for r in rows if r.page_id == 1}
    assert first["conversion"].block == "One two\nthree <3 link\n4 < 5"
    digest = f"sha256:{hashlib.sha256(PAGE.encode()).hexdigest()}"
    assert first["metadata"].block.split("\r\n") == [
        f"source-digest: {digest}", "source-header: HTTP/1.1 200 OK",
        "source-header: Content-Type: text/html; charset=utf-8", f"source-header: Content-Length: {len(PAGE.encode())}",
        "title: A & B", "language: fr", "outlink: /q?a=1&b", "",
    ]
    assert first["metadata"].refers_to == first["conversion"].refers_to
    text = {r.page_id: r.block for r in rows if r.record_type == "conversion"}
    assert text[2] == text[3] == "" and text[5] == "open" and text[None] == "é" * 50_000


class Read(HTMLParser):
    """Text and links of a page by the library's parser."""

    def __init__(self, page):
        super().__init__()
        self.text, self.links = "", []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href"][:1]

    def handle_data(self, data):
        self.text += data


def test_references_and_links_are_those_of_a_parser(spark):
    names = [f"&{name} " for name in sorted(html5) if not html5[name].isspace()]
    plain = "&copy; 2026 &middot; it&#8217;s caf&#xE9; &#x1F600; &amp;amp; &nothing; &#00065; &copy 1 &#128; &#xD800; 5 &lt; 6"
    bodies = [plain, "<b>".join(names[:1200]), "".join(names[1200:]), "&#" + "9" * 5000 + "; &#" + "0" * 5000 + "65;"]
    tags = [
        "<a href=/x>", "<a href = '/y z'>", "<A class=b\nHREF=\"/it's\">", "<a href='/say\"so\"'>", "<a title='a' href=/q?a=1&amp;b=&eacute;>",
        '<a href="/p?x=1&lt;&#8217;">', "<a name=here>", '<a data-href="/no">', "<a disabled href=/one href=/two>", "<abbr href=/no>",
    ]
    bodies += ["".join(f"{t}link</a> " for t in tags), "<a href=/x " * 20_000, '<a title="no href=here" href="/yes">z</a>']
    pages = spark.createDataFrame([(i, "u", f"<body>{b}</body>") for i, b in enumerate(bodies)], "page_id long, url string, html string")
    got = {(r.page_id, r.record_type): r.block for r in warc.derivatives(warc.responses(pages)).collect()}
    for i, body in enumerate(bodies):
        links = [x[9:] for x in got[i, "metadata"].split("\r\n") if x.startswith("outlink: ")]
        if i == 3:
            assert got[i, "conversion"] == "\ufffd A"
        elif i < 3:
            want = re.sub("[\x00-\x20]+", " ", Read(body).text.replace("\xa0", " ")).strip()
            assert re.sub("[\x00-\x20]+", " ", got[i, "conversion"]).strip() == want
        elif i != 5:
            assert links == Read(body).links
    assert [x for x in got[4, "metadata"].split("\r\n") if "outlink" in x][:4] == [
        "outlink: /x", "outlink: /y z", "outlink: /it's", 'outlink: /say"so"'
    ]
    assert "outlink" not in got[5, "metadata"]
    assert warc._hrefs('<a href="?a=1&copy=2&copyx&copy&amp=&reg;">') == ["?a=1&copy=2&copyx©&amp=®"]  # as in a browser


def test_written_files_are_warc(pages, tmp_path):
    records = warc.derivatives(warc.responses(pages)).repartition(2)
    warc.write_warc(records, str(tmp_path / "out"))
    found = []
    for file in Path(tmp_path / "out").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            n = int(fields["Content-Length"])
            assert version == "WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n"
            assert fields["WARC-Block-Digest"] == f"sha256:{hashlib.sha256(rest[:n]).hexdigest()}"
            found.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], rest[:n].decode()))
            data = rest[n + 4 :]
    assert sorted(found) == sorted((r.record_id, r.refers_to, r.block) for r in records.collect())


def junk(n, seed):
    return " ".join(f"{w}{random.Random(seed).choice('#*$%')}" for w in random.Random(seed).choices(["aa", "bb", "cc"], k=n))


def test_co_training(spark, make, odd):
    rng = random.Random(10)
    prose = "the of and to in that is for it on some words make sentences".split()
    truth = {i: int(i % 4 > 0) for i in range(20, 420)}
    rows = [(i, " ".join(rng.choices(prose, k=60)) if y else junk(60, i), "en", "good" if y else "bad") for i, y in truth.items()]
    docs = make(odd + rows)
    known = [(i, y) for i, y in truth.items() if i % 5 < 2] + [(20, 0), (None, 1), (21, None), (99999, 1)]
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    model = co_train(docs, labels, rounds=3, max_labelled=120, pool=100)
    assert model.exchanged["text"] > 0 and model.exchanged["meta"] > 0
    got = score(docs, model).collect()
    assert len(got) == len(odd) + len(rows)
    unseen = [r for r in got if r.doc_id in truth and r.doc_id % 5 >= 2]
    assert sum(r.kept == bool(truth[r.doc_id]) for r in unseen) > 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 for r in got)


def test_co_training_searches_all_documents_and_sees_rare_classes(spark, make):
    """Pseudo-labels are a share of all unlabelled documents, not of a pool; a class of 6 in 600 is fitted."""
    rng = random.Random(12)
    prose = "the of and to in that is for it on some words make sentences".split()
    bad = {i for i in range(20, 1220) if i % 100 == 5}
    rows = [(i, junk(60, i) if i in bad else " ".join(rng.choices(prose, k=60)), "en", "bad" if i in bad else "good") for i in range(20, 1220)]
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in range(20, 620)], "doc_id long, quality int")
    docs = make(rows)
    model = co_train(docs, labels, rounds=2, max_labelled=40, pool=20)
    assert model.views and all(slope > 0 for slope, _ in model.calibration.values())
    assert all(40 <= n <= 80 for n in model.exchanged.values())
    got = {r.doc_id: r.kept for r in score(docs, model).collect()}
    assert sum(got[i] == (i not in bad) for i in range(620, 1220)) > 0.97 * 600 and not any(got[i] for i in bad)


def test_co_training_without_classes(spark, make):
    docs = make([(1, "a"), (2, None)])
    for known in ([], [(1, 1)]):
        model = co_train(docs, spark.createDataFrame(known, "doc_id long, quality int"))
        assert not model.views and len({r.score for r in score(docs, model).collect()}) == 1
    empty = make([])
    assert score(empty, co_train(empty, spark.createDataFrame([], "doc_id long, quality int"))).count() == 0


def test_co_training_features_against_python(make, odd):
    """Both views' inputs of every row, computed in Python."""
    index = functools.cache(HashingTF(numFeatures=cotrain.TEXT_BITS).indexOf)
    docs = make(odd + [(i, junk(40, i), "fr", None) for i in range(20, 26)] + [(30, "A1 b\nB2 b #x")])
    texts = Counter()
    for row in docs.collect():
        text = row.text or ""
        found = re.findall("[^\x20\x09-\x0d]+", text)
        counts = Counter(index(w) for w in found)
        norm = math.sqrt(sum(n * n for n in counts.values())) or 1.0
        n = max(1, len(text))
        classes = ["[#*$%&<>|]", "[A-Z]", "[0-9]", "[^A-Za-z0-9#*$%&<>|\x20\x09-\x0d]", "[\x20\x09-\x0d]"]
        shares = [len(re.findall(c, text)) / n for c in classes] + [len(set(found)) / max(1, len(found))]
        view = {b: c / norm for b, c in counts.items()} | {cotrain.TEXT_BITS + k: x for k, x in enumerate(shares)}
        lengths = [math.log1p(len(text)), math.log1p(max(1, len(found))), math.log1p(text.count("\n") + 1)]
        rounded = tuple(sorted((b, round(x, 9)) for b, x in view.items() if x))
        texts[row.doc_id, rounded, tuple(round(x, 9) for x in lengths)] += 1
    got = Counter()
    for row in cotrain._vectors(document_features(docs)).collect():
        text = row.text.toArray()
        rounded = tuple((b, round(float(text[b]), 9)) for b in range(len(text)) if text[b])
        got[row.id, rounded, tuple(round(float(x), 9) for x in row.meta.toArray()[-3:])] += 1
    assert got == texts


def test_pseudo_labels_against_brute_force(spark):
    """The most confident of all rows, down to a bin in which a hash decides."""
    rng = random.Random(17)
    margins = {i: rng.choice([0.0, 0.5, rng.gauss(0, 1), rng.gauss(3, 2), 900.0]) for i in range(3000)}
    free = spark.createDataFrame(list(margins.items()), "id long, m double").repartition(5)
    draw = {r.id: r.d for r in free.select("id", cotrain._draw("id", 8).alias("d")).collect()}
    for wanted in ({1.0: 300, 0.0: 100}, {1.0: 1, 0.0: 5000}, {1.0: 700, 0.0: 1}):
        got = {r.id: r.y for r in free.select("id", cotrain._confident(free, "m", wanted).alias("y")).collect()}
        for y, n in wanted.items():
            mine = {i: min(math.floor(abs(m) / cotrain.BIN), cotrain.BINS) for i, m in margins.items() if (m > 0 if y else m < 0)}
            given = {i for i, label in got.items() if label == y}
            edge, sure = -1, set()
            for edge in sorted(set(mine.values()), reverse=True):
                last = {i for i, b in mine.items() if b == edge}
                if len(sure) + len(last) >= n:
                    break
                sure |= last
            else:
                last = set()
            part = (n - len(sure)) / len(last) if last else 0
            assert given == sure | {i for i in last if draw[i] < part * cotrain.SHARES}
            assert abs(len(given) - min(n, len(mine))) <= 4 * math.sqrt(len(last)) + 1


def test_co_training_reads_given_features(spark, make):
    """Features made once give the model and the scores that each call's own give."""
    docs = make([(i, junk(30, i) if i % 3 else "the words of a sentence in the text " * (i % 5 + 1)) for i in range(90)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(45)], "doc_id long, quality int")
    features = document_features(docs)
    shared = score(docs, co_train(docs, labels, rounds=2, features=features), features=features)
    own = score(docs, co_train(docs, labels, rounds=2))
    assert {r.doc_id: round(r.score, 6) for r in shared.collect()} == {r.doc_id: round(r.score, 6) for r in own.collect()}


def mix_brute(rows, weights, copies):
    sized = [(i, len(re.findall("[^\x20\x09-\x0d]+", t or "")), s) for i, t, _, s in rows]
    sources = sorted({s for *_, s in sized}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, n, x in sized if x == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target, free, left = {}, set(sources), sum(size.values())
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        full = {s for s in free if copies * size[s] <= level * weight[s]}
        if not full:
            return size, target | {s: level * weight[s] for s in free}
        target |= {s: copies * size[s] for s in full}
        left -= sum(copies * size[s] for s in full)
        free -= full


def test_mix(make, odd):
    rng = random.Random(11)
    rows = [(*r, "en", "odd") for r in odd]
    rows += [(i, "w " * rng.randrange(1, 60), "en", rng.choice(["a", "a", "a", "a", "b", None, "é", "tiny"][: 5 + i % 4])) for i in range(20, 900)]
    size, target = mix_brute(rows, (1, 2, 3), 3)
    got = fair_mix(make(rows), payload=["doc_id", "source", "size"])
    found = got.collect()
    assert len(found) == len(rows) and {r.row["size"] for r in found} == {"clash"}
    taken, longest = {s: 0 for s in size}, {s: 0 for s in size}
    for r in found:
        s = r.row.source
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
        longest[s] = max(longest[s], r["size"])
    assert sum(taken.values()) <= sum(size.values())
    assert all(abs(taken[s] - target[s]) <= longest[s] + max(longest.values()) for s in size)
    again = fair_mix(make(rows[::-1]), payload=["doc_id", "source", "size"]).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    assert mixed_documents(got).count() == sum(r.copies for r in found)


def test_mix_of_nothing(make):
    assert fair_mix(make([])).count() == 0
    assert [r.taken for r in fair_mix(make([(1, None), (2, "  ")])).collect()] == [0, 0]


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(5).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars")
    docs.union(extra).union(docs.limit(3)).write.parquet(str(tmp_path / "documents.parquet"))
    current = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "mix", "encode"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = current
        stage(spark, current, str(tmp_path)).write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
        assert sorted(current.dtypes) == sorted(docs.dtypes) and current.count() > 0
        if name == "near":
            assert current.count() < before.count() and current.distinct().count() == current.count()
    out = corpus_pipeline.run(spark, str(tmp_path))
    texts = current.groupBy("doc_id", F.sha2("text", 256).alias("h")).count()
    assert out.groupBy("doc_id", F.col("decoded_sha256").alias("h")).count().exceptAll(texts).count() == 0
    assert out.count() == current.count()


def test_near_stage_keeps_one_of_each_group(spark, make):
    """Null and repeated identifiers against brute force."""
    rng = random.Random(13)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts)]
    rows += [(None, texts[0] + " more"), (None, "alone " + texts[0][:0] + " ".join(f"z{k}" for k in range(60))), (None, texts[1] + " x")]
    rows += [(7, " ".join(f"y{k}" for k in range(60))), (7, texts[7]), (200, None), (201, ""), (None, None)]

    def shingles(text):
        w = (text or "").split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    want = []
    for i, text in order:
        mine = shingles(text)
        if not any(mine and len(mine & shingles(t)) >= 0.75 * len(mine | shingles(t)) for _, t in want):
            want.append((i, text))
    got = corpus_pipeline.near(spark, make(rows), "").select("doc_id", "text").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def mixed_corpus():
    """Clean, shared, repeated, near and empty documents of a language that has a reference."""
    rng = random.Random(17)
    common = "the of and to in is that for it as".split()
    words = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("nd", "rt", "ll", "ng", "st")]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(n))

    rows = [(i, "\n".join(text(12) for _ in range(8)) + ("\nShared footer line" if i % 2 else "")) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(6)] + rows[:4] + [(None, rows[9][1]), (7, rows[20][1])]
    return rows + [(200, None), (201, ""), (202, "too short"), (203, "same words again and again " * 30)]


def test_stages_of_a_mixed_corpus(spark, make, tmp_path):
    """Every stage, with clashing columns, against brute force on what the stage before kept."""
    docs = make(mixed_corpus())
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != "encode":
            assert sorted(out.columns) == sorted(docs.columns)
        out.write.parquet(str(tmp_path / name))
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()], spark.read.parquet(str(tmp_path / name))
        docs = kept[name][1]

    def pairs(rows):
        return sorted(map(repr, rows))

    def texts(df):
        return [(r.doc_id, r.text) for r in df.collect()]

    before, out = kept["quality"]
    gone = {202, 203, 200, 201}
    assert pairs(texts(out)) == pairs([r for r in before if r[0] not in gone])
    before, out = kept["lines"]
    assert pairs(texts(out)) == pairs([(i, t.removesuffix("\nShared footer line").replace("\nShared footer line end", "\nShared footer line end")) for i, t in before])
    before, out = kept["near"]
    sets = [({tuple(w[k : k + 5]) for k in range(len(w) - 4)}, i, t) for i, t in before for w in [t.split()]]
    groups = []
    for mine, i, t in sorted(sets, key=lambda s: (s[1] is None, s[1] or 0, s[2])):
        if not any(100 * len(mine & s) >= 75 * len(mine | s) for s, *_ in groups):
            groups.append((mine, i, t))
    assert pairs(texts(out)) == pairs([g[1:] for g in groups])
    before, out = kept["mix"]
    sizes = Counter(before)
    taken = Counter(texts(out))
    assert set(taken) <= set(sizes) and all(n <= 3 * sizes[r] for r, n in taken.items())
    budget = sum(len(t.split()) for _, t in before)
    total = sum(len(t.split()) * n for (_, t), n in taken.items())
    assert budget - max(len(t.split()) for _, t in before) < total <= budget
    before, out = kept["encode"]
    assert pairs([(r.doc_id, r.decoded_sha256) for r in out.collect()]) == pairs([(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in before])


def test_pipeline_of_nothing(spark, make, tmp_path):
    make([]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_delete_what_the_stage_before_wrote(spark, make, tmp_path):
    first = corpus_pipeline.quality(spark, make(mixed_corpus()), "")
    folders = list(corpus_pipeline.left_by_last)
    assert folders and all(Path(f).exists() for f in folders)
    first.write.parquet(str(tmp_path / "quality"))
    corpus_pipeline.lines(spark, spark.read.parquet(str(tmp_path / "quality")), "").count()
    assert not any(Path(f).exists() for f in folders)
    # a stage whose result was not written keeps what it reads
    again = corpus_pipeline.quality(spark, make(mixed_corpus()), "")
    assert corpus_pipeline.near(spark, again, "").count() > 0


def test_targets_of_very_many_sources(spark):
    """Work in proportion to the sources: the frames of the targets are running ones."""
    sizes = spark.range(200_000).selectExpr("lpad(id, 7, '0') AS mix_source", "1 + id * 7919 % 1000 AS slice_size")
    found = targets(sizes, (1, 2, 3), 1.0, 3)
    row = found.agg(F.count("*").alias("n"), F.sum("source_size").alias("words"), F.sum("target").alias("target")).first()
    assert row["n"] == 200_000 and row["target"] == pytest.approx(row["words"], rel=1e-9)
    assert found.where("target > 3 * source_size + 1e-6").isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "currentrow$(), unboundedfollowing$()" not in plan

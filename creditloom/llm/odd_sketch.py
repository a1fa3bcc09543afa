"""MinHash near-duplicates: banded candidates, odd sketches, exact links on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import attach_by_leaf, text_of
from creditloom.llm.graph import components
from creditloom.session import materialize

WORDS = 5
BANDS, ROWS = 36, 4
"""A pair at a similarity of 0.75 shares none of the bands with a chance of 1e-6."""
SKETCH_BITS = 512
PARITY_BITS = 1024
"""Bits of the parity bitmap of a whole set."""
BLOCK = 2048
REMEMBER = 300_000
"""Word hashes that a task remembers."""
FEW = 64
"""Members of a bucket outside its main component that are compared with all members directly."""
MEMBERS = 1024
"""Members of a larger bucket that are compared in one block."""
LEAVES = 64
MAX_FILTER = 1 << 27
"""Bits of the filter of wanted sets, the bound of what is sent to the tasks (16 MB)."""
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SIGNED = "id long, n long, digest binary, bands array<long>, sketch array<long>, parity array<long>"
ODD = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20)
TIMES = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
PLUS = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct 5-word shingles; a shorter text is one shingle."""
    found = text.encode().translate(TO_WORDS).split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, min(len(h), WORDS), dtype=np.uint64)
    for i in range(min(len(h), WORDS)):
        out = _mix(out) + h[i : i + n]
    return np.unique(_mix(out))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _minima(found: np.ndarray) -> np.ndarray:
    x = (found >> np.uint64(32)).astype(np.uint32)[:, None]
    blocks = [(x[i : i + BLOCK] * TIMES + PLUS).min(axis=0) for i in range(0, len(x), BLOCK)]
    return np.minimum.reduce(blocks)


def _bands(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key) + rows[:, i]
    return _mix(key).view(np.int64)


def _sketch(minima: np.ndarray) -> np.ndarray:
    """Parity bitmap: every sample (position, minimum) flips one bit."""
    return _parity(_mix(_mix(np.arange(len(minima), dtype=np.uint64)) + minima), SKETCH_BITS)


def _parity(numbers: np.ndarray, bits: int) -> np.ndarray:
    flips = np.bincount((numbers % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def most_differing(similarity: float) -> int:
    """Expected bits in the XOR of two odd sketches of sets with the similarity."""
    differing = 2 * BANDS * ROWS * (1 - similarity)
    return round(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing))


def near_duplicates(
    docs: DataFrame, percent: int = 75, sketch_floor: float = 0.42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document with the component of its links.

    Documents are linked when the Jaccard similarity of their sets of 5-word shingles (A-Z in lower
    case) is at least `percent` / 100. Documents with equal sets are one class, and only classes are
    compared. 144 MinHash samples make 36 bands of 4; a bucket is the classes that share a band. The
    samples folded into a parity bitmap of 512 bits, the odd sketch, estimate a candidate pair's
    similarity from the population count of the XOR; pairs that it puts below `sketch_floor`, eight
    standard deviations under the threshold, are left. A second bitmap of 1024 bits has the parity of
    the whole set: the XOR of two has at most one bit for each shingle of one set only, so a pair with
    more bits than a link may have such shingles is no link for certain. This spares short documents
    around one passage. All others are confirmed on their full sets.

    Buckets are never expanded into all pairs. First every member meets the bucket's smallest; links
    make components, and members of one component need no further comparison. Members outside
    then meet a random one of each other component that a bucket offers. What is left are buckets with
    several components, whose members outside the main component meet all members of others: up to 64
    such members inside a join, more in blocks of members dealt over many tasks. Sketches are
    compared right there, so that only likely pairs leave it, each counted in its first shared bucket.

    Sets are made again from the text for classes in shared buckets only, chosen by a bitmap of
    bounded size, and written once.
    Nothing of the size of the corpus reaches the driver.

    Null and empty texts have no shingles, no links, and are kept. Rows repeated with identifier and
    text are in one component; all are kept or none. Null identifiers count as larger than others; a
    component of nulls only has a null component_id and is kept. Other columns are ignored.

    Returns doc_id, n_shingles, component_id, kept.
    """
    read = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    signed = materialize(
        read.mapInArrow(_sign, SIGNED).withColumn(
            "leaf", F.pmod(F.xxhash64("id"), F.lit(LEAVES)).cast("int")
        ),
        "signatures",
    )
    classes = materialize(
        signed.where("n > 0").groupBy("digest").agg(
            F.min("id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"), F.first("parity").alias("parity"),
        ),
        "classes",
    )
    banded = classes.select("digest", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("digest").alias("smallest"), F.count("*").alias("m")).where("m > 1")
    members = materialize(banded.join(shared, "bucket").select("bucket", "digest", "smallest"), "members")

    floor = most_differing(sketch_floor)
    first = members.where("digest <> smallest").select(F.col("digest").alias("a"), F.col("smallest").alias("b"))
    sets = _sets_of(members.select("digest").distinct(), read)
    links = _confirm(_likely(first, classes, percent, floor), sets, percent)
    labelled = _labelled(members, components(links))
    mixed = labelled.groupBy("bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"),
        F.max_by(F.struct("digest", "root"), F.xxhash64("bucket", "digest")).alias("other"),
    ).where("low <> high").select("bucket", "other")
    second = labelled.join(mixed, "bucket").where("root <> other.root")
    second = second.groupBy(F.col("digest").alias("a"), "other.root").agg(F.max("other.digest").alias("b"))
    likely = _likely(second.select("a", "b"), classes, percent, floor)
    links = materialize(links.union(_confirm(likely, sets, percent)), "links")

    rest = _remaining(_labelled(members, components(links)), classes, percent, floor)
    links = links.union(_confirm(rest, sets, percent))

    roots = components(links)
    found = classes.select("digest", "least").join(roots, classes["digest"] == roots["node"], "left")
    found = found.select("digest", "least", F.coalesce("root", "digest").alias("root"))
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = attach_root(found, least)
    rows = signed.select("id", "n", "digest", "leaf")
    linked = attach_by_leaf(rows.where("n > 0"), groups, ["digest"]).select("id", "n", "component_id")
    return linked.union(rows.where("n = 0").select("id", "n", F.col("id"))).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def attach_root(found: DataFrame, least: DataFrame) -> DataFrame:
    """digest, component_id: a component's number for all its classes, large ones spread over leaves."""
    spread = found.withColumn("leaf", F.pmod(F.xxhash64("digest"), F.lit(LEAVES)).cast("int"))
    return attach_by_leaf(spread, least, ["root"]).select("digest", "component_id")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, digests, bands, sketches, parities = [], [], [], [], []
        for text in batch.column(1):
            found = shingles(text.as_py(), hashes)
            sizes.append(len(found))
            digests.append(_digest(found))
            if len(found):
                minima = _minima(found)
                bands.append(_bands(minima))
                sketches.append(_sketch(minima))
                parities.append(_parity(found, PARITY_BITS))
        some = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64) > 0)])

        def lists(values, n):
            flat = np.concatenate(values) if values else np.empty(0, dtype=np.int64)
            return pa.ListArray.from_arrays(pa.array(some * n, pa.int32()), pa.array(flat, pa.int64()))

        yield pa.record_batch(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                lists(bands, BANDS), lists(sketches, SKETCH_BITS // 64), lists(parities, PARITY_BITS // 64),
            ],
            ["id", "n", "digest", "bands", "sketch", "parity"],
        )


def _differing(a: Column, b: Column, bits: int) -> Column:
    """Population count of the XOR of two bitmaps."""
    parts = (F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(bits // 64))
    return sum(parts, F.lit(0))


def _alike(a: str, b: str, percent: int, floor: int) -> Column:
    """Whether sizes and bitmaps allow a link.

    With d shingles in one of the sets only, 100 * (n + m - d) >= percent * (n + m + d) for a link.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = _differing(F.col(f"{a}.parity"), F.col(f"{b}.parity"), PARITY_BITS)
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & (_differing(F.col(f"{a}.sketch"), F.col(f"{b}.sketch"), SKETCH_BITS) <= floor)
        & ((100 + percent) * apart <= (100 - percent) * (n + m))
    )


def _likely(pairs: DataFrame, classes: DataFrame, percent: int, floor: int) -> DataFrame:
    """The distinct pairs a > b that sizes and bitmaps allow."""
    facts = classes.select("digest", F.struct("n", "sketch", "parity").alias("facts"))
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = pairs.join(facts.toDF("a", "x"), "a").join(facts.toDF("b", "y"), "b")
    return pairs.where(_alike("x", "y", percent, floor)).select("a", "b")


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, digest, root of all members."""
    known = members.select("bucket", "digest").join(roots, members["digest"] == roots["node"], "left")
    return materialize(known.select("bucket", "digest", F.coalesce("root", "digest").alias("root")), "labelled")


def _remaining(labelled: DataFrame, classes: DataFrame, percent: int, floor: int) -> DataFrame:
    """Likely pairs between components that share a bucket."""
    counts = labelled.groupBy("bucket", "root").agg(F.count("*").alias("m"))
    main = counts.groupBy("bucket").agg(F.sum("m").alias("m"), F.max_by("root", F.struct("m", "root")).alias("main"),
                                        F.max("m").alias("in_main")).where("m > in_main")
    sized = labelled.join(main, "bucket").withColumn("outside", F.col("m") - F.col("in_main"))
    sized = materialize(sized, "mixed-buckets")
    facts = classes.select("digest", "n", "sketch", "parity")

    few = _with_list(sized.where(F.col("outside") <= FEW).select("bucket", "digest", "root", "main")).join(
        facts, "digest"
    )
    pairs = few.where("root <> main").alias("x").join(
        few.alias("y"),
        (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") != F.col("y.root"))
        & _alike("x", "y", percent, floor)
        & (F.col("x.bucket") == F.array_min(F.array_intersect("x.buckets", "y.buckets"))),
    ).select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b"))

    many = sized.where(F.col("outside") > FEW).join(
        classes.select("digest", "n", "sketch", "parity", "bands"), "digest"
    )
    more = _blocks(many).groupBy("bucket", "i", "j").applyInArrow(
        lambda table: _compared(table, percent, floor), "a binary, b binary"
    )
    both = pairs.union(more)
    return both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _blocks(rows: DataFrame) -> DataFrame:
    """The rows of large buckets, dealt to the pairs (i, j) of blocks in which they are compared.

    Blocks of members outside the main component come first; each meets itself and all later ones.
    A row is repeated once per block it meets, so that a bucket of any size is compared by many tasks.
    """
    cut = rows.withColumn("first", F.greatest(F.lit(1), F.ceil(F.col("outside") / MEMBERS)).cast("int")).withColumn(
        "blocks", F.when(F.col("m") <= MEMBERS, F.col("first")).otherwise(
            F.col("first") + F.ceil(F.col("in_main") / MEMBERS).cast("int")
        )
    )
    apart = F.col("root") != F.col("main")
    nth = F.xxhash64("digest")
    later = F.col("blocks") - F.col("first")
    block = F.when(apart | (later == 0), F.pmod(nth, F.col("first"))).otherwise(
        F.col("first") + F.pmod(nth, F.greatest(later, F.lit(1)))
    )
    cut = cut.withColumn("apart", apart).withColumn("block", block.cast("int"))
    earlier = F.transform(
        F.sequence(F.lit(0), F.least("block", F.col("first") - 1)),
        lambda i: F.struct(i.alias("i"), F.col("block").alias("j")),
    )
    after = F.filter(
        F.transform(
            F.sequence(F.col("block"), F.col("blocks")), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))
        ),
        lambda p: (p["j"] > p["i"]) & (p["j"] < F.col("blocks")) & (p["i"] < F.col("first")),
    )
    dealt = cut.withColumn("pair", F.explode(F.concat(earlier, after)))
    return dealt.select("bucket", "pair.*", "block", "apart", "digest", "root", "n", "sketch", "parity", "bands")


def _compared(table: pa.Table, percent: int, floor: int) -> pa.Table:
    """The pairs of block i outside the main component and block j that sizes, bitmaps and roots allow.

    A pair that shares an earlier band is left to the bucket of that band.
    """

    def matrix(name: str) -> np.ndarray:
        return table.column(name).combine_chunks().flatten().to_numpy().reshape(len(table), -1)

    digests = table.column("digest").combine_chunks()
    roots = table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
    n, block = table.column("n").to_numpy(), table.column("block").to_numpy()
    sketches, parities, bands = matrix("sketch"), matrix("parity"), matrix("bands")
    band = int(np.flatnonzero(bands[0] == table.column("bucket")[0].as_py())[0])
    apart = table.column("apart").to_numpy(zero_copy_only=False)
    left = np.flatnonzero(apart & (block == table.column("i")[0].as_py()))
    right = np.flatnonzero(block == table.column("j")[0].as_py())
    found = []
    for at in range(0, len(left), 64):
        x = left[at : at + 64]
        smaller = np.minimum.outer(n[x], n[right])
        alike = (100 * smaller >= percent * np.maximum.outer(n[x], n[right])) & (roots[x][:, None] != roots[right])
        one, other = np.nonzero(alike)
        one, other = x[one], right[other]
        near = _apart(sketches, one, other) <= floor
        one, other = one[near], other[near]
        near = (100 + percent) * _apart(parities, one, other) <= (100 - percent) * (n[one] + n[other])
        one, other = one[near], other[near]
        new = ~(bands[one, :band] == bands[other, :band]).any(axis=1)
        found.append((one[new], other[new]))
    one, other = (np.concatenate([f[side] for f in found] or [np.empty(0, np.int64)]) for side in (0, 1))
    return pa.table({"a": digests.take(pa.array(one)), "b": digests.take(pa.array(other))})


def _apart(bitmaps: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Population counts of the XOR of bitmaps, pair by pair."""
    total = np.zeros(len(one), dtype=np.int64)
    for word in bitmaps.view(np.uint64).T:  # numpy counts the bits of a negative number's absolute value
        total += np.bitwise_count(word[one] ^ word[other])
    return total


def _with_list(rows: DataFrame) -> DataFrame:
    """The rows with all buckets that their class has among them: a pair counts in its first shared one."""
    lists = rows.groupBy("digest").agg(F.collect_set("bucket").alias("buckets"))
    return rows.join(lists, "digest")


def _sets_of(wanted: DataFrame, read: DataFrame) -> DataFrame:
    """digest and full set of the wanted classes, and of a few others."""
    wanted = materialize(wanted, "wanted")
    n = wanted.count()
    bits = min(MAX_FILTER, 1 << max(16, math.ceil(math.log2(64 * n + 1))))
    number = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long") % bits + 1
    maps = wanted.select(number.alias("x")).groupBy(F.bitmap_bucket_number("x").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")
    )
    chosen = np.zeros(bits // 8, dtype=np.uint8)
    for row in maps.toLocalIterator():
        at = (row["piece"] - 1) * 4096
        chosen[at : at + 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    chosen = read.sparkSession.sparkContext.broadcast(chosen)
    sets = read.select("text").mapInArrow(
        lambda batches: _sets(batches, chosen.value, bits), "digest binary, items binary"
    ).dropDuplicates(["digest"])
    return materialize(sets, "sets")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked, by their full sets."""
    full = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return materialize(
        full.mapInArrow(lambda batches: _linked(batches, percent), "a binary, b binary"), "confirmed"
    )


def _sets(batches: Iterator[pa.RecordBatch], chosen: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    hashes, seen = WordHashes(), set()
    for batch in batches:
        digests, items = [], []
        for text in batch.column(0):
            found = shingles(text.as_py(), hashes)
            digest = _digest(found)
            at = int.from_bytes(digest[:7], "big") % bits
            if len(found) and chosen[at >> 3] >> (at & 7) & 1 and digest not in seen:
                seen.add(digest)
                digests.append(digest)
                items.append(found.tobytes())
        yield pa.record_batch([pa.array(digests, pa.binary()), pa.array(items, pa.binary())], ["digest", "items"])


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y"))
        linked = []
        for x, y in zip(*sides):
            x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= percent * (len(x) + len(y) - both))
        names = ["a", "b"]
        yield pa.record_batch(
            [batch.column(batch.schema.get_field_index(c)).filter(pa.array(linked, pa.bool_())) for c in names], names
        )

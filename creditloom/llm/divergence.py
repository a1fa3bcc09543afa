"""Quality rules by distribution divergence from language references, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import SPACE, text_of, words
from creditloom.session import materialize

# Frequent function words of each language.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist"),
    "en": ("the", "of", "and", "to", "in", "that", "is", "for", "it", "on"),
    "es": ("de", "la", "que", "el", "en", "los", "se", "del", "las", "por"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "que"),
}
# The two-letter codes of ISO 639.
LANGUAGES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo "
    "es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka "
    "kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng "
    "nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su "
    "sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()
OTHER = "other"
"""Languages without a list."""
UNTAGGED = "*"
"""Null tags and those that name no language."""
CHAR_CLASSES = {
    "digit": "[0-9]",
    "upper": "[A-Z]",
    "symbol": "[#*$%&|<>]",
    "punctuation": r"[!-\x22'-)+-/:;=?-@\[-`{}~]",
    "space": f"[{SPACE}]",
    "beyond": r"[^\x00-\x7F]",
}
"""Every other character, small letters above all, is in a class of its own."""
WINDOW = 8


def quality_rules(
    docs: DataFrame, min_words: int = 20, max_repeat_pct: int = 30, judge_words: int = 50,
    max_char_divergence: float = 0.04, max_word_divergence: float = 0.062,
    char_allowance: float = 2.0, word_allowance: float = 1.2, text_col: str = "text", lang_col: str = "lang", payload: list[str] | None = None,
) -> DataFrame:
    """Base counts of every whole text and whether it is kept.

    Base: fewer than `min_words` words, or over `max_repeat_pct` percent of the words inside 8-word
    windows that occur twice or more. Divergence: a language's reference is the sum of its documents'
    histograms of character classes, and of the language's common words with all other words in one
    bin; only documents that pass the base rules and are tagged with a language that has a list are in a
    reference. A text is compared by the Jensen-Shannon divergence in bits (the distance's square): its
    characters to the nearest reference, as the language tag may be wrong, its words to that of its
    language, or the nearest one if its tag is null or names no language. It may differ by the given
    maximum and an allowance divided by its number of words, as short texts differ by chance; those of
    fewer than `judge_words` words are not judged, nor are the words of languages without a list. In the
    characters of those languages letters of any script are one class.

    Windows are compared by 64-bit hashes, built from word hashes by doubling; only texts with a
    repeated window sort their windows. Every text stays in its row: nothing but a few sums per
    language is shuffled; the references, as many as the lists at most, become literals.

    Null and empty texts have no words and fail. Without any reference no text is judged by divergence.
    Every row is judged by itself, repeated ones too. An empty table gives an empty result. `payload`
    names the columns to carry in the struct `row` (all by default).

    Returns row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_divergence,
    word_divergence (from the tag's language), nearest_word_divergence (of untagged texts; all three
    null where not judged), base_failed, kept.
    """
    text = text_of(text_col)
    lang = F.col(lang_col).cast("string")
    known = F.when(lang.isin(*COMMON_WORDS), lang).when(lang.isin(*LANGUAGES), OTHER).otherwise(F.lit(UNTAGGED))
    lists = F.create_map(
        *[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))],
        F.lit(OTHER), F.array().cast("array<string>"),
        F.lit(UNTAGGED), F.array(*[F.lit(w) for v in COMMON_WORDS.values() for w in v]),
    )
    read = docs.select(
        F.struct(*[F.col(c) for c in (docs.columns if payload is None else payload)]).alias("row"),
        known.alias("reference"), text.alias("text"), words(text).alias("words"),
    )
    chars = [_count("text", c) for c in CHAR_CLASSES.values()]
    counted = read.select(
        "row", "reference",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _dup_lines(F.col("text")).alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.array(*chars).alias("in_class"),
        _common(F.col("words"), lists[F.col("reference")]).alias("common"),
    )
    counted = materialize(counted, "quality-counts").withColumns(
        {
            "chars": F.concat("in_class", F.array(F.col("n_chars") - _total("in_class"))),
            "used": F.concat("common", F.array(F.col("n_words") - _total("common"))),
            "base_failed": (F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")),
        }
    )
    char_bins, word_bins = len(CHAR_CLASSES) + 1, max(map(len, COMMON_WORDS.values())) + 1
    sums = counted.where(F.col("reference").isin(*COMMON_WORDS) & ~F.col("base_failed")).groupBy("reference").agg(
        *[F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(char_bins)],
        *[F.sum(F.get("used", F.lit(i))).alias(f"w{i}") for i in range(word_bins)],
    )
    references = {
        r["reference"]: ([r[f"c{i}"] for i in range(char_bins)], [r[f"w{i}"] or 0 for i in range(word_bins)])
        for r in sums.collect()
    }
    nothing = F.lit(None).cast("double")

    def nearest(distances: list[Column]) -> Column:
        return F.array_min(F.array(nothing, *distances))

    def letters_as_one(bins: list) -> list:
        return [*bins[:-2], bins[-2] + bins[-1]]

    chars = nearest([divergence("chars", _shares(c)) for c, _ in references.values()])
    pooled = F.array(*letters_as_one([F.get("chars", F.lit(i)) for i in range(char_bins)]))
    any_script = nearest([divergence(pooled, _shares(letters_as_one(c))) for c, _ in references.values()])
    used = [F.when(F.col("reference") == name, divergence("used", _shares(w))) for name, (_, w) in references.items()]
    first, of_list = 1, {}
    for name, names in COMMON_WORDS.items():
        found = F.slice("common", first, len(names))
        of_list[name] = F.concat(found, F.array(F.col("n_words") - _total(found)))
        first += len(names)
    any_list = nearest([divergence(of_list[name], _shares(w)) for name, (_, w) in references.items()])
    long_enough = F.col("n_words") >= judge_words
    symbol = list(CHAR_CLASSES).index("symbol")
    judged = counted.select(
        "row", "n_words", "word_chars", F.get("in_class", F.lit(symbol)).alias("n_symbols"), "n_dup_lines",
        "n_repeat_words",
        F.when(long_enough, F.when(F.col("reference") == OTHER, any_script).otherwise(chars)).alias("char_divergence"),
        F.when(long_enough, F.coalesce(nothing, *used)).alias("word_divergence"),
        F.when(long_enough & (F.col("reference") == UNTAGGED), any_list).alias("nearest_word_divergence"),
        "base_failed",
    )
    far = (F.col("char_divergence") > max_char_divergence + char_allowance / F.col("n_words")) | (
        F.coalesce("word_divergence", "nearest_word_divergence") > max_word_divergence + word_allowance / F.col("n_words")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))


def _shares(counts: list[int]) -> list[float]:
    return [n / max(1, sum(counts)) for n in counts]


def divergence(counts: str | Column, reference: list[float]) -> Column:
    """Jensen-Shannon divergence in bits of counts and a reference's shares; null without counts."""

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a / 2 * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    shares = F.array(*map(F.lit, reference))
    terms = let(
        _total(counts),
        lambda all_: F.zip_with(
            counts, shares, lambda n, q: let(n / all_, lambda p: term(p, q) + term(q, p))
        ),
    )
    return F.when(
        (_total(counts) > 0) & F.lit(sum(reference) > 0),
        F.aggregate(terms, F.lit(0.0), lambda total, t: total + t),
    )


def _total(counts: str | Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n)


def _count(text: str, char_class: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, f"{char_class}+", ""))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, though the body names it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _common(found: Column, wanted: Column) -> Column:
    """How often each of the wanted words is found."""
    return let(
        wanted,
        lambda names: let(
            F.filter(found, lambda w: F.array_contains(names, w)),
            lambda hits: F.transform(names, lambda n: F.size(F.filter(hits, lambda w: w == n)).cast("long")),
        ),
    )


def _repeat_words(found: Column) -> Column:
    """Words inside windows that occur twice or more."""

    def doubled(hashes: Column, shift: int) -> Column:
        n = F.size(hashes) - shift
        return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, shift + 1, n), lambda a, b: F.xxhash64(a, b))

    def windows(single: Column) -> Column:
        return let(doubled(single, 1), lambda two: let(doubled(two, 2), lambda four: doubled(four, 4)))

    def covered(starts: Column) -> Column:
        """Words that windows at the sorted starts cover."""
        none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
        return F.aggregate(
            starts, none,
            lambda done, s: F.struct(
                (done["words"] + s + WINDOW - F.greatest(done["end"], s)).alias("words"), (s + WINDOW).alias("end")
            ),
        )["words"]

    def repeated(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(x: Column) -> Column:
            n = F.size(x)
            nobody = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
            beside = F.zip_with(
                F.concat(nobody, F.slice(x, 1, n - 1)), F.concat(F.slice(x, 2, n - 1), nobody),
                lambda a, b: F.struct(a["h"].alias("before"), b["h"].alias("after")),
            )
            both = F.zip_with(
                x, beside,
                lambda a, b: F.when(
                    a["h"].eqNullSafe(b["before"]) | a["h"].eqNullSafe(b["after"]), a["i"]
                ),
            )
            return F.array_sort(F.filter(both, lambda i: i.isNotNull()))

        return let(let(ordered, marked), covered)

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), repeated(hashes)).otherwise(F.lit(0))

    single = F.transform(found, lambda w: F.xxhash64(w))
    return F.when(F.size(found) > WINDOW, let(let(single, windows), counted)).otherwise(F.lit(0))

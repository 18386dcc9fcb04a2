"""Quality rules by distribution divergence (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import materialize
from .systematic_mix import SPACE_RUN, SPACES

# Frequent function words of four languages, in natural order.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "a", "that", "is", "was", "for", "it", "with", "on", "by", "from",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht",
    "de", "la", "le", "et", "les", "en", "un", "une", "que", "dans", "est", "pour", "par", "qui", "du",
    "el", "y", "los", "las", "se", "por", "con", "para", "una", "su", "al", "como", "más", "lo", "es",
)

# Character classes as Java patterns of what does NOT belong to the class.
CHAR_CLASSES = (
    ("lower", r"[^a-z]+"),
    ("upper", r"[^A-Z]+"),
    ("other_letter", r"[\P{L}a-zA-Z]+"),
    ("digit", r"[^0-9]+"),
    ("space", r"[^\x20\x09-\x0D]+"),
    ("symbol", r"[^#*$%&|<>@=+~^_/\\{}\[\]]+"),
)

#: Distances (0..1) above which a document is rejected, and the sizes from which they count.
MAX_CHAR_DISTANCE, MIN_CHARS = 0.30, 200
MAX_WORD_DISTANCE, MIN_WORDS = 0.25, 60
#: A text of n words may exceed the word distance by this over sqrt(n): sampling noise.
WORD_NOISE = 0.9
#: A language serves as reference from so many words on; below, the pooled one does.
MIN_REFERENCE_WORDS = 1000
#: So many references (half a kilobyte each) are sent to every task; more are joined by shuffle.
MAX_BROADCAST_LANGUAGES = 5000


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur at least twice in ``words``."""
    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, j: F.least(F.lit(5), F.coalesce(F.get(at, j + 1) - p, F.lit(5))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def repeated(sorted_: Column) -> Column:
        same = F.transform(sorted_, lambda x, j: F.when(
            x["h"].eqNullSafe(F.get(sorted_, j - 1)["h"]) | x["h"].eqNullSafe(F.get(sorted_, j + 1)["h"]), x["i"]))
        return _let(F.sort_array(F.filter(same, lambda p: p.isNotNull())), covered)

    def windows(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _let(F.array_sort(pairs), repeated))

    starts = F.sequence(F.lit(1), F.size(words) - 4)
    return F.when(F.size(words) > 5, _let(F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, 5))), windows)
                  ).otherwise(F.lit(0))


def base_features(documents: DataFrame) -> DataFrame:
    """Counts of every document, without its text: doc_id, lang, the base
    columns, ``chars`` (one count per character class and the rest) and
    ``commons`` (one count per common word and the rest)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(SPACES))
    words = F.when(F.length(bare) > 0, F.split(bare, SPACE_RUN)).otherwise(F.array().cast("array<string>"))

    def of_words(w: Column) -> Column:
        known = F.filter(w, lambda x: x.isin(*COMMON_WORDS))
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        _repeated_words(w).cast("long").alias("n_repeat_words"),
                        F.concat(F.lit(" "), F.array_join(known, "  "), F.lit(" ")).alias("known"))

    def of_lines(lines: Column) -> Column:
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    rows = documents.select("doc_id", "lang", text.alias("text")).select(
        "doc_id", "lang", "text", F.inline(F.transform(F.array(words), of_words)))
    used = [F.length(F.regexp_replace("text", pattern, "")).cast("long") for _, pattern in CHAR_CLASSES]
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    counted = [F.floor((F.length("known") - F.length(F.replace(F.col("known"), F.lit(f" {w} "), F.lit(""))))
                       / (len(w) + 2)).cast("long") for w in COMMON_WORDS]
    out = rows.select(
        "doc_id", "lang", "n_words", "n_repeat_words", F.length("text").cast("long").alias("n_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, of_lines).alias("n_dup_lines"),
        F.array(*used).alias("chars"), F.array(*counted).alias("commons"))

    def with_rest(counts: str, total: str) -> Column:
        rest = F.col(total) - F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
        return F.array_append(F.col(counts), F.greatest(rest, F.lit(0).cast("long")))

    space = [name for name, _ in CHAR_CLASSES].index("space")
    return out.withColumns({
        "word_chars": F.col("n_chars") - F.col("chars")[space],
        "chars": with_rest("chars", "n_chars"), "commons": with_rest("commons", "n_words")})


def references(features: DataFrame, min_words: int = MIN_REFERENCE_WORDS) -> DataFrame:
    """Histograms of every language over all documents, and of all documents
    together (``ref`` null): (ref, ref_chars, ref_commons)."""
    def summed(counts: str) -> DataFrame:
        bins = features.select("lang", "n_words", F.posexplode(counts).alias("bin", "n"))
        per = bins.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
        pooled = per.groupBy("bin").agg(F.sum("n").alias("n")).select(
            F.lit(None).cast("string").alias("ref"), "bin", "n")
        both = per.where(F.col("lang").isNotNull()).select(F.col("lang").alias("ref"), "bin", "n").unionByName(pooled)
        return both.groupBy("ref").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("bin", "n"))), lambda x: x["n"]).alias("ref_" + counts))

    chars, commons = summed("chars"), summed("commons")
    enough = F.aggregate("ref_commons", F.lit(0).cast("long"), lambda a, b: a + b) >= min_words
    return chars.join(commons.withColumnRenamed("ref", "r"), F.col("ref").eqNullSafe(F.col("r"))).drop("r").where(
        enough | F.col("ref").isNull())


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0..1) of two count histograms; null if one is empty."""
    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    def distance(sums: Column) -> Column:
        shares = F.zip_with(p, q, lambda a, b: F.struct((a / sums["p"]).alias("p"), (b / sums["q"]).alias("q")))
        terms = F.transform(shares, lambda x: part(x["p"], x["q"]) + part(x["q"], x["p"]))
        return F.when((sums["p"] > 0) & (sums["q"] > 0), F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2)))

    return _let(F.struct(total(p).alias("p"), total(q).alias("q")), distance)


def quality_verdicts(documents: DataFrame, max_char_distance: float = MAX_CHAR_DISTANCE,
                     max_word_distance: float = MAX_WORD_DISTANCE, min_chars: int = MIN_CHARS,
                     min_words: int = MIN_WORDS, word_noise: float = WORD_NOISE) -> DataFrame:
    """Base counts, distances to the document's language and the verdict.

    Every document is compared with the histograms of its ``lang`` over all
    documents (null or rare languages: of all documents together).  A document
    fails the base rule with fewer than 10 words or more than 20 % of them in
    repeated 5-word windows; it fails the method when it is long enough
    (``min_chars`` / ``min_words``) and a distance is above its limit, which
    for words grows for short texts (``word_noise``).  Null
    and empty texts have no words and fail the base rule; repeated rows are
    judged one by one; columns other than doc_id, text, lang are ignored; an
    empty table gives an empty result.
    """
    features = materialize(base_features(documents), "quality-features")
    refs = materialize(references(features), "quality-references")
    small = F.broadcast if refs.count() <= MAX_BROADCAST_LANGUAGES else (lambda df: df)
    known = refs.where(F.col("ref").isNotNull())
    pooled = refs.where(F.col("ref").isNull()).select(
        F.col("ref_chars").alias("all_chars"), F.col("ref_commons").alias("all_commons"), F.lit(1).alias("one"))
    rows = (features.join(small(known), features["lang"] == known["ref"], "left").withColumn("one", F.lit(1))
            .join(F.broadcast(pooled), "one", "left"))
    distance = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        js_distance(F.col("chars"), F.coalesce("ref_chars", "all_chars")).alias("char_distance"),
        js_distance(F.col("commons"), F.coalesce("ref_commons", "all_commons")).alias("word_distance"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    allowed = max_word_distance + word_noise / F.sqrt(F.col("n_words"))
    strange = (((F.col("n_chars") >= min_chars) & (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance))
               | ((F.col("n_words") >= min_words) & (F.coalesce("word_distance", F.lit(0.0)) > allowed)))
    return distance.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~strange).alias("kept"), "char_distance", "word_distance")

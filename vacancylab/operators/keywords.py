"""Keyword dictionaries and text tagging (K1-K7).

Tagging is one scan of ``postings``: the dictionary is small and bounded.  AI
keywords (tens) become an OR chain of ``contains`` inside whole-stage codegen;
technology patterns (hundreds) an automaton that scans each text once in
Arrow-batched workers.  No join with the dictionary, no shuffle - the tags come
out of the scan stage, and only the anti join against already stored tags
shuffles.  Case never matters: texts and keywords are lower-cased alike.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import (apply_condition, batch_condition, combine_conditions,
                                    country_condition, keyword_condition)
from ..functions.matching import group_matcher
from ._util import MAX_DICTIONARY_ROWS, collect_bounded

LANGUAGES = ("en", "de", "fr", "it")

# The AI keyword list (English) the stored AI tags are built from.
# The last entry is one keyword because the source list ends without a comma.
AI_KEYWORDS_EN = [
    "machine learning", "computer vision", "machine vision", "deep learning",
    "virtual agents", "image recognition", "natural language processing",
    "speech recognition", "pattern recognition", "object recognition",
    "neural networks", "ai chatbot", "supervised learning", "text mining",
    "support vector machines", "unsupervised learning", "image processing",
    "mahout", "recommender systems", "support vector machines (svm)",
    "random forests", "latent semantic analysis", "sentiment analysis",
    "opinion mining", "latent dirichlet allocation", "predictive models",
    "kernel methods", "keras", "gradient boosting", "opencv", "xgboost",
    "libsvm", "word2vec", "chatbot",
    "machine translation and sentiment classification",
]

# Technology fields and their codes.
TECH_FIELDS = [
    ("3d printing", 1), ("Autonomous Cars", 2), ("Bispecific monoclonal antibody", 3),
    ("Cloud computing", 4), ("Computer vision", 5), ("Drug conjugates", 6),
    ("Electronic gaming", 7), ("Millimeter wave", 8), ("Fingerprint sensor", 9),
    ("Fracking", 10), ("GPS", 11), ("Hybrid vehicle electric car", 12),
    ("Lane departure warning", 13), ("Lithium battery", 14), ("Machine Learning AI", 15),
    ("Mobile payment", 16), ("Oled display", 17), ("Online streaming", 18),
    ("Rfid tags", 19), ("Search Engine", 20), ("Smart devices", 21),
    ("Social Networking", 22), ("Software defined radio", 23), ("Solar Power", 24),
    ("Stent graft", 25), ("Touchscreen", 26), ("Virtual Reality", 27), ("Wifi", 28),
    ("Wireless charging", 29),
]


# Translations that are replaced, and the field whose keywords are one pattern.
TECH_REPLACEMENTS = [
    ("Cloud computing", "it", "pas", "paas"),
    ("Cloud computing", "it", "saa", "saas"),
    ("Online streaming", "fr", "direct", "transmission en direct"),
]
ONE_PATTERN_FIELD = ("Oled display", " oled")


# --------------------------------------------------------------------- K1 / K2
def build_tech_dictionary(fields: DataFrame, keywords: DataFrame) -> DataFrame:
    """K1: join technology fields with their keywords on ``bloom_code``;
    non-breaking spaces become spaces, keywords are lower-cased, and the fixed
    replacements apply.  Columns: bloom_field, bloom_code and the language
    columns that ``keywords`` has (translations are inputs)."""
    joined = fields.join(keywords, "bloom_code", "inner")

    def cleaned(column: str) -> Column:
        word = F.lower(F.regexp_replace(F.col(column), "\u00a0", " "))
        fixed = word
        for field, lang, old, new in TECH_REPLACEMENTS:
            if column == f"keyword_{lang}":
                fixed = F.when((F.col("bloom_field") == field) & (word == old), F.lit(new)).otherwise(fixed)
        return F.when(F.col("bloom_field") == ONE_PATTERN_FIELD[0], F.lit(ONE_PATTERN_FIELD[1])).otherwise(
            fixed).alias(column)

    columns = [f"keyword_{lang}" for lang in LANGUAGES if f"keyword_{lang}" in keywords.columns]
    return joined.select("bloom_field", F.col("bloom_code").cast("int").alias("bloom_code"), *map(cleaned, columns))


def build_ai_dictionary(comma_text: DataFrame, column: str = "value") -> DataFrame:
    """K2: one comma-separated line of AI terms -> one lower-cased, stripped keyword per row."""
    words = F.explode(F.split(F.col(column), ", "))
    return (comma_text.select(words.alias("w"))
            .select(F.trim(F.lower(F.col("w"))).alias("keyword_en"))
            .filter(F.col("keyword_en") != ""))


# ------------------------------------------------------------------------ K3
def load_keywords(dictionary: DataFrame, tech_field_subset: str | Sequence[str] | None = None,
                  multilingual: bool = False) -> DataFrame:
    """K3: distinct keywords, optionally for one technology field, English only
    or the union of the language columns present.  Column: ``keyword``."""
    df = dictionary
    if tech_field_subset:
        subset = [tech_field_subset] if isinstance(tech_field_subset, str) else list(tech_field_subset)
        df = df.filter(F.col("bloom_field").isin(subset))
    if multilingual:
        cols = [f"keyword_{l}" for l in LANGUAGES if f"keyword_{l}" in df.columns]
        df = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("keyword"))
    else:
        df = df.select(F.col("keyword_en").alias("keyword"))
    return df.filter(F.col("keyword").isNotNull()).distinct()


def _keyword_list(keywords) -> list[str]:
    if isinstance(keywords, str):
        return [keywords]
    if isinstance(keywords, DataFrame):
        col = "keyword" if "keyword" in keywords.columns else keywords.columns[0]
        rows = collect_bounded(keywords.select(col).distinct(), MAX_DICTIONARY_ROWS, "keyword list")
        return sorted(r[0] for r in rows if r[0] is not None)
    return sorted(set(keywords))


def keyword_hits(postings: DataFrame, keywords: DataFrame, matching_column: str = "job_description") -> DataFrame:
    """Loaded keywords (K3) with the postings that hold ``' ' + keyword``,
    both in lower case (0 if none).  Columns: keyword, n_postings."""
    words = _keyword_list(keywords)
    found = group_matcher([(" " + w.lower(), i) for i, w in enumerate(words)], len(words))(F.lower(F.col(matching_column)))
    counts = postings.select(F.explode(found).alias("nth")).groupBy("nth").agg(F.count(F.lit(1)).alias("n_postings"))
    literals = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    counts = counts.select(F.get(literals, F.col("nth")).alias("keyword"), "n_postings")
    return keywords.select("keyword").distinct().join(counts, "keyword", "left").fillna(0, ["n_postings"])


# ------------------------------------------------------------------------ K4
def keyword_query(postings: DataFrame, keywords, matching_column: str = "job_description",
                  data_batch="all", countries="all", positions: DataFrame | None = None,
                  boundary: str = "space") -> DataFrame:
    """K4: ids of postings whose lower-cased ``matching_column`` contains
    ``' ' + keyword`` for any keyword, within batch(es) and countries.

    Countries live on ``positions``; they are applied as a semi join.
    """
    kws = _keyword_list(keywords)
    scope = apply_condition(postings, batch_condition(data_batch))
    ccond = country_condition(countries)
    if ccond is not None:
        if positions is None:
            raise ValueError("a country filter needs the positions table")
        scope = scope.join(positions.filter(ccond).select("uniq_id"), "uniq_id", "left_semi")
    return (scope.filter(keyword_condition(F.col(matching_column), kws, boundary))
            .select("uniq_id"))


# ------------------------------------------------------------------------ K5
def tag_ai(postings: DataFrame, keywords, data_batch="all", existing: DataFrame | None = None,
           matching_column: str = "job_description") -> DataFrame:
    """K5: new AI tag rows (``uniq_id``) for a batch; ids already stored are
    skipped (idempotent append), each id once."""
    hits = keyword_query(postings, keywords, matching_column, data_batch)
    # uniq_id is the postings key (checked by the integrity report), so no distinct
    hits = hits.filter(F.col("uniq_id").isNotNull())
    if existing is not None:
        hits = hits.join(existing.select("uniq_id"), "uniq_id", "left_anti")
    return hits


def tagging_report(postings: DataFrame, keywords, data_batch="all",
                   matching_column: str = "job_description") -> DataFrame:
    """K5 report: searchable postings and keyword hits, in one aggregate."""
    kws = _keyword_list(keywords)
    scope = apply_condition(postings, batch_condition(data_batch))
    hit = keyword_condition(F.col(matching_column), kws)
    return scope.agg(F.count("uniq_id").alias("n_searchable"),
                     F.count(F.when(hit, F.col("uniq_id"))).alias("n_hits"))


# ------------------------------------------------------------------------ K6
def tech_patterns(dictionary: DataFrame, multilingual: bool = False) -> list[tuple[str, int, list[str]]]:
    """Driver-side pattern table ``[(field, code, [patterns])]`` (bounded)."""
    if multilingual:
        cols = [f"keyword_{l}" for l in LANGUAGES if f"keyword_{l}" in dictionary.columns]
        kw = F.explode(F.array(*[F.col(c) for c in cols]))
    else:
        kw = F.col("keyword_en")
    flat = (dictionary.select("bloom_field", F.col("bloom_code").cast("int").alias("bloom_code"),
                              kw.alias("keyword"))
            .filter(F.col("keyword").isNotNull()).distinct())
    rows = collect_bounded(flat, MAX_DICTIONARY_ROWS, "technology dictionary")
    grouped: OrderedDict[tuple[str, int], set[str]] = OrderedDict()
    for r in sorted(rows, key=lambda r: (r["bloom_code"], r["bloom_field"], r["keyword"])):
        grouped.setdefault((r["bloom_field"], r["bloom_code"]), set()).add(r["keyword"].lower())
    return [(f, c, sorted(p)) for (f, c), p in grouped.items()]


def tech_field_matches(lowered: Column, patterns: list[tuple[str, int, list[str]]]) -> Column:
    """Array<struct<bloom_field, bloom_code>>, one entry per field: the field
    when one of its patterns occurs in ``lowered`` (already lower-cased),
    else NULL.  No higher-order function wraps it (``array_compact`` would
    force the whole expression out of generated code); callers explode and
    drop the NULL entries."""
    items = []
    for field, code, pats in patterns:
        cond = None
        for p in pats:
            c = lowered.contains(F.lit(" " + p))
            cond = c if cond is None else (cond | c)
        items.append(F.when(cond, F.struct(F.lit(field).alias("bloom_field"),
                                           F.lit(code).cast("int").alias("bloom_code"))))
    return F.array(*items)


def tag_tech(postings: DataFrame, dictionary: DataFrame, data_batch="all",
             existing: DataFrame | None = None, multilingual: bool = False,
             matching_column: str = "job_description", engine: str = "automaton") -> DataFrame:
    """K6: one row per (posting, technology field) whose keywords occur;
    pairs already stored are skipped.  Columns: uniq_id, bloom_field, bloom_code.

    The text is lower-cased once in its own projection and scanned once by the
    automaton over all lower-cased patterns; ``engine="jvm"`` asks for one
    ``contains`` per pattern instead (same rows)."""
    if engine not in ("jvm", "automaton"):
        raise ValueError("engine must be 'jvm' or 'automaton'")
    patterns = tech_patterns(dictionary, multilingual)
    scope = apply_condition(postings, combine_conditions([batch_condition(data_batch),
                                                          F.col("uniq_id").isNotNull()]))
    lowered = scope.select("uniq_id", F.lower(F.col(matching_column)).alias("__lt"))
    if engine == "jvm":
        matches = tech_field_matches(F.col("__lt"), patterns)
    else:
        fields = F.array(*[F.struct(F.lit(f).alias("bloom_field"), F.lit(c).cast("int").alias("bloom_code"))
                           for f, c, _ in patterns])
        udf = group_matcher([(" " + p, i) for i, (_, _, pats) in enumerate(patterns) for p in pats],
                            len(patterns))
        matches = F.transform(udf(F.col("__lt")), lambda i: F.element_at(fields, i + 1))
        lowered = lowered.select("uniq_id", matches.alias("__m"))
        matches = F.col("__m")
    tags = (lowered.select("uniq_id", F.explode(matches).alias("m"))
            .filter(F.col("m").isNotNull())
            .select("uniq_id", "m.bloom_field", "m.bloom_code"))
    if existing is not None:
        tags = tags.join(existing.select("uniq_id", "bloom_code"), ["uniq_id", "bloom_code"], "left_anti")
    return tags


# ------------------------------------------------------------------------ K7
def hits_per_field(tech_tags: DataFrame, dictionary: DataFrame) -> DataFrame:
    """K7: tagged postings per field; fields without hits report 0."""
    fields = dictionary.select("bloom_field", F.col("bloom_code").cast("int").alias("bloom_code")).distinct()
    counts = tech_tags.groupBy("bloom_field", "bloom_code").agg(F.count("uniq_id").alias("n_postings"))
    return (fields.join(counts, ["bloom_field", "bloom_code"], "left")
            .select("bloom_field", "bloom_code",
                    F.coalesce(F.col("n_postings"), F.lit(0).cast("bigint")).alias("n_postings")))

"""Inverted term index: keyword questions without reading texts again.

A keyword occurs where ``' ' + keyword`` does, both in lower case.  So its words
stand after spaces: all but the last are whole terms, the last is an open stem.
The index holds one row per term of a text, with its place and whether a space
follows; what it answers is exact, so a new keyword list never scans a text.

Stored, a batch is one partition of segments: files over some of its texts each,
whose rows are sorted by (term, id).  A lookup pushes the keywords' words into
the scan, which skips the row groups that hold none of them; a term of any
frequency spreads over the segments.  Only texts are dealt out, never their
terms, and a segment holds so few ids that Parquet stores them by dictionary.

Defined results: NULL texts and NULL ids have no rows; ids are the key of
postings (I12); a keyword without words (empty) matches every text that holds a
space; spaces inside, before or after a keyword count as they stand.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import broadcast_if_small
from .keywords import load_keywords

#: Characters of a word that lookups are joined on; the whole word is compared after it.
KEY_CHARS = 4
INDEX_COLUMNS = ("term", "uniq_id", "place", "closed")
#: Characters of text in a segment, about: some 3 million rows, which a task sorts in memory.
SEGMENT_CHARS = 1 << 24


def term_rows(postings: DataFrame, matching_column: str = "job_description") -> DataFrame:
    """(data_batch if there, term, uniq_id, place, closed): what stands after each space."""
    batch = [c for c in ("data_batch",) if c in postings.columns]
    pieces = (postings.where(F.col("uniq_id").isNotNull())
              .select(*batch, "uniq_id", F.split(F.lower(F.col(matching_column)), " ", -1).alias("__pieces")))
    rows = pieces.select(*batch, "uniq_id", (F.size("__pieces") - 1).alias("__last"),
                         F.posexplode("__pieces").alias("place", "term"))
    return rows.where("place > 0").select(*batch, "term", "uniq_id", "place", (F.col("place") < F.col("__last")).alias("closed"))


def segmented(postings: DataFrame, matching_column: str = "job_description") -> DataFrame:
    """``postings`` dealt out by id into the segments of an index: one more
    exchange of the texts, a tenth of the volume of their terms."""
    chosen = postings.where(F.col("uniq_id").isNotNull() & F.col(matching_column).isNotNull()).select(
        *[c for c in ("data_batch",) if c in postings.columns], "uniq_id", matching_column)
    chars = chosen.agg(F.sum(F.length(matching_column).cast("long"))).first()[0] or 0
    return chosen.repartition(1 + chars // SEGMENT_CHARS, "uniq_id")


def sorted_index(rows: DataFrame) -> DataFrame:
    """Index rows as they are stored: each task's rows, a segment, sorted."""
    return rows.sortWithinPartitions("term", "uniq_id", "place")


def keyword_words(keywords: DataFrame) -> DataFrame:
    """One row per word of each distinct keyword: (keyword, nth, word, n_words,
    open, closed, key).  ``open``: the word is a stem; ``closed``: a space must follow."""
    pieces = F.split(F.lower("keyword"), " ", -1)
    ends = (F.size("__p") > 1) & (F.element_at("__p", -1) == "")  # a final space closes the word before it
    cut = (keywords.where(F.col("keyword").isNotNull()).select("keyword").distinct()
           .withColumn("__p", pieces).withColumn("__ends", ends)
           .withColumn("__p", F.when(F.col("__ends"), F.slice("__p", F.lit(1), F.size("__p") - 1)).otherwise(F.col("__p"))))
    rows = cut.select("keyword", F.size("__p").alias("n_words"), "__ends", F.posexplode("__p").alias("nth", "word"))
    last = F.col("nth") == F.col("n_words") - 1
    return rows.select("keyword", "nth", "word", "n_words", (last & ~F.col("__ends")).alias("open"),
                       (last & F.col("__ends")).alias("closed"), F.substring("word", 1, KEY_CHARS).alias("key"))


def _words_condition(words: Sequence[str]) -> Column:
    """Index rows that one of the keywords can need: a range of terms for each (pushed into the scan)."""
    return functools.reduce(operator.or_, [F.col("term").startswith(w) for w in sorted(set(words))], F.lit(False))


def indexed_hits(index: DataFrame, keywords: DataFrame | Sequence[str]) -> DataFrame:
    """Distinct (keyword, uniq_id) of the keywords that occur.

    A list of keywords is pushed into the index scan; a table of any size is
    joined.  A whole word meets its terms by an equi-join, a stem those that begin
    with its first characters, and is compared whole behind it; a keyword occurs
    where all its words stand side by side, counted per (keyword, id, start)."""
    spark = index.sparkSession
    if not isinstance(keywords, DataFrame):
        listed = sorted(set(keywords))
        index = index.where(_words_condition([p for k in listed for p in k.lower().split(" ")]))
        keywords = spark.createDataFrame([(k,) for k in listed], "keyword string")
    words = keyword_words(keywords).withColumnRenamed("closed", "must_close")
    ends = ~F.col("must_close") | F.col("closed")
    rows = index.select(*INDEX_COLUMNS)
    # whole words meet their terms; stems the terms that begin alike, in one pass for each length of key (five at most)
    met = rows.join(broadcast_if_small(words.where("not open")), F.col("term") == F.col("word")).where(ends)
    for n in sorted(r[0] for r in words.where("open").select(F.length("key")).distinct().collect()):
        stems = broadcast_if_small(words.where(F.col("open") & (F.length("key") == n)))
        met = met.unionByName(rows.join(stems, F.left("term", F.lit(n)) == F.col("key"))
                              .where(F.col("term").startswith(F.col("word")) & ends))
    single = met.where("n_words = 1").select("keyword", "uniq_id").distinct()
    phrases = (met.where("n_words > 1").groupBy("keyword", "uniq_id", (F.col("place") - F.col("nth")).alias("start"), "n_words")
               .agg(F.count(F.lit(1)).alias("n")).where("n = n_words").select("keyword", "uniq_id").distinct())
    return single.unionByName(phrases)


def indexed_ids(index: DataFrame, keywords) -> DataFrame:
    """K4 / K5 from the index: ids of postings that hold any keyword, each once."""
    return indexed_hits(index, keywords).select("uniq_id").distinct()


def indexed_counts(index: DataFrame, keywords: DataFrame) -> DataFrame:
    """K3 from the index: (keyword, n_postings), 0 where a keyword occurs nowhere."""
    counts = indexed_hits(index, keywords).groupBy("keyword").agg(F.count(F.lit(1)).alias("n_postings"))
    return keywords.select("keyword").distinct().join(counts, "keyword", "left").fillna(0, ["n_postings"])


def indexed_tech_tags(index: DataFrame, dictionary: DataFrame, existing: DataFrame | None = None,
                      multilingual: bool = False) -> DataFrame:
    """K6 from the index: one row per (posting, field) whose keywords occur;
    pairs already stored are skipped."""
    columns = [c for c in dictionary.columns if c.startswith("keyword_")] if multilingual else ["keyword_en"]
    fields = dictionary.select("bloom_field", F.col("bloom_code").cast("int").alias("bloom_code"),
                               F.explode(F.array(*columns)).alias("keyword")).where("keyword is not null").distinct()
    hits = indexed_hits(index, load_keywords(dictionary, multilingual=multilingual))
    tags = hits.join(broadcast_if_small(fields), "keyword").select("uniq_id", "bloom_field", "bloom_code").distinct()
    if existing is not None:
        tags = tags.join(existing.select("uniq_id", "bloom_code"), ["uniq_id", "bloom_code"], "left_anti")
    return tags.select("uniq_id", "bloom_field", "bloom_code")

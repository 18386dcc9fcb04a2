"""Keyword questions from the term index against the scan of whole texts."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vacancylab import jobs
from vacancylab.operators import keywords, term_index
from vacancylab.session import land_table

TEXTS = {
    "a": "we use Keras daily", "b": "keras starts the text", "c": "a  double space", "d": "ends with ai ", "e": "ends with ai",
    "f": None, "g": "", "h": " ", "i": "machine  learning", "j": "MACHINE learnings", "k": "machine\nlearning and machine learning",
    "l": "xmachine learning", "m": "a a a b a a c", "n": "x" * 50_000 + " y" + "z" * 50_000, "o": "50% of_all a.i", "p": "tab\tkeras keras\t",
}
WORDS = ["keras", "Keras", "machine learning", "ai", "ai ", "", " ", " double", "a a", "a a c", "a a b", "a  double", "learn", "50%",
         "of_a", "y" + "z" * 40_000, "x", "absent", "MACHINE LEARNINGS", "machine  learn", " a", "kera", "a.i", "a_i"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [*TEXTS.items(), (None, "keras keras")]
    return spark.createDataFrame(rows, "uniq_id string, job_description string")


def _expected():
    return {(w, i) for w in WORDS for i, t in TEXTS.items() if t is not None and " " + w.lower() in t.lower()}


def _pairs(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_hits_equal_brute_force(spark, texts):
    index = land_table(term_index.sorted_index(term_index.term_rows(texts)), "terms")
    assert _pairs(term_index.indexed_hits(index, WORDS)) == _expected()
    table = spark.createDataFrame([(w,) for w in [*WORDS, None, "keras"]], "keyword string")
    assert _pairs(term_index.indexed_hits(index, table)) == _expected()
    assert _pairs(term_index.indexed_hits(index, [])) == set()
    counts = {r["keyword"]: r["n_postings"] for r in term_index.indexed_counts(index, table).collect() if r["keyword"] is not None}
    assert counts == {w: sum(k == w for k, _ in _expected()) for w in WORDS}


def test_empty_index(spark, texts):
    index = term_index.term_rows(texts.where("false"))
    assert term_index.indexed_ids(index, ["keras"]).count() == 0


def test_published_list_equals_the_scan_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").cast("string").alias("uniq_id"),
                                                                      F.col("text").alias("job_description"))
    index = land_table(term_index.sorted_index(term_index.term_rows(docs)), "terms")
    common = [r["w"] for r in docs.select(F.explode(F.split("job_description", "[ \n]+")).alias("w")).where("length(w) > 3")
              .groupBy("w").count().orderBy(F.desc("count"), "w").limit(120).collect()]
    # stems, capitals and phrases of the corpus beside the 35 published keywords
    phrases = [r["p"] for r in docs.select(F.regexp_extract("job_description", r" (\w+ \w+ \w\w)", 1).alias("p")).where("p != ''")
               .distinct().orderBy("p").limit(14).collect()]
    listed = sorted({*keywords.AI_KEYWORDS_EN, *(w[:4].upper() for w in common), *phrases})
    found = _pairs(term_index.indexed_hits(index, listed))
    assert found and any(" " in k for k, _ in found)
    for scan, got in ((keywords.keyword_query(docs, keywords.AI_KEYWORDS_EN), term_index.indexed_ids(index, keywords.AI_KEYWORDS_EN)),
                      (keywords.keyword_query(docs, listed), term_index.indexed_ids(index, listed))):
        assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in scan.collect())


def test_plan_reads_no_text_and_runs_no_python(spark, texts, tmpdir_path):
    postings = texts.where("uniq_id is not null").withColumn("data_batch", F.lit("b1")).select(
        "*", F.lit("yes").alias("unique_posting_text"), F.lit("yes").alias("unique_posting_textlocation"))
    postings.write.partitionBy("data_batch").parquet(f"{tmpdir_path}/postings")
    jobs.index_terms(spark, tmpdir_path, "b1")
    jobs.index_terms(spark, tmpdir_path, "b1")  # again: the partition is replaced
    index = jobs.open_term_index(spark, tmpdir_path, "b1")
    hits = term_index.indexed_hits(index, ["machine learning", "Keras"])
    assert _pairs(hits) == {p for p in _expected() if p[0] in ("machine learning", "Keras")}
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(term,keras)" in plan and "job_description" not in plan
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_segments_are_sorted_alone_and_hold_every_row(spark, texts, monkeypatch):
    monkeypatch.setattr(term_index, "SEGMENT_CHARS", 20_000)
    dealt = term_index.segmented(texts)
    assert dealt.rdd.getNumPartitions() == 6    # 100,200 characters and a few
    rows = term_index.sorted_index(term_index.term_rows(dealt))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # texts are dealt out before their terms; no term is in an exchange
    assert "rangepartitioning" not in plan and plan.index("Generate") < plan.index("Exchange") and plan.count("Exchange") == 1
    index = land_table(rows, "terms")
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, term_index.term_rows(texts).collect()))
    assert _pairs(term_index.indexed_hits(index, WORDS)) == _expected()


def test_a_table_of_keywords_multiplies_no_index_row(spark, texts):
    index = land_table(term_index.sorted_index(term_index.term_rows(texts)), "terms")
    table = spark.createDataFrame([(w,) for w in WORDS], "keyword string")
    plan = term_index.indexed_hits(index, table)._jdf.queryExecution().optimizedPlan().toString()
    # what is exploded are the keywords' words, never prefixes of the index's terms
    assert "explode(transform" not in plan and "Cartesian" not in plan

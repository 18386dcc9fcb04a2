"""LIKE folds case: capitals in keywords, patterns and exclusions change nothing; NULL-safe full joins keep every key."""

import pytest
from pyspark.sql import functions as F

from vacancylab.functions.predicates import keyword_condition
from vacancylab.operators import companies, keywords
from vacancylab.operators._util import null_safe_join
from vacancylab.sources.fixtures import JobTables

TEXTS = [("a", "we use Keras daily"), ("b", "we use KERAS daily"), ("c", "kerass"), ("d", None), ("e", " ÄRZTE und")]


@pytest.fixture
def postings(spark):
    return spark.createDataFrame([(i, t, "b1", "yes") for i, t in TEXTS],
                                 "uniq_id string, job_description string, data_batch string, unique_posting_text string")


@pytest.mark.parametrize("boundary", ["space", "word"])
@pytest.mark.parametrize("word", ["keras", "Keras", "KERAS"])
def test_keyword_query(postings, word, boundary):
    found = {r.uniq_id for r in keywords.keyword_query(postings, [word, "no such"], boundary=boundary).collect()}
    assert found == ({"a", "b"} if boundary == "space" else {"a", "b", "c"})
    assert {r.uniq_id for r in keywords.keyword_query(postings, ["Ärzte"]).collect()} == {"e"}


@pytest.mark.parametrize("engine", ["jvm", "automaton"])
def test_engines_and_tags(spark, postings, engine):
    hit = keyword_condition(F.col("job_description"), ["Keras"], engine=engine)
    assert {r.uniq_id for r in postings.filter(hit).collect()} == {"a", "b"}
    words = spark.createDataFrame([("F", 1, "Keras"), ("F", 1, "keras"), ("G", 2, "ÄRZTE")],
                                  "bloom_field string, bloom_code int, keyword_en string")
    tags = {(r.uniq_id, r.bloom_field) for r in keywords.tag_tech(postings, words, engine=engine).collect()}
    assert tags == {("a", "F"), ("b", "F"), ("e", "G")}
    hits = {r.keyword: r.n_postings for r in keywords.keyword_hits(postings, keywords.load_keywords(words)).collect()}
    assert hits == {"Keras": 2, "keras": 2, "ÄRZTE": 1}
    assert keywords.tagging_report(postings, ["KERAS"]).first().n_hits == 2
    with pytest.raises(ValueError):
        keyword_condition(F.col("job_description"), ["x"], engine="auto")


def test_exclusions(spark, postings):
    names = ["bayer ag", "bayern gmbh", "Bayern kg", "novartis"]
    employers = spark.createDataFrame([(n,) for n in names], "company_name string")
    positions = spark.createDataFrame([(u, n, "CH01") for u, n in zip("abcd", names)],
                                      "uniq_id string, company_name string, nuts_2 string")
    tags = spark.createDataFrame([("a",), ("b",), ("c",)], "uniq_id string")
    db = JobTables(postings=postings, positions=positions, employers=employers, regions=None, ai_tags=tags, tech_tags=None)
    patterns = companies.patterns_from_list(spark, [("Bayer", "Bayer")])
    for tokens in (["Bayern"], ["bayern"]):
        for fn in (companies.company_region_postings, companies.company_region_ai_postings):
            assert [r.company_name for r in fn(db, patterns, tokens, "b1").collect()] == ["bayer ag"]


def test_full_join_keeps_the_keys_of_both_sides(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("l", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20), ("r", 30)], "k string, y int")
    join = null_safe_join(left, right, ["k"], "full")
    assert sorted(((r.k or "", r.x, r.y) for r in join.collect()), key=str) == sorted(
        [("a", 1, 10), ("", 2, 20), ("l", 3, None), ("r", None, 30)], key=str)
    plan = join._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.k for r in null_safe_join(left, right, ["k"], "right").collect()} == {"a", None, "r"}

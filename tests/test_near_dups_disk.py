"""E4 and E6 keep little on disk: texts are written once and compressed, replaced tables and shuffle files go."""

from __future__ import annotations

import os
import random
from urllib.parse import urlparse

import pytest

from conftest import SF_SMALL
from test_near_dups import run_both
from vacancylab.operators import near_dups
from vacancylab.plans import catalog, fixture_sql, q_evaluation
from vacancylab.session import Scratch, ensure_checkpoint_dir

SCHEMA = "company_name string, uniq_id string, job_description string"


def _kept_bytes(spark):
    root = urlparse(ensure_checkpoint_dir(spark)).path
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(root) for f in files)


def _texts(n, words, seed):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(5000)}" for _ in range(words)) for _ in range(n)]


def _near_copies(n, words, seed=3):
    texts = _texts(n, words, seed)
    return [(f"e{i % 3}", f"{i:04d}{mark}", text + more) for i, text in enumerate(texts)
            for mark, more in (("", ""), ("x", " apply now"), ("y", " apply soon"))]


def test_the_pass_leaves_no_texts_behind(spark):
    rows = _near_copies(40, 400)
    df = spark.createDataFrame(rows, SCHEMA)
    before = _kept_bytes(spark)
    flagged = near_dups.token_duplicates(df)
    kept = _kept_bytes(spark) - before
    assert flagged.count() == 80
    assert kept < sum(len(r[2]) for r in rows) / 10


def test_texts_are_verified_in_parts(spark, monkeypatch):
    """However many parts the texts are dealt into, and whether rows are few or not."""
    monkeypatch.setattr(near_dups, "PART_ROWS", 7)
    monkeypatch.setattr(near_dups, "FEW_ROWS", 0)
    got, want = run_both(spark, spark.createDataFrame(_near_copies(12, 170, seed=4), SCHEMA))
    assert got == want and len(got) == 24


def test_a_posting_without_an_id_takes_no_part(spark):
    rows = _near_copies(4, 170, seed=6)
    more = [("e0", None, rows[0][2] + " apply"), ("e0", None, "alone"), (None, "z", rows[0][2]), ("e1", "zz", None)]
    found = {tuple(r) for r in near_dups.token_duplicates(spark.createDataFrame(rows + more, SCHEMA)).collect()}
    assert found == {tuple(r) for r in near_dups.token_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == 8


def test_copies_go_through_the_joins_once(spark):
    """with_copies reads its tables as often as the form without copies."""
    reads = {by: q_evaluation._e4_input(spark, SF_SMALL, by)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
             for by in ("", "_with_copies")}
    assert 0 < reads["_with_copies"] == reads[""]


def test_scratch_deletes_what_is_dropped_and_all_at_its_end(spark):
    before, setting = _kept_bytes(spark), spark.conf.get(Scratch.CLEANUP, None)
    with pytest.raises(KeyError):
        with Scratch(spark, "t") as scratch:
            one = scratch.land(spark.range(10_000))
            with_one = _kept_bytes(spark)
            two = scratch.land(one.where("id < 10"))
            scratch.drop(one, spark.range(1))
            assert before < _kept_bytes(spark) < with_one and two.count() == 10
            raise KeyError
    assert _kept_bytes(spark) == before and spark.conf.get(Scratch.CLEANUP, None) == setting


def test_e6_reads_the_postings_once(spark):
    """The counts come from the rows that the flags were made of, not from a second run of the input."""
    per_employer = q_evaluation._e6(spark, SF_SMALL, "_with_copies")
    for df in (per_employer, near_dups.combined_summary(per_employer)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_only_texts_of_candidates_are_exchanged(spark, monkeypatch):
    """One large group, as a language is: of its texts only those that may hold another's windows meet them."""
    rows = [("en", f"{i:04d}", text) for i, text in enumerate(_texts(300, 200, seed=8))]
    rows += [("en", f"x{i}", rows[i][2] + " and more") for i in range(4)]
    met, verified = [], near_dups.verified_edges

    def counted(pairs, docs, windows):
        met.append(docs.count())
        return verified(pairs, docs, windows)

    monkeypatch.setattr(near_dups, "verified_edges", counted)
    assert near_dups.token_duplicates(spark.createDataFrame(rows, SCHEMA)).count() == 4
    assert 4 <= sum(met) <= 12


def test_texts_are_exchanged_by_one_key(spark):
    """Every join that carries texts is on the posting's id, so one exchange serves them all."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = q_evaluation._e4_input(spark, SF_SMALL, "")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [uniq_id" in plan and "SortMergeJoin [doc_id" not in plan


def test_postings_by_id_are_the_postings_by_key(spark):
    """Repeated and missing keys on both sides."""
    spark.createDataFrame([(1, "a", "s", "en", 1), (1, "b", "s", "en", 1), (2, "c", "s", "de", 1), (97, "d", "t", "en", 1),
                           (None, "e", "t", "en", 1), (-3, "f", "t", "en", 1), (5, None, None, None, None)],
                          "doc_id long, text string, source string, lang string, n_chars long").createOrReplaceTempView("some_documents")
    spark.sql("""SELECT * FROM VALUES (1L, timestamp'2020-01-02'), (1L, timestamp'2020-01-03'), (2L, NULL), (97L, timestamp'2021-01-01'),
                 (NULL, timestamp'2020-01-01'), (-3L, timestamp'2020-01-01'), (5L, timestamp'2020-01-01') AS o(o_orderkey, o_orderdate)
              """).createOrReplaceTempView("some_orders")
    by_id, by_key = (spark.sql(fixture_sql.view_sql("v_postings", "some_{}".format, views))
                     for views in (fixture_sql.TEXT_VIEWS, fixture_sql.SPARK_VIEWS))
    assert by_id.schema == by_key.schema
    rows = sorted(map(str, by_id.collect()))
    assert rows == sorted(map(str, by_key.collect())) and len(rows) == 8


LANDED = ["e4_token_duplicates_with_copies",
          "e6_combined_duplicates_with_copies",
          "e6_combined_summary_with_copies",
          "e6_combined_duplicates_by_language",
          "e6_combined_summary_by_language",
          "e4_token_duplicates_by_language",
          "e6_combined_summary",
          "e6_combined_duplicates",
          "e6_worst_employers",
          "e4_token_duplicates"]


@pytest.mark.parametrize("name", LANDED)
def test_the_query_runs_on_postings_written_once(spark, monkeypatch, name):
    class Landing(Exception):
        pass

    def landed(*_):
        raise Landing

    monkeypatch.setattr(near_dups, "landed_rows", landed)
    catalog.load_all()
    with pytest.raises(Landing):
        catalog.QUERIES[name](spark, SF_SMALL)

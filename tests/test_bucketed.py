"""Bucketed tables: the same rows as the plain ones, and no exchange that holds a text."""

import os
import re

import pytest

from conftest import SF_SMALL
from vacancylab.operators import dedup, evaluation, reports
from vacancylab.sources.bucketed import BucketedStore
from vacancylab.sources.fixtures import fixture_db

B = "src_2023_01"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bucketed"))
    db = fixture_db(spark, SF_SMALL, flags=False)
    made = BucketedStore(spark, root, 16, "jobs_test")
    made.write_postings(db.postings)
    made.write_positions(db.positions)
    yield made, db
    spark.sql("DROP DATABASE jobs_test CASCADE")


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _exchanged(df):
    """Columns of every exchange in the plan."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    return [re.sub(r"#\d+L?", "", x).split(", ") for x in found]


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_no_text_is_exchanged(spark, store):
    made, db = store
    tables = made.tables(regions=db.regions)
    employers = db.employers.limit(20)
    for df in (made.new_flags(B), reports.total_postings_by_region(tables), reports.total_postings_by_region(tables, data_batch=B),
               evaluation.employer_postings(tables, employers), made.postings()):
        columns = _exchanged(df)
        assert not any("job_description" in c for c in columns), columns
    assert _exchanged(made.postings()) == []
    # A1 exchanges counts per region only, no row per posting
    assert not any({"uniq_id", "pc_id"} & set(c) for c in _exchanged(reports.total_postings_by_region(tables)))
    assert "job_description" not in made.new_flags(B).columns
    # the plain tables do move texts
    flagged = dedup.clean_duplicates(db.postings, db.positions, B)
    assert any("job_description" in c for c in _exchanged(flagged))


def test_same_rows(spark, store):
    made, db = store
    files = {d: {f: os.stat(os.path.join(d, f)).st_mtime_ns for f in fs if f.endswith(".parquet")}
             for d, _, fs in os.walk(f"{made.root}/posting_texts")}
    for batch in ("src_2022_01", B):
        made.flag_duplicates(batch)
    assert files == {d: {f: os.stat(os.path.join(d, f)).st_mtime_ns for f in fs if f.endswith(".parquet")}
                     for d, _, fs in os.walk(f"{made.root}/posting_texts")}
    plain = dedup.clean_duplicates(db.postings, db.positions, "all")
    assert _sorted(made.postings().select(*plain.columns)) == _sorted(plain)
    db = fixture_db(spark, SF_SMALL)
    tables = made.tables(regions=db.regions)
    assert _sorted(reports.total_postings_by_region(tables)) == _sorted(reports.total_postings_by_region(db))
    employers = db.employers.orderBy("company_name").limit(20)
    assert _sorted(evaluation.employer_postings(tables, employers)) == _sorted(evaluation.employer_postings(db, employers))
    # another session's declaration over the same folder
    again = BucketedStore(spark, made.root, 16, "jobs_again")
    assert _sorted(again.postings()) == _sorted(made.postings())
    spark.sql("DROP DATABASE jobs_again CASCADE")


def test_reset_touches_one_batch_of_the_flags(spark, store):
    made, db = store
    for batch in ("src_2022_01", B):
        made.flag_duplicates(batch)
    other = _sorted(made.flags("src_2022_01"))
    want = dedup.reset_flag(made.postings(), db.positions, "unique_posting_text", "yes", B, ["europe"])
    want = _sorted(want.select("uniq_id", "unique_posting_text", "data_batch"))
    made.reset_flag("unique_posting_text", "yes", B, ["europe"])
    assert _sorted(made.postings().select("uniq_id", "unique_posting_text", "data_batch")) == want
    assert _sorted(made.flags("src_2022_01")) == other
    assert len(os.listdir(f"{made.root}/posting_flags/data_batch={B}")) >= 16

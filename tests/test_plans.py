"""Plan shape checks: no hot-key windows, pushdown, single-scan tagging."""

import os

from conftest import SF_SMALL
from vacancylab.operators import dedup, ingest, keywords, reports, sampling
from vacancylab.sources import fixtures
from vacancylab.sources.fixtures import build_database, fixture_views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicate_flags_use_partial_aggregates_not_windows(spark):
    v = fixture_views(spark, SF_SMALL)
    p = plan(dedup.clean_duplicates(dedup.with_default_flags(v["v_postings"]), v["v_positions"], "all"))
    assert "Window" not in p and "partial_min" in p


def test_first_per_key_is_an_aggregate(spark):
    raw = ingest.with_file_order(fixture_views(spark, SF_SMALL)["v_raw"], "file", "row_seq")
    p = plan(ingest.first_per_key(raw.select("uniq_id", "company_name", "_file", "_order"), "uniq_id"))
    assert "Window" not in p and "partial_min_by" in p


def test_tagging_does_not_shuffle(spark):
    from pyspark.sql import functions as F
    v = fixture_views(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.md5(F.col("doc_id").cast("string")).alias("uniq_id"), F.col("text").alias("job_description"))
    assert "Exchange" not in plan(keywords.tag_tech(docs, v["v_tech_dict"]))
    assert "Exchange" not in plan(keywords.tag_ai(docs, v["v_ai_dict"]))


def test_report_pushes_batch_and_flag_into_scan(spark, tmpdir_path):
    db = build_database(spark, SF_SMALL, os.path.join(tmpdir_path, "db"))
    df = reports.ai_postings_by_region(db, 2, "src_2023_01", True)
    p = df._jdf.queryExecution().executedPlan().toString()
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(data_batch" in formatted
    assert "EqualTo(unique_posting_text,yes)" in formatted
    assert "ReadSchema: struct<uniq_id:string,unique_posting_text:string>" in formatted
    assert p


def test_duplicate_ids_exchange_no_text(spark):
    from vacancylab.operators import dedup
    from vacancylab.sources.fixtures import fixture_views
    v = fixture_views(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = dedup.duplicate_ids_by_level(
            v["v_postings"], v["v_positions"], "all",
            {"t": ["job_description"], "l": ["city", "job_description"]})
        plan = flagged._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    import re
    bodies = re.split(r"\n(?=\(\d+\) )", plan)
    exchanges = [b for b in bodies if re.match(r"\(\d+\) Exchange", b)]
    assert exchanges
    # the only column of that name that crosses is the 64-character digest made below the join
    projects = [b for b in bodies if "sha2(" in b]
    assert projects and not any("sha2(" in b and "Join" in b.split("\n")[0] for b in bodies)


def test_a6_reads_postings_and_positions_once(spark, tmp_path):
    root = str(tmp_path)
    fixtures.write_db(fixtures.fixture_db(spark, SF_SMALL), root)
    plan = reports.ai_share_by_region(fixtures.stored_db(spark, root), 2, "all", True)._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(f"{c}#") > 0 for c in ("unique_posting_text", "inferred_country")] == [True, True]
    assert plan.count("Relation [") == 4  # postings, positions, tags, region names


def test_sample_plans_run_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "sample plan")
    df = spark.range(1000).selectExpr("cast(id as string) k")
    sample = sampling.hash_top_n(df, None, "k", share=0.1)
    assert not tracker.getJobIdsForGroup("build")
    assert sample.count() == 100
    spark.sparkContext.setJobGroup("rest", "other tests")

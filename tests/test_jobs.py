"""Batch jobs end to end on sf0.001: update from raw CSV files, augment, clean."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vacancylab import jobs
from vacancylab.operators import dedup
from vacancylab.sources.fixtures import fixture_views


def test_update_augment_clean(spark, tmpdir_path):
    v = fixture_views(spark, SF_SMALL)
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    pdf = v["v_raw"].orderBy("file", "row_seq").toPandas()
    for f, part in pdf.groupby("file"):
        part.drop(columns=["file", "row_seq"]).to_csv(os.path.join(raw_dir, f"{f}.csv"), index=False)
    root = "file://" + os.path.join(tmpdir_path, "db")
    v["v_regions"].write.parquet(f"{root}/regions")

    n = jobs.update_batch(spark, raw_dir, root, "b24", suffix=".csv")
    assert n["postings"] > 0 and n["positions"] == n["postings"] and n["employers"] > 0
    again = jobs.update_batch(spark, raw_dir, root, "b24", suffix=".csv")
    assert again == {"positions": 0, "employers": 0, "postings": 0}

    t = jobs.open_tables(spark, root)
    assert t.positions.filter(F.col("nuts_2").isNotNull()).count() > 0   # G5 on ingest
    codes = sorted(map(tuple, t.positions.select("uniq_id", "nuts_2", "nuts_3").collect()), key=repr)
    jobs.augment(spark, root, "b24", ["licen", "tionha"], v["v_tech_dict"])
    t = jobs.open_tables(spark, root)
    assert sorted(map(tuple, t.positions.select("uniq_id", "nuts_2", "nuts_3").collect()), key=repr) == codes
    n_dup = dedup.duplicate_ids(t.postings, t.positions, "b24").count()
    assert t.postings.filter(F.col("unique_posting_text") == "no").count() == n_dup
    n_ai = t.ai_tags.count()
    assert n_ai > 0 and t.tech_tags.count() > 0
    jobs.augment(spark, root, "b24", ["licen", "tionha"], v["v_tech_dict"])
    assert jobs.open_tables(spark, root).ai_tags.count() == n_ai

    jobs.clean_tables(spark, root, "b24")
    t = jobs.open_tables(spark, root)
    assert t.postings.count() == 0 and t.positions.count() == 0
    assert t.employers.count() == 0 and t.ai_tags.count() == 0 and t.tech_tags.count() == 0


def test_killed_replacement_keeps_a_version(spark, tmpdir_path):
    root = "file://" + tmpdir_path
    tags = lambda *ids: spark.createDataFrame([(i,) for i in ids], "uniq_id string")
    jobs.replace_table(spark, tags("a"), root, "ai_tags")
    # killed between the two moves: the new version is written, the old one moved away
    tags("b").write.parquet(jobs._swap_path(root, "ai_tags", "new"))
    jobs._move(spark, f"{root}/ai_tags", jobs._swap_path(root, "ai_tags", "old"))
    assert [r.uniq_id for r in jobs.open_tables(spark, root).ai_tags.collect()] == ["a"]
    # killed after them: the old version is left over
    tags("x").write.parquet(jobs._swap_path(root, "ai_tags", "old"))
    jobs.replace_table(spark, tags("c"), root, "ai_tags")
    assert [r.uniq_id for r in jobs.open_tables(spark, root).ai_tags.collect()] == ["c"]


def test_missing_table_is_an_error(spark, tmpdir_path):
    for job in (lambda: jobs.augment(spark, tmpdir_path, "b", ["x"], None), lambda: jobs.clean_tables(spark, tmpdir_path, "b")):
        with pytest.raises(FileNotFoundError):
            job()


def _paths(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names
            if "_swap" not in d and f.endswith(".parquet")}


def _two_batches(spark, folder):
    """Two batches with an employer each and one that both name."""
    root = "file://" + folder
    for b in ("b1", "b2"):
        ids = [f"{b}-{i}" for i in range(3)]
        post = spark.createDataFrame([(i, "t", b, "yes", "yes") for i in ids],
                                     "uniq_id string, job_description string, data_batch string, "
                                     "unique_posting_text string, unique_posting_textlocation string")
        pos = spark.createDataFrame([(i, e) for i, e in zip(ids, ("both", f"only {b}", None))], "uniq_id string, company_name string")
        post.drop("data_batch").write.parquet(f"{root}/postings/data_batch={b}")
        pos.write.parquet(f"{root}/positions/data_batch={b}")
        post.select("uniq_id").write.parquet(f"{root}/ai_tags/data_batch={b}")
        post.selectExpr("uniq_id", "'F' AS bloom_field", "1 AS bloom_code").write.parquet(f"{root}/tech_tags/data_batch={b}")
    spark.createDataFrame([("both",), ("only b1",), ("only b2",), ("nobody",)], "company_name string").write.parquet(f"{root}/employers")
    return root


@pytest.mark.parametrize("killed_at", range(8))
def test_deleting_a_batch_touches_no_other(spark, tmpdir_path, monkeypatch, killed_at):
    root = _two_batches(spark, tmpdir_path)
    others = {p: t for p, t in _paths(tmpdir_path).items() if "data_batch=b2" in p}
    real, moves = jobs._move, [0]

    def move(*args):
        moves[0] += 1
        if moves[0] == killed_at:
            raise KeyboardInterrupt
        real(*args)
    monkeypatch.setattr(jobs, "_move", move)
    if killed_at in range(1, 7):  # four partitions, then the old and the new employers
        with pytest.raises(KeyboardInterrupt):
            jobs.clean_tables(spark, root, "b1")
    jobs.clean_tables(spark, root, "b1")
    t = jobs.open_tables(spark, root)
    for name in jobs.BY_BATCH:
        assert sorted(r.uniq_id for r in getattr(t, name).collect()) == ["b2-0", "b2-1", "b2-2"]
    assert sorted(r.company_name for r in t.employers.collect()) == ["both", "only b2"]
    assert {p: t for p, t in _paths(tmpdir_path).items() if "data_batch=" in p} == others
    assert not [n for n in os.listdir(f"{tmpdir_path}/_swap") if n.endswith(".gone")]


def test_half_moved_partition_is_put_back(spark, tmpdir_path):
    root = _two_batches(spark, tmpdir_path)
    jobs._move(spark, f"{root}/postings/data_batch=b1", jobs._swap_path(root, "postings/data_batch=b1", "old"))
    assert jobs.open_tables(spark, root).postings.count() == 6

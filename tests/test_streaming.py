"""Incremental ingest with Trigger.AvailableNow: new files only, replay-safe."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_sampling_ingest import _csv
from vacancylab import jobs
from vacancylab.sources.fixtures import fixture_db, fixture_views
from vacancylab.streaming import ingest_stream
from vacancylab.streaming.ingest_stream import publish, start_ingest


def _write(d, name, rows):
    with open(os.path.join(d, name), "w") as fh:
        fh.write(_csv(rows))


def test_available_now_ingest(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    root = os.path.join(tmpdir_path, "db")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    _write(raw, "f1.csv", [("a1", "2021-01-02", "t1", " ACME ", "Basel", "true", "zurich", "switzerland"),
                           ("a2", "2021-01-03", "t2", "acme", None, "0", None, None),
                           ("a2", "2021-01-03", "t2 again", "acme", None, "0", None, None)])
    q = start_ingest(spark, raw, root, "b1", ckpt)
    q.awaitTermination(300)
    post = spark.read.parquet(os.path.join(root, "postings"))
    # a2 occurs twice in the batch: dropped entirely (stored behaviour)
    assert sorted(r.uniq_id for r in post.collect()) == ["a1"]
    assert spark.read.parquet(os.path.join(root, "employers")).count() == 1
    _write(raw, "f2.csv", [("a1", "2021-02-01", "t3", "other", "Bern", "1", "bern", "switzerland"),
                           ("a3", "2021-02-01", "t4", "other", "Bern", "1", "bern", "switzerland")])
    q = start_ingest(spark, raw, root, "b1", ckpt)
    q.awaitTermination(300)
    post = spark.read.parquet(os.path.join(root, "postings"))
    assert sorted(r.uniq_id for r in post.collect()) == ["a1", "a3"]
    pos = {r.uniq_id: (r.company_name, r.remote_position) for r in
           spark.read.parquet(os.path.join(root, "positions")).collect()}
    assert pos == {"a1": ("acme", "1"), "a3": ("other", "1")}
    assert sorted(r.company_name for r in spark.read.parquet(os.path.join(root, "employers")).collect()) == \
        ["acme", "other"]
    # nothing new: a third run appends nothing
    q = start_ingest(spark, raw, root, "b1", ckpt)
    q.awaitTermination(300)
    assert spark.read.parquet(os.path.join(root, "postings")).count() == 2


# --- the stream stores what the batch job stores, however the files fall into triggers
OLD, NEW = "src_2022_01", "b24"


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for f, part in fixture_views(spark, SF_SMALL)["v_raw"].orderBy("file", "row_seq").toPandas().groupby("file"):
        part.drop(columns=["file", "row_seq"]).to_csv(folder / f"{f}.csv", index=False)
    return str(folder)


def _store(spark, root, regions=True):
    """The tables before the batch: an older batch, as in the registered batch-update queries."""
    db = fixture_db(spark, SF_SMALL, flags=False, geo=False, tags=False)
    old = db.postings.where(F.col("data_batch") == OLD)
    old.drop("data_batch").write.parquet(f"{root}/postings/data_batch={OLD}")
    db.positions.join(old.select("uniq_id"), "uniq_id", "left_semi").write.parquet(f"{root}/positions/data_batch={OLD}")
    db.employers.write.parquet(f"{root}/employers")
    if regions:
        db.regions.write.parquet(f"{root}/regions")
    return db


def _rows(spark, root):
    t = jobs.open_tables(spark, root)
    return {n: sorted(map(tuple, getattr(t, n).collect()), key=repr) for n in ("postings", "positions", "employers")}


@pytest.fixture(scope="module")
def by_batch_job(spark, raw_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("batch"))
    _store(spark, root)
    jobs.update_batch(spark, raw_dir, root, NEW, suffix=".csv")
    return _rows(spark, root)


@pytest.mark.parametrize("files", [None, 1, 7])
def test_stream_equals_batch_job(spark, raw_dir, by_batch_job, tmpdir_path, files):
    db = _store(spark, tmpdir_path)
    run = start_ingest(spark, raw_dir, tmpdir_path, NEW, f"{tmpdir_path}/ckpt", db.regions, max_files_per_trigger=files)
    assert run.awaitTermination(300)
    assert _rows(spark, tmpdir_path) == by_batch_job and run.appended["postings"] > 0
    n_files = len(os.listdir(raw_dir))
    ledger = spark.read.parquet(f"{tmpdir_path}/_ledger")
    assert ledger.count() == n_files == ledger.select("file").distinct().count()
    assert ledger.select("load").distinct().count() == (1 if files is None else -(-n_files // files))
    assert not os.listdir(f"{tmpdir_path}/_pending/{NEW}/raw")


def test_stream_equals_registered_queries(spark, by_batch_job):
    import __spark_entry__ as entry
    for name in ("postings", "positions"):
        new = entry.queries()[f"i_batch_update_{name}"](spark, SF_SMALL)
        ids = {r[0] for r in new.select("uniq_id").collect()}
        stored = {r[0] for r in by_batch_job[name]}
        assert ids and ids <= stored and len(stored) == len(by_batch_job[name])


@pytest.mark.parametrize("step", [0, 1, 2, 3, 5, 6])
def test_killed_anywhere_and_replayed(spark, raw_dir, by_batch_job, tmpdir_path, monkeypatch, step):
    db = _store(spark, tmpdir_path)

    class Killed(Exception):
        pass

    def killed_after(module, name, calls):
        real, n = getattr(module, name), [0]

        def wrapped(*args, **kwargs):
            n[0] += 1
            if n[0] > calls:
                raise Killed
            return real(*args, **kwargs)
        monkeypatch.setattr(module, name, wrapped)

    ckpt = f"{tmpdir_path}/ckpt"
    if step == 0:  # a trigger is killed before its mark, and replayed by the next run
        killed_after(ingest_stream.ingest, "rows_per_file", 2)
    elif step <= 3:  # between the appends
        killed_after(jobs, "append_rows", step - 1)
    else:  # in the stage; before the stage is dropped
        killed_after(jobs, "stage_rows" if step == 5 else "drop_stage", 0)
    with pytest.raises(Exception) as failure:
        start_ingest(spark, raw_dir, tmpdir_path, NEW, ckpt, db.regions, max_files_per_trigger=9).awaitTermination(300)
    assert "Killed" in str(failure.value) or isinstance(failure.value, Killed)
    monkeypatch.undo()
    start_ingest(spark, raw_dir, tmpdir_path, NEW, ckpt, db.regions, max_files_per_trigger=9).awaitTermination(300)
    assert _rows(spark, tmpdir_path) == by_batch_job
    ledger = spark.read.parquet(f"{tmpdir_path}/_ledger")
    assert ledger.count() == len(os.listdir(raw_dir))


def test_a_name_with_two_codes_stops_before_any_append(spark, raw_dir, tmpdir_path):
    db = _store(spark, tmpdir_path)
    before = _rows(spark, tmpdir_path)
    some = db.positions.where("inferred_state is not null").first().inferred_state
    twice = spark.createDataFrame([(some, "A1", "A11"), (some, "A2", "A21")], "name_en string, nuts_2 string, nuts_3 string")
    for c in db.regions.columns:
        if c not in twice.columns:
            twice = twice.withColumn(c, F.lit(2 if c.endswith("level") else None).cast(db.regions.schema[c].dataType))
    with pytest.raises(AssertionError, match="rows for"):
        start_ingest(spark, raw_dir, tmpdir_path, NEW, f"{tmpdir_path}/ckpt", twice.select(*db.regions.columns)).awaitTermination(300)
    assert _rows(spark, tmpdir_path) == before
    publish(spark, tmpdir_path, NEW, db.regions)  # the rows still wait
    assert len(_rows(spark, tmpdir_path)["postings"]) > len(before["postings"])

"""Archives as streams (S2), files loaded once (I11), and the jobs around the dimension, the subset and the flags."""

import gzip
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from vacancylab import jobs
from vacancylab.sources import raw as rawsrc


def _csv(ids, text="some text"):
    return "uniq_id,job_description,company_name,inferred_country,extra\n" + "".join(
        f'{i},"{text} {i}, ""quoted""\nsecond line",Firm {i},CH,x\n' for i in ids)


def _zip(path, *members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i, text in enumerate(members):
            z.writestr(f"m{i}.csv", text)


def test_archive_above_the_cell_limit(spark, tmpdir_path):
    ids = [f"u{i}" for i in range(3_000)]
    _zip(f"{tmpdir_path}/big file%20.zip", _csv(ids, "long " * 40))
    limit = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1000")
    try:
        assert os.path.getsize(f"{tmpdir_path}/big file%20.zip") > 1000
        df = rawsrc.read_raw_zip(spark, tmpdir_path, chunk_rows=700)
        rows = df.orderBy("_order").select("uniq_id", "job_description", "city", "_order.s").collect()
    finally:
        spark.conf.set(limit, before)
    assert [r[0] for r in rows] == ids and [r[3] for r in rows] == list(range(3_000))
    assert rows[5][1] == "long " * 40 + ' u5, "quoted"\nsecond line' and rows[5][2] is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def test_same_rows_from_every_layout(spark, tmpdir_path):
    text = "uniq_id,job_description\na,NA\nb,\"\"\nc,null\nd,\n"
    _zip(f"{tmpdir_path}/x.zip", text)
    with gzip.open(f"{tmpdir_path}/x.csv.gz", "wt") as f:
        f.write(text)
    with open(f"{tmpdir_path}/x.csv", "w") as f:
        f.write(text)
    want = [("a", "NA"), ("b", None), ("c", "null"), ("d", None)]
    for suffix in (".zip", ".csv.gz", ".csv"):
        got = rawsrc.read_raw_zip(spark, tmpdir_path, suffix=suffix).orderBy("_order").select("uniq_id", "job_description")
        assert [tuple(r) for r in got.collect()] == want
    got = rawsrc.read_raw_csv(spark, f"{tmpdir_path}/x.csv").orderBy("_order").select("uniq_id", "job_description")
    assert [tuple(r) for r in got.collect()] == want


def test_two_members_and_empty_members(spark, tmpdir_path):
    _zip(f"{tmpdir_path}/empty.zip", "")
    _zip(f"{tmpdir_path}/header.zip", "uniq_id,city\n")
    assert rawsrc.read_raw_zip(spark, tmpdir_path).count() == 0
    _zip(f"{tmpdir_path}/two.zip", _csv(["a"]), _csv(["b"]))
    with pytest.raises(Exception, match="expected one member, found 2"):
        rawsrc.read_raw_zip(spark, tmpdir_path).count()


def test_custom_opener(spark, tmpdir_path):
    _zip(f"{tmpdir_path}/a.zip", _csv(["a"]))
    where = tmpdir_path

    def opener(path):
        return open(f"{where}/{path.rsplit('/', 1)[1]}", "rb")
    assert rawsrc.read_raw_zip(spark, tmpdir_path, opener=opener).count() == 1


@pytest.mark.parametrize("suffix", [".zip", ".csv"])
def test_update_opens_new_files_only(spark, tmpdir_path, suffix):
    raw, root = f"{tmpdir_path}/raw in", f"{tmpdir_path}/db"
    os.makedirs(raw)

    def put(name, ids):
        if suffix == ".zip":
            _zip(f"{raw}/{name}.zip", _csv(ids))
        else:
            with open(f"{raw}/{name}.csv", "w") as f:
                f.write(_csv(ids))
    put("one", ["a", "b"])
    assert jobs.update_batch(spark, raw, root, "b1", suffix)["postings"] == 2
    assert jobs.files_to_load(spark, raw, root, "b1", suffix).count() == 0
    put("two", ["b", "c"])
    left = jobs.files_to_load(spark, raw, root, "b1", suffix).collect()
    assert [os.path.basename(r["path"]) for r in left] == [f"two{suffix}"]
    assert jobs.update_batch(spark, raw, root, "b1", suffix)["postings"] == 1  # b is stored
    assert jobs.update_batch(spark, raw, root, "b1", suffix) == {"positions": 0, "employers": 0, "postings": 0}
    put("one", ["a", "b", "d"])  # replaced: read again
    assert jobs.update_batch(spark, raw, root, "b1", suffix)["postings"] == 1
    ledger = spark.read.parquet(f"{root}/_ledger")
    assert sorted(r[0] for r in ledger.select("n_rows").collect()) == [2, 2, 3]
    assert jobs.update_batch(spark, raw, root, "b1", suffix, reread=True)["postings"] == 0
    jobs.clean_tables(spark, root, "b1")  # a deleted batch can be loaded again
    # b stands in both files: drop-all over the files of one call
    assert jobs.update_batch(spark, raw, root, "b1", suffix)["postings"] == 3


def test_region_grid_job(spark, tmpdir_path):
    head = "name_en;name_de;name_fr;regio_abbrev;nuts_level;oecd_level;iso_2;iso_3;nuts_0;nuts_1;nuts_2;nuts_3;oecd_tl1;oecd_tl2;oecd_tl3;self_classified\n"
    row = "{};Zürich;Zurich;ZH;3;3;CH;CHE;CH;CH0;CH04;{};CH;CH04;CH040;\n"
    path = f"{tmpdir_path}/grid.csv"
    root = f"{tmpdir_path}/db"

    def put(*rows):
        with open(path, "w", encoding="ISO-8859-1") as f:
            f.write(head + "".join(row.format(*r) for r in rows))
    put(("ZURICH", "CH040"), ("Geneva", "CH013"))
    assert jobs.load_region_grid(spark, path, root) == 2
    stored = jobs.open_tables(spark, root).regions
    assert sorted((r["name_en"], r["name_de"]) for r in stored.collect()) == [("geneva", "zürich"), ("zurich", "zürich")]
    put(("A", "CH040"), ("a", "CH040"))
    with pytest.raises(ValueError, match="1 keys"):
        jobs.load_region_grid(spark, path, root)
    assert jobs.open_tables(spark, root).regions.count() == 2
    put(("B", "CH040"))
    assert jobs.load_region_grid(spark, path, root) == 1 and jobs.open_tables(spark, root).regions.count() == 1


def test_development_subset_and_flag_reset(spark, tmpdir_path):
    raw, root, small = (f"{tmpdir_path}/{n}" for n in ("raw", "db", "small"))
    os.makedirs(raw)
    for b in ("b1", "b2"):
        _zip(f"{raw}/{b}.zip", _csv([f"{b}-{i}" for i in range(20)], "same"))
        jobs.update_batch(spark, raw, root, b)
    ids = [r[0] for r in jobs.open_tables(spark, root).postings.select("uniq_id").collect()]
    assert len(ids) == len(set(ids))
    jobs.augment(spark, root, "b1", ["text", "same"], spark.createDataFrame([("F", 1, "b1")], "bloom_field string, bloom_code int, keyword_en string"))
    n = jobs.create_development_db(spark, root, small, sample_share=0.1, n_per_country=5)
    t = jobs.open_tables(spark, small)
    kept = {r[0] for r in t.postings.select("uniq_id").collect()}
    assert 5 <= n["postings"] == len(kept) < len(ids) and n["positions"] == n["postings"] == n["employers"]
    assert kept == {r[0] for r in t.positions.select("uniq_id").collect()}
    assert {r[0] for r in t.tech_tags.select("uniq_id").collect()} == {
        r[0] for r in jobs.open_tables(spark, root).tech_tags.select("uniq_id").collect()} & kept
    assert jobs.create_development_db(spark, root, small, sample_share=0.1, n_per_country=5) == n  # again: same rows
    with pytest.raises(ValueError):
        jobs.create_development_db(spark, root, root + "/")

    batch = jobs.open_tables(spark, root).postings.select("data_batch").first()[0]
    jobs.reset_flag(spark, root, "unique_posting_text", "no", batch)
    jobs.reset_flag(spark, root, "unique_posting_text", "yes", batch, exclude_countries=["DE"])
    flags = jobs.open_tables(spark, root).postings.where(F.col("data_batch") == batch).select("unique_posting_text").distinct()
    assert [r[0] for r in flags.collect()] == ["yes"]
    assert jobs.open_tables(spark, root).postings.count() == len(ids)

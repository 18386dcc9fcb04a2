"""Sampling exactness, raw sources, ingest invariants and streaming ingest."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from conftest import SF_SMALL, Tables
from vacancylab.operators import ingest, sampling
from vacancylab.sources import raw as rawsrc
from vacancylab.sources.fixtures import fixture_db, stored_db, write_db


def test_hash_top_n_exact(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    for n in (1, 37, 1234, 5000, 6000):
        got = sorted(r.k for r in sampling.hash_top_n(df, n, "k", 9).collect())
        want = sorted(r.k for r in df.orderBy(sampling.hash_order(F.col("k"), 9), "k").limit(n).collect())
        assert got == want


def test_country_sample_uses_group_limit(spark):
    pos = spark.range(2000).select(F.col("id").cast("string").alias("uniq_id"),
                                   F.lit("x").alias("company_name"),
                                   F.when(F.col("id") % 3 == 0, "big").otherwise(
                                       (F.col("id") % 5).cast("string")).alias("inferred_country"))
    out = sampling.country_sample(pos, 10, 1)
    assert out.count() == 10 * pos.select("inferred_country").distinct().count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


RAW_HEADER = ["uniq_id", "crawl_timestamp", "job_description", "company_name", "city", "is_remote",
              "inferred_state", "inferred_country"]


def _csv(rows):
    buf = io.StringIO()
    buf.write(",".join(RAW_HEADER) + "\n")
    for r in rows:
        buf.write(",".join('"' + str(v).replace('"', '""') + '"' if v is not None else "" for v in r) + "\n")
    return buf.getvalue()


def test_raw_csv_and_zip(spark, tmpdir_path):
    rows1 = [("a1", "2021-01-02", 'multi\nline "text"', " ACME ", " Basel ", "true", "Zurich", "Switzerland"),
             ("a2", "2021-01-03", "t2", "acme", None, "0", None, None)]
    rows2 = [("a1", "2021-02-01", "t3", "Other", "Bern", "1.0", "bern", "switzerland")]
    d = os.path.join(tmpdir_path, "batch")
    os.makedirs(d)
    with open(os.path.join(d, "f1.csv"), "w") as fh:
        fh.write(_csv(rows1))
    with zipfile.ZipFile(os.path.join(d, "f2.zip"), "w") as zf:
        zf.writestr("inner.csv", _csv(rows2))
    csv_df = rawsrc.read_raw_csv(spark, os.path.join(d, "f1.csv"))
    zip_df = rawsrc.read_raw_zip(spark, d)
    assert csv_df.count() == 2 and zip_df.count() == 1
    both = csv_df.unionByName(zip_df.select(*csv_df.columns))
    assert [r.path.split("/")[-1] for r in rawsrc.list_raw_files(spark, d, ".zip").collect()] == ["f2.zip"]
    pos = ingest.first_per_key(ingest.structure(ingest.rename_raw(both), "positions"), "uniq_id")
    got = {r.uniq_id: (r.company_name, r.city, r.remote_position) for r in pos.collect()}
    first = "f1.csv" < "f2.zip"
    assert got["a1"] == (("acme", "basel", "1") if first else ("other", "bern", "1"))
    assert got["a2"] == ("acme", None, "0")
    text = {r.uniq_id: r.job_description for r in csv_df.collect()}
    assert text["a1"] == 'multi\nline "text"'


def test_ingest_twice_is_noop(spark, tmpdir_path):
    from vacancylab.plans.q_ingest import _raw
    db = fixture_db(spark, SF_SMALL, flags=False, geo=False, tags=False)
    empty = Tables(postings=db.postings.limit(0), positions=db.positions.limit(0),
                   employers=db.employers.limit(0), regions=db.regions)
    raw = _raw(spark, SF_SMALL)
    new = ingest.ingest_batch(raw, "b9", empty, db.regions)
    root = os.path.join(tmpdir_path, "db")
    new.ai_tags = new.postings.limit(0).select("uniq_id")
    new.tech_tags = new.postings.limit(0).select("uniq_id", F.lit("x").alias("bloom_field"),
                                                 F.lit(1).alias("bloom_code"))
    write_db(new, root)
    stored = stored_db(spark, root)
    n = stored.postings.count()
    assert n > 0 and n == stored.postings.select("uniq_id").distinct().count()
    again = ingest.ingest_batch(raw, "b9", stored, db.regions)
    assert again.postings.count() == 0 and again.positions.count() == 0 and again.employers.count() == 0
    rep = ingest.integrity_report(stored.postings, "postings").first()
    assert rep.keys_unique and rep.unknown_columns == ""


def test_delete_and_orphans(spark):
    db = fixture_db(spark, SF_SMALL)
    kept = ingest.delete_batch(db.postings, db.postings, "src_2022_01")
    tags = ingest.remove_orphan_tags(db.tech_tags, kept)
    assert tags.join(kept, "uniq_id", "left_anti").count() == 0
    assert ingest.delete_batch(db.positions, db.postings, None).count() == 0


def test_files_not_loaded_sampled(spark):
    raw = spark.createDataFrame([("f1", str(i)) for i in range(50)] + [("f2", str(i)) for i in range(50, 60)],
                                "_file string, uniq_id string")
    stored = spark.createDataFrame([(str(i),) for i in range(55)], "uniq_id string")
    full = {r.files: r.n_missing for r in ingest.files_not_loaded(raw, stored).collect()}
    assert full == {"f2": 5}
    some = {r.files: r.n_missing for r in ingest.files_not_loaded(raw, stored, sample_rows=5).collect()}
    assert set(some) <= {"f2"} and all(0 < n <= 5 for n in some.values())


def test_employer_postings_accepts_list(spark):
    db = fixture_db(spark, SF_SMALL, tags=False)
    from vacancylab.operators import evaluation
    names = [r.company_name for r in db.positions.select("company_name").distinct().limit(3).collect()
             if r.company_name]
    a = evaluation.employer_postings(db, names).count()
    b = evaluation.employer_postings(db, spark.createDataFrame([(n,) for n in names], "company_name string")).count()
    assert a == b > 0


def test_dimension_files_and_export(spark, tmpdir_path):
    grid = os.path.join(tmpdir_path, "grid.csv")
    header = ("name_en;name_de;name_fr;regio_abbrev;nuts_level;oecd_level;iso_2;iso_3;nuts_0;nuts_1;"
              "nuts_2;nuts_3;oecd_tl1;oecd_tl2;oecd_tl3;self_classified\n")
    with open(grid, "w", encoding="ISO-8859-1") as fh:
        fh.write(header)
        fh.write("Zurich;Zürich;Zurich;ZH;3;3;CH;CHE;CH0;CH0;CH04;CH040;CHE;CH04;CH040;no\n")
    reg = rawsrc.read_region_grid(spark, grid).first()
    assert (reg.name_en, reg.name_de, reg.nuts_level, reg.nuts_3) == ("zurich", "zürich", 3, "CH040")
    emp = os.path.join(tmpdir_path, "emp.csv")
    with open(emp, "w") as fh:
        fh.write("nuts_2;employed_people;employed_share\nCH0;10;1\nCH01;4;0.4\n")
    e = rawsrc.read_dimension_csv(spark, emp, sep=";").collect()
    assert [(r.nuts_2, r.employed_people) for r in e] == [("CH0", 10), ("CH01", 4)]
    out = os.path.join(tmpdir_path, "export")
    rawsrc.export_csv(spark.createDataFrame(e), out)
    assert spark.read.option("header", "true").csv(out).count() == 2

"""Rows chosen by their places, samples cut per group, shares added up from months."""

import os
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, Tables
from vacancylab.operators import ingest, sampling, shares

RAW = "uniq_id string, job_description string, _file string, _order struct<f:string,b:bigint,s:bigint>"


def _raw(spark, rows):
    return spark.createDataFrame([(k, t, f, (f, 0, s)) for k, t, f, s in rows], RAW)


def _explain(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_first_rows_equal_the_first_in_file_order(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "hot", "hot", *"abcdefgh"]), rng.choice([None, "", f"text {i}"]),
             rng.choice([None, "f1", "f2"]), i) for i in range(400)]
    rng.shuffle(rows)
    stored = spark.createDataFrame([("a",), ("zz",)], "uniq_id string")
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or "", r[3]))  # NULL file first
    want = {}
    for key, text, file, place in order:
        if key is not None:
            want.setdefault(key, (text, file, place))
    got = {r.uniq_id: (r.job_description, r._file, r._order.s) for r in ingest.first_rows(_raw(spark, rows), "uniq_id").collect()}
    assert got == want
    new = ingest.unique_records(_raw(spark, rows), "uniq_id", stored).collect()
    assert {r.uniq_id: (r.job_description, r._file, r._order.s) for r in new} == {k: v for k, v in want.items() if k != "a"}
    assert len(new) == len(want) - 1
    kept = ingest.exclude_duplicated(_raw(spark, rows), None, "keep_first").collect()
    assert len(kept) == len(want)
    assert ingest.first_rows(_raw(spark, []), "uniq_id").count() == 0


def test_texts_enter_no_aggregate_and_one_exchange(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "raw")
    _raw(spark, [(str(i % 7), "t" * i, "f", i) for i in range(50)]).write.parquet(path)
    raw = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = _explain(spark, ingest.unique_records(raw, "uniq_id", spark.createDataFrame([("3",)], "uniq_id string")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    nodes = [n for n in text.split("\n\n") if n.startswith("(")]
    assert not [n for n in nodes if "Aggregate" in n.split("\n")[0] and "job_description" in n]
    assert len([n for n in nodes if "Exchange" in n.split("\n")[0] and "job_description" in n]) == 1
    assert [n for n in nodes if "Scan" in n.split("\n")[0] and "job_description" not in n]


def test_country_sample_equals_the_plain_window(spark):
    pos = spark.range(6000).select(
        F.when(F.col("id") % 11 > 0, F.col("id").cast("string")).alias("uniq_id"), F.lit("x").alias("company_name"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 40).cast("string"))
        .alias("inferred_country"), F.lit(1).alias("__b"))
    w = Window.partitionBy("inferred_country").orderBy(sampling.hash_order(F.col("uniq_id"), 4), "uniq_id")
    ranked = pos.where("uniq_id is not null").withColumn("rn", F.row_number().over(w))
    for n in (1, 25, 70, 1500, 5000):
        want = sorted(r.uniq_id for r in ranked.where(F.col("rn") <= n).collect())
        got = sampling.country_sample(pos.where("uniq_id is not null"), n, 4)
        assert sorted(r.uniq_id for r in got.collect()) == want
    per = pos.groupBy("inferred_country").count().collect()
    assert sampling.country_sample(pos, 25, 4).count() == sum(min(25, r["count"]) for r in per)
    assert sampling.country_sample(pos.limit(0), 5).count() == 0


def test_a_cut_leaves_few_rows_of_a_hot_group(spark):
    n = 200
    for size in (2_000, 200_000):
        rows = spark.range(size).select(F.lit("hot").alias("g"), (F.xxhash64("id") / 2 + 2.0 ** 62).alias("p"))
        bucket = sampling.log_bucket(F.col("p"))
        cut = sampling.group_cuts(rows, n, ["g"], bucket).first()["__cut"]
        left = rows.where(bucket <= cut).count()
        assert n <= left <= 1.3 * n


def test_shares_by_month_equal_a_query_per_sample(spark):
    months = [None, "2020-01-05", "2020-01-30", "2020-02-11", "2021-07-01"]
    postings = spark.createDataFrame(
        [(str(i), months[i % 5], "no" if i % 13 == 0 else "yes") for i in range(200)],
        "uniq_id string, crawl_timestamp string, unique_posting_textlocation string")
    positions = spark.createDataFrame([(str(i), f"R{i % 3}" if i % 7 else None) for i in range(200)],
                                      "uniq_id string, nuts_2 string")
    regions = spark.createDataFrame([("R0", "zero", 2), ("R1", "one", 2)], "nuts_2 string, name_en string, nuts_level int")
    tags = spark.createDataFrame([(str(i), f"field {i % 4}") for i in range(0, 200, 3) for _ in range(2)],
                                 "uniq_id string, bloom_field string")
    db = Tables(postings=postings, positions=positions, regions=regions, tech_tags=tags)
    samples = [shares.FULL, "2020-01", "2021-07", "1999-01"]
    for measure in (shares.geo_dist, shares.tech_share, shares.spatial_tech, shares.field_shares):
        whole = sorted(map(str, measure(db, samples).collect()))
        single = sorted(str(r) for s in samples for r in measure(db, s).collect())
        assert whole and whole == single, measure.__name__
    rows = [i for i in range(200) if i % 13]
    got = {(r["sample"], r["region_code"]): r["total_postings"] for r in shares.geo_dist(db, samples).collect()}
    for sample, chosen in ((shares.FULL, rows), ("2020-01", [i for i in rows if i % 5 in (1, 2)])):
        for code in (None, "R0", "R1", "R2"):
            assert got[sample, code] == sum((f"R{i % 3}" if i % 7 else None) == code for i in chosen)
    totals = {r["sample"]: r["total_postings"] for r in shares.sample_totals(db, samples[1:]).collect()}
    assert totals == {shares.FULL: len(rows), "2020-01": sum(i % 5 in (1, 2) for i in rows), "2021-07": sum(i % 5 == 4 for i in rows)}

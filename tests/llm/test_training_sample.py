"""The training sample of the language model against a plain window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vacancylab.llm import crf_langid


def _plain(ids, n):
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    return sorted(map(tuple, ids.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
                      .select("doc_id", "lang").distinct().collect()), key=str)


def test_sample_equals_the_plain_window(spark):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").where("lang is not null")
    hot = spark.range(5000).select((F.col("id") - 2500).alias("doc_id"), F.lit("hot").alias("lang"))
    odd = spark.createDataFrame([(None, "xx"), (7, "xx"), (7, "xx"), (7, "yy")], "doc_id long, lang string")
    for ids in (documents, hot.unionByName(odd), odd, odd.limit(0)):
        for n in (1, 3, 400):
            got = sorted(map(tuple, crf_langid.training_ids(ids, n).collect()), key=str)
            assert got == _plain(ids, n)


def test_a_hot_language_sends_few_rows_to_its_task(spark):
    ids = spark.range(0, 100_000, 1, 40).select(F.col("id").alias("doc_id"), F.lit("hot").alias("lang"))
    bucket = crf_langid.log_bucket(F.xxhash64("doc_id").cast("double") + F.lit(2.0 ** 63))
    cut = crf_langid.group_cuts(ids, 400, ["lang"], bucket).first()["__cut"]
    assert 400 <= ids.where(bucket <= cut).count() <= 500

"""Stand-alone keys for set operations, top-k and window forms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import dedup
from ..sources.fixtures import fixture_db
from .catalog import register
from .fixture_sql import CURRENT_BATCH
from .oracle import sql


@register("u1_union_all_tag_ids", sql("""
    SELECT uniq_id, 'ai' AS source FROM ai_tags UNION ALL SELECT uniq_id, 'tech' FROM tech_tags"""))
def u1(spark, sf_dir):
    db = fixture_db(spark, sf_dir)
    return db.ai_tags.select("uniq_id", F.lit("ai").alias("source")).unionByName(
        db.tech_tags.select("uniq_id", F.lit("tech").alias("source")))


@register("u2_union_keep_last", sql("""
    SELECT uniq_id, bloom_field, bloom_code FROM (
      SELECT *, row_number() OVER (PARTITION BY uniq_id, bloom_code ORDER BY prio DESC) AS rn FROM (
        SELECT uniq_id, bloom_field, bloom_code, 0 AS prio FROM tech_tags WHERE bloom_code <= 2
        UNION ALL SELECT uniq_id, upper(bloom_field), bloom_code, 1 FROM tech_tags) u) t WHERE rn = 1"""))
def u2(spark, sf_dir):
    # stored tags + a new tagging run: on key clashes the new row wins (keep last)
    db = fixture_db(spark, sf_dir)
    old = db.tech_tags.filter(F.col("bloom_code") <= 2).withColumn("prio", F.lit(0))
    new = db.tech_tags.withColumn("bloom_field", F.upper("bloom_field")).withColumn("prio", F.lit(1))
    both = old.unionByName(new)
    w = Window.partitionBy("uniq_id", "bloom_code").orderBy(F.col("prio").desc())
    return both.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(
        "uniq_id", "bloom_field", "bloom_code")


@register("u3_key_difference", sql("SELECT uniq_id FROM ai_tags WHERE uniq_id NOT IN (SELECT uniq_id FROM tech_tags)"))
def u3(spark, sf_dir):
    db = fixture_db(spark, sf_dir)
    return db.ai_tags.select("uniq_id").join(db.tech_tags.select("uniq_id"), "uniq_id", "left_anti")


@register("u3_key_union", sql("SELECT uniq_id FROM ai_tags UNION SELECT uniq_id FROM tech_tags"))
def u3u(spark, sf_dir):
    db = fixture_db(spark, sf_dir)
    return db.ai_tags.select("uniq_id").union(db.tech_tags.select("uniq_id")).distinct()


@register("u4_distinct_states", sql("SELECT DISTINCT state, inferred_state FROM positions"))
def u4(spark, sf_dir):
    return fixture_db(spark, sf_dir, flags=False, tags=False).positions.select("state", "inferred_state").distinct()


@register("w1_row_number_duplicates", sql(f"""
    SELECT uniq_id FROM (
      SELECT c.uniq_id, row_number() OVER (PARTITION BY p.job_description ORDER BY c.uniq_id) AS rn
      FROM positions c JOIN (SELECT * FROM v_postings WHERE data_batch = '{CURRENT_BATCH}') p
      ON c.uniq_id = p.uniq_id) t WHERE rn > 1"""))
def w1(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return dedup.duplicate_ids_window(db.postings, db.positions, CURRENT_BATCH, ["job_description"])


@register("t1_t2_top_boards_by_unique", sql("""
    SELECT job_board, count(*) AS n_postings FROM postings WHERE unique_posting_text = 'yes'
    GROUP BY job_board ORDER BY n_postings DESC, job_board LIMIT 5"""))
def t2(spark, sf_dir):
    db = fixture_db(spark, sf_dir, tags=False)
    return (db.postings.filter(F.col("unique_posting_text") == "yes").groupBy("job_board")
            .agg(F.count(F.lit(1)).alias("n_postings"))
            .orderBy(F.col("n_postings").desc(), "job_board").limit(5))

"""Registered duplicate-flag queries (D1-D6, I15) and their SQL twins."""

from __future__ import annotations

from ..operators import dedup
from ..schemas import FLAG_COLUMNS
from ..sources.fixtures import fixture_db
from .catalog import register
from .fixture_sql import CURRENT_BATCH
from .oracle import sql

B = CURRENT_BATCH


def _later_sql(key: str, scope: str = "true") -> str:
    """All ids of a group but the least."""
    return sql(f"""
    SELECT unnest(list_sort(list(uniq_id))[2:]) AS uniq_id
    FROM v_postings JOIN positions USING (uniq_id) WHERE {scope} GROUP BY {key}""")


IN_BATCH = f"data_batch = '{B}'"


@register("d1_text_duplicates", _later_sql("job_description", IN_BATCH))
def d1(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return dedup.duplicate_ids(db.postings, db.positions, B, ["job_description"])


@register("d2_city_text_duplicates", _later_sql("data_batch, city, job_description"))
def d2(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return dedup.duplicate_ids(db.postings, db.positions, "all", ["city", "job_description"])


@register("d3_duplicates_restricted_scope",
          _later_sql("job_description", IN_BATCH + " AND inferred_country IN ('europe', 'asia')"))
def d3(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return dedup.duplicate_ids(db.postings, db.positions, B, ["job_description"],
                               restrict_to=["europe", "asia"])


@register("d3_duplicates_excluded_scope",
          _later_sql("job_description", IN_BATCH + " AND inferred_country NOT IN ('europe', 'asia')"))
def d3_ex(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return dedup.duplicate_ids(db.postings, db.positions, B, ["job_description"],
                               exclude=["europe", "asia"])


@register("d4_flagged_postings", sql("SELECT * FROM postings"))
def d4(spark, sf_dir):
    return fixture_db(spark, sf_dir, tags=False).postings


@register("d4_flag_rows", sql("SELECT uniq_id, data_batch, unique_posting_text, unique_posting_textlocation FROM postings"))
def d4_rows(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    flags = db.postings.select("uniq_id", "data_batch", *FLAG_COLUMNS)
    return dedup.flag_rows(flags, db.postings, db.positions)


@register("d5_flag_summary", sql("""
    SELECT 'unique_posting_text' AS flag, unique_posting_text AS value, count(*) AS n_postings
    FROM postings GROUP BY unique_posting_text
    UNION ALL
    SELECT 'unique_posting_textlocation', unique_posting_textlocation, count(*)
    FROM postings GROUP BY unique_posting_textlocation"""))
def d5(spark, sf_dir):
    return dedup.flag_summary(fixture_db(spark, sf_dir, tags=False).postings)


@register("d6_unique_share_by_country", sql(f"""
    SELECT posn.inferred_country AS country, count(*) AS n_postings,
           count(CASE WHEN chosen.unique_posting_text = 'yes' THEN 1 END) AS n_unique,
           floor(count(CASE WHEN chosen.unique_posting_text = 'yes' THEN 1 END) * 1000.0 / count(*) + 0.5) / 1000.0
             AS share_unique
    FROM (SELECT * FROM postings WHERE data_batch = '{B}') chosen JOIN positions posn ON posn.uniq_id = chosen.uniq_id
    GROUP BY posn.inferred_country"""))
def d6(spark, sf_dir):
    db = fixture_db(spark, sf_dir, tags=False)
    return dedup.unique_share_by_country(db.postings, db.positions, B)


@register("i15_reset_flag_for_countries", sql(f"""
    SELECT uniq_id, crawl_timestamp, job_description, job_board, text_language, data_batch,
      CASE WHEN data_batch = '{B}' AND uniq_id IN (SELECT uniq_id FROM positions WHERE inferred_country IN ('europe'))
           THEN 'yes' ELSE unique_posting_text END AS unique_posting_text,
      unique_posting_textlocation
    FROM postings"""))
def i15(spark, sf_dir):
    db = fixture_db(spark, sf_dir, tags=False)
    return dedup.reset_flag(db.postings, db.positions, "unique_posting_text", "yes", B,
                            restrict_to_countries=["europe"])


@register("i15_reset_flag_except_countries", sql(f"""
    SELECT uniq_id, crawl_timestamp, job_description, job_board, text_language, data_batch,
      unique_posting_text,
      CASE WHEN data_batch = '{B}' AND uniq_id IN (SELECT uniq_id FROM positions
                                                  WHERE inferred_country NOT IN ('europe'))
           THEN 'yes' ELSE unique_posting_textlocation END AS unique_posting_textlocation
    FROM postings"""))
def i15_ex(spark, sf_dir):
    db = fixture_db(spark, sf_dir, tags=False)
    return dedup.reset_flag(db.postings, db.positions, "unique_posting_textlocation", "yes", B,
                            exclude_countries=["europe"])

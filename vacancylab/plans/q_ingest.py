"""Registered ingest / maintenance queries (I1-I16, S10) and their SQL twins.

The raw batch is ``v_raw`` (documents seen as provider rows; ``file`` is the
source, ``row_seq`` the row position).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import ingest
from ..sources.fixtures import fixture_db, fixture_views
from .catalog import register
from .fixture_sql import CURRENT_BATCH
from .oracle import sql
from .q_regions import G4_SQL

NEW_BATCH = "src_2024_01"
OLD_BATCH = "src_2022_01"
GONE_FILES = ["src3", "src4"]


def _raw(spark, sf_dir):
    raw = fixture_views(spark, sf_dir)["v_raw"]
    raw = ingest.with_file_order(raw, "file", "row_seq").drop("file", "row_seq")
    return ingest.rename_raw(ingest.conform_raw(raw))


# --- SQL side -----------------------------------------------------------------
def _norm(c: str) -> str:
    return f"lower(trim({c}))"


REMOTE = ("CASE WHEN lower(trim(is_remote)) IN ('true', '1', '1.0', 'yes') THEN '1' "
          "WHEN lower(trim(is_remote)) IN ('false', '0', '0.0', 'no') THEN '0' END")
NULL_S = "cast(NULL AS varchar)"
NULL_D = "cast(NULL AS double)"

RAWC = ("rawc", f"""
    SELECT uniq_id, file AS _file, row_seq,
           crawl_timestamp, {NULL_S} AS url, {NULL_S} AS post_date, {NULL_S} AS job_title,
           job_description, {NULL_S} AS html_job_description, {_norm('job_board')} AS job_board,
           inferred_iso3_lang_code AS text_language,
           {_norm('company_name')} AS company_name, {NULL_S} AS category, {NULL_S} AS inferred_department_name,
           {NULL_D} AS inferred_department_score, {_norm('city')} AS city, {NULL_S} AS inferred_city,
           {_norm('state')} AS state, {_norm('inferred_state')} AS inferred_state, {NULL_S} AS country,
           {_norm('inferred_country')} AS inferred_country, {NULL_S} AS job_type, {NULL_S} AS inferred_job_title,
           {REMOTE} AS remote_position,
           {NULL_S} AS contact_phone_number, {NULL_S} AS contact_email, {NULL_S} AS inferred_company_type,
           cast(inferred_company_type_score AS double) AS inferred_company_type_score
    FROM v_raw""")

POS_COLS = ["uniq_id"] + schemas.BASE_TABLE_COLUMNS["positions"]
POST_COLS = ["uniq_id"] + schemas.BASE_TABLE_COLUMNS["postings"]
EMP_COLS = ["company_name"] + schemas.BASE_TABLE_COLUMNS["employers"]


def _first(cols, key="uniq_id") -> str:
    c = ", ".join(cols)
    return f"""SELECT {c}, _file FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _file, row_seq) AS rn
               FROM rawc WHERE {key} IS NOT NULL) t WHERE rn = 1"""


FIRST_POS = ("first_pos", _first(POS_COLS))
FIRST_POST = ("first_post", _first(POST_COLS))
DUPS = ("dups", """SELECT uniq_id AS duplicated_ids, count(*) AS n_occurrences FROM rawc
                   WHERE uniq_id IS NOT NULL GROUP BY uniq_id HAVING count(*) > 1""")


def _cols(cols, alias=""):
    return ", ".join(f"{alias}{c}" for c in cols)


# --- queries ------------------------------------------------------------------
@register("i1_i3_structured_positions", sql(f"SELECT {_cols(POS_COLS)} FROM first_pos", [RAWC, FIRST_POS]))
def i1(spark, sf_dir):
    pos = ingest.first_per_key(ingest.structure(_raw(spark, sf_dir), "positions"), "uniq_id")
    return pos.drop("_file", ingest.ORDER)


@register("i5_unique_positions", sql(f"""
    SELECT {_cols(POS_COLS)} FROM first_pos
    WHERE uniq_id NOT IN (SELECT uniq_id FROM v_postings WHERE data_batch = '{OLD_BATCH}')""",
                                      [RAWC, FIRST_POS]))
def i5(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    stored = db.positions.join(db.postings.filter(F.col("data_batch") == OLD_BATCH).select("uniq_id"),
                               "uniq_id", "left_semi")
    pos = ingest.structure(_raw(spark, sf_dir), "positions")
    return ingest.unique_records(pos, "uniq_id", ingest.existing_keys(stored, "uniq_id")).drop(
        "_file", ingest.ORDER)


@register("i7_batch_postings", sql(f"""
    SELECT {_cols(POST_COLS)}, '{NEW_BATCH}' AS data_batch, 'yes' AS unique_posting_text,
           'yes' AS unique_posting_textlocation FROM first_post""", [RAWC, FIRST_POST]))
def i7(spark, sf_dir):
    post = ingest.first_rows(ingest.structure(_raw(spark, sf_dir), "postings"), "uniq_id")
    return ingest.add_batch_defaults(post.drop("_file", ingest.ORDER), NEW_BATCH)


@register("i8_new_employers", sql(f"""
    SELECT {_cols(EMP_COLS)} FROM (
      SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY _file, row_seq) AS rn FROM rawc
      WHERE company_name IS NOT NULL AND company_name NOT IN (SELECT company_name FROM v_employers)) t
    WHERE rn = 1""", [RAWC]))
def i8(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    return ingest.new_employers(_raw(spark, sf_dir), db.employers).drop("_file", ingest.ORDER)


@register("i9_duplicated_ids", sql("SELECT * FROM dups", [RAWC, DUPS]))
def i9(spark, sf_dir):
    return ingest.duplicated_ids(_raw(spark, sf_dir))


@register("i9_duplicated_ids_per_repeat", sql("""
    SELECT d.duplicated_ids FROM dups d JOIN rawc r ON r.uniq_id = d.duplicated_ids
    QUALIFY row_number() OVER (PARTITION BY d.duplicated_ids ORDER BY r._file, r.row_seq) > 1""", [RAWC, DUPS]))
def i9_rep(spark, sf_dir):
    return ingest.duplicated_ids(_raw(spark, sf_dir), one_row_per_repeat=True)


@register("i10_exclude_duplicated_ids", sql("""
    SELECT uniq_id, company_name, city FROM rawc
    WHERE uniq_id NOT IN (SELECT duplicated_ids FROM dups)""", [RAWC, DUPS]))
def i10(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    pos = ingest.structure(raw, "positions")
    return ingest.exclude_duplicated(pos, ingest.duplicated_ids(raw)).select("uniq_id", "company_name", "city")


@register("i10_keep_first_duplicated", sql(f"SELECT uniq_id, company_name, city FROM first_pos",
                                            [RAWC, FIRST_POS]))
def i10_keep(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    pos = ingest.structure(raw, "positions")
    return ingest.exclude_duplicated(pos, ingest.duplicated_ids(raw), "keep_first").select(
        "uniq_id", "company_name", "city")


GONE = ", ".join(f"'{f}'" for f in GONE_FILES)


@register("i11_files_not_loaded", sql(f"""
    SELECT r._file AS files, count(CASE WHEN s.uniq_id IS NULL THEN 1 END) AS n_missing
    FROM rawc r LEFT JOIN (SELECT DISTINCT uniq_id FROM positions WHERE uniq_id IN
                           (SELECT uniq_id FROM v_postings WHERE job_board NOT IN ({GONE}))) s
      ON s.uniq_id = r.uniq_id
    WHERE r.uniq_id IS NOT NULL
    GROUP BY r._file HAVING count(CASE WHEN s.uniq_id IS NULL THEN 1 END) > 0""", [RAWC]))
def i11(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    stored = db.positions.join(db.postings.filter(~F.col("job_board").isin(GONE_FILES)).select("uniq_id"),
                               "uniq_id", "left_semi")
    return ingest.files_not_loaded(_raw(spark, sf_dir), stored)


@register("i12_integrity_report", sql("""
    SELECT 'positions' AS "table", count(*) AS n_rows, count(DISTINCT uniq_id) AS n_keys,
           count(*) = count(DISTINCT uniq_id) AS keys_unique,
           '' AS unknown_columns, 'nuts_2,nuts_3' AS missing_columns
    FROM rawc""", [RAWC]))
def i12(spark, sf_dir):
    pos = ingest.structure(_raw(spark, sf_dir), "positions")
    return ingest.integrity_report(pos, "positions")


@register("i13_delete_batch", sql(f"""
    SELECT * FROM positions WHERE uniq_id NOT IN (SELECT uniq_id FROM postings WHERE data_batch = '{OLD_BATCH}')"""))
def i13(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return ingest.delete_batch(db.positions, db.postings, OLD_BATCH)


@register("i13_delete_batch_postings", sql(f"SELECT * FROM postings WHERE data_batch <> '{OLD_BATCH}'"))
def i13_post(spark, sf_dir):
    db = fixture_db(spark, sf_dir, tags=False)
    return ingest.delete_batch(db.postings, db.postings, OLD_BATCH)


@register("i14_remove_orphan_employers", sql("""
    SELECT * FROM employers WHERE company_name IN
      (SELECT company_name FROM positions WHERE company_name IS NOT NULL AND remote_position = '1')"""))
def i14(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    return ingest.remove_orphan_employers(db.employers, db.positions.filter(F.col("remote_position") == "1"))


@register("i14_remove_orphan_tags", sql(f"""
    SELECT * FROM tech_tags WHERE uniq_id IN (SELECT uniq_id FROM postings WHERE data_batch = '{CURRENT_BATCH}')"""))
def i14_tags(spark, sf_dir):
    db = fixture_db(spark, sf_dir)
    return ingest.remove_orphan_tags(db.tech_tags, db.postings.filter(F.col("data_batch") == CURRENT_BATCH))


@register("i16_rows_per_file", sql("SELECT _file AS file, count(*) AS n_rows FROM first_post GROUP BY _file",
                                   [RAWC, FIRST_POST]))
def i16(spark, sf_dir):
    post = ingest.first_rows(ingest.structure(_raw(spark, sf_dir), "postings"), "uniq_id")
    return ingest.rows_per_file(post)


@register("i_batch_update_positions", sql(f"""
    SELECT p.*, l.nuts_2, l.nuts_3 FROM (
      SELECT {_cols(POS_COLS)} FROM first_pos
      WHERE uniq_id NOT IN (SELECT duplicated_ids FROM dups)
        AND uniq_id NOT IN (SELECT uniq_id FROM v_postings WHERE data_batch = '{OLD_BATCH}')) p
    LEFT JOIN ({G4_SQL}) l ON p.inferred_state = l.inferred_state""", [RAWC, FIRST_POS, DUPS]))
def i_batch(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    old = db.postings.filter(F.col("data_batch") == OLD_BATCH)
    stored = type(db)(postings=old, positions=db.positions.join(old.select("uniq_id"), "uniq_id", "left_semi"),
                      employers=db.employers, regions=db.regions, ai_tags=None, tech_tags=None)
    new = ingest.ingest_batch(_raw(spark, sf_dir), NEW_BATCH, stored, db.regions)
    return new.positions


@register("i_batch_update_postings", sql(f"""
    SELECT {_cols(POST_COLS)}, '{NEW_BATCH}' AS data_batch, 'yes' AS unique_posting_text,
           'yes' AS unique_posting_textlocation FROM first_post
    WHERE uniq_id NOT IN (SELECT duplicated_ids FROM dups)
      AND uniq_id NOT IN (SELECT uniq_id FROM v_postings WHERE data_batch = '{OLD_BATCH}')""",
                                        [RAWC, FIRST_POST, DUPS]))
def i_batch_post(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    old = db.postings.filter(F.col("data_batch") == OLD_BATCH)
    stored = type(db)(postings=old, positions=db.positions.join(old.select("uniq_id"), "uniq_id", "left_semi"),
                      employers=db.employers, regions=db.regions, ai_tags=None, tech_tags=None)
    return ingest.ingest_batch(_raw(spark, sf_dir), NEW_BATCH, stored, db.regions).postings


@register("s10_table_row_counts", sql("""
    SELECT 'postings' AS "table", count(*) AS n_rows FROM postings
    UNION ALL SELECT 'positions', count(*) FROM positions
    UNION ALL SELECT 'employers', count(*) FROM employers
    UNION ALL SELECT 'regions', count(*) FROM regions
    UNION ALL SELECT 'ai_tags', count(*) FROM ai_tags
    UNION ALL SELECT 'tech_tags', count(*) FROM tech_tags"""))
def s10(spark, sf_dir):
    return ingest.table_row_counts(fixture_db(spark, sf_dir))

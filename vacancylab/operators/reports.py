"""Regional reports (A1-A6, A16, A17) and the example queries.

Report parameters: ``regional_level`` (2 or 3), ``data_batch`` (one batch,
a list or "all") and ``unique_postings_only``.  GROUP BY keeps the NULL
region / NULL country groups; region names are attached last (G8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import (apply_condition, batch_condition, combine_conditions,
                                    is_not_null_safe, remote_condition, unique_condition)
from .regions import add_region_names, region_column


def _posting_ids(postings: DataFrame, data_batch, unique_postings_only: bool) -> DataFrame:
    cond = combine_conditions([batch_condition(data_batch), unique_condition(unique_postings_only)])
    return apply_condition(postings, cond).select("uniq_id")


# ------------------------------------------------------------------------ A1
def total_postings_by_region(db, regional_level: int = 2, data_batch="all",
                             unique_postings_only: bool = True, sort: bool = True) -> DataFrame:
    """A1: postings per region code; a posting without position counts 0."""
    rc = region_column(regional_level)
    chosen = _posting_ids(db.postings, data_batch, unique_postings_only)
    posn = db.positions.select(F.col("uniq_id").alias("pc_id"), F.col(rc).alias("region_code"))
    df = (chosen.join(posn, chosen.uniq_id == posn.pc_id, "left")
          .groupBy("region_code").agg(F.count("pc_id").alias("n_postings")))
    return add_region_names(df, db.regions, "n_postings" if sort else None)


def _tagged_by_region(db, tags: DataFrame, count_name: str, regional_level, data_batch,
                      unique_postings_only, extra_keys=()) -> DataFrame:
    rc = region_column(regional_level)
    chosen = _posting_ids(db.postings, data_batch, unique_postings_only)
    posn = db.positions.select("uniq_id", F.col("inferred_country").alias("country"),
                             F.col(rc).alias("region_code"))
    rows = (tags.join(posn, "uniq_id", "left")
            .join(chosen, "uniq_id", "inner"))
    keys = ["country", "region_code", *extra_keys]
    return rows.groupBy(*keys).agg(F.count("uniq_id").alias(count_name))


# ------------------------------------------------------------------------ A2
def ai_postings_by_region(db, regional_level: int = 2, data_batch="all",
                          unique_postings_only: bool = True, sort: bool = True) -> DataFrame:
    """A2: AI-tagged postings per (country, region code)."""
    df = _tagged_by_region(db, db.ai_tags.select("uniq_id"), "n_ai_postings",
                           regional_level, data_batch, unique_postings_only)
    return add_region_names(df, db.regions, "n_ai_postings" if sort else None)


# ------------------------------------------------------------------------ A3 / A4
def tech_postings_by_region(db, by_field: bool = True, regional_level: int = 2, data_batch="all",
                            unique_postings_only: bool = True) -> DataFrame:
    """A3 (by field) / A4 (all fields; a posting in k fields counts k times)."""
    tags = db.tech_tags.select("uniq_id", F.col("bloom_field").alias("technology_field"))
    extra = ("technology_field",) if by_field else ()
    if not by_field:
        tags = tags.drop("technology_field")
    df = _tagged_by_region(db, tags, "n_disruptive_tech_postings", regional_level,
                           data_batch, unique_postings_only, extra)
    return add_region_names(df, db.regions, "n_disruptive_tech_postings")


# ------------------------------------------------------------------------ A5
def remote_postings_by_region(db, regional_level: int = 2, data_batch="all",
                              unique_postings_only: bool = True) -> DataFrame:
    """A5: remote postings per (country, region code)."""
    rc = region_column(regional_level)
    chosen = _posting_ids(db.postings, data_batch, unique_postings_only)
    posn = (db.positions.filter(remote_condition())
          .select("uniq_id", F.col("inferred_country").alias("country"), F.col(rc).alias("region_code")))
    df = (chosen.join(posn, "uniq_id", "inner")
          .groupBy("country", "region_code").agg(F.count("uniq_id").alias("n_remote_postings")))
    return add_region_names(df, db.regions, "n_remote_postings")


# ------------------------------------------------------------------------ A6
def ai_share_by_region(db, regional_level: int = 2, data_batch="all",
                       unique_postings_only: bool = True) -> DataFrame:
    """AI postings per (country, region) next to all postings of the region
    (NULL is a region), ``ai_share = n_ai_postings / n_postings``, sorted by
    share.  Postings, positions and tags are read and joined once; both counts
    come out of one aggregate."""
    rc = region_column(regional_level)
    chosen = _posting_ids(db.postings, data_batch, unique_postings_only)
    posn = db.positions.select("uniq_id", F.lit(True).alias("placed"), F.col("inferred_country").alias("country"),
                               F.col(rc).alias("region_code"))
    tags = db.ai_tags.groupBy("uniq_id").agg(F.count(F.lit(1)).alias("tags"))
    cells = (chosen.join(posn, "uniq_id", "left").join(tags, "uniq_id", "left")
             .groupBy("country", "region_code")
             .agg(F.count("placed").alias("n"), F.sum("tags").cast("bigint").alias("n_ai_postings")))
    # one row per (country, region): small whatever the number of postings
    out = cells.withColumn("n_postings", F.sum("n").over(Window.partitionBy("region_code")).cast("bigint")).where(
        "n_ai_postings > 0")
    out = add_region_names(out, db.regions).withColumn("ai_share", F.try_divide("n_ai_postings", "n_postings"))
    return (out.select("country", "region_code", "n_ai_postings", "region", "n_postings", "ai_share")
            .orderBy(F.col("ai_share").desc_nulls_last(), "country", "region_code"))


# ------------------------------------------------------------------------ A16
def ai_postings_in_country(db, country: str, regional_level: int = 2) -> DataFrame:
    """AI postings per region of one country; NULL region excluded."""
    rc = region_column(regional_level)
    posn = db.positions.filter(F.col("inferred_country") == F.lit(country)).select(
        "uniq_id", F.col(rc).alias("region"))
    return (db.ai_tags.join(posn, "uniq_id", "inner").groupBy("region")
            .agg(F.count("uniq_id").alias("n_ai_postings"))
            .filter(F.col("region").isNotNull())
            .orderBy(F.col("n_ai_postings").desc(), "region"))


# ------------------------------------------------------------------------ A17
def unique_postings_listing(db, flag: str = "unique_posting_text") -> DataFrame:
    """Non-duplicated postings with employer, city and text."""
    chosen = db.postings.filter(F.col(flag) == "yes").select("uniq_id", "job_description")
    posn = db.positions.select("uniq_id", "company_name", "city")
    return chosen.join(posn, "uniq_id", "left").select("uniq_id", "company_name", "city", "job_description")


# ------------------------------------------------------------------------ X1-X6
def postings_by_board(db) -> DataFrame:
    """Postings per job board, descending."""
    return (db.postings.groupBy(F.col("job_board").alias("plattform"))
            .agg(F.count(F.lit(1)).alias("n_postings"))
            .orderBy(F.col("n_postings").desc(), "plattform"))


def top_cities(db, k: int = 10, drop_null: bool = False) -> DataFrame:
    """Top-k cities.  SQL form: ``count(city)`` (the NULL group counts 0)
    and the literal 'nan' excluded null-safely; ``drop_null=True`` is the
    dplyr form (NULL city dropped, rows counted)."""
    posn = db.positions
    if drop_null:
        posn = posn.filter(F.col("city").isNotNull())
        agg = posn.groupBy("city").agg(F.count(F.lit(1)).alias("n_postings"))
    else:
        agg = (posn.groupBy("city").agg(F.count("city").alias("n_postings"))
               .filter(is_not_null_safe("city", "nan")))
    return agg.orderBy(F.col("n_postings").desc(), F.col("city").asc_nulls_first()).limit(k)


def company_titles_in_city(db, city_pattern: str, company_pattern: str) -> DataFrame:
    """Positions whose city / company match case-insensitive LIKE patterns."""
    posn = db.positions
    cols = ["company_name", "city"] + (["inferred_job_title"] if "inferred_job_title" in posn.columns else [])
    return posn.filter(F.col("city").ilike(city_pattern) & F.col("company_name").ilike(company_pattern)).select(*cols)


def postings_with_term(db, term: str) -> DataFrame:
    """Postings whose text contains ``term`` (case-insensitive substring,
    no leading space) with employer and city."""
    chosen = db.postings.filter(F.col("job_description").ilike(f"%{term}%")).select("uniq_id", "job_description")
    posn = db.positions.select("uniq_id", "company_name", "city")
    return chosen.join(posn, "uniq_id", "left").select("uniq_id", "company_name", "city", "job_description")


def top_companies_for_term(db, term: str, k: int = 20) -> DataFrame:
    """Top-k employers by postings containing ``term`` (NULL employer kept)."""
    rows = postings_with_term(db, term)
    return (rows.groupBy("company_name").agg(F.count(F.lit(1)).alias("n_postings"))
            .orderBy(F.col("n_postings").desc(), F.col("company_name").asc_nulls_first()).limit(k))


def first_descriptions(db, n: int = 5) -> DataFrame:
    """The first n descriptions in the order of ``uniq_id``."""
    return db.postings.select("uniq_id", "job_description").orderBy("uniq_id").limit(n).select("job_description")

"""Registered share/distribution queries (A7-A15) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shares
from ..sources.fixtures import fixture_db
from .catalog import register
from .oracle import sql

MONTHS = ["1996-03", "1998-07", "2000-01"]
SAMPLES = ["full_sample", *MONTHS]
_MONTH_LIST = ", ".join(f"'{m}'" for m in MONTHS)

# (uniq_id, sample) twin: each cleaned posting in the full sample and its month.
SAMPLES_CTE = ("samp", f"""
    SELECT uniq_id, 'full_sample' AS sample FROM postings WHERE unique_posting_textlocation = 'yes'
    UNION ALL
    SELECT uniq_id, substr(crawl_timestamp, 1, 7) FROM postings
    WHERE unique_posting_textlocation = 'yes' AND substr(crawl_timestamp, 1, 7) IN ({_MONTH_LIST})""")


def _dim(level: int) -> tuple[str, str]:
    return (f"dim{level}", f"""SELECT nuts_{level} AS region_code, min(name_en) AS region FROM regions
                              WHERE nuts_level = {level} GROUP BY nuts_{level}""")


def _geo_sql(level: int) -> str:
    return sql(f"""
    SELECT c.sample, c.region_code, d.region, c.total_postings,
           c.total_postings / sum(c.total_postings) OVER (PARTITION BY c.sample) AS postings_share
    FROM (SELECT s.sample, posn.nuts_{level} AS region_code, count(*) AS total_postings
          FROM positions posn JOIN samp s ON s.uniq_id = posn.uniq_id GROUP BY s.sample, posn.nuts_{level}) c
    LEFT JOIN dim{level} d ON c.region_code = d.region_code""", [SAMPLES_CTE, _dim(level)])


@register("a7_geo_dist_nuts2", _geo_sql(2))
def a7(spark, sf_dir):
    return shares.geo_dist(fixture_db(spark, sf_dir, tags=False), SAMPLES, 2)


@register("a7_geo_dist_nuts3", _geo_sql(3))
def a7_3(spark, sf_dir):
    return shares.geo_dist(fixture_db(spark, sf_dir, tags=False), SAMPLES, 3)


def _tech_share_sql(table: str) -> str:
    return sql(f"""
    SELECT s.sample, '{table}' AS tech,
           count(CASE WHEN t.uniq_id IS NOT NULL THEN 1 END) AS tech_postings,
           count(*) AS total_postings,
           count(CASE WHEN t.uniq_id IS NOT NULL THEN 1 END) / count(*) AS share
    FROM samp s LEFT JOIN (SELECT DISTINCT uniq_id FROM {table}) t ON t.uniq_id = s.uniq_id
    GROUP BY s.sample""", [SAMPLES_CTE])


@register("a8_tech_share_technology", _tech_share_sql("tech_tags"))
def a8(spark, sf_dir):
    return shares.tech_share(fixture_db(spark, sf_dir), SAMPLES, "tech")


@register("a8_tech_share_ai", _tech_share_sql("ai_tags"))
def a8_ai(spark, sf_dir):
    return shares.tech_share(fixture_db(spark, sf_dir), SAMPLES, "ai")


def _spatial_sql(table: str) -> str:
    return sql(f"""
    SELECT c.sample, '{table}' AS tech, c.region_code, d.region, c.n_postings,
           c.n_postings / sum(c.n_postings) OVER (PARTITION BY c.sample) AS share
    FROM (SELECT s.sample, posn.nuts_2 AS region_code, count(*) AS n_postings
          FROM positions posn JOIN samp s ON s.uniq_id = posn.uniq_id
          WHERE posn.uniq_id IN (SELECT uniq_id FROM {table})
          GROUP BY s.sample, posn.nuts_2) c
    LEFT JOIN dim2 d ON c.region_code = d.region_code
    WHERE c.region_code IS NOT NULL AND d.region IS NOT NULL""", [SAMPLES_CTE, _dim(2)])


@register("a9_spatial_tech_technology", _spatial_sql("tech_tags"))
def a9(spark, sf_dir):
    return shares.spatial_tech(fixture_db(spark, sf_dir), SAMPLES, "tech")


@register("a9_spatial_tech_ai", _spatial_sql("ai_tags"))
def a9_ai(spark, sf_dir):
    return shares.spatial_tech(fixture_db(spark, sf_dir), SAMPLES, "ai")


FIELD_SQL = """
    SELECT c.sample, c.field, c.tech_postings,
           c.tech_postings / sum(c.tech_postings) OVER (PARTITION BY c.sample) AS share
    FROM (SELECT s.sample, t.bloom_field AS field, count(DISTINCT t.uniq_id) AS tech_postings
          FROM tech_tags t JOIN samp s ON s.uniq_id = t.uniq_id GROUP BY s.sample, t.bloom_field) c"""


@register("a10_field_shares", sql(FIELD_SQL, [SAMPLES_CTE]))
def a10(spark, sf_dir):
    return shares.field_shares(fixture_db(spark, sf_dir), SAMPLES)


@register("a11_a13_complete_field_panel", sql(f"""
    SELECT sample, field, tech_postings, share FROM (
      SELECT f.*, count(*) OVER (PARTITION BY field) AS n FROM ({FIELD_SQL}) f) t
    WHERE n = {len(SAMPLES)}""", [SAMPLES_CTE]))
def a11(spark, sf_dir):
    return shares.period_panel(fixture_db(spark, sf_dir), MONTHS, "fields")


@register("a13_complete_region_panel", sql(f"""
    SELECT sample, region_code, region, total_postings, postings_share FROM (
      SELECT g.*, count(*) OVER (PARTITION BY region) AS n FROM (
        SELECT c.sample, c.region_code, d.region, c.total_postings,
               c.total_postings / sum(c.total_postings) OVER (PARTITION BY c.sample) AS postings_share
        FROM (SELECT s.sample, posn.nuts_2 AS region_code, count(*) AS total_postings
              FROM positions posn JOIN samp s ON s.uniq_id = posn.uniq_id GROUP BY s.sample, posn.nuts_2) c
        LEFT JOIN dim2 d ON c.region_code = d.region_code) g
      WHERE g.region_code IS NOT NULL AND g.region IS NOT NULL AND g.region <> 'nation_0') t
    WHERE n = {len(SAMPLES)}""", [SAMPLES_CTE, _dim(2)]))
def a13(spark, sf_dir):
    return shares.period_panel(fixture_db(spark, sf_dir, tags=False), MONTHS, "nuts_2",
                               drop_regions=["nation_0"])


@register("a13_sample_totals", sql("SELECT sample, count(*) AS total_postings FROM samp GROUP BY sample",
                                   [SAMPLES_CTE]))
def a13_tot(spark, sf_dir):
    return shares.sample_totals(fixture_db(spark, sf_dir, geo=False, tags=False), MONTHS)


@register("a12_month_distribution", sql("""
    SELECT month, n_postings, share, avg(share) OVER () AS mean_share FROM (
      SELECT month, n_postings, n_postings / sum(n_postings) OVER () AS share FROM (
        SELECT substr(crawl_timestamp, 1, 7) AS month, count(*) AS n_postings FROM postings
        WHERE unique_posting_textlocation = 'yes' GROUP BY 1) a) b"""))
def a12(spark, sf_dir):
    return shares.month_distribution(fixture_db(spark, sf_dir, tags=False))


EXT_CTE = ("ext", """
    SELECT nuts_2, employed_people / sum(employed_people) OVER () AS employed_share,
           vacancies / sum(vacancies) OVER () AS vacancy_share FROM v_external_shares""")

A14_BODY = """
    SELECT e.nuts_2, g.region, g.postings_share, e.employed_share, e.vacancy_share,
           g.postings_share - e.employed_share AS abs_diff,
           (g.postings_share - e.employed_share) / e.employed_share AS rel_diff
    FROM ext e JOIN (
        SELECT c.region_code, d.region, c.total_postings / sum(c.total_postings) OVER () AS postings_share
        FROM (SELECT posn.nuts_2 AS region_code, count(*) AS total_postings FROM positions posn
              WHERE posn.uniq_id IN (SELECT uniq_id FROM postings WHERE unique_posting_textlocation = 'yes')
              GROUP BY posn.nuts_2) c
        LEFT JOIN dim2 d ON c.region_code = d.region_code) g
      ON g.region_code = e.nuts_2
    WHERE g.region IS NOT NULL"""


def _external(db):
    ext = db.external_shares
    emp = shares.with_share(ext, "employed_people", "employed_share")
    vac = shares.with_share(ext, "vacancies", "vacancy_share")
    return shares.external_comparison(db, emp, vac)


@register("a14_external_comparison", sql(A14_BODY, [EXT_CTE, _dim(2)]))
def a14(spark, sf_dir):
    return _external(fixture_db(spark, sf_dir, tags=False))


@register("a15_shares_long", sql("""
    SELECT nuts_2, region, 'postings' AS measure, postings_share AS share FROM a14
    UNION ALL SELECT nuts_2, region, 'employed', employed_share FROM a14
    UNION ALL SELECT nuts_2, region, 'vacancy', vacancy_share FROM a14""",
                                 [EXT_CTE, _dim(2), ("a14", A14_BODY)]))
def a15(spark, sf_dir):
    return shares.shares_long(_external(fixture_db(spark, sf_dir, tags=False)))

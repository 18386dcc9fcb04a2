"""Registered region queries (G1-G6) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import regions
from ..sources.fixtures import fixture_db, fixture_views
from .catalog import register
from .oracle import sql

G4_SQL = """
    SELECT inferred_state, nuts_2, nuts_3 FROM (
      SELECT *, count(*) OVER (PARTITION BY inferred_state) AS n FROM (
        SELECT name_en AS inferred_state, nuts_2, nuts_3 FROM regions WHERE nuts_level IN (2, 3)
        UNION ALL
        SELECT name_en, oecd_tl2, oecd_tl3 FROM regions
        WHERE nuts_2 IS NULL AND nuts_3 IS NULL AND oecd_level IN (2, 3)) b) t
    WHERE n = 1 OR (inferred_state IS NOT NULL AND nuts_2 IS NOT NULL AND nuts_3 IS NOT NULL)"""


@register("g1_match_regions", sql("SELECT * FROM positions_g1"))
def g1(spark, sf_dir):
    v = fixture_views(spark, sf_dir)
    return regions.match_regions(v["v_positions"], v["v_regions"])


@register("g2_assign_regions_with_rules", sql("SELECT * FROM positions"))
def g2(spark, sf_dir):
    return fixture_db(spark, sf_dir, flags=False, tags=False).positions


@register("g3_coverage_summary", sql("""
    SELECT count(CASE WHEN nuts_2 IS NOT NULL AND nuts_3 IS NOT NULL THEN 1 END) AS n_matched,
           count(*) AS n_total,
           count(CASE WHEN nuts_2 IS NOT NULL AND nuts_3 IS NOT NULL THEN 1 END) / count(*) AS share
    FROM positions"""))
def g3(spark, sf_dir):
    return regions.coverage_summary(fixture_db(spark, sf_dir, flags=False, tags=False).positions)


@register("g4_update_lookup", sql(G4_SQL))
def g4(spark, sf_dir):
    return regions.update_lookup(fixture_views(spark, sf_dir)["v_regions"])


@register("g5_attach_region_codes", sql(f"""
    SELECT p.*, l.nuts_2, l.nuts_3 FROM v_positions p LEFT JOIN ({G4_SQL}) l
    ON p.inferred_state = l.inferred_state"""))
def g5(spark, sf_dir):
    v = fixture_views(spark, sf_dir)
    out = regions.attach_region_codes(v["v_positions"], v["v_regions"])
    return out.select(*v["v_positions"].columns, "nuts_2", "nuts_3")


@register("g6_region_names", sql(
    "SELECT name_en AS region, oecd_tl2 AS region_code FROM regions WHERE oecd_level = 2"))
def g6(spark, sf_dir):
    return regions.region_names(fixture_views(spark, sf_dir)["v_regions"])


@register("g8_positions_by_region_named", sql("""
    SELECT a.*, n.region FROM (SELECT nuts_2 AS region_code, count(*) AS n_positions
                               FROM positions GROUP BY nuts_2) a
    LEFT JOIN (SELECT name_en AS region, oecd_tl2 AS region_code FROM regions WHERE oecd_level = 2) n
      ON a.region_code IS NOT DISTINCT FROM n.region_code"""))
def g8(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    counts = db.positions.groupBy(F.col("nuts_2").alias("region_code")).agg(
        F.count(F.lit(1)).alias("n_positions"))
    return regions.add_region_names(counts, db.regions, "n_positions")

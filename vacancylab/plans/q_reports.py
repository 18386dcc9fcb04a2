"""Registered report queries (A1-A6, A16, A17, X1-X6) and their SQL twins."""

from __future__ import annotations

from ..operators import reports
from ..sources.fixtures import fixture_db
from .catalog import register
from .fixture_sql import CURRENT_BATCH
from .oracle import REGION_NAMES, sql, with_names

B = CURRENT_BATCH
#: One row per chosen posting, with its place and what it is tagged as.
FACTS = ("facts", f"""
    SELECT p.uniq_id, q.uniq_id AS placed, q.inferred_country AS country, q.nuts_2, q.nuts_3,
           coalesce(q.remote_position = '1', false) AS remote, p.uniq_id IN (SELECT uniq_id FROM ai_tags) AS ai,
           coalesce(t.fields, []) AS fields
    FROM postings p LEFT JOIN positions q USING (uniq_id)
    LEFT JOIN (SELECT uniq_id, list(bloom_field) AS fields FROM tech_tags GROUP BY uniq_id) t USING (uniq_id)
    WHERE data_batch = '{B}' AND unique_posting_text = 'yes'""")


def _cells(level: str = "nuts_2") -> list[tuple[str, str]]:
    """All counts of a (country, region) cell in one aggregate."""
    return [REGION_NAMES, FACTS, ("cells", f"""
    SELECT country, {level} AS region_code, count(placed) AS n_postings, count(*) FILTER (ai) AS n_ai,
           sum(len(fields))::BIGINT AS n_tech, count(*) FILTER (remote) AS n_remote
    FROM facts GROUP BY ALL""")]


def _cell_sql(count: str, name: str) -> str:
    return sql(with_names("a"), [*_cells(), (
        "a", f"SELECT country, region_code, {count} AS {name} FROM cells WHERE {count} > 0")])


def _total_sql(level: str) -> str:
    return sql(with_names("a"), [*_cells(level), (
        "a", "SELECT region_code, sum(n_postings)::BIGINT AS n_postings FROM cells GROUP BY region_code")])


@register("a1_total_postings_by_region", _total_sql("nuts_2"))
def a1(spark, sf_dir):
    return reports.total_postings_by_region(fixture_db(spark, sf_dir), 2, B, True)


@register("a1_total_postings_by_region_nuts3", _total_sql("nuts_3"))
def a1_n3(spark, sf_dir):
    return reports.total_postings_by_region(fixture_db(spark, sf_dir), 3, B, True)


@register("a2_ai_postings_by_region", _cell_sql("n_ai", "n_ai_postings"))
def a2(spark, sf_dir):
    return reports.ai_postings_by_region(fixture_db(spark, sf_dir), 2, B, True)


@register("a3_tech_postings_by_region_field", sql(with_names("a"), [REGION_NAMES, FACTS, ("a", """
    SELECT country, nuts_2 AS region_code, technology_field, count(*) AS n_disruptive_tech_postings
    FROM (SELECT country, nuts_2, unnest(fields) AS technology_field FROM facts) tagged GROUP BY ALL""")]))
def a3(spark, sf_dir):
    return reports.tech_postings_by_region(fixture_db(spark, sf_dir), True, 2, B, True)


@register("a4_tech_postings_by_region", _cell_sql("n_tech", "n_disruptive_tech_postings"))
def a4(spark, sf_dir):
    return reports.tech_postings_by_region(fixture_db(spark, sf_dir), False, 2, B, True)


@register("a5_remote_postings_by_region", _cell_sql("n_remote", "n_remote_postings"))
def a5(spark, sf_dir):
    return reports.remote_postings_by_region(fixture_db(spark, sf_dir), 2, B, True)


@register("a6_ai_share_by_region", sql("""
    SELECT a.*, n.region, n_ai_postings / n_postings AS ai_share
    FROM a LEFT JOIN region_names n ON a.region_code IS NOT DISTINCT FROM n.region_code
    WHERE n_ai_postings > 0""", [*_cells(), ("a", """
    SELECT country, region_code, n_ai AS n_ai_postings,
           (sum(n_postings) OVER (PARTITION BY region_code))::BIGINT AS n_postings
    FROM cells""")]))
def a6(spark, sf_dir):
    return reports.ai_share_by_region(fixture_db(spark, sf_dir), 2, B, True)


A16_COUNTRY = "europe"


@register("a16_ai_postings_in_country", sql(f"""
    SELECT nuts_2 AS region, count(*) AS n_ai_postings FROM positions SEMI JOIN ai_tags USING (uniq_id)
    WHERE inferred_country = '{A16_COUNTRY}' AND nuts_2 IS NOT NULL GROUP BY nuts_2"""))
def a16(spark, sf_dir):
    return reports.ai_postings_in_country(fixture_db(spark, sf_dir), A16_COUNTRY)


@register("a17_unique_postings_listing", sql("""
    SELECT uniq_id, company_name, city, job_description FROM positions RIGHT JOIN postings USING (uniq_id)
    WHERE unique_posting_text = 'yes'"""))
def a17(spark, sf_dir):
    return reports.unique_postings_listing(fixture_db(spark, sf_dir))


@register("x1_postings_by_board", sql("""
    SELECT job_board AS plattform, count(*) AS n_postings FROM postings GROUP BY job_board"""))
def x1(spark, sf_dir):
    return reports.postings_by_board(fixture_db(spark, sf_dir, flags=False, geo=False, tags=False))


@register("x2_top_cities", sql("""
    SELECT city, count(city) AS n_postings FROM positions GROUP BY city
    HAVING city IS DISTINCT FROM 'nan'
    ORDER BY n_postings DESC, city ASC NULLS FIRST LIMIT 10"""))
def x2(spark, sf_dir):
    return reports.top_cities(fixture_db(spark, sf_dir, flags=False, tags=False), 10)


@register("x2_top_cities_non_null", sql("""
    SELECT city, count(*) AS n_postings FROM positions WHERE city IS NOT NULL GROUP BY city
    ORDER BY n_postings DESC, city ASC LIMIT 10"""))
def x2b(spark, sf_dir):
    return reports.top_cities(fixture_db(spark, sf_dir, flags=False, tags=False), 10, drop_null=True)


@register("x3_company_in_city", sql("""
    SELECT company_name, city FROM positions
    WHERE city ILIKE 'CITY1_' AND company_name ILIKE '%supplier#%1%'"""))
def x3(spark, sf_dir):
    return reports.company_titles_in_city(fixture_db(spark, sf_dir, flags=False, tags=False),
                                          "CITY1_", "%supplier#%1%")


X_TERM = "licen"


@register("x4_postings_with_term", sql(f"""
    SELECT uniq_id, company_name, city, job_description FROM positions RIGHT JOIN postings USING (uniq_id)
    WHERE contains(lower(job_description), '{X_TERM}')"""))
def x4(spark, sf_dir):
    return reports.postings_with_term(fixture_db(spark, sf_dir, flags=False, tags=False), X_TERM)


@register("x5_top_companies_for_term", sql(f"""
    SELECT company_name, count(*) AS n_postings FROM positions RIGHT JOIN postings USING (uniq_id)
    WHERE contains(lower(job_description), '{X_TERM}')
    GROUP BY company_name ORDER BY n_postings DESC, company_name NULLS FIRST LIMIT 20"""))
def x5(spark, sf_dir):
    return reports.top_companies_for_term(fixture_db(spark, sf_dir, flags=False, tags=False), X_TERM)


@register("x6_first_descriptions", sql("""
    SELECT job_description FROM (SELECT * FROM postings ORDER BY uniq_id LIMIT 5) first_five"""))
def x6(spark, sf_dir):
    return reports.first_descriptions(fixture_db(spark, sf_dir, flags=False, geo=False, tags=False))

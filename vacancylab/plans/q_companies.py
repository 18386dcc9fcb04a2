"""Registered company-study queries (C1-C10) and their SQL twins.

Firm patterns are re-parametrised on the generated supplier names; order
matters (supplier 45 matches two patterns of two different firms).
"""

from __future__ import annotations

from ..operators import companies
from ..sources.fixtures import fixture_db
from .catalog import register
from .fixture_sql import ALL_BATCHES, CURRENT_BATCH
from .oracle import sql

B = CURRENT_BATCH
FIXTURE_FIRMS = [
    ("#00000001", "Alpha Group"),
    ("#00000002", "Beta Holding"),
    ("0000004", "Gamma Pharma"),
    ("#000000045", "Delta Pharma"),
    ("#00000005", "Epsilon"),
    ("#00000006", "Beta Holding"),
]
FIXTURE_EXCLUSIONS = ["SUPPLIER#000000013", "Supplier#000000052"]


def _values() -> str:
    rows = ", ".join(f"({i}, '{p}', '{f}')" for i, (p, f) in enumerate(FIXTURE_FIRMS))
    return f"SELECT * FROM (VALUES {rows}) AS t(pattern_order, firm_name_pattern, firm_name)"


def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


#: One row per counted posting of a matched employer; everything else groups it.
FACTS = f"""
    SELECT n.company_name, n.nuts_2, (SELECT count(*) FROM ai_tags a WHERE a.uniq_id = n.uniq_id) AS tags,
           coalesce((SELECT arg_min(firm_name, pattern_order) FROM ({_values()})
                     WHERE contains(n.company_name, firm_name_pattern)), n.company_name) AS firm
    FROM positions n SEMI JOIN employers ON employers.company_name = n.company_name
    SEMI JOIN (SELECT uniq_id FROM postings WHERE data_batch = '{B}' AND unique_posting_text = 'yes') kept
      ON kept.uniq_id = n.uniq_id
    WHERE len([w for w in {_listed(p for p, _ in FIXTURE_FIRMS)} if contains(lower(n.company_name), lower(w))]) > 0
      AND len([w for w in {_listed(FIXTURE_EXCLUSIONS)} if contains(lower(n.company_name), lower(w))]) = 0"""

C_CTES = [
    ("facts", FACTS),
    ("c2", "SELECT company_name, nuts_2, count(*) AS n_postings FROM facts GROUP BY ALL"),
    ("c3", "SELECT company_name, nuts_2, cast(sum(tags) AS bigint) AS n_ai_postings FROM facts WHERE tags > 0 GROUP BY ALL"),
    ("c8", """
    SELECT firm AS company_name, f.nuts_2, n_postings, n_ai_postings, nullif(n_ai_postings, 0) / n_postings AS ai_share,
           g.name_en, cast(NULL AS varchar) AS country
    FROM (SELECT firm, regexp_replace(nuts_2, '^(UK.).*', '\\1') AS nuts_2, nuts_2 AS whole, count(*) AS n_postings,
                 cast(sum(tags) AS bigint) AS n_ai_postings FROM facts GROUP BY ALL) f
    LEFT JOIN (SELECT name_en, coalesce(nuts_2, oecd_tl2) AS nuts_2 FROM regions WHERE oecd_level = 2) g
      ON f.nuts_2 IS NOT DISTINCT FROM g.nuts_2"""),
]


def _patterns(spark):
    return companies.patterns_from_list(spark, FIXTURE_FIRMS)


def _db(spark, sf_dir):
    return fixture_db(spark, sf_dir)


@register("c1_firm_patterns_dedup", sql("""
    SELECT pattern_order, firm_name_pattern, firm_name FROM (
      SELECT *, row_number() OVER (PARTITION BY firm_name_pattern ORDER BY pattern_order) AS rn
      FROM (SELECT pattern_order, firm_name_pattern, firm_name FROM fp
            UNION ALL SELECT pattern_order + 100, firm_name_pattern, 'Subsidiary' FROM fp) u) t
    WHERE rn = 1""", [("fp", f"""SELECT p.pattern_order, p.firm_name_pattern, p.firm_name FROM ({_values()}) p
                          WHERE EXISTS (SELECT 1 FROM employers e WHERE lower(e.company_name) LIKE
                                        '%' || lower(p.firm_name_pattern) || '%')""")]))
def c1(spark, sf_dir):
    from pyspark.sql import functions as F
    db = _db(spark, sf_dir)
    # patterns that occur in the stored employer names, with a subsidiary list
    # that repeats them (each repeated pattern keeps its first row)
    present = companies.patterns_present(_patterns(spark), db.employers)
    subs = present.select((F.col("pattern_order") + 100).alias("pattern_order"), "firm_name_pattern",
                          F.lit("Subsidiary").alias("firm_name"))
    return companies.firm_patterns(present.unionByName(subs))


@register("c2_company_region_postings", sql("SELECT * FROM c2", C_CTES))
def c2(spark, sf_dir):
    return companies.company_region_postings(_db(spark, sf_dir), _patterns(spark), FIXTURE_EXCLUSIONS, B)


@register("c3_company_region_ai_postings", sql("SELECT * FROM c3", C_CTES))
def c3(spark, sf_dir):
    return companies.company_region_ai_postings(_db(spark, sf_dir), _patterns(spark), FIXTURE_EXCLUSIONS, B)


@register("c4_matched_employer_count", sql("SELECT count(DISTINCT company_name) AS n_employers FROM c2", C_CTES))
def c4(spark, sf_dir):
    return companies.matched_employer_count(
        companies.company_region_postings(_db(spark, sf_dir), _patterns(spark), FIXTURE_EXCLUSIONS, B))


@register("c5_false_positive_review", sql("""
    SELECT company_name, cast(sum(n_postings) AS bigint) AS n_postings FROM c2 GROUP BY company_name
    HAVING sum(n_postings) >= 5""", C_CTES))
def c5(spark, sf_dir):
    total = companies.company_region_postings(_db(spark, sf_dir), _patterns(spark), FIXTURE_EXCLUSIONS, B)
    return companies.false_positive_review(total, 5)


@register("c6_c8_company_ai_shares", sql("SELECT * FROM c8", C_CTES))
def c8(spark, sf_dir):
    return companies.company_ai_shares(_db(spark, sf_dir), _patterns(spark), FIXTURE_EXCLUSIONS, B)


@register("j6_company_regions_of_batches", sql("""
    SELECT company_name, nuts_2, count(*) FILTER (b = 'src_2022_01') AS n_first, count(*) FILTER (b = 'src_2023_01') AS n_second
    FROM (SELECT n.company_name, n.nuts_2, p.data_batch AS b FROM positions n JOIN postings p USING (uniq_id)
          WHERE p.unique_posting_textlocation = 'yes')
    WHERE b IN ('src_2022_01', 'src_2023_01') GROUP BY company_name, nuts_2"""))
def j6(spark, sf_dir):
    return companies.company_regions_of_batches(_db(spark, sf_dir), *ALL_BATCHES)


@register("c9_top_companies_by_ai_share", sql("""
    SELECT company_name, n_ai_postings, n_postings, n_ai_postings / n_postings AS ai_share FROM (
      SELECT company_name, cast(sum(n_ai_postings) AS bigint) AS n_ai_postings,
             cast(sum(n_postings) AS bigint) AS n_postings FROM c8 GROUP BY company_name) s
    WHERE n_ai_postings / n_postings > 0 ORDER BY ai_share DESC, company_name LIMIT 20""", C_CTES))
def c9(spark, sf_dir):
    shares = companies.company_ai_shares(_db(spark, sf_dir), _patterns(spark), FIXTURE_EXCLUSIONS, B)
    return companies.top_companies_by_ai_share(shares, 20)


@register("c10_top_companies_min_postings", sql("""
    SELECT company_name, n_ai_postings, n_postings, n_ai_postings / n_postings AS ai_share FROM (
      SELECT company_name, cast(sum(n_ai_postings) AS bigint) AS n_ai_postings,
             cast(sum(n_postings) AS bigint) AS n_postings FROM c8 GROUP BY company_name) s
    WHERE n_ai_postings / n_postings > 0 AND n_postings > 10
    ORDER BY ai_share DESC, company_name LIMIT 20""", C_CTES))
def c10(spark, sf_dir):
    shares = companies.company_ai_shares(_db(spark, sf_dir), _patterns(spark), FIXTURE_EXCLUSIONS, B)
    return companies.top_companies_by_ai_share(shares, 20, min_postings=10)

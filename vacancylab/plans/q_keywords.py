"""Registered keyword/tagging queries (K3-K7) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keywords, term_index
from ..session import land_table
from ..sources.fixtures import fixture_db
from .catalog import ORACLES, register
from .fixture_sql import CURRENT_BATCH
from .oracle import sql

B = CURRENT_BATCH
LIKE = "lower(p.job_description) LIKE ('% ' || lower(d.keyword_en) || '%')"
COUNTRIES = ["europe", "asia"]


def _k3_sql(scope: str = "true") -> str:
    return sql(f"""
    SELECT keyword, count(uniq_id) AS n_postings
    FROM (SELECT DISTINCT keyword_en AS keyword FROM v_tech_dict WHERE {scope}) k
    LEFT JOIN postings ON contains(lower(job_description), ' ' || lower(keyword)) GROUP BY keyword""")


@register("k3_load_keywords", _k3_sql())
def k3(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    return keywords.keyword_hits(db.postings, keywords.load_keywords(db.tech_dict))


@register("k3_load_keywords_field", _k3_sql("bloom_field = 'Beta'"))
def k3_field(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    return keywords.keyword_hits(db.postings, keywords.load_keywords(db.tech_dict, tech_field_subset="Beta"))


@register("k4_keyword_query", sql(f"""
    SELECT p.uniq_id FROM postings p
    WHERE p.data_batch = '{B}'
      AND p.uniq_id IN (SELECT uniq_id FROM positions WHERE inferred_country IN ('europe', 'asia'))
      AND EXISTS (SELECT 1 FROM v_ai_dict d WHERE {LIKE})"""))
def k4(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return keywords.keyword_query(db.postings, db.ai_dict, data_batch=B, countries=COUNTRIES,
                                  positions=db.positions)


@register("k5_tag_ai_new_only", sql(f"""
    SELECT p.uniq_id FROM postings p
    WHERE p.data_batch = '{B}' AND EXISTS (SELECT 1 FROM v_ai_dict d WHERE {LIKE})
      AND p.uniq_id NOT IN (SELECT uniq_id FROM postings p WHERE lower(p.job_description) LIKE '% licen%')"""))
def k5(spark, sf_dir):
    db = fixture_db(spark, sf_dir, tags=False)
    existing = keywords.keyword_query(db.postings, ["licen"])
    return keywords.tag_ai(db.postings, db.ai_dict, data_batch=B, existing=existing)


@register("k5_tagging_report", sql(f"""
    SELECT count(p.uniq_id) AS n_searchable,
           count(CASE WHEN EXISTS (SELECT 1 FROM v_ai_dict d WHERE {LIKE}) THEN p.uniq_id END) AS n_hits
    FROM postings p WHERE p.data_batch = '{B}'"""))
def k5_report(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    return keywords.tagging_report(db.postings, db.ai_dict, data_batch=B)


@register("k6_tag_tech_new_only", sql(f"""
    SELECT DISTINCT p.uniq_id, d.bloom_field, d.bloom_code FROM postings p JOIN v_tech_dict d ON {LIKE}
    WHERE p.data_batch = '{B}'
      AND NOT EXISTS (SELECT 1 FROM tech_tags t WHERE t.uniq_id = p.uniq_id AND t.bloom_code = d.bloom_code
                      AND t.bloom_code = 1)"""))
def k6(spark, sf_dir):
    db = fixture_db(spark, sf_dir)
    existing = db.tech_tags.filter(F.col("bloom_code") == 1)
    return keywords.tag_tech(db.postings, db.tech_dict, data_batch=B, existing=existing)


@register("k6_tech_tags", sql("SELECT * FROM tech_tags"))
def k6_all(spark, sf_dir):
    return fixture_db(spark, sf_dir).tech_tags


@register("k5_ai_tags", sql("SELECT * FROM ai_tags"))
def k5_all(spark, sf_dir):
    return fixture_db(spark, sf_dir).ai_tags


#: The published list, with two words that the generated texts hold.
LISTED = [*keywords.AI_KEYWORDS_EN, "LICEN", "tionHa"]


@register("k5_published_ai_keywords", sql(f"""
    SELECT uniq_id FROM postings WHERE len([k for k in {LISTED} if contains(lower(job_description), ' ' || lower(k))]) > 0"""))
def k5_listed(spark, sf_dir):
    return keywords.tag_ai(fixture_db(spark, sf_dir, flags=False, geo=False, tags=False).postings, LISTED)


@register("k7_hits_per_field", sql("""
    SELECT f.bloom_field, f.bloom_code, coalesce(c.n, 0) AS n_postings
    FROM (SELECT DISTINCT bloom_field, bloom_code FROM v_tech_dict) f
    LEFT JOIN (SELECT bloom_field, bloom_code, count(uniq_id) AS n FROM tech_tags GROUP BY 1, 2) c
      ON c.bloom_field = f.bloom_field AND c.bloom_code = f.bloom_code"""))
def k7(spark, sf_dir):
    db = fixture_db(spark, sf_dir)
    return keywords.hits_per_field(db.tech_tags, db.tech_dict)


# ---- the same questions asked of a term index, which is landed before it is read
def _index(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, geo=False, tags=False)
    return db, land_table(term_index.sorted_index(term_index.term_rows(term_index.segmented(db.postings))), "terms")


@register("k3_keywords_from_index", _k3_sql())
def k3_index(spark, sf_dir):
    db, index = _index(spark, sf_dir)
    return term_index.indexed_counts(index, keywords.load_keywords(db.tech_dict))


@register("k5_published_ai_keywords_from_index", ORACLES["k5_published_ai_keywords"])
def k5_index(spark, sf_dir):
    return term_index.indexed_ids(_index(spark, sf_dir)[1], LISTED)


@register("k6_tech_tags_from_index", sql("SELECT * FROM tech_tags"))
def k6_index(spark, sf_dir):
    db, index = _index(spark, sf_dir)
    return term_index.indexed_tech_tags(index, db.tech_dict)

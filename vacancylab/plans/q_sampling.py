"""Registered sampling queries (R1-R5) and their SQL twins."""

from __future__ import annotations

from ..operators import evaluation, sampling
from ..sources.fixtures import fixture_db
from .catalog import register
from .oracle import sql

SEED = 472023
SHARE = 0.05
PER_COUNTRY = 20


def H(col: str) -> str:
    return f"md5(coalesce(cast({col} AS varchar), '') || '{SEED}')"


R1_CTE = ("r1", f"""
    SELECT uniq_id, company_name FROM (
      SELECT uniq_id, company_name, row_number() OVER (ORDER BY {H('uniq_id')}, uniq_id) AS rn
      FROM positions) t
    WHERE rn <= (SELECT floor(count(*) * {SHARE}) FROM positions)""")
R2_CTE = ("r2", f"""
    SELECT uniq_id, company_name FROM (
      SELECT uniq_id, company_name, row_number() OVER (PARTITION BY inferred_country
             ORDER BY {H('uniq_id')}, uniq_id) AS rn FROM positions) t WHERE rn <= {PER_COUNTRY}""")
R3_CTE = ("r3", """
    SELECT DISTINCT uniq_id FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2) u
    WHERE uniq_id IS NOT NULL AND company_name IS NOT NULL""")


@register("r1_overall_random_sample", sql("SELECT * FROM r1", [R1_CTE]))
def r1(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return sampling.overall_random_sample(db.positions, SHARE, SEED)


@register("r2_country_sample", sql("SELECT * FROM r2", [R2_CTE]))
def r2(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return sampling.country_sample(db.positions, PER_COUNTRY, SEED)


@register("r3_development_sample_ids", sql("SELECT * FROM r3", [R1_CTE, R2_CTE, R3_CTE]))
def r3(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    return sampling.development_sample_ids(db.positions, SHARE, PER_COUNTRY, SEED)


@register("r4_subset_employers", sql("""
    SELECT * FROM employers WHERE company_name IN (
      SELECT company_name FROM positions WHERE uniq_id IN (SELECT uniq_id FROM r3)
      AND company_name IS NOT NULL)""", [R1_CTE, R2_CTE, R3_CTE]))
def r4_emp(spark, sf_dir):
    db = fixture_db(spark, sf_dir, flags=False, tags=False)
    ids = sampling.development_sample_ids(db.positions, SHARE, PER_COUNTRY, SEED)
    return sampling.referential_subset(db, ids).employers


@register("r4_subset_tech_tags", sql("SELECT * FROM tech_tags WHERE uniq_id IN (SELECT uniq_id FROM r3)",
                                     [R1_CTE, R2_CTE, R3_CTE]))
def r4_tags(spark, sf_dir):
    db = fixture_db(spark, sf_dir)
    ids = sampling.development_sample_ids(db.positions, SHARE, PER_COUNTRY, SEED)
    return sampling.referential_subset(db, ids).tech_tags


PERIOD = ["1996-01", "1996-02", "1996-03", "1996-04", "1996-05", "1996-06",
          "1996-07", "1996-08", "1996-09", "1996-10", "1996-11", "1996-12"]
N_PERIOD = 60
PERIOD_LIST = ", ".join(f"'{m}'" for m in PERIOD)
PP_CTE = ("pp", f"""
    SELECT posn.company_name, chosen.uniq_id, chosen.job_description
    FROM (SELECT * FROM postings WHERE unique_posting_textlocation = 'yes'
          AND substr(crawl_timestamp, 1, 7) IN ({PERIOD_LIST})) chosen
    LEFT JOIN positions posn ON posn.uniq_id = chosen.uniq_id""")


@register("r5_period_posting_sample", sql(f"""
    SELECT * FROM pp ORDER BY {H('uniq_id')}, uniq_id LIMIT {N_PERIOD}""", [PP_CTE]))
def r5(spark, sf_dir):
    db = fixture_db(spark, sf_dir, tags=False)
    pp = evaluation.period_postings_with_company(db, PERIOD)
    return sampling.period_posting_sample(pp, N_PERIOD, SEED)

"""Benchmark: the batch jobs and the headline reports at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Stages timed separately:
  jobs     - dimensions (S5), region assignment (G1+G2), duplicate flags
             (D1+D2), AI tags (K5), technology tags (K6), in job order,
             each step writing its Parquet table (scratch folder) and the
             next reading it; plus the tagger with a 176-pattern dictionary;
  reports  - headline reports over the stored tables (no-op sink).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vacancylab.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="vacancylab-bench-")
    spark = get_spark("vacancylab-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                      extra_conf={"spark.driver.memory": "16g",
                                  "spark.local.dir": os.path.join(scratch, "local")})
    spark.sparkContext.setLogLevel("ERROR")

    from pyspark.sql import functions as F

    from vacancylab.operators import dedup, evaluation, keywords, near_dups, regions, reports, shares
    from vacancylab.plans.fixture_sql import CURRENT_BATCH
    from vacancylab.sources.fixtures import build_database, fixture_views

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)

    v = fixture_views(spark, sf_dir)
    # warm-up: JVM, codegen caches, file listing
    run(v["v_postings"].select("uniq_id"))
    n_postings = v["v_postings"].count()

    root = os.path.join(scratch, "db")
    db = build_database(spark, sf_dir, root, timer=timed)
    big = keywords.tag_tech(db.postings, spark.createDataFrame(
        [(f, c, k) for f, c, ks in _real_style_dictionary() for k in ks],
        "bloom_field string, bloom_code int, keyword_en string"), data_batch="all")
    timed("k6_tech_tagging_176_patterns", lambda: run(big))

    months = ["1996-03", "1998-07", "2000-01"]
    samples = ["full_sample", *months]
    emp = evaluation.employer_sample(db, 1000, 2, seed=472023)
    report_queries = {
        "a1_total_postings_by_region": lambda: reports.total_postings_by_region(db, 2, CURRENT_BATCH, True),
        "a2_ai_postings_by_region": lambda: reports.ai_postings_by_region(db, 2, CURRENT_BATCH, True),
        "a3_tech_postings_by_region_field": lambda: reports.tech_postings_by_region(db, True, 2, CURRENT_BATCH),
        "a6_ai_share_by_region": lambda: reports.ai_share_by_region(db, 2, CURRENT_BATCH, True),
        "a7_geo_dist_4_samples": lambda: shares.geo_dist(db, samples, 2),
        "a9_spatial_tech_4_samples": lambda: shares.spatial_tech(db, samples, "tech"),
        "a10_field_shares_4_samples": lambda: shares.field_shares(db, samples),
        "d6_unique_share_by_country": lambda: dedup.unique_share_by_country(db.postings, db.positions,
                                                                             CURRENT_BATCH),
        "e3_within_employer": lambda: evaluation.within_employer_duplicates(
            evaluation.employer_postings(db, emp)),
        "e7_between_employer": lambda: evaluation.between_employer_duplicates(
            evaluation.period_postings_with_company(db),
            evaluation.period_postings_with_company(db).select("company_name").distinct()),
        "e4_token_duplicates": lambda: near_dups.token_duplicates(evaluation.employer_postings(db, emp)),
        "x5_top_companies_for_term": lambda: reports.top_companies_for_term(db, "licen"),
    }
    for name, build in report_queries.items():
        timed(name, lambda b=build: run(b()))

    total = round(sum(timings.values()), 3)
    out = {
        "metric": "total_seconds_batch_jobs_and_reports",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "postings": n_postings,
        "postings_per_sec": {k: round(n_postings / t, 1) for k, t in timings.items()
                             if k in ("d1_d2_duplicate_flags", "k5_ai_tagging", "k6_tech_tagging",
                                      "a2_ai_postings_by_region") and t > 0},
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


def _real_style_dictionary():
    """29 fields x 6 patterns, the size of the stored technology dictionary,
    built from a rule (letter trigrams), to time the single-scan tagger."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = []
    for i in range(29):
        pats = [letters[(i + j) % 26] + letters[(i * 7 + j) % 26] + letters[(i * 3 + 2 * j) % 26]
                for j in range(6)]
        out.append((f"field{i}", i + 1, pats))
    return out


if __name__ == "__main__":
    main()

"""Firm patterns as data (C1, C6, P8) against a loop over names and patterns."""

from conftest import Tables
from vacancylab.operators import companies

NAMES = ["Roche AG", "roche", "Rochester Inc", "F. Hoffmann-La Roche", "Bayer", "BAYER AG", "Bayerische Werke", "ab", "a", "", "AbbVie",
         "Novo Nordisk Roche", "  ", "Société Générale", "SOCIÉTÉ", "x" * 5_000 + "roche", None, "roche", "aaaaaaaa"]
PATTERNS = [(3, "Roche", "Roche"), (1, "Novo Nordisk", "Novo"), (2, "roche", "lower"), (5, "b", "B"), (4, "Bayer", "Bayer"), (6, "", "any"),
            (7, "socié", "S"), (8, "aaaa", "A"), (9, "absent name", "none"), (10, "ab", "AB"), (3, "Roche", "Later"), (11, None, "null")]


def _tables(spark):
    names = spark.createDataFrame([(n,) for n in NAMES], "company_name string")
    return names, spark.createDataFrame(PATTERNS, "pattern_order int, firm_name_pattern string, firm_name string")


def _brute(fold):
    key = (lambda t: t.lower()) if fold else (lambda t: t)
    return {(n, *p) for n in NAMES if n is not None for p in PATTERNS if p[1] is not None and key(p[1]) in key(n)}


def test_matches_equal_brute_force(spark):
    names, patterns = _tables(spark)
    for fold in (True, False):
        rows = [tuple(r) for r in companies.matching_patterns(names, patterns, fold).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == _brute(fold)
    assert companies.matching_patterns(names.where("false"), patterns).count() == 0
    assert companies.matching_patterns(names, patterns.where("false")).count() == 0


def test_first_pattern_names_the_firm(spark):
    names, patterns = _tables(spark)
    got = {r[0]: r[1] for r in companies.canonical_firm_names(names, patterns).collect()}
    want = {}
    for name, order, pattern, firm in sorted(_brute(False), key=lambda m: (m[1], m[2], m[3])):
        want.setdefault(name, firm)
    assert got == want and got["Novo Nordisk Roche"] == "Novo" and got["Roche AG"] == "Later"


def test_many_patterns_stay_data(spark):
    names = spark.range(2_000).selectExpr("concat('Firm ', id * 50, ' Holding') AS company_name")
    patterns = spark.range(100_000).selectExpr("cast(id AS int) AS pattern_order", "concat('firm ', id, ' h') AS firm_name_pattern",
                                               "concat('F', id) AS firm_name")
    found = companies.matching_patterns(names, patterns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 60_000 and "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.count() == 2_000
    present = companies.patterns_present(patterns, names)
    assert "Holding" in present._jdf.queryExecution().optimizedPlan().toString()  # the employers are scanned by the plan
    assert present.count() == 2_000


def test_exclusions_and_company_counts(spark):
    employers = spark.createDataFrame([(n,) for n in ("Roche AG", "Rochester", "Other")], "company_name string")
    positions = spark.createDataFrame([("1", "Roche AG", "CH03"), ("2", "Rochester", "US1"), ("3", "Other", None), ("4", None, None)],
                                      "uniq_id string, company_name string, nuts_2 string")
    postings = spark.createDataFrame([(str(i), "b", "yes") for i in range(5)], "uniq_id string, data_batch string, unique_posting_text string")
    patterns = companies.patterns_from_list(spark, [("roche", "Roche")])
    db = Tables(employers=employers, positions=positions, postings=postings)
    counted = lambda words: {tuple(r) for r in companies.company_region_postings(db, patterns, words, "b").collect()}
    assert counted(["ROCHESTER"]) == {("Roche AG", "CH03", 1)}
    assert counted([]) == {("Roche AG", "CH03", 1), ("Rochester", "US1", 1)}

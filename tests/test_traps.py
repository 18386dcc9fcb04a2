"""One small hand-made fixture per semantic trap."""

from pyspark.sql import functions as F

from conftest import Tables
from vacancylab.functions import predicates as P
from vacancylab.operators import dedup, ingest, keywords, regions, reports, shares

POST = ("uniq_id string, crawl_timestamp string, job_description string, job_board string, "
        "text_language string, data_batch string, unique_posting_text string, unique_posting_textlocation string")
POS = ("uniq_id string, company_name string, city string, state string, inferred_state string, "
       "inferred_country string, remote_position string, nuts_2 string, nuts_3 string")


def ids(df, col="uniq_id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_q1_keyword_needs_leading_space(spark):
    texts = [("a", "Machine learning at start"), ("b", "line\nmachine learning"), ("c", "(machine learning)"),
             ("d", "x-machine learning"), ("e", "we do additive manufacturing"), ("f", "big  oled screen"),
             ("g", "big oled screen"), ("h", "a driverless truck here"), ("i", "a driverless trucks"),
             ("j", "we like MACHINE LEARNING"), ("k", None)]
    df = spark.createDataFrame(texts, "uniq_id string, job_description string")
    hit = keywords.keyword_query(df, ["machine learning", "additive manufactur", " oled", "driverless truck "])
    assert ids(hit) == ["e", "f", "h", "j"]


def test_q1_word_boundary_option(spark):
    df = spark.createDataFrame([("a", "Machine learning"), ("b", "(machine learning)"), ("c", "xmachine learning")],
                               "uniq_id string, job_description string")
    assert ids(keywords.keyword_query(df, ["machine learning"], boundary="word")) == ["a", "b"]


def test_q2_unicode_lower(spark):
    df = spark.createDataFrame([("a", "Wir suchen ÜBERSETZER"), ("b", "x übersetzer")],
                               "uniq_id string, job_description string")
    assert ids(keywords.keyword_query(df, ["übersetzer"])) == ["a", "b"]


def test_q3_wildcards_literal(spark):
    df = spark.createDataFrame([("a", "x 100% remote"), ("b", "x 100x remote"), ("c", "x a_b")],
                               "uniq_id string, job_description string")
    assert ids(keywords.keyword_query(df, ["100%", "a_b"])) == ["a", "c"]


def test_q4_location_level_uses_location_flag(spark):
    df = spark.createDataFrame([("a", "yes", "no"), ("b", "no", "yes")],
                               "uniq_id string, unique_posting_text string, unique_posting_textlocation string")
    assert ids(df.filter(P.unique_condition(True, "location"))) == ["b"]
    assert ids(df.filter(P.unique_condition(True, "overall"))) == ["a"]


def test_q5_country_filter_through_positions(spark):
    post = spark.createDataFrame([("a", "x tionha", "b1"), ("b", "x tionha", "b1"), ("c", "x tionha", "b2")],
                                 "uniq_id string, job_description string, data_batch string")
    pos = spark.createDataFrame([("a", "ch"), ("b", "de"), ("c", "ch")], "uniq_id string, inferred_country string")
    out = keywords.keyword_query(post, ["tionha"], data_batch="b1", countries=["ch"], positions=pos)
    assert ids(out) == ["a"]


def test_q6_orphans_null_safe(spark):
    emp = spark.createDataFrame([("x",), ("y",), ("z",)], "company_name string")
    pos = spark.createDataFrame([("1", "x"), ("2", None)], "uniq_id string, company_name string")
    assert ids(ingest.remove_orphan_employers(emp, pos), "company_name") == ["x"]


def _dup_fixture(spark):
    post = spark.createDataFrame([
        ("1", "t1", "b1"), ("2", "t1", "b1"), ("3", "t1", "b2"), ("4", None, "b1"), ("5", None, "b1"),
        ("6", "t2", "b1"), ("7", "t2", "b1"), ("8", "t3", "b1"), ("9", "t3", "b1")],
        "uniq_id string, job_description string, data_batch string")
    post = dedup.with_default_flags(post)
    pos = spark.createDataFrame([
        ("1", "zh", "ch"), ("2", "zh", "ch"), ("3", "zh", "ch"), ("4", None, "ch"), ("5", None, "ch"),
        ("6", "zh", "de"), ("7", "ge", "de"), ("8", None, None)],  # 9 has no position
        "uniq_id string, city string, inferred_country string")
    return post, pos


def test_q15_q16_q17_text_duplicates(spark):
    post, pos = _dup_fixture(spark)
    flagged = dedup.duplicate_ids(post, pos, "b1", ["job_description"])
    # within batch b1 only; NULL texts form a group; 9 has no position -> never flagged
    assert ids(flagged) == ["2", "5", "7"]
    assert ids(flagged) == ids(dedup.duplicate_ids_window(post, pos, "b1", ["job_description"]))
    loc = dedup.duplicate_ids(post, pos, "b1", ["city", "job_description"])
    assert ids(loc) == ["2", "5"]


def test_q7_geo_scope(spark):
    post, pos = _dup_fixture(spark)
    assert ids(dedup.duplicate_ids(post, pos, "b1", ["job_description"], restrict_to=["de"])) == ["7"]
    # NULL country is outside both scopes
    assert ids(dedup.duplicate_ids(post, pos, "b1", ["job_description"], exclude=["de"])) == ["2", "5"]


def test_dedup_idempotent_and_counts(spark):
    post, pos = _dup_fixture(spark)
    once = dedup.clean_duplicates(post, pos, "b1")
    twice = dedup.clean_duplicates(once, pos, "b1")
    assert sorted(once.collect()) == sorted(twice.collect())
    s = {(r.flag, r.value): r.n_postings for r in dedup.flag_summary(once).collect()}
    assert s[("unique_posting_text", "yes")] + s[("unique_posting_text", "no")] == post.count()


def test_q8_nan_city_null_safe(spark):
    pos = spark.createDataFrame([("1", None), ("2", "nan"), ("3", "basel"), ("4", "basel"), ("5", "bern")],
                                "uniq_id string, city string")
    out = {r.city: r.n_postings for r in reports.top_cities(Tables(positions=pos), 10).collect()}
    assert out == {None: 0, "basel": 2, "bern": 1}
    out2 = {r.city: r.n_postings for r in reports.top_cities(Tables(positions=pos), 10, drop_null=True).collect()}
    assert out2 == {"nan": 1, "basel": 2, "bern": 1}


def test_q9_remote_normalised(spark):
    df = spark.createDataFrame([("true",), ("1",), ("1.0",), ("0",), (None,), ("False",)], "v string")
    got = [r[0] for r in df.select(ingest.normalise_remote(F.col("v"))).collect()]
    assert got == ["1", "1", "1", "0", None, "0"]


def test_q10_duplicate_id_policies(spark):
    raw = spark.createDataFrame([("a", "f1", 1), ("a", "f1", 2), ("b", "f1", 3), ("b", "f2", 1), ("b", "f2", 2),
                                 ("c", "f2", 3)], "uniq_id string, file string, row_seq long")
    raw = ingest.with_file_order(raw, "file", "row_seq")
    d = ingest.duplicated_ids(raw)
    assert {r.duplicated_ids: r.n_occurrences for r in d.collect()} == {"a": 2, "b": 3}
    assert ids(ingest.duplicated_ids(raw, one_row_per_repeat=True), "duplicated_ids") == ["a", "b", "b"]
    assert ids(ingest.exclude_duplicated(raw, d, "drop_all")) == ["c"]
    kept = ingest.exclude_duplicated(raw, d, "keep_first").collect()
    assert sorted((r.uniq_id, r.file, r.row_seq) for r in kept) == [("a", "f1", 1), ("b", "f1", 3), ("c", "f2", 3)]


REG = ("name_en string, name_de string, name_fr string, nuts_level int, oecd_level int, nuts_2 string, "
       "nuts_3 string, oecd_tl2 string, oecd_tl3 string")


def test_q11_region_name_matching(spark):
    reg = spark.createDataFrame([
        ("zurich", "zürich", "zurich_fr", 2, 2, "CH04", None, "CH04", None),
        ("zurich", "zürich", "zurich_fr", 3, 3, "CH04", "CH040", "CH04", "CH040"),
        ("bern", "bern_de", "berne", 2, 2, None, None, "CH02", None),
        ("bern", "bern_de", "berne", 3, 3, "CH02", "CH021", "CH02", "CH021"),
        ("tokyo", "tokio", "tokyo_fr", None, 2, None, None, "JP13", None)], REG)
    pos = spark.createDataFrame([("1", None, "zürich"), ("2", "berne", "zurich"), ("3", "tokio", None),
                                 ("4", None, None)], "uniq_id string, state string, inferred_state string")
    out = {r.uniq_id: (r.nuts_2, r.nuts_3) for r in regions.match_regions(pos, reg).collect()}
    # state first (berne -> CH02/CH021), then inferred_state; each level independently
    assert out == {"1": ("CH04", "CH040"), "2": ("CH02", "CH021"), "3": (None, None), "4": (None, None)}
    lk = {(r.inferred_state, r.nuts_2, r.nuts_3) for r in regions.update_lookup(reg).collect()}
    # ambiguous names keep their complete rows; OECD-only name keeps OECD codes
    assert lk == {("zurich", "CH04", "CH040"), ("bern", "CH02", "CH021"), ("tokyo", "JP13", None)}


def test_q12_refined_rules_literal(spark):
    pos = spark.createDataFrame([
        ("1", "st. gallen", None, "x", None, None), ("2", None, "%gallen%", "x", None, None),
        ("3", None, "gallen", "x", None, None), ("4", "kanton basel", None, "x", None, None),
        ("5", "baselstadt", None, "x", None, None), ("6", "sg", None, "x", "CH01", "CH011"),
        ("7", None, None, "wil", None, "CH999")],
        "uniq_id string, state string, inferred_state string, city string, nuts_2 string, nuts_3 string")
    out = {r.uniq_id: (r.nuts_2, r.nuts_3) for r in regions.apply_region_rules(pos).collect()}
    assert out == {"1": ("CH05", "CH055"), "2": ("CH05", "CH055"), "3": (None, None),
                   "4": ("CH03", None), "5": ("CH03", "CH031"), "6": ("CH01", "CH011"),
                   "7": ("CH05", "CH055")}


def test_q13_region_dimension_deduplicated(spark):
    reg = spark.createDataFrame([("a", "a", "a", 2, 2, "R1", None, "R1", None),
                                 ("b", "b", "b", 2, 2, "R1", None, "R1", None)], REG)
    post = dedup.with_default_flags(spark.createDataFrame([("1", "2020-01-01"), ("2", "2020-02-01")],
                                                          "uniq_id string, crawl_timestamp string"))
    pos = spark.createDataFrame([("1", "R1"), ("2", None)], "uniq_id string, nuts_2 string")
    out = shares.geo_dist(Tables(postings=post, positions=pos, regions=reg)).collect()
    got = {r.region_code: (r.region, r.total_postings, r.postings_share) for r in out}
    assert got == {"R1": ("a", 1, 0.5), None: (None, 1, 0.5)}


def test_q14_time_window():
    from vacancylab.operators.evaluation import timewindow
    assert timewindow("2021-05", 1) == ["2021-04", "2021-05", "2021-06"]
    assert timewindow("2021-01", 2) == ["2020-12", "2020-11", "2021-01", "2021-02", "2021-03"]
    assert timewindow("2021-05", 0) == ["2021-05"]


def test_share_invariants(spark):
    post = dedup.with_default_flags(spark.createDataFrame(
        [(str(i), f"2020-0{1 + i % 3}-01") for i in range(30)], "uniq_id string, crawl_timestamp string"))
    pos = spark.createDataFrame([(str(i), f"R{i % 4}" if i % 5 else None) for i in range(30)],
                                "uniq_id string, nuts_2 string")
    reg = spark.createDataFrame([(f"r{i}", "x", "y", 2, 2, f"R{i}", None, f"R{i}", None) for i in range(4)], REG)
    db = Tables(postings=post, positions=pos, regions=reg)
    for sample, total in (shares.geo_dist(db, ["full_sample", "2020-01"]).groupBy("sample")
                          .agg(F.sum("postings_share")).collect()):
        assert abs(total - 1.0) < 1e-12
    m = shares.month_distribution(db).collect()
    assert abs(sum(r.share for r in m) - 1.0) < 1e-12


def test_automaton_equals_jvm_matching(spark):
    import bench
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("uniq_id"), F.col("text").alias("job_description"))
    rows = [(f, c, k) for f, c, ks in bench._real_style_dictionary() for k in ks] + [("x", 99, "the")]
    d = spark.createDataFrame(rows, "bloom_field string, bloom_code int, keyword_en string")
    a = sorted(keywords.tag_tech(docs, d, engine="automaton").collect())
    j = sorted(keywords.tag_tech(docs, d, engine="jvm").collect())
    assert a == j and len(a) > 0
    kws = [k for _, _, k in rows]
    ka = ids(docs.filter(P.keyword_condition(F.col("job_description"), kws, engine="automaton")))
    kj = ids(docs.filter(P.keyword_condition(F.col("job_description"), kws, engine="jvm")))
    assert ka == kj and len(ka) > 0


def test_k1_k2_dictionaries(spark):
    fields = spark.createDataFrame([("Oled display", 17), ("Cloud computing", 4)], "bloom_field string, bloom_code int")
    kws = spark.createDataFrame([(17, "OLED screen"), (4, "Software as a service")],
                                "bloom_code int, keyword_en string")
    d = {r.bloom_code: r.keyword_en for r in keywords.build_tech_dictionary(fields, kws).collect()}
    assert d == {17: " oled", 4: "software as a service"}
    line = spark.createDataFrame([("Machine Learning, Deep Learning, Chatbot",)], "value string")
    assert [r[0] for r in keywords.build_ai_dictionary(line).collect()] == \
        ["machine learning", "deep learning", "chatbot"]
    assert len(keywords.AI_KEYWORDS_EN) == 35 and len(keywords.TECH_FIELDS) == 29


def test_catalog_helpers(spark, tmpdir_path):
    import os
    from vacancylab.sources import catalog
    spark.range(3).write.parquet(os.path.join(tmpdir_path, "postings"))
    assert catalog.list_tables(spark, tmpdir_path) == ["postings"]
    assert catalog.register_views(spark, tmpdir_path) == ["postings"]
    assert spark.sql("SELECT count(*) FROM postings").first()[0] == 3
    assert catalog.table_keys("tech_tags") == ["uniq_id", "bloom_code"]


def test_name_patterns_fold_case_and_null_rules(spark, tmpdir_path):
    import zipfile

    from pyspark.sql import functions as F

    from vacancylab.functions.predicates import name_pattern_condition
    from vacancylab.operators.companies import firm_patterns
    from vacancylab.operators.evaluation import timewindow
    from vacancylab.sources.raw import read_raw_csv, read_raw_zip
    names = spark.createDataFrame([("ROCHE AG",), ("Rochester",), (None,)], "company_name string")
    assert [r[0] for r in names.where(name_pattern_condition("company_name", ["roche"], ["rochesteR"])).collect()] == [
        "ROCHE AG"]
    table = lambda *rows: spark.createDataFrame(rows, "pattern_order int, firm_name_pattern string, firm_name string")
    both = firm_patterns(table((0, "a", "A"), (1, "b", "B")), table((0, "c", "C"), (1, "a", "Z"))).collect()
    assert sorted((r[0], r[2]) for r in both) == [(0, "A"), (1, "B"), (2, "C")]
    assert timewindow("2020-01", 2) == ["2019-12", "2019-11", "2020-01", "2020-02", "2020-03"]
    raw = "uniq_id,job_title,city\n1,NA,\n2,null,None\n"
    with open(f"{tmpdir_path}/r.csv", "w") as f:
        f.write(raw)
    with zipfile.ZipFile(f"{tmpdir_path}/r.zip", "w") as z:
        z.writestr("r.csv", raw)
    found = [sorted(tuple(r) for r in df.select("uniq_id", "job_title", F.coalesce("city", F.lit("-"))).collect())
             for df in (read_raw_csv(spark, f"{tmpdir_path}/r.csv"), read_raw_zip(spark, tmpdir_path))]
    assert found[0] == found[1] == [("1", "NA", "-"), ("2", "null", "None")]


def test_tech_dictionary_languages_and_replacements(spark):
    fields = spark.createDataFrame([("Cloud computing", 3), ("Online streaming", 18), ("Oled display", 17)],
                                   "bloom_field string, bloom_code int")
    kws = spark.createDataFrame([(3, "PaaS", "PaaS", "Pas"), (3, "SaaS", "SaaS", "saa"), (18, "Stream\u00a0live", "Direct", "pas"),
                                 (17, "OLED screen", "ecran oled", None)],
                                "bloom_code int, keyword_en string, keyword_fr string, keyword_it string")
    rows = {tuple(r)[1:] for r in keywords.build_tech_dictionary(fields, kws).collect()}
    assert rows == {(3, "paas", "paas", "paas"), (3, "saas", "saas", "saas"),
                    (18, "stream live", "transmission en direct", "pas"), (17, " oled", " oled", " oled")}


def test_keyword_hits_counts_postings(spark):
    posts = spark.createDataFrame([("a", "x Deep learning"), ("b", None), ("c", "deep learning"), ("d", "a deep learning deep learning")],
                                  "uniq_id string, job_description string")
    words = spark.createDataFrame([("deep learning",), ("keras",)], "keyword string")
    assert {tuple(r) for r in keywords.keyword_hits(posts, words).collect()} == {("deep learning", 2), ("keras", 0)}
    assert keywords.keyword_hits(posts, words.limit(0)).count() == 0

"""Near-duplicate detection (E4-E6) against a brute-force sequential pass."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vacancylab.operators import near_dups


def brute_force(rows, skip_last_pair=True):
    """The sequential semantics, over (company, uniq_id, text, windows) rows."""
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = set()
    for company, group in by.items():
        group.sort(key=lambda r: r[1])
        if len(group) <= 1:
            continue
        flagged = []
        for i, p in enumerate(group):
            if p[1] in flagged:
                continue
            remaining = [q for q in group[i + 1:] if q[1] not in flagged]
            if skip_last_pair and len(remaining) <= 1:
                continue
            for q in remaining:
                if all(w in q[2] for w in p[3]):
                    flagged.append(q[1])
        out |= {(company, u) for u in flagged}
    return out


def run_both(spark, df):
    got = {(r.company_name, r.uniq_id) for r in near_dups.token_duplicates(df).collect()}
    docs = near_dups.distinct_employer_texts(df)
    win = docs.select("company_name", "uniq_id", "job_description",
                      near_dups.token_windows(F.col("job_description"), F.col("uniq_id"), 10, 3, 5, 42)
                      .alias("w")).collect()
    want = brute_force([(r.company_name, r.uniq_id, r.job_description, list(r.w)) for r in win])
    return got, want


def _words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_token_fixture(spark):
    rng = random.Random(7)
    base = _words(rng, 200)
    txt = " ".join(base)
    changed_far = base.copy()
    changed_far[0] = "CHANGED"          # outside most windows
    chain_a = _words(rng, 180)
    rows = [
        ("emp1", "id01", txt),
        ("emp1", "id02", " ".join(changed_far)),
        ("emp1", "id03", txt + " extra tail words here"),
        ("emp1", "id04", " ".join(_words(rng, 30))),          # short text: character slices
        ("emp1", "id05", " ".join(_words(rng, 220))),
        ("emp2", "id06", " ".join(chain_a)),                    # three-chain
        ("emp2", "id07", " ".join(chain_a) + " more"),
        ("emp2", "id08", "lead " + " ".join(chain_a) + " more"),
        ("emp3", "id09", txt),                                   # employer with exactly two texts
        ("emp3", "id10", txt + " x"),
        ("emp4", "id11", txt),                                   # exact copies collapse first
        ("emp4", "id12", txt),
        ("emp4", "id13", "tiny"),
        ("emp4", "id14", "tiny text"),
        ("emp4", "id15", "a tiny text indeed"),
        (None, "id16", txt),
        ("emp5", "id17", None),
    ]
    df = spark.createDataFrame(rows, "company_name string, uniq_id string, job_description string")
    got, want = run_both(spark, df)
    assert got == want
    assert ("emp1", "id03") in got
    assert not any(c == "emp3" for c, _ in got)  # last pair is skipped (parity)


def test_random_near_copies(spark):
    rng = random.Random(11)
    rows = []
    for e in range(6):
        seeds = [_words(rng, rng.choice([40, 160, 400])) for _ in range(5)]
        for j in range(25):
            t = list(rng.choice(seeds))
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = f"m{rng.randrange(99)}"
            if rng.random() < 0.3:
                t = t + _words(rng, 5)
            rows.append((f"e{e}", f"u{e:02d}{j:03d}", " ".join(t)))
    df = spark.createDataFrame(rows, "company_name string, uniq_id string, job_description string")
    got, want = run_both(spark, df)
    assert got == want
    assert len(got) > 10


def test_generated_documents_grouped_by_board(spark):
    """Whole sf0.001 documents, grouped by source so groups hold near copies."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    df = docs.select(F.col("source").alias("company_name"), F.md5(F.col("doc_id").cast("string")).alias("uniq_id"),
                     F.col("text").alias("job_description"))
    got, want = run_both(spark, df)
    assert got == want


def test_windows_shape(spark):
    words = " ".join(f"t{i}" for i in range(300))
    df = spark.createDataFrame([("a", words), ("b", "one two three four five six")], "uniq_id string, t string")
    r = {x.uniq_id: x.w for x in df.select("uniq_id", near_dups.token_windows(
        F.col("t"), F.col("uniq_id"), 10, 3, 5, 42).alias("w")).collect()}
    starts = sorted(int(w.split(" ")[0][1:]) for w in r["a"])
    assert all(len(w.split(" ")) == 10 for w in r["a"])
    assert all(b - a > 10 for a, b in zip(starts, starts[1:]))
    # 6 tokens -> cut = round(2) = 2 characters
    assert r["b"] == ["on", "e ", "two three four five six"]


def test_rounds_equal_sequential_pass(spark):
    rng = random.Random(23)
    rows = []
    for n in (2, 3, 40):
        for c in "ab":
            words = _words(rng, 300)
            rows += [(f"p{n}{c}", f"p{n}{c}{i:04d}", " ".join([*words[:-1], f"end{i}"])) for i in range(n)]
    for e in range(4):
        seeds = [_words(rng, rng.choice([160, 300])) for _ in range(3)]
        for j in range(20):
            t = list(rng.choice(seeds))
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = f"m{rng.randrange(50)}"
            rows.append((f"e{e}", f"r{e}{j:03d}", " ".join(t)))
    df = spark.createDataFrame(rows, "company_name string, uniq_id string, job_description string")
    docs = near_dups.distinct_employer_texts(df)
    win = docs.select("company_name", "uniq_id", "job_description",
                      near_dups.token_windows(F.col("job_description"), F.col("uniq_id"), 10, 3, 5, 42)
                      .alias("w")).collect()
    texts = [(r.company_name, r.uniq_id, r.job_description, list(r.w)) for r in win]
    for skip in (False, True):
        found = {(r.company_name, r.uniq_id) for r in near_dups.token_duplicates(df, skip_last_pair=skip).collect()}
        assert found == brute_force(texts, skip_last_pair=skip) and len(found) > 5


def test_a_group_of_near_copies_makes_one_edge_per_posting(spark):
    rng = random.Random(5)
    words = _words(rng, 300)
    for n in (60, 1000):
        df = spark.createDataFrame([("c", f"id{i:05d}", " ".join([*words, f"end{i}"])) for i in range(n)],
                                   "company_name string, uniq_id string, job_description string")
        docs = near_dups.distinct_employer_texts(df).persist()
        windows = docs.select("company_name", "uniq_id", near_dups.token_windows(
            F.col("job_description"), F.col("uniq_id"), 10, 3, 5, 42).alias("windows"))
        state, edges = near_dups.greedy_rounds(docs, windows, *near_dups.probe_tables(docs, windows))
        assert edges.count() == n - 1
        assert state.where("st = 2").count() == n - 1


def test_texts_that_share_a_key_without_containing_each_other(spark):
    rng = random.Random(6)
    shared = " ".join(_words(rng, 60))
    rows = [("c", f"id{i:03d}", f"{shared} " + " ".join(_words(rng, 8))) for i in range(40)]
    rows += [("c", f"tiny{i:03d}", f"k{i} m{i % 3}") for i in range(20)]
    df = spark.createDataFrame(rows, "company_name string, uniq_id string, job_description string")
    got, want = run_both(spark, df)
    assert got == want


def test_overlapping_windows_are_refused():
    with pytest.raises(ValueError):
        near_dups.token_windows(F.col("t"), F.col("uniq_id"), 10, 3, 1)


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_winnowed_places_are_the_minima_of_runs():
    import numpy as np
    rng = np.random.default_rng(2)
    for n in (0, 3, 5, 6, 40):
        h = rng.integers(0, 9, n)
        want = {i + j for i in range(n - near_dups.WINNOW + 1) for j in range(near_dups.WINNOW)
                if h[i + j] == h[i:i + near_dups.WINNOW].min()}
        assert set(near_dups._winnow(h).tolist()) == want


def test_a_common_introduction_makes_no_pairs(spark):
    """Unrelated texts that begin alike (an employer's boilerplate) hardly meet, and not at all on text."""
    rng = random.Random(9)
    intro = _prose(rng, 40)
    rows = [("emp", f"{i:04d}", f"{intro} {_prose(rng, 60)}") for i in range(1000)]
    rows += [("emp", f"x{i}", f"{rows[i][2][:-3]}new") for i in range(3)]
    df = spark.createDataFrame(rows, "company_name string, uniq_id string, job_description string")
    docs = near_dups.distinct_employer_texts(df)
    windows = docs.select("company_name", "uniq_id", near_dups.token_windows(
        F.col("job_description"), F.col("uniq_id"), 10, 3, 5, 42).alias("windows"))
    probes, index, marks = near_dups.probe_tables(docs, windows)
    assert probes.join(index, ["company_name", "key"]).where("dst > src").count() < 10_000
    assert near_dups.candidate_pairs(probes, index, marks).count() <= 10
    assert near_dups.token_duplicates(df).count() == len(_walked(df))


def test_checks_keep_their_distance(spark):
    """The same sentences in another order hold all fingerprints of the sentences, but are no copy."""
    rng = random.Random(10)
    a, b, c = (_prose(rng, 30) for _ in range(3))
    rows = [("e", "1", f"{a} {b} {c}"), ("e", "2", f"{c} {b} {a}"), ("e", "3", f"{a} {b} {c} and more"), ("e", "4", f"{b} {a} {c}")]
    df = spark.createDataFrame(rows, "company_name string, uniq_id string, job_description string")
    found = {r.uniq_id for r in near_dups.token_duplicates(df).collect()}
    assert found == _walked(df) == {"3"}


def _walked(df):
    """Flagged ids by the pass over the postings in id order."""
    docs = near_dups.distinct_employer_texts(df)
    rows = {r.uniq_id: (r.job_description, r.w) for r in docs.select("uniq_id", "job_description", near_dups.token_windows(
        F.col("job_description"), F.col("uniq_id"), 10, 3, 5, 42).alias("w")).collect()}
    ids, flagged = sorted(rows), set()
    for i, p in enumerate(ids):
        if p in flagged:
            continue
        left = [q for q in ids[i + 1:] if q not in flagged]
        if len(left) <= 1:
            break
        flagged |= {q for q in left if all(w in rows[q][0] for w in rows[p][1])}
    return flagged

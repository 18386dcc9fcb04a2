"""E4 for texts under 20 tokens: grams of the longest window instead of single tokens."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vacancylab.operators import near_dups

SCHEMA = "company_name string, uniq_id string, job_description string"


def _windows(docs):
    return docs.select("company_name", "uniq_id", near_dups.token_windows(
        F.col("job_description"), F.col("uniq_id"), 10, 3, 5, 42).alias("windows"))


def test_short_texts_that_share_common_words_do_not_meet(spark):
    docs = spark.createDataFrame([("a", f"{i:03d}", f"Alpha{i:03d} and the beta{i:03d}") for i in range(60)]
                                 + [("a", "900", "so Alpha007 and the beta007 it is")], SCHEMA)
    probes, index, marks = near_dups.probe_tables(docs, _windows(docs))
    pairs = {(r["src"], r["dst"]) for r in near_dups.candidate_pairs(probes, index, marks).collect()}
    assert pairs == {("007", "900")}     # and none of the other pairs that share "and the"


def test_every_text_that_holds_a_short_text_is_flagged(spark):
    short = ["", "é", "a b", "ö 😀 x", "one two three", "tail end of a line that goes on", "x" * 40 + " " + "y" * 50]
    rows = []
    for n, text in enumerate(short):
        rows += [(f"e{n}", "0", text), (f"e{n}", "1", f"before {text} after"), (f"e{n}", "2", text + "!"),
                 (f"e{n}", "3", "nothing of it 123")]
    found = {(r[0], r[1]) for r in near_dups.token_duplicates(
        spark.createDataFrame(rows, SCHEMA), skip_last_pair=False).collect()}
    # brute force over the windows themselves
    docs = spark.createDataFrame(rows, SCHEMA)
    windows = {(r[0], r[1]): r[2] for r in _windows(docs).collect()}
    wanted = set()
    for employer in {r[0] for r in rows}:
        texts = sorted((i, t) for e, i, t in rows if e == employer)
        for i, _ in texts:
            if (employer, i) not in wanted:
                wanted |= {(employer, j) for j, t in texts if j > i and all(w in t for w in windows[employer, i])}
    assert found == wanted and len(wanted) >= 2 * len(short)


@pytest.mark.parametrize("n", [1, 2, 8, 16])
def test_gram_hashes_depend_on_the_characters_alone(n):
    text = "sat the cat é😀 sat the cat upon a mat, the other cat"
    by_gram: dict[str, set[int]] = {}
    for i, h in enumerate(near_dups._gram_hashes(text, [n])[n].tolist()):
        by_gram.setdefault(text[i:i + n], set()).add(h)
    assert all(len(h) == 1 for h in by_gram.values())
    assert len(set.union(*by_gram.values())) == len(by_gram)


def test_the_bit_map_of_grams_grows_with_the_keys(spark):
    """Of the grams that are no key few pass, however many keys there are; all keys pass."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefghijklmnop") for _ in range(4000)) for _ in range(3)]
    kept = [int(h) for h in near_dups._gram_hashes(texts[0], [8])[8][::100]]
    keys = spark.range(300_000).select(F.xxhash64("id").alias("key"), F.lit(8).alias("n")).unionByName(
        spark.createDataFrame([(h, 8) for h in kept], "key long, n int"))
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.explode(near_dups.gram_finder(keys)(F.col("t"))).alias("key"))
    got = {r["key"] for r in found.collect()}
    assert set(kept) <= got and len(got) < len(set(kept)) + 0.03 * 3 * 4000


def test_hashes_of_token_runs_depend_on_the_tokens_alone():
    import numpy as np
    text = "a  b c é😀 d a  b c é😀 x  "
    tokens = text.split(" ")
    by_run: dict[tuple, set[int]] = {}
    hashes = near_dups._kgram_hashes(text)
    assert len(hashes) == len(tokens) - near_dups.K_GRAM + 1
    for i, h in enumerate(hashes.tolist()):
        by_run.setdefault(tuple(tokens[i:i + near_dups.K_GRAM]), set()).add(h)
    assert all(len(h) == 1 for h in by_run.values()) and len(set.union(*by_run.values())) == len(by_run)
    assert [len(near_dups._kgram_hashes(t)) for t in ("", " ", "a b c", "a b c d")] == [0, 0, 0, 1]
    assert np.array_equal(near_dups._kgram_hashes("a b c d"), near_dups._kgram_hashes("x a b c d")[1:])

"""False-discovery control of the secret scan against the raw list, its rate on made tokens, and long texts."""

import math
import random
import re
import string
import time

from vacancylab.llm import secrets_battery as sb


def _benjamini_hochberg(ps, fdr):
    """Positions that Benjamini-Hochberg reports."""
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    last = max((k for k, i in enumerate(order, 1) if ps[i] <= fdr * k / len(ps)), default=0)
    return set(order[:last])


def _binned(p):
    """The p-value as the histogram keeps it, rounded up to its bin."""
    return 10 ** (-int(min(-math.log10(max(p, 1e-300)), sb.MAX_LOG) * sb.BINS) / sb.BINS)


def _tokens(rng, kind, n):
    letters = string.ascii_letters + string.digits
    if kind == "key":
        return ["".join(rng.choice(letters) for _ in range(rng.randint(20, 60))) for _ in range(n)]
    if kind == "word":
        return ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(16, 40))) for _ in range(n)]
    # structured: counters, repeats and paths
    return [rng.choice([f"item{rng.randrange(99)}_" * rng.randint(3, 6), "aB3" * rng.randint(6, 12),
                        "/usr/share/lib/python/site-packages"[: rng.randint(18, 35)],
                        "abcdefghijklmnopqrstuvwxyzABCDEF0123"[: rng.randint(20, 36)]]) for _ in range(n)]


def _reported(documents, tokens):
    df = documents([(i, f"see {t} there", "en", "a") for i, t in enumerate(tokens)])
    return {r.doc_id for r in sb.secret_spans(df).collect() if r.n_random}


def test_reports_what_the_raw_list_reports(documents):
    rng = random.Random(1)
    tokens = _tokens(rng, "key", 150) + _tokens(rng, "word", 400) + _tokens(rng, "structured", 400)
    classes = {}
    for i, t in enumerate(tokens):
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}", t):
            found = None if sb.HEX.search(t) else sb.battery(m.group())
            if found is not None:
                p = min(1.0, found[1] / found[0]) if found[0] >= sb.MIN_RANDOMNESS else 1.0
                classes.setdefault(max(x for x in sb.LENGTH_CLASSES if x <= len(m.group())), []).append((i, _binned(p)))
    want = set()
    for items in classes.values():
        want |= {items[k][0] for k in _benjamini_hochberg([p for _, p in items], sb.FDR)}
    assert _reported(documents, tokens) == want


def test_rates(documents):
    rng = random.Random(2)
    keys = _tokens(rng, "key", 500)
    assert len(_reported(documents, keys)) >= 450
    others = _tokens(rng, "word", 1500) + _tokens(rng, "structured", 1500)
    assert len(_reported(documents, others)) <= 1
    found = _reported(documents, keys + others)
    assert sum(i >= len(keys) for i in found) <= 0.01 * len(found) + 1 and len(found) >= 450


def test_tokens_that_fail_the_battery_lend_no_support(spark):
    """Many refused tokens with small p-values must not lower the limit for accepted ones."""
    rows = [(16, 0, False)] * 500 + [(16, 48, True)] * 4 + [(16, 0, True)] * 496
    tested = spark.createDataFrame(rows, "length_class int, bin int, random boolean")
    assert sb.thresholds(tested) == {}


def test_many_spans_in_one_text():
    text = " ".join("%016x" % (i * 7919 + 10**15) for i in range(20_000))
    base = sb.base_spans(text)
    assert len(base) >= 19_000
    began = time.perf_counter()
    outside = [(s, e) for s, e, *_ in sb.tested_spans(text, base)]
    assert time.perf_counter() - began < 2.0
    assert not [x for x in outside if any(s <= x[0] and x[1] <= e for s, _, e in base[:50])]

"""Whitening against a dense eigendecomposition with numpy, and on odd rows."""

import math

import numpy as np
import pytest

from vacancylab.llm import lanczos_whitening

SF = "/root/testdata/sf0.001"


def _check(df, d_expected=None):
    rows = [r for r in df.select("vec_id", "embedding").collect() if r.embedding
            and all(c is not None and math.isfinite(c) for c in r.embedding)]
    if d_expected:
        rows = [r for r in rows if len(r.embedding) == d_expected]
    xs = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in r.embedding) for r in rows]
    fit = sorted(set(xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    k = min(16, int((values > values[0] * 1e-12).sum()))
    found = lanczos_whitening.whiten(df).collect()
    assert len(found) == len(rows) * k
    by = {}
    for r in found:
        assert r.n == n and r.identity_error <= 1e-4
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9 * r.explained + 1e-13
        by.setdefault(r.component, []).append((r.vec_id, r.deviation, r.whitened))
    for j, got in by.items():
        deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in xs]
        assert sorted((r.vec_id, v) for r, v in zip(rows, deviation)) == sorted((i, v) for i, v, _ in got)
        e = values[j - 1]
        alone = all(abs(e - o) > 1e-6 * values[0] for i, o in enumerate(values) if i != j - 1)
        if alone:
            wants = [float(np.array([c - s / n for c, s in zip(x, sums)]) @ vectors[:, j - 1] / math.sqrt(e)) for x in xs]
            a = np.array(sorted((i, w) for i, _, w in got))
            for sign in (1, -1):
                b = np.array(sorted((r.vec_id, sign * w) for r, w in zip(rows, wants)))
                if np.allclose(a, b, atol=1e-6):
                    break
            else:
                raise AssertionError(f"component {j} differs")
    return found


@pytest.fixture
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, e, "x", 3) for i, e in rows], "vec_id long, embedding array<double>, x string, n int")
    return build


def test_table(spark):
    found = _check(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert max(r.identity_error for r in found) < 1e-9


def test_repeated_singular_values_and_low_rank(spark, vectors):
    # the corners of a box and their opposites: equal deviations along groups of axes
    rows = []
    for axis, size in enumerate([5, 5, 5, 3, 3, 1, 1, 1]):
        for sign in (1, -1):
            rows.append([float(sign * size * (a == axis)) for a in range(8)] + [0.5, 0.25])
    found = _check(vectors(list(enumerate(rows))))
    assert {r.component for r in found} == set(range(1, 9))


def test_few_steps_are_not_enough_without_a_fresh_start(spark, vectors):
    rng = np.random.default_rng(3)
    wide = rng.standard_normal((400, 40)) * np.r_[[30.0] * 6, [9.0] * 14, np.full(20, 0.4)]
    _check(vectors([(i, r.tolist()) for i, r in enumerate(wide)]))


def test_odd_rows(spark, vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [3.0, -1.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [1.0, inf]), (8, [0.0, 0.015]), (9, [1.0, 2.0, 3.0]), (None, [4.0, 4.0])]
    found = lanczos_whitening.whiten(vectors(rows)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == sorted((i, c) for i in (0, 1, 2, 2, 8) for c in (1, 2))
    assert {r.n for r in found} == {4}
    for none in ([], [(1, [1.0]), (2, [1.0])], [(1, None)]):
        assert lanczos_whitening.whiten(vectors(none)).count() == 0
    huge = lanczos_whitening.whiten(vectors([(1, [1e300, 0.0]), (2, [0.0, 0.0])])).collect()
    assert {r.deviation for r in huge} == {None} and {r.component for r in huge} == {1}

"""Merkle manifest against a walk over all nodes in Python, and on odd rows."""

import hashlib
import random
import zlib

import pytest

from vacancylab.llm import merkle_manifest

from .conftest import ODD


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _above(nodes):
    return [_h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]


def _path(nodes, at, folded):
    """Siblings on the way up, the digest above, and the folded one."""
    proof = ""
    while len(nodes) > 1:
        first = at // 16 * 16
        run = nodes[first:first + 16]
        i = at - first
        proof += "".join(run[:i] + run[i + 1:])
        folded = _h(*run[:i], folded, *run[i + 1:])
        nodes, at = _above(nodes), at // 16
    return proof, nodes[0], folded


def _brute(rows):
    trees = {}
    for row in rows:
        tampered = row.text
        if row.doc_id is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0:
            tampered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row.text)
        trees.setdefault(row.source, []).append((row.doc_id, _leaf(row, row.text), _leaf(row, tampered)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots = []
    for s in order:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subroots.append(_path([x[1] for x in trees[s]], 0, "")[1])
    found = []
    for k, s in enumerate(order):
        leaves = [x[1] for x in trees[s]]
        for i, (doc_id, leaf, tampered) in enumerate(trees[s]):
            low, subroot, folded = _path(leaves, i, tampered)
            high, root, folded = _path(subroots, k, folded)
            found.append((doc_id, leaf, subroot, root, _h(low, high), folded, folded == root))
    return found


def _check(df):
    rows = df.select("doc_id", "text", "lang", "source", "n_chars").collect()
    found = [tuple(r) for r in merkle_manifest.prove(df).select(*merkle_manifest.RESULT).collect()]
    assert sorted(found, key=repr) == sorted(_brute(rows), key=repr)
    return found


@pytest.mark.parametrize("sources", [1, 3, 40])
def test_against_a_walk(spark, documents, sources):
    rng = random.Random(sources)
    rows = [(rng.randrange(900), rng.choice(["Ab c", "abc", "É A", None, ""]), rng.choice(["en", None]),
             rng.choice([None, *(f"s{i}" for i in range(sources - 1))])) for _ in range(700)]
    rows += [(i, f"Hot Text {i}", "en", "hot") for i in range(400 if sources == 3 else 0)]
    found = _check(documents(rows))
    assert len({r[3] for r in found}) == 1 and any(not r[6] for r in found) and any(r[6] for r in found)


def test_node_rows_in_copies(spark, documents, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "RUNS_A_COPY", 2)
    _check(documents([(i, f"Text {i}", "en", "ab"[i % 7 == 0]) for i in range(1200)]))


def test_odd_rows(spark, documents):
    _check(documents(ODD))
    _check(documents([(5, "Only one", "en", "a")]))
    _check(documents([(1, "Same", "en", "a")] * 40))
    empty = merkle_manifest.prove(documents([]))
    assert empty.columns == list(merkle_manifest.RESULT) and empty.count() == 0

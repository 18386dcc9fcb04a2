"""Operators on pairs, the pipeline and the registry, against brute force and on odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np

from vacancylab.llm import graph, pivot_index, signature_join, suffix_dedup

from .conftest import ODD


def _components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    links += [(5, 5), (None, 3)]
    found = {r.node: r.component for r in graph.connected_components(
        spark.createDataFrame(links, "u long, v long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == _components({x for p in real for x in p}, real)
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- op2
def _kept(rows):
    where = Counter()
    for text in rows:
        where.update(text[i:i + 200] for i in range(len(text) - 199))
    out = []
    for text in rows:
        cover = np.zeros(len(text) + 1, dtype=bool)
        for i in range(len(text) - 199):
            if where[text[i:i + 200]] > 1:
                cover[i:i + 200] = True
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        kept = bytes(b for b, c in zip(text, cover, strict=False) if not c)
        out.append((len(text), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _repeating_texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9)))
    long_ = " ".join(word() for _ in range(400))
    texts = [long_, long_[300:900] + "X" + long_[901:], long_[:199], long_[100:300], "z" * 700, "ab" * 150, "z" * 150]
    texts += [" ".join(word() for _ in range(60)) + long_[500:500 + n] + word() for n in (150, 199, 200, 201, 260, 400)]
    texts += [long_[1000:1400].replace("a", "b", k) for k in range(4)]
    return texts


def test_remove_repeats_against_brute_force(documents):
    texts = _repeating_texts()
    docs = documents([(i, t, "en", "a") for i, t in enumerate(texts)] + [(100 + (i or 0), *x) for i, *x in ODD[:-1]])
    ordered = docs.collect()
    expected = sorted(zip([r.doc_id for r in ordered], _kept([(r.text or "").encode() for r in ordered]), strict=True))
    for hot in (20_000, 1):
        found = [(r[0], tuple(r[1:])) for r in suffix_dedup.remove_repeats(docs, hot_contexts=hot).collect()]
        assert sorted(found) == expected
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_long_texts_are_read_in_parts(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 300)
    texts = [t.encode() for t in _repeating_texts()]
    pieces = [p for group in suffix_dedup._pieces(texts) for p in group]
    starts = Counter((row, start + i) for row, start, part in pieces for i in range(len(part) - 199))
    assert starts == Counter((row, i) for row, t in enumerate(texts) for i in range(len(t) - 199))
    for group in suffix_dedup._pieces(texts):
        for anchor, _, row, lo, hi in zip(*suffix_dedup.contexts(group), strict=True):
            assert 0 <= lo < hi <= len(texts[row]) - 199 and isinstance(int(anchor), int)


def test_marks_do_not_depend_on_batches():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    n = 3000
    g, ctx = rng.integers(0, 40, n), rng.integers(0, 30, n)
    order = np.lexsort((ctx, g))
    cols = {"g": g[order], "ctx": ctx[order], "n": rng.integers(0, 3, n).astype(np.int32), "d": np.arange(n),
            "rk": np.arange(n), "lo": np.zeros(n, dtype=np.int64), "hi": np.ones(n, dtype=np.int64)}

    def marks(step):
        batches = [pa.RecordBatch.from_pydict({c: x[i:i + step] for c, x in cols.items()}) for i in range(0, n, step)]
        rows = [r for b in suffix_dedup._mark_contexts(iter(batches)) for r in b.to_pylist()]
        return sorted((r["kind"], r["g"], r["d"] if r["kind"] != suffix_dedup.PARTNER else -1) for r in rows)

    assert marks(n) == marks(1) == marks(77)


def test_recurring_sorts_suffixes():
    rng = random.Random(9)
    base = bytes(rng.choice(b"ab") for _ in range(500))
    strings = [base[:350], base[100:480], base[:350], b"a" * 260, bytes(base[120:330]) + b"c"]
    group = np.array([1, 1, 2, 2, 1])
    where = Counter((int(group[k]), s[i:i + 200]) for k, s in enumerate(strings) for i in range(len(s) - 199))
    for k, (s, found) in enumerate(zip(strings, suffix_dedup.recurring(strings, group), strict=True)):
        assert found.tolist() == [i for i in range(len(s) - 199) if where[int(group[k]), s[i:i + 200]] > 1]


# --- op7
def _vectors(n=120, dim=8):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(12, dim))
    out = [(base[i % 12] + rng.normal(size=dim) * 0.07).astype(np.float32).tolist() for i in range(n)]
    return [(i, v, i % 2) for i, v in enumerate(out)]


def test_near_vectors_against_brute_force(spark):
    rows = _vectors()
    rows += [(200 + i, rows[0][1], 0) for i in range(5)] + [(300, [2 * x for x in rows[0][1]], 0)]
    rows += [(401, None, 0), (402, [0.0] * 8, 0), (403, [float("nan")] * 8, 0), (404, [None] + [1.0] * 7, 0),
             (405, rows[0][1], None), (406, [float("inf")] * 8, 0), (407, [1.0, 2.0], 0), (408, [1.0, 2.0], 0), (409, [], 0),
             (410, rows[0][1], 0), (410, rows[0][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as rep")
    good = [(k, i, np.array(v, dtype=np.float64), lab) for k, (i, v, lab) in enumerate(rows)
            if v and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for x, a in enumerate(good) for b in good[x + 1:] if a[3] == b[3] and len(a[2]) == len(b[2])
             and a[2] @ b[2] / np.sqrt((a[2] @ a[2]) * (b[2] @ b[2])) >= 0.98]
    degree = Counter(k for p in links for k, *_ in p)
    part = _components([r[0] for r in rows], [(a[1], b[1]) for a, b in links])
    expected = sorted((i, degree[k], part[i], part[i] == i) for k, (i, *_) in enumerate(rows))
    for block in (2048, 3):
        assert sorted(map(tuple, pivot_index.near_vectors(frame, block=block).collect())) == expected
    assert pivot_index.near_vectors(frame.limit(0)).count() == 0


def test_recall_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.collect()
    unit = np.array([r.embedding for r in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r.label for r in rows])
    true = ((unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])).sum() - len(rows)
    found = sum(r.n_links for r in pivot_index.near_vectors(frame).collect())
    assert 0.9 * true <= found <= true


# --- op8
def _shingles(text):
    words = (text or "").encode().translate(signature_join._LOWER).split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_against_brute_force(documents):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(150)] = f"x{rng.randrange(9)}"
        texts.append(" ".join(words) if i % 3 else " ".join(words).upper())
    texts += [" ".join(f"u{rng.randrange(900)}" for _ in range(n)) for n in (3, 4, 5, 60, 60)] + ["a b", "A  b\n", "a c"]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(i + 100 if i else i, *x) for i, *x in ODD]
    docs = documents(rows)
    sets = [(i, _shingles(t)) for i, t, *_ in rows]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[x + 1:]
             if s and t and a is not None and b is not None and 100 * len(s & t) >= 85 * len(s | t)]
    part = _components([i for i, _ in sets if i is not None], links)
    expected = sorted(((i, len(s), part.get(i), i is None or part[i] == i) for i, s in sets), key=repr)
    for blocks in ({}, {"block_docs": 7}, {"block_shingles": 900}):
        found = sorted((tuple(r) for r in signature_join.near_duplicates(docs, **blocks).collect()), key=repr)
        assert found == expected
    kept = signature_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        {i for i, p in part.items() if i == p})
    assert signature_join.near_duplicates(docs.limit(0)).count() == 0


def test_one_doc_id_with_several_texts(documents):
    rng = random.Random(18)
    a, b, c = ([f"{x}{rng.randrange(900)}" for _ in range(120)] for x in "abc")
    near = lambda words, at: " ".join([*words[:at], "changed", *words[at + 1:]])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (7, near(a, 50)), (8, near(b, 60)), (3, " ".join(c)), (3, " ".join(c)),
            (3, "  ".join(c)), (9, near(c, 3)), (9, "text of its own that nothing else is like"), (4, ""), (4, None), (4, "x")]
    docs = documents([(i, t, "en", "a") for i, t in rows])
    sets = [(i, _shingles(t)) for i, t in rows]
    links = [(x, y) for x, (_, s) in enumerate(sets) for y in range(x + 1, len(sets)) if s and sets[y][1]
             and 100 * len(s & sets[y][1]) >= 85 * len(s | sets[y][1])]
    part = _components(range(len(rows)), links)
    least = {}
    for x, root in part.items():
        least[root] = min(least.get(root, rows[x][0]), rows[x][0])
    expected = sorted((rows[x][0], len(sets[x][1]), least[part[x]], rows[x][0] == least[part[x]]) for x in part)
    assert sorted(tuple(r) for r in signature_join.near_duplicates(docs).collect()) == expected
    assert {r.component_id for r in signature_join.near_duplicates(docs).where("doc_id in (7, 8)").collect()} == {1}
    kept = sorted((r.doc_id, " ".join((r.text or "").split())) for r in signature_join.drop_near_duplicates(docs).collect())
    assert kept == sorted([(1, " ".join(a)), (1, " ".join(b)), (3, " ".join(c)), (9, rows[8][1]), (4, ""), (4, "x")])


def test_block_lists_count_like_all_pairs():
    rng = np.random.default_rng(5)
    docs = []
    for i in range(120):
        base = np.arange(300, dtype=np.uint64) + np.uint64(1000 * (i % 7))
        own = np.unique(np.where(rng.random(300) < rng.choice([0, 0.03, 0.1]), rng.integers(1, 2**62, 300).astype(np.uint64), base))
        docs.append((i.to_bytes(2), signature_join.signature(own), own))
    for left, right in ((docs, []), (docs[:50], docs[50:])):
        links = [(x[0], y[0]) for i, x in enumerate(left) for y in (left[i + 1:] if not right else right)
                 if (x[1] == y[1]).sum() >= 17 and 100 * len(np.intersect1d(x[2], y[2])) >= 85 * len(np.union1d(x[2], y[2]))]
        found = signature_join._links_of_block(left, right, not right, 17, 85)
        assert set(found) <= set(links)
        names = [d[0] for d in docs]
        assert _components(names, found) == _components(names, links)


# --- pipeline and registry
def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
        found[name] = docs
        if name != "pack":
            assert docs.columns == columns
    before = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    named = {r.doc_id for r in found["language_id"].collect()}
    assert all(not any(c.isalpha() for c in before[i] or "") for i in set(before) - named)
    groups = Counter(r.component_id for r in signature_join.near_duplicates(found["language_id"]).collect())
    assert sorted(groups) == sorted(r.doc_id for r in found["near_dedup"].collect())
    assert {r.doc_id for r in found["secret_scan"].collect()} == set(groups)
    assert sum(r.length for r in found["pack"].collect()) > 0
    again = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, found["pack"].collect()), key=repr)


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and {"op6_distribution_divergence", "op9_systematic_mix", "op13_recursive_climb"} <= set(entry.oracle_sql())

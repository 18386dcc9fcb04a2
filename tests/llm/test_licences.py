"""Licence scan against every offset of every template tried in Python, and on odd rows."""

import math
import random
import re

import pytest

from vacancylab.llm import license_index as li

from .conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _at(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase]


def _brute(rows):
    """All columns; the alignments come from every offset, not from an index."""
    texts = [_words(t) for _, t in rows]
    templates = [(t.label, _words(t.text), [_words(p) for p in t.phrases]) for t in li.TEMPLATES]
    vocabulary = {w for _, ws, _ in templates for w in ws}
    idf = {w: 1 + math.log((len(texts) + 1) / (sum(w in set(ws) for ws in texts) + 1)) for w in vocabulary}
    out = []
    for (doc_id, _), words in zip(rows, texts):
        base = [(i, label) for p, label in li.BASE_PHRASES for i in _at(words, p.split())]
        labels, score, n = {label for _, label in base}, 0.0, len(words)
        held = set(words)
        for label, ws, phrases in templates:
            if not all(_at(words, p) for p in phrases):
                continue
            anchors = sorted(held & set(ws), key=lambda w: (-idf[w], w.encode()))[:li.ANCHORS]
            for offset in range(-len(ws) + 1, n):
                votes = sum(0 <= offset + i < n and words[offset + i] == w for i, w in enumerate(ws) if w in anchors)
                if votes < li.MIN_VOTES or not all(
                        any(abs(offset + _at(ws, p)[0] - i) <= li.SLACK for i in _at(words, p)) for p in phrases):
                    continue
                labels.add(label)
                hit = sum(idf[w] for i, w in enumerate(ws) if 0 <= offset + i < n and words[offset + i] == w)
                score = max(score, hit / sum(idf[w] for w in ws))
        starts = [i for i, _ in base]
        out.append((doc_id, n, len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), round(score, 9)))
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels,
                    round(r.score, 9)) for r in li.scan_licences(df).collect()), key=repr)


def _garbled(rng, text):
    """A licence text with words dropped, added or changed, in other case and with other spacing."""
    out = []
    for w in text.split():
        x = rng.random()
        out += [] if x < 0.04 else [w, "é-x"] if x < 0.08 else [w.upper()] if x < 0.3 else [w]
    return rng.choice([" ", "\n * ", ", "]).join(out)


def test_against_all_offsets(spark, documents):
    rng = random.Random(11)
    filler = "the of and to license this software permission under rights free general öl 2 0 version".split()
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts += [" ".join(rng.choice(filler) for _ in range(rng.randint(0, 30))),
                      _garbled(rng, rng.choice(li.TEMPLATES).text)]
        rows.append((i, " ".join(parts), "en", "a"))
    rows += [(200, "MIT License " * 3000, "en", "a"), (201, "mit-license, Apache\tLICENSE", "en", "a"),
             (202, "mit the license", "en", "a"), (203, "smit license. mit licenses", "en", "a")]
    rows += [(300 + i, t.text, "en", "a") for i, t in enumerate(li.TEMPLATES)] + [r[:4] for r in ODD]
    df = documents(rows)
    assert _found(df) == _brute([(r.doc_id, r.text) for r in df.collect()])


def test_every_template_alone_has_its_label(spark, documents):
    df = documents([(i, f"some words before\n{t.text}. And after", "en", "a") for i, t in enumerate(li.TEMPLATES)])
    for r in li.scan_licences(df).collect():
        own = [m for m in r.matches if m.template == r.doc_id]
        assert own and own[0].score == pytest.approx(1.0) and own[0].first_word == 3
        assert li.TEMPLATES[r.doc_id].label in r.labels.split(",")


def test_given_texts(spark, small_documents):
    found = _found(small_documents)
    assert found == _brute([(r.doc_id, r.text) for r in small_documents.select("doc_id", "text").collect()])
    assert {"mit", "apache", "cc-by-nc"} <= {x for r in found for x in r[6].split(",")}


def test_empty_table(spark, documents):
    assert li.scan_licences(documents([])).count() == 0

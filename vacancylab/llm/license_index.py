"""Licence scan: a positional index of licence templates, entered by each file's rarest licence words.

Templates are word sequences with a label and mandatory key phrases.  The index
posts every word of every template with its places there.  One pass over all
texts counts in how many documents each of these words occurs; the inverse
document frequencies, no more than the templates have words, go to the tasks.
The second pass looks up, per file and template, the ``ANCHORS`` licence words
of the file that are rarest in the corpus; their postings are intersected by
relative position (place in the file less place in the template), and an
alignment that ``MIN_VOTES`` of them agree on is verified: every mandatory
phrase must stand within ``SLACK`` words of its place.  A template whose
phrases hold a word that the file lacks is not looked up, since it could not
be verified.  No text is shuffled; whole texts are scanned in both passes.

The score of an alignment is the share of the template's words, weighted by
inverse document frequency, that stand at their exact place; a document has the
score of its best alignment, 0 without one.

Odd input.  Null and empty texts have no words and no labels.  Equal and
repeated doc_ids keep one result row per row.  Ties between equally rare words
go by the word.  An empty table gives an empty result.  Columns beyond doc_id
and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of lower-cased UTF-8: digits, letters a-z and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Rarest licence words of a file that enter a template's postings.
ANCHORS = 6
#: Anchors that must agree on a relative position.
MIN_VOTES = 2
#: Words by which a mandatory phrase may be off its place.
SLACK = 8

# Phrases of the base labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


# Notices and key sentences of well-known public licences.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the Software), to deal in the Software without restriction, including "
             "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
             "copies of the Software", ("permission is hereby granted free of charge",
                                        "deal in the software without restriction")),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the "
             "License at http://www.apache.org/licenses/LICENSE-2.0", ("apache org licenses license 2 0",)),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", ("general public license",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version", ("terms of the gnu general public license",
                                                    "free software foundation")),
    Template("lgpl", "Licensed under the GNU Lesser General Public License", ("lesser general public license",)),
    Template("agpl", "Licensed under the GNU Affero General Public License", ("affero general public license",)),
    Template("bsd", "Released under the BSD License", ("bsd license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license",)),
    Template("epl", "This program is made available under the terms of the Eclipse Public License",
             ("eclipse public license",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the "
             "authors be held liable for any damages arising from the use of this software",
             ("in no event will the authors be held liable",)),
    Template("boost", "Distributed under the Boost Software License, Version 1.0", ("boost software license",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
    Template("cc0", "Released under CC0 1.0 Universal", ("cc0 1 0",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nc", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("creative commons attribution noncommercial",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
)

SCHEMA = ("doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, "
          "matches array<struct<label:string,template:int,phrase_word:long,first_word:long,last_word:long,score:double>>")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _places(ids: np.ndarray, phrase: Sequence[int]) -> np.ndarray:
    """Where the words of ``phrase`` stand consecutively."""
    if len(ids) < len(phrase):
        return np.empty(0, dtype=np.int64)
    hit = ids[: len(ids) - len(phrase) + 1] == phrase[0]
    for i, w in enumerate(phrase[1:], 1):
        hit &= ids[i: len(ids) - len(phrase) + 1 + i] == w
    return np.flatnonzero(hit)


class PositionalIndex:
    """Postings word -> (template, places), with the words' document frequencies."""

    def __init__(self, templates: Sequence[Template]):
        self.templates = templates
        texts = [words_of(t.text) for t in templates]
        phrases = [[words_of(p) for p in t.phrases] for t in templates]
        self.base = [(words_of(p), label) for p, label in BASE_PHRASES]
        known = sorted({w for t in texts for w in t} | {w for ps in phrases for p in ps for w in p}
                       | {w for p, _ in self.base for w in p})
        self.vocabulary = {w: i for i, w in enumerate(known)}
        number = self.vocabulary.__getitem__
        self.words = [np.array([number(w) for w in t]) for t in texts]
        self.base_ids = [([number(w) for w in p], label) for p, label in self.base]
        self.phrases = []
        for t, ps in zip(self.words, phrases, strict=True):
            own = []
            for p in ps:
                ids = [number(w) for w in p]
                at = _places(t, ids)
                if not len(at):
                    raise ValueError(f"phrase {b' '.join(p).decode()!r} is not in its template")
                own.append((ids, int(at[0])))
            self.phrases.append(own)
        self.postings: dict[int, list[tuple[int, np.ndarray]]] = {}
        for t, ids in enumerate(self.words):
            for w in np.unique(ids).tolist():
                self.postings.setdefault(w, []).append((t, np.flatnonzero(ids == w)))
        self.needed = [frozenset(w for ids, _ in own for w in ids) for own in self.phrases]
        self.weights = np.ones(len(known))
        self.order = list(range(len(known)))

    def weigh(self, frequencies: dict[int, int], documents: int) -> None:
        """Inverse document frequencies; ``order`` ranks words by falling weight, then by the word."""
        self.weights = np.array([1.0 + math.log((documents + 1) / (frequencies.get(i, 0) + 1))
                                 for i in range(len(self.vocabulary))])
        rank = sorted(range(len(self.weights)), key=lambda i: (-self.weights[i], i))
        self.order = [0] * len(rank)
        for place, i in enumerate(rank):
            self.order[i] = place

    def alignments(self, ids: np.ndarray) -> list[tuple[str, int, int, int, int, float]]:
        """(label, template, place of the first phrase, first and last word, score) of every verified alignment."""
        present = sorted(set(np.unique(ids).tolist()) - {-1}, key=self.order.__getitem__)
        held = frozenset(present)
        anchors: dict[int, list[tuple[int, np.ndarray]]] = {
            t: [] for t, needed in enumerate(self.needed) if needed <= held}
        if not anchors:
            return []
        for w in present:
            for t, places in self.postings.get(w, ()):
                if t in anchors and len(anchors[t]) < ANCHORS:
                    anchors[t].append((w, places))
        found = []
        where: dict[int, np.ndarray] = {}
        for t, own in anchors.items():
            offsets = []
            for w, places in own:
                if w not in where:
                    where[w] = np.flatnonzero(ids == w)
                offsets.append((where[w][:, None] - places[None, :]).ravel())
            values, votes = np.unique(np.concatenate(offsets), return_counts=True)
            found += self._verified(ids, t, values[votes >= MIN_VOTES])
        return found

    def _verified(self, ids: np.ndarray, t: int, offsets: np.ndarray) -> list[tuple]:
        words, weights = self.words[t], self.weights[self.words[t]]
        at = np.full(len(offsets), -1)
        good = np.ones(len(offsets), dtype=bool)
        for k, (phrase, place) in enumerate(self.phrases[t]):
            stands = _places(ids, phrase)
            if not len(stands):
                return []
            expected = offsets + place
            after = np.searchsorted(stands, expected)
            below, above = stands[np.maximum(after - 1, 0)], stands[np.minimum(after, len(stands) - 1)]
            nearest = np.where(np.abs(expected - below) <= np.abs(above - expected), below, above)
            good &= np.abs(nearest - expected) <= SLACK
            if k == 0:
                at = nearest
        offsets, at = offsets[good], at[good]
        best: dict[int, tuple] = {}
        for start in range(0, len(offsets), 1024):
            some = offsets[start: start + 1024]
            place = some[:, None] + np.arange(len(words))
            inside = (place >= 0) & (place < len(ids))
            hit = inside & (ids[np.clip(place, 0, len(ids) - 1)] == words)
            scores = np.where(hit, weights, 0.0).sum(axis=1) / weights.sum()
            for o, p, row, s in zip(some.tolist(), at[start: start + 1024].tolist(), hit, scores.tolist(), strict=True):
                if p not in best or s > best[p][-1]:
                    hits = np.flatnonzero(row)
                    span = (o + int(hits[0]), o + int(hits[-1])) if len(hits) else (p, p)
                    best[p] = (self.templates[t].label, t, p, *span, min(1.0, s))
        return [best[p] for p in sorted(best)]


def _frequencies(documents: DataFrame, index: PositionalIndex) -> tuple[dict[int, int], int]:
    """Documents that hold each licence word, and all documents; as many numbers as the templates have words."""
    vocabulary = index.vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            total[-1] += batch.num_rows
            for text in batch.column(0):
                total.update([vocabulary[w] for w in set(words_of(text.as_py())) if w in vocabulary])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())],
                                         ["word", "n"])

    counts = (documents.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word int, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).collect())
    found = {r["word"]: r["n"] for r in counts}
    return found, found.pop(-1, 0)


def scan_licences(documents: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document: base phrases, labels, score, and every verified alignment in ``matches``."""
    index = PositionalIndex(templates)
    index.weigh(*_frequencies(documents, index))
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = SCHEMA.format(kind=kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, base = index.vocabulary, index.base_ids
        names = schema_names
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                ids = np.fromiter((vocabulary.get(w, -1) for w in words), dtype=np.int64, count=len(words))
                starts = [(_places(ids, p), label) for p, label in base]
                places = np.concatenate([s for s, _ in starts])
                labels = {label for s, label in starts if len(s)}
                matches = index.alignments(ids)
                rows.append((len(words), len(places), int(places.min()) if len(places) else None,
                             int(places.max()) if len(places) else None, ",".join(sorted(labels)),
                             ",".join(sorted(labels | {m[0] for m in matches})),
                             max((m[-1] for m in matches), default=0.0),
                             [dict(zip(("label", "template", "phrase_word", "first_word", "last_word", "score"), m,
                                       strict=True)) for m in matches]))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("label", pa.string()), ("template", pa.int32()), ("phrase_word", pa.int64()),
                 ("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]], names)

    schema_names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(scan, schema)

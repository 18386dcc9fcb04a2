"""Language identification: a linear-chain conditional random field over words."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sampling import group_cuts, log_bucket

#: Bounds of the training sample: documents of a language, parts of a document, words of a part.
DOCS_PER_LANGUAGE, PARTS, PART_WORDS = 400, 4, 16
#: Share of training sequences in which two languages follow each other.
SWITCHED = 0.4
#: Feature weights (a power of two, features are hashed), rounds of fitting, penalty.
WEIGHTS, ROUNDS, PENALTY = 1 << 15, 50, 1e-5
#: Words that a task remembers, and bytes of text that it labels at a time.
CACHE_WORDS, GROUP_BYTES = 400_000, 1 << 20
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_WIDTH = 32
_GRAMS = (2, 3, 4)


def held_out(doc_id: Column) -> Column:
    """Documents that training never sees: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the words between two marks, one word a row."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    if length.max(initial=0) > _WIDTH:
        raise ValueError(f"a word of more than {_WIDTH} characters")
    chars = np.array(words, dtype=f"U{_WIDTH}").view(np.uint32).reshape(len(words), _WIDTH)
    out = np.zeros((len(words), _WIDTH + 2), dtype=np.uint32)
    out[:, 0] = 2
    out[:, 1:-1] = chars
    out[np.arange(len(words)), length + 1] = 3
    return out, length


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: n-grams of 2 to 4 characters with marks at
    the ends, and so affixes of up to 3, a longer prefix and suffix of 3 marked
    as such, and the whole word.  Returns ids (one word a row) and which of
    them count."""
    codes, length = _codes(words)
    ids, used = [], []
    place = np.arange(_WIDTH + 2)
    for n in _GRAMS:
        m = _WIDTH + 3 - n
        h = np.full((len(words), m), n, dtype=np.uint32)
        for j in range(n):
            h = h * np.uint32(0x01000193) ^ codes[:, j:j + m]
        ids.append(h)
        used.append(place[None, :m] + n <= length[:, None] + 2)
    rows = np.arange(len(words))
    prefix, suffix, whole = (np.full(len(words), s, dtype=np.uint32) for s in (11, 12, 13))
    for j in range(3):
        prefix = prefix * np.uint32(0x01000193) ^ codes[:, 1 + j]
        suffix = suffix * np.uint32(0x01000193) ^ codes[rows, np.maximum(length - j, 0)]
    for j in range(_WIDTH):
        whole = whole * np.uint32(0x01000193) ^ codes[:, 1 + j]
    ids += [x[:, None] for x in (prefix, suffix, whole)]
    used.append(np.ones((len(words), 3), dtype=bool))
    h = np.concatenate(ids, axis=1)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return ((h ^ (h >> np.uint32(13))) % np.uint32(WEIGHTS)).astype(np.int32), np.concatenate(used, axis=1)


def forward_backward(emission: np.ndarray, transition: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of every label at every place of many chains.

    ``emission``: scores of the words of all chains, one chain after the
    other; ``lengths`` descend.  Returns posteriors (words x labels), expected
    label pairs (labels x labels) and the log of each chain's partition sum.
    """
    k = emission.shape[1]
    top = emission.max(axis=1, keepdims=True)
    e, a = np.exp(emission - top), np.exp(transition)
    first = np.cumsum(lengths) - lengths
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # chains longer than t
    alpha, scale = np.empty_like(e), np.empty(len(e))
    last = np.full((len(lengths), k), 1.0 / k)
    for t in range(steps):
        at = first[: active[t]] + t
        now = (last[: active[t]] @ a if t else last[: active[t]]) * e[at]
        total = now.sum(axis=1)
        now /= total[:, None]
        alpha[at], scale[at] = now, total
        last[: active[t]] = now
    beta = np.ones_like(e)
    pairs = np.zeros((k, k))
    for t in range(steps - 1, 0, -1):
        at = first[: active[t]] + t
        later = e[at] * beta[at] / scale[at][:, None]
        beta[at - 1] = later @ a.T
        pairs += (alpha[at - 1].T @ later) * a
    posterior = alpha * beta
    posterior /= posterior.sum(axis=1, keepdims=True)
    log_z = np.add.reduceat(np.log(scale) + top[:, 0], first) if len(first) else np.empty(0)
    return posterior, pairs, log_z


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # WEIGHTS x languages
    transition: np.ndarray  # from x to
    lexicon: dict[str, int]  # row of a word in lexicon_rows
    lexicon_rows: np.ndarray  # words x languages: a word of the language; the last row is of all other words
    lexicon_weights: np.ndarray  # languages x languages

    def emission(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.languages)))
        for i in range(0, len(words), 20_000):
            part = words[i:i + 20_000]
            ids, used = features(part)
            sums = (self.weights[ids] * used[:, :, None]).sum(axis=1)
            out[i:i + len(part)] = sums / np.sqrt(used.sum(axis=1))[:, None]
        return out + self.in_lexicon(words) @ self.lexicon_weights

    def in_lexicon(self, words: list[str]) -> np.ndarray:
        rows = np.fromiter((self.lexicon.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        return self.lexicon_rows[rows].astype(float)


def fit(parts: list[tuple[str, list[str]]], rounds: int = ROUNDS, seed: int = 10) -> Model:
    """Model from (language, words) parts, by gradient steps on the
    log-likelihood of word labels.  Some sequences join parts of two
    languages, so that the transitions learn code-switching."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in parts})
    number = {lang: i for i, lang in enumerate(languages)}
    k = len(languages)
    by_lang = [[w for lang, w in parts if lang == x] for x in languages]
    chains: list[list[tuple[int, list[str]]]] = []
    for lang, words in parts:
        chain = [(number[lang], words)]
        if k > 1 and rng.random() < SWITCHED:
            other = int((number[lang] + rng.integers(1, k)) % k)
            cut = int(rng.integers(1, len(words) + 1))
            chain = [(number[lang], words[:cut]), (other, by_lang[other][rng.integers(len(by_lang[other]))])]
        chains.append(chain)
    chains.sort(key=lambda c: -sum(len(w) for _, w in c))
    index: dict[str, int] = defaultdict()
    index.default_factory = index.__len__
    tokens = np.array([index[w] for c in chains for _, words in c for w in words], dtype=np.int64)
    gold = np.array([lang for c in chains for lang, words in c for _ in words], dtype=np.int64)
    lengths = np.array([sum(len(w) for _, w in c) for c in chains], dtype=np.int64)
    vocabulary = list(index)

    counts = np.zeros((len(vocabulary), k))
    np.add.at(counts, (tokens, gold), 1)
    mostly = (counts >= 3) & (counts >= 0.7 * counts.sum(axis=1, keepdims=True))
    listed = np.flatnonzero(mostly.any(axis=1))
    lexicon = {vocabulary[i]: row for row, i in enumerate(listed.tolist())}
    model = Model(languages, np.zeros((WEIGHTS, k)), np.zeros((k, k)), lexicon,
                  np.concatenate([mostly[listed], np.zeros((1, k), dtype=bool)]), np.zeros((k, k)))
    if not len(tokens):
        return model

    ids, used = features(vocabulary)
    flat_word = np.repeat(np.arange(len(vocabulary)), used.sum(axis=1))
    flat_id = ids[used]
    norm = 1 / np.sqrt(used.sum(axis=1))
    lex = model.in_lexicon(vocabulary)
    inner = np.ones(len(tokens), dtype=bool)
    inner[np.cumsum(lengths) - lengths] = False
    at = np.flatnonzero(inner)
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (gold[at - 1], gold[at]), 1)
    params = [model.weights, model.transition, model.lexicon_weights]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, rounds + 1):
        sums = np.stack([np.bincount(flat_word, weights=model.weights[flat_id, j], minlength=len(vocabulary))
                         for j in range(k)], axis=1) * norm[:, None]
        emission = (sums + lex @ model.lexicon_weights)[tokens]
        posterior, pairs, _ = forward_backward(emission, model.transition, lengths)
        posterior[np.arange(len(gold)), gold] -= 1
        error = np.stack([np.bincount(tokens, weights=posterior[:, j], minlength=len(vocabulary))
                          for j in range(k)], axis=1) / len(tokens)
        scaled = error * norm[:, None]
        grads = [np.stack([np.bincount(flat_id, weights=scaled[flat_word, j], minlength=WEIGHTS)
                           for j in range(k)], axis=1) + PENALTY * model.weights,
                 (pairs - gold_pairs) / len(tokens) + PENALTY * model.transition,
                 lex.T @ error + PENALTY * model.lexicon_weights]
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model


def _training_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, parts = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = [w for w in map(_letters, _runs(text)) if w]
            for at in sorted({int(x) for x in np.linspace(0, max(0, len(words) - PART_WORDS), PARTS)}):
                if part := words[at:at + PART_WORDS]:
                    langs.append(lang)
                    parts.append(" ".join(part))
        yield pa.RecordBatch.from_arrays([pa.array(langs, type=pa.string()), pa.array(parts, type=pa.string())],
                                         names=["lang", "words"])


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(_LETTERS.findall(word))


def _runs(text: str) -> list[str]:
    """Runs without white space of a lower-cased text; those of more than
    ``_WIDTH`` characters as words of at most so many letters."""
    runs = text.lower().split()
    if max(map(len, runs), default=0) > _WIDTH:
        runs = [w for run in runs for w in (_pieces(run) if len(run) > _WIDTH else (run,))]
    return runs


def _pieces(run: str) -> list[str]:
    """The letters of a run as one word if it is short enough, else the parts
    between non-letters, cut into consecutive pieces.  Marks (vowel signs,
    accents) stand inside words and separate nothing."""
    letters = _letters(run)
    if len(letters) <= _WIDTH:
        return [letters]
    if not run.isalpha():
        run = "".join(c for c in run if c.isalnum() or unicodedata.category(c)[0] != "M")
    return [part[i:i + _WIDTH] for part in _LETTERS.findall(run) for i in range(0, len(part), _WIDTH)]


def training_ids(known: DataFrame, docs_per_language: int) -> DataFrame:
    """(doc_id, lang): of every language the ``docs_per_language`` documents
    with the least hash of their id, ties by id, repeated ones once.

    A histogram of the hashes gives each language a cut that leaves about as
    many, so no task orders more of them than that and one bucket.  The cuts,
    one row a language, are broadcast: the model has a column for each
    language anyway."""
    hashed = F.xxhash64("doc_id")
    bucket = log_bucket(hashed.cast("double") + F.lit(2.0 ** 63))
    ids = known.select("doc_id", "lang")
    cuts = group_cuts(ids, docs_per_language, ["lang"], bucket)
    near = ids.withColumn("__b", bucket).join(F.broadcast(cuts), "lang", "left").where(
        F.col("__cut").isNull() | (F.col("__b") <= F.col("__cut")))
    least = Window.partitionBy("lang").orderBy(hashed, "doc_id")
    return near.select("doc_id", "lang", F.row_number().over(least).alias("rn")).where(
        F.col("rn") <= docs_per_language).select("doc_id", "lang").distinct()


def train(documents: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Model from a bounded sample (``training_ids``) of the labelled documents
    that are not held out, and of each a few parts spread over the whole text."""
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = training_ids(known, docs_per_language)
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    rows = sample.select("lang", "text").mapInArrow(_training_parts, "lang string, words string").collect()
    return fit(sorted((r["lang"], r["words"].split()) for r in rows))


class _Labeller:
    """Emission scores of words, remembered within a task."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.scores = np.empty((0, len(self.model.languages)))
        self.real = np.empty(0, dtype=bool)

    def group(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, score) of texts: the label with the highest mean
        posterior over the words, and that mean."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        before = len(self.index)
        tokens = []
        for text in texts:
            words = _runs(text)
            tokens.append(np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words)))
        new = [_letters(w) for w in list(islice(reversed(self.index), len(self.index) - before))[::-1]]
        self.scores = np.concatenate([self.scores, self.model.emission(new)])
        self.real = np.concatenate([self.real, np.fromiter(map(bool, new), dtype=bool, count=len(new))])
        tokens = [t[self.real[t]] for t in tokens]
        order = sorted((i for i in range(len(texts)) if len(tokens[i])), key=lambda i: -len(tokens[i]))
        out = [(UNKNOWN, 0.0)] * len(texts)
        if order and self.model.languages:
            lengths = np.array([len(tokens[i]) for i in order])
            posterior, _, _ = forward_backward(self.scores[np.concatenate([tokens[i] for i in order])],
                                               self.model.transition, lengths)
            means = np.add.reduceat(posterior, np.cumsum(lengths) - lengths) / lengths[:, None]
            for i, mean in zip(order, means, strict=True):
                best = int(np.argmax(mean))
                out[i] = (self.model.languages[best], float(min(1.0, max(0.0, mean[best]))))
        return out


def with_language(documents: DataFrame, model: Model | None = None, language: str = "lang_pred",
                  score: str = "score") -> DataFrame:
    """``documents`` with the predicted language of its ``text`` and its score
    in two more columns (replacing columns of these names)."""
    fitted = model or train(documents)
    shared = documents.sparkSession.sparkContext.broadcast(fitted)  # WEIGHTS x languages numbers
    rows = documents.drop(language, score)
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _Labeller(shared.value)
        for batch in batches:
            texts = batch.column(at)
            sizes = np.fromiter((len(t.as_py() or "") for t in texts), dtype=np.int64, count=len(texts))
            order = np.argsort(-sizes, kind="stable")
            found: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes[order]) // GROUP_BYTES)) + 1
            for group in np.split(order, cuts):
                some = labeller.group([texts[int(i)].as_py() or "" for i in group])
                for i, x in zip(group.tolist(), some, strict=True):
                    found[i] = x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], type=pa.string()),
                 pa.array([x for _, x in found], type=pa.float64())],
                names=[*batch.schema.names, language, score])

    schema = T.StructType([*rows.schema.fields, T.StructField(language, T.StringType()),
                           T.StructField(score, T.DoubleType())])
    return rows.mapInArrow(run, schema)


def predict_languages(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score.

    Every word is labelled by forward-backward; the document gets the label
    with the highest mean posterior, the score.  Trains on ``documents`` if no
    model is given; lang, source and doc_id are never inputs of a prediction.
    Null and empty texts, texts without a letter, and any text if there was
    nothing to learn from are ``und`` with score 0; null doc_ids are not held
    out; repeated rows are predicted one by one; an empty table gives an empty
    result; extra columns are ignored.
    """
    fitted = model or train(documents)
    rows = documents.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return with_language(rows, fitted).select("doc_id", "held_out", "lang_pred", "score")

"""Token counts by section: whole documents encoded once, offsets joined to sections."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _tokens

#: A token that crosses a boundary counts where it begins ("first"), where it
#: ends ("last"), where most of its characters are, the earlier section on a
#: tie ("most"), or is shared by characters ("split").
RULES = ("first", "last", "most", "split")
SCHEMA = ("doc_id long, section int, start long, end long, n_tokens double, n_crossing long, doc_tokens long")


def line_sections(text: str) -> list[int]:
    """Starts of the sections of a text: its lines, each with its line break.
    The empty rest after a final line break is not a section."""
    starts, at = [0], text.find("\n") + 1
    while 0 < at < len(text):
        starts.append(at)
        at = text.find("\n", at) + 1
    return starts


def char_spans(text: str, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of every token.  A token that
    begins or ends inside a character covers that character."""
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    char_of = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths[ids])
    return char_of[ends - lengths[ids]], char_of[ends - 1] + 1


def attribute(first: np.ndarray, end: np.ndarray, starts: np.ndarray, n_chars: int, rule: str) -> tuple:
    """Interval join of token spans with sections [starts[i], starts[i+1]):
    tokens of each section by ``rule``, and tokens that cross its start."""
    n = len(starts)
    a = np.searchsorted(starts, first, side="right") - 1
    b = np.searchsorted(starts, end - 1, side="right") - 1
    cross = a != b
    crossing = np.bincount(b[cross], minlength=n)
    if rule == "first" or not cross.any():
        return np.bincount(a, minlength=n).astype(float), crossing
    if rule == "last":
        return np.bincount(b, minlength=n).astype(float), crossing
    counts = np.bincount(a[~cross], minlength=n).astype(float)
    bounds = np.append(starts, n_chars)
    for i in np.flatnonzero(cross):
        parts = np.arange(a[i], b[i] + 1)
        chars = np.minimum(end[i], bounds[parts + 1]) - np.maximum(first[i], bounds[parts])
        if rule == "split":
            counts[parts] += chars / chars.sum()
        else:
            counts[parts[np.argmax(chars)]] += 1
    return counts, crossing


def section_tokens(documents: DataFrame, rule: str = "most", ranks_path: str | None = None,
                   sections: Callable[[str], list[int]] = line_sections) -> DataFrame:
    """Tokens of every section of every document.

    Each whole text is encoded once; ``sections`` gives the ascending starts
    (the first one 0) of its sections, by default its lines.  One row per
    section: doc_id, section (from 0), start and end in characters, n_tokens
    by ``rule`` (whole numbers but for "split"; the sections of a document
    add up to doc_tokens), n_crossing (tokens that begin before its start and
    end after), doc_tokens.  Null and empty texts have one empty section with
    no tokens; repeated rows are counted one by one; a null doc_id stays
    null; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}; one of {', '.join(RULES)}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _tokens.token_lengths(ranks_path)
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                starts = np.asarray(sections(text), dtype=np.int64)
                ids = _tokens.encode(text, ranks_path)
                if len(ids):
                    n_tokens, crossing = attribute(*char_spans(text, ids, lengths), starts, len(text), rule)
                else:
                    n_tokens, crossing = np.zeros(len(starts)), np.zeros(len(starts), dtype=np.int64)
                values = ([doc_id] * len(starts), range(len(starts)), starts.tolist(),
                          [*starts[1:].tolist(), len(text)], n_tokens.tolist(), crossing.tolist(),
                          [len(ids)] * len(starts))
                for col, value in zip(cols, values, strict=True):
                    col.extend(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])

    return documents.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(count, SCHEMA)

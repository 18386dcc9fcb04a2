"""Packing documents into sequences: length patterns fitted by non-negative least squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _tokens
from ._tables import materialize

CAPACITY = 2048
SEPARATOR = 0
#: Patterns hold at most so many documents; lengths are fitted in steps of GRID tokens.
MAX_PARTS, GRID = 6, 32
#: Pieces of one length that one window task ranks at a time.
ROWS_PER_GROUP = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def document_pieces(documents: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None) -> DataFrame:
    """Token pieces of every document: its ids and a separator, cut only when
    longer than ``capacity``, the remainder first."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(_tokens.encode(text.as_py(), ranks_path), np.uint32(SEPARATOR)).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(cut, PIECES)


def patterns(total: int, max_parts: int, smallest: int = 1) -> list[tuple[int, ...]]:
    """All ascending tuples of at most ``max_parts`` whole numbers that add up to ``total``."""
    out = [(total,)] if total >= smallest else []
    if max_parts > 1:
        for part in range(smallest, total // 2 + 1):
            out += [(part, *rest) for rest in patterns(total - part, max_parts - 1, part)]
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Non-negative least squares by active sets: min |a x - b|, x >= 0."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        active[best] = True
        while True:
            idx = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[idx] = z
                break
            bad = z <= 0
            step = np.min(x[idx][bad] / np.maximum(x[idx][bad] - z[bad], 1e-300))
            x[idx] += step * (z - x[idx])
            active[idx[bad & (x[idx] <= 1e-12 * max(1.0, x.max()))]] = False
            if step == 0:
                active[best] = False
                x[~active] = 0
                break
            x[~active] = 0
    return x


class _Shelf:
    """Unplaced pieces by exact length."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.used = np.zeros_like(counts)

    def take(self, length: int, n: int) -> int:
        """Remove ``n`` pieces; their first rank among the pieces of this length."""
        first = int(self.used[length])
        self.used[length] += n
        self.left[length] -= n
        return first

    def longest(self, most: int) -> int:
        found = np.flatnonzero(self.left[: most + 1] > 0)
        return int(found[-1]) if len(found) else 0


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY, max_parts: int = MAX_PARTS,
                 grid: int = GRID) -> list[tuple[int, int, int, int, int]]:
    """Places for ``counts[l]`` pieces of each length l (1..capacity).

    Returns rows (length, first_rank, n, first_sequence, offset): the pieces
    ``first_rank .. first_rank+n-1`` of this length go, one each, to
    sequences from ``first_sequence`` on, at ``offset``.

    1. Lengths are rounded up to classes of ``grid`` tokens.  The shortest
       documents stay out, about as many tokens as rounding up will waste.
    2. Patterns of at most ``max_parts`` classes that fill a sequence are
       enumerated, and repeat counts fitted to the class histogram by
       non-negative least squares; whole repeats (rounded down) are kept.
    3. Each pattern takes its pieces from the classes, and what remains free
       is filled with the longest residual pieces that fit.
    4. The residual pieces are packed longest first, each sequence filled with
       the longest pieces that fit.
    All steps work on counts of lengths, so they cost the same for any number
    of documents, and the plan has a few thousand rows.
    """
    shelf, plan, sequences = _Shelf(np.asarray(counts, dtype=np.int64)), [], 0
    lengths = np.arange(len(counts))

    def place(run: list[int], n: int) -> None:
        """``n`` sequences that begin with the lengths of ``run``, then best fits."""
        nonlocal sequences
        spans, at = [], 0
        for length in run:
            spans.append((length, shelf.take(length, n), at))
            at += length
        todo = [(spans, at, n)]
        while todo:
            spans, at, n = todo.pop()
            length = shelf.longest(capacity - at)
            if not length:
                for span_length, rank, offset in spans:
                    plan.append((span_length, rank, n, sequences, offset))
                sequences += n
                continue
            per = max(1, min((capacity - at) // length, int(shelf.left[length]) // n))
            m = n if per * n <= shelf.left[length] else int(shelf.left[length])
            if m < n:  # too few for all: the rest goes on without
                todo.append(([(a, r + m, o) for a, r, o in spans], at, n - m))
            more = [(length, shelf.take(length, m), at + i * length) for i in range(per)]
            todo.append(([*spans, *more], at + per * length, m))

    classes, n_classes = -(-lengths // grid), capacity // grid
    fitted = shelf.left.copy()
    waste = float((fitted * (classes * grid - lengths)).sum())
    reserved = np.cumsum(fitted * lengths)
    fitted[reserved <= waste] = 0
    histogram = np.bincount(classes, weights=fitted, minlength=n_classes + 1)[1:]
    if histogram.sum():
        pats = patterns(n_classes, max_parts)
        a = np.zeros((n_classes, len(pats)))
        for j, pat in enumerate(pats):
            for part in pat:
                a[part - 1, j] += 1
        repeats = np.floor(nnls(a, histogram) + 1e-6).astype(np.int64)
        for j in sorted(np.flatnonzero(repeats), key=lambda j: (-pats[j][-1], j)):
            left = int(repeats[j])
            while left:
                run, need = [], {}
                for part in reversed(pats[j]):
                    # longest first, so that short classes keep what fills gaps best
                    for length in range(part * grid, (part - 1) * grid, -1):
                        if min(shelf.left[length], fitted[length]) > need.get(length, 0):
                            run.append(length)
                            need[length] = need.get(length, 0) + 1
                            break
                if len(run) < len(pats[j]):
                    break
                n = min(left, *(int(min(shelf.left[x], fitted[x])) // k for x, k in need.items()))
                for length, k in need.items():
                    fitted[length] -= k * n
                place(run, n)
                left -= n
    while longest := shelf.longest(capacity):
        per = min(capacity // longest, int(shelf.left[longest]))
        place([longest] * per, int(shelf.left[longest]) // per)
    return plan


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, max_parts: int = MAX_PARTS, grid: int = GRID,
                   rows_per_group: int = ROWS_PER_GROUP, ranks_path: str | None = None) -> DataFrame:
    """Sequence and offset of every piece of every document.

    The histogram of piece lengths (at most ``capacity`` rows, whatever the
    input) is the only thing that reaches the driver; the plan made from it
    goes back to the tasks as a few thousand rows, and each piece finds its
    place by its length and its rank among the pieces of that length.  Ranks
    are offsets of slices of a hash plus row numbers inside, so a length that
    very many pieces share is split.  Null and empty texts are one separator;
    repeated rows are packed one by one; null doc_ids stay null; an empty
    table gives an empty result; other columns are ignored.
    """
    pieces = materialize(document_pieces(documents, capacity, ranks_path), "pieces")
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    plan = np.array(sorted(plan_packing(counts, capacity, max_parts, grid)), dtype=np.int64).reshape(-1, 5)

    slices = F.create_map(*[F.lit(int(x)) for r in histogram if r["count"] > rows_per_group
                            for x in (r["length"], -(-r["count"] // rows_per_group))] or [F.lit(0), F.lit(1)])
    key = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(2**31))
    n_slices = F.coalesce(F.element_at(slices, F.col("length").cast("int")), F.lit(1))
    sliced = pieces.withColumn("slice", F.shiftright(key * n_slices.cast("long"), 31))
    running = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("length", "slice").agg(F.count("*").alias("n")).select(
        "length", "slice", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = sliced.withColumn("rn", F.row_number().over(inside)).join(offsets, ["length", "slice"]).withColumn(
        "rank", F.col("before") + F.col("rn") - 1)

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = int(plan[:, 1].max(initial=0)) + int(plan[:, 2].max(initial=0)) + 1
        starts = plan[:, 0] * width + plan[:, 1]
        for frame in frames:
            at = np.searchsorted(starts, frame["length"].to_numpy() * width + frame["rank"].to_numpy(), "right") - 1
            row = plan[at]
            out = frame[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
            out["sequence_id"] = row[:, 3] + frame["rank"].to_numpy() - row[:, 1]
            out["offset"] = row[:, 4]
            yield out

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        places, PIECES + ", sequence_id long, offset long")

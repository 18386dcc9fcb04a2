"""Removal of repeated 200-byte strings by hash-compared suffix sorting.

Every 200-byte string of a text holds one *anchor*: its 48-byte part with the
least hash.  Equal strings have the same anchor at the same place, so strings
need comparing only under their anchor, and consecutive strings with the same
anchor occurrence form one *context*.  Contexts are compared by digest first;
only where an anchor stands in different contexts are the suffixes of these
contexts sorted, to find which of their strings recur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialize

#: Length of the strings that must not recur, and of the anchors in them.
LENGTH, ANCHOR = 200, 48
#: Bytes of text that are hashed at a time, and of contexts that are sorted at a time.
SLICE_BYTES, CHUNK_BYTES = 1 << 20, 1 << 21
#: An anchor with more different contexts is resolved string by string, over all tasks.
HOT_CONTEXTS = 20_000

_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(21).integers(1, 2**63, 256, dtype=np.uint64)
DUPLICATE, UNSURE, PARTNER = 0, 1, 2
MARKS = "kind int, g long, d long, rk long, lo long, hi long"
_EMPTY = np.empty(0, dtype=np.int64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    def up(base: int) -> np.ndarray:
        out = np.full(n, base % 2**64, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        return out
    return up(_BASE), up(pow(_BASE, -1, 2**64))


class PrefixHashes:
    """Polynomial hashes of all substrings of a byte array, from its prefixes."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(SLICE_BYTES + LENGTH, CHUNK_BYTES, len(data)).bit_length()
        power, self.inverse = _powers(size)
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * power[: len(data)], out=self.prefix[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def all_of(self, length: int) -> np.ndarray:
        n = len(self.prefix) - length
        return (self.prefix[length:] - self.prefix[:n]) * self.inverse[:n]

    def common(self, p: np.ndarray, q: np.ndarray, most: int) -> np.ndarray:
        """Length of the common extension of the suffixes at p and q, up to
        ``most``, by binary search over equal hashes."""
        out = np.full(len(p), most, dtype=np.int64)
        rest = np.flatnonzero(self.of(p, most) != self.of(q, most))
        low, high = np.zeros(len(rest), dtype=np.int64), np.full(len(rest), most - 1, dtype=np.int64)
        a, b = p[rest], q[rest]
        for _ in range(int(most).bit_length()):
            middle = (low + high + 1) // 2
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        out[rest] = low
        return out


def _least_positions(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value of every window."""
    least, at, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        later = least[step:] < least[:-step]
        least = np.where(later, least[step:], least[:-step])
        at = np.where(later, at[step:], at[:-step])
        span += step
    return at


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _pieces(texts: list[bytes | None]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, first byte, bytes) of texts, in lists of about SLICE_BYTES; the
    parts of a long text overlap so that each string lies in one part."""
    out, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(0, len(text or b"") - LENGTH + 1), SLICE_BYTES):
            part = text[start:start + SLICE_BYTES + LENGTH - 1]
            out.append((row, start, part))
            size += len(part)
            if size >= SLICE_BYTES:
                yield out
                out, size = [], 0
    if out:
        yield out


def contexts(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """(anchor, digest, row, lo, hi) of all contexts: the strings that start
    in [lo, hi) of the row's text share one occurrence of the anchor."""
    data = b"".join(p for *_, p in pieces)
    hashes = PrefixHashes(np.frombuffer(data, dtype=np.uint8))
    anchor = hashes.all_of(ANCHOR)
    at = _least_positions(_mixed(anchor), LENGTH - ANCHOR + 1)
    lengths = np.array([len(p) for *_, p in pieces])
    first = np.cumsum(lengths) - lengths
    last = first + lengths - LENGTH + 1  # end of the piece's string starts
    inside = np.zeros(len(at) + 1, dtype=np.int64)
    np.add.at(inside, first, 1)
    np.add.at(inside, last, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    begins = np.zeros(len(at), dtype=bool)
    begins[first] = True
    begins[1:] |= at[1:] != at[:-1]
    lo = np.flatnonzero(begins & inside)
    piece = np.searchsorted(first, lo, side="right") - 1
    hi = np.minimum(np.append(lo[1:], len(at)), last[piece])
    view = memoryview(data)
    digest = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(
        lo.tolist(), (hi + LENGTH - 1).tolist(), strict=True)), dtype=np.uint64, count=len(lo))
    rows = np.array([r for r, *_ in pieces], dtype=np.int64)
    shift = np.array([s for _, s, _ in pieces], dtype=np.int64) - first
    return (anchor[at[lo]].view(np.int64), digest.view(np.int64), rows[piece], lo + shift[piece], hi + shift[piece])


def _runs(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges in the order of (row, lo), adjoining ones joined."""
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (lo[1:] > hi[:-1])
    begin = np.flatnonzero(new)
    return row[begin], lo[begin], np.maximum.reduceat(hi, begin) if len(begin) else hi


def _find_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per different (anchor, context) of a batch, with how often it
    stands there (1, or 2 for more) and its place; n = 0: a range of strings
    that recur within the batch."""
    for batch in batches:
        d, rk = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        parts = [contexts(p) for p in _pieces(batch.column(2).to_pylist())]
        if not parts:
            continue
        g, ctx, row, lo, hi = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((ctx, g))
        new = np.ones(len(g), dtype=bool)
        new[1:] = (np.diff(g[order]) != 0) | (np.diff(ctx[order]) != 0)
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(g)))
        known = order[np.repeat(count > 1, count)]
        r2, lo2, hi2 = _runs(row[known], lo[known], hi[known])
        one = order[begin]
        n = np.concatenate([np.minimum(count, 2), np.zeros(len(r2), dtype=np.int64)]).astype(np.int32)
        spread = _mixed((rk[r2] + lo2).astype(np.int64).view(np.uint64)).view(np.int64)
        cols = [np.concatenate(x) for x in ((g[one], spread), (ctx[one], np.zeros_like(spread)))]
        rows = np.concatenate([row[one], r2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (*cols, n, d[rows], rk[rows], np.concatenate([lo[one], lo2]),
                                   np.concatenate([hi[one], hi2]))],
            names=["g", "ctx", "n", "d", "rk", "lo", "hi"])


def _judge(t: dict[str, np.ndarray], many: bool) -> dict[str, np.ndarray]:
    """Marks of complete (anchor, context) groups; ``many``: their anchor is
    known to have other contexts."""
    new = np.ones(len(t["g"]), dtype=bool)
    new_g = new.copy()
    new_g[1:] = np.diff(t["g"]) != 0
    new[1:] = new_g[1:] | (np.diff(t["ctx"]) != 0)
    group = np.cumsum(new) - 1
    anchor = np.cumsum(new_g) - 1
    total = np.bincount(group, weights=t["n"])[group]
    several = np.bincount(anchor[new])[anchor] > 1
    several |= many
    dup = (total > 1) & (t["n"] == 1)
    partner = new & (total > 1) & several
    unsure = (total == 1) & several
    take = np.concatenate([np.flatnonzero(x) for x in (dup, unsure, partner)])
    kind = np.repeat(np.array([DUPLICATE, UNSURE, PARTNER], dtype=np.int32), [dup.sum(), unsure.sum(), partner.sum()])
    return {"kind": kind} | {c: t[c][take] for c in ("g", "d", "rk", "lo", "hi")}


def _mark_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from rows in the order of (g, ctx): strings that recur, contexts
    that must be compared, and one place of a context they must be compared
    with.  Holds one batch and the last anchor, or of a long one its last context."""
    def batch_of(marks: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in marks.values()], names=list(marks))

    rest: dict[str, np.ndarray] | None = None
    many = False
    for batch in batches:
        t = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names)}
        known = t["n"] == 0
        if known.any():
            yield batch_of({"kind": np.full(known.sum(), DUPLICATE, dtype=np.int32)}
                           | {c: t[c][known] for c in ("g", "d", "rk", "lo", "hi")})
            t = {c: x[~known] for c, x in t.items()}
        if rest is not None:
            t = {c: np.concatenate([rest[c], t[c]]) for c in t}
        if not len(t["g"]):
            continue
        cut = int(np.searchsorted(t["g"], t["g"][-1], side="left"))
        if cut:  # the anchors before the last one are complete
            first = int(np.searchsorted(t["g"], t["g"][0], side="right")) if many else 0
            if first:
                yield batch_of(_judge({c: x[:first] for c, x in t.items()}, True))
            if first < cut:
                yield batch_of(_judge({c: x[first:cut] for c, x in t.items()}, False))
            many = False
        rest = {c: x[cut:] for c, x in t.items()}
        inner = int(np.searchsorted(rest["ctx"], rest["ctx"][-1], side="left"))
        if inner and len(rest["g"]) > 50_000:  # of a long anchor the last context remains
            yield batch_of(_judge({c: x[:inner] for c, x in rest.items()}, True))
            rest, many = {c: x[inner:] for c, x in rest.items()}, True
        if len(rest["g"]) > 50_000:  # a long context: one place stands for all
            own = rest["n"] == 1
            yield batch_of({"kind": np.full(own.sum(), DUPLICATE, dtype=np.int32)}
                           | {c: rest[c][own] for c in ("g", "d", "rk", "lo", "hi")})
            rest = {c: x[:1].copy() for c, x in rest.items()}
            rest["n"][:] = 2
    if rest is not None and len(rest["g"]):
        yield batch_of(_judge(rest, many))


def _sorted_suffixes(hashes: PrefixHashes, data: np.ndarray, words: np.ndarray, start: np.ndarray,
                     group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``start`` in the order of (group, suffix), and its segments of suffixes
    that share their first 24 bytes.  Inside the segments this is a mergesort,
    all merges of a level at once: each suffix finds its rank in the sibling
    run by binary search, comparing suffixes through their common extension."""
    order = np.lexsort((words[start + 16], words[start + 8], words[start], group))
    start, group = start[order], group[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = ((np.diff(group) != 0) | (words[start[1:]] != words[start[:-1]])
               | (words[start[1:] + 8] != words[start[:-1] + 8]) | (words[start[1:] + 16] != words[start[:-1] + 16]))
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(start)))
    segment = np.cumsum(new) - 1

    def less(p: np.ndarray, q: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        same = hashes.common(p, q, LENGTH)
        whole = same >= LENGTH
        step = np.where(whole, 0, same)
        return np.where(whole, or_equal, data[p + step] < data[q + step])

    width = 1
    while (active := np.flatnonzero(length[segment] > width)).size:
        base, size = begin[segment[active]], length[segment[active]]
        local = active - base
        run = local // width
        sibling = run ^ 1
        low = np.minimum(sibling * width, size)
        high = np.minimum(low + width, size)
        first = low.copy()
        right = (run & 1).astype(bool)
        me = start[active]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            other = start[base[open_] + middle]
            # how many of the sibling stand before me: on a tie the left run is first
            before = less(other, me[open_], right[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        place = base + (run // 2) * 2 * width + (local - run * width) + (low - first)
        merged = start.copy()
        merged[place] = me
        start = merged
        width *= 2
    return start, segment


def recurring(strings: list[bytes], group: np.ndarray) -> list[np.ndarray]:
    """Of each string (all of at least LENGTH bytes) the starts whose LENGTH
    bytes also start elsewhere in the strings of its group."""
    data = np.frombuffer(b"".join(strings) + bytes(32), dtype=np.uint8)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    hashes = PrefixHashes(data)
    n = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(strings)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[owner]
    # strings whose hash is alone in their group recur nowhere
    value = _mixed(hashes.of(start, LENGTH) + group[owner].view(np.uint64) * np.uint64(_BASE))
    order = np.argsort(value, kind="stable")
    alike = np.zeros(len(value), dtype=bool)
    equal = value[order[1:]] == value[order[:-1]]
    alike[order[1:][equal]] = True
    alike[order[:-1][equal]] = True
    start, owner = start[alike], owner[alike]
    words = np.zeros(len(data) - 7, dtype=np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | data[i:len(data) - 7 + i]
    ordered, segment = _sorted_suffixes(hashes, data, words, start, group[owner])
    p, q = ordered[:-1], ordered[1:]
    near = np.flatnonzero((segment[1:] == segment[:-1]) & (hashes.of(p, LENGTH) == hashes.of(q, LENGTH)))
    for offset in range(0, LENGTH, 8):  # equal hashes are confirmed byte by byte
        near = near[words[p[near] + min(offset, LENGTH - 8)] == words[q[near] + min(offset, LENGTH - 8)]]
    found = np.unique(np.concatenate([p[near], q[near]]))
    whose = np.searchsorted(first, found, side="right") - 1
    bounds = np.searchsorted(whose, np.arange(len(strings) + 1))
    return [found[a:b] - first[i] for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]


def _compare_contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of recurring strings in rows ordered by anchor."""
    def result(rows: list[tuple]) -> pa.RecordBatch:
        _, group = np.unique(np.array([r[0] for r in rows], dtype=np.int64), return_inverse=True)
        out: list[list] = [[], [], [], []]
        for row, starts in zip(rows, recurring([r[5] for r in rows], group.astype(np.int64)), strict=True):
            if row[4] == UNSURE and len(starts):
                cuts = np.flatnonzero(np.diff(starts) > 1) + 1
                for run in np.split(starts, cuts):
                    for col, x in zip(out, (row[1], row[2], row[3] + int(run[0]), row[3] + int(run[-1]) + 1), strict=True):
                        col.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in out], names=["d", "rk", "lo", "hi"])

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if size >= CHUNK_BYTES and row[0] != held[-1][0]:
                yield result(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield result(held)


def _digest_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit digests of the strings of contexts, one row each."""
    for batch in batches:
        for _, d, rk, lo, kind, data in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            n = len(data) - LENGTH + 1
            digests = [xxhash.xxh3_128_digest(data[i:i + LENGTH]) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, type=pa.binary()), pa.array([d] * n, type=pa.int64()),
                 pa.array([rk] * n, type=pa.int64()), pa.array(range(lo, lo + n), type=pa.int64()),
                 pa.array([kind] * n, type=pa.int32())], names=["digest", "d", "rk", "at", "kind"])


def _cut_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for d, rk, text, marks in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            for m in marks:
                if m["kind"] != DUPLICATE:
                    for col, x in zip(out, (m["g"], d, rk, m["lo"], m["kind"], text[m["lo"]:m["hi"] + LENGTH - 1]),
                                      strict=True):
                        col.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds, strict=True)],
                                         names=["g", "d", "rk", "lo", "kind", "data"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for d, rk, text, marks, more in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            found = [(m["lo"], m["hi"]) for m in marks if m["kind"] == DUPLICATE]
            found += [(m["lo"], m["hi"]) for m in more or ()]
            removed, spans, kept, at = 0, 0, hashlib.sha256(), 0
            for lo, hi in sorted(found):
                end = hi + LENGTH - 1
                if lo > at or not spans:
                    spans += 1
                    kept.update(text[at:lo])
                    removed += end - lo
                    at = end
                elif end > at:
                    removed += end - at
                    at = end
            kept.update(text[at:])
            for col, x in zip(out, (d, rk, removed, spans, kept.hexdigest()), strict=True):
                col.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds, strict=True)],
                                         names=["d", "rk", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(documents: DataFrame, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """Digest of every document without the bytes that a recurring 200-byte string covers.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and
    kept_sha256 of the remaining bytes.  Strings are judged on the input; a
    string recurs if it starts at any other place, in the same document or
    another one.  Null texts are empty; texts below 200 bytes keep all;
    repeated rows are separate documents, so they remove each other; null
    doc_ids stay null; extra columns are ignored; an empty table gives an
    empty result.

    Contexts are combined per batch before the shuffle by anchor, so a
    passage in very many documents sends one row per batch.  An anchor with
    more than ``hot_contexts`` different contexts is dealt out over all tasks
    by the digests of its strings; the result is the same.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("d"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("rk"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = keyed.mapInArrow(_find_contexts, "g long, ctx long, n int, d long, rk long, lo long, hi long")
    marks = materialize(found.repartition(parts, "g").sortWithinPartitions("g", "ctx").mapInArrow(
        _mark_contexts, MARKS), "marks")

    # the texts that need a second look, with their marks; they cross the wire once whole
    per_row = marks.groupBy("d", "rk").agg(F.collect_list(F.struct("kind", "g", "lo", "hi")).alias("marks"))
    touched = materialize(keyed.join(per_row, ["d", "rk"]), "touched")
    strings = touched.select("d", "rk", "text", "marks").mapInArrow(
        _cut_strings, "g long, d long, rk long, lo long, kind int, data binary")
    hot = marks.where(F.col("kind") != DUPLICATE).groupBy("g").agg(F.count("*").alias("n")).where(
        F.col("n") > hot_contexts).select("g")
    hot = materialize(hot, "hot-anchors")
    ranges = "d long, rk long, lo long, hi long"
    if hot.isEmpty():
        resolved = strings.repartition(parts, "g").sortWithinPartitions("g").mapInArrow(_compare_contexts, ranges)
    else:
        resolved = strings.join(hot, "g", "left_anti").repartition(parts, "g").sortWithinPartitions("g").mapInArrow(
            _compare_contexts, ranges)
        digests = materialize(strings.join(hot, "g", "left_semi").mapInArrow(
            _digest_strings, "digest binary, d long, rk long, at long, kind int"), "digests")
        twice = digests.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
        resolved = resolved.unionByName(
            digests.where(F.col("kind") == UNSURE).join(twice, "digest", "left_semi").select(
                "d", "rk", F.col("at").alias("lo"), (F.col("at") + 1).alias("hi")))
    more = resolved.groupBy("d", "rk").agg(F.collect_list(F.struct("lo", "hi")).alias("more"))
    cut = touched.join(more, ["d", "rk"], "left").select("d", "rk", "text", "marks", "more").mapInArrow(
        _remove, "d long, rk long, n_removed long, n_spans long, kept_sha256 string")
    # equal (d, rk) are equal rows, so any of them tells the result
    cut = cut.where("n_removed > 0").groupBy("d", "rk").agg(
        F.max("n_removed").alias("n_removed"), F.max("n_spans").alias("n_spans"), F.max("kept_sha256").alias("cut_sha"))
    every = keyed.select(
        "d", "rk", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    return every.join(cut, ["d", "rk"], "left").select(
        F.when(F.col("d") != F.lit(-2**63), F.col("d")).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("cut_sha", "sha").alias("kept_sha256"))

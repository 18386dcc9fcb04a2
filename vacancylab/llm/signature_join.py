"""Near-duplicate documents: inverted join of MinHash signature coordinates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialize
from .graph import connected_components

SHINGLE = 5
#: Similarity (intersection over union of the shingle sets) of a link, in percent.
SIMILARITY = 85
#: Coordinates of a signature, and how many of them candidates must share.  A
#: pair at the similarity shares fewer with probability 1e-6.
COORDINATES, MATCHES = 32, 17
#: Documents and shingles of one side of a block that one task compares.
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 4_000_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MUL = np.random.default_rng(20).integers(1, 2**63, (2, 64), dtype=np.uint64) | np.uint64(1)


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a UTF-8 text.

    A-Z are lower-cased, words are runs without ASCII white space; a text of
    fewer than five words has its whole sequence as one shingle, one without
    words has none.
    """
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.full(n, min(len(h), SHINGLE), dtype=np.uint64)
    for j in range(min(len(h), SHINGLE)):
        out = (out ^ h[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Least value (32 bits) of each of the coordinates' hash functions over the set."""
    out = np.empty(coordinates, dtype=np.uint32)
    for j in range(coordinates):
        mixed = (shingles ^ _MUL[1, j]) * _MUL[0, j]
        out[j] = (mixed >> np.uint64(32)).min()
    return out


def _features(coordinates: int, with_set: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, signatures, sets = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_hashes(text.as_py())
                n.append(len(shingles))
                raw = shingles.tobytes()
                digests.append(xxhash.xxh3_128_digest(raw) if len(shingles) else None)
                signatures.append(signature(shingles, coordinates).tobytes() if len(shingles) else None)
                sets.append(raw)
            cols = [batch.column(0), batch.column(2), pa.array(n, type=pa.int64()), pa.array(digests, type=pa.binary()),
                    pa.array(signatures, type=pa.binary())]
            names = ["doc_id", "text_key", "n_shingles", "digest", "signature"]
            if with_set:
                cols.append(pa.array(sets, type=pa.binary()))
                names.append("shingles")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def document_features(documents: DataFrame, coordinates: int = COORDINATES, with_set: bool = False) -> DataFrame:
    """doc_id, key of the text, n_shingles, digest of the set and signature of every document."""
    schema = "doc_id long, text_key binary, n_shingles long, digest binary, signature binary" + ", shingles binary" * with_set
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), _text_key()).mapInArrow(
        _features(coordinates, with_set), schema)


def _text_key():
    """128 bits of a text; a null one counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))).alias("text_key")


def prefix_postings(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(key, rep): postings that can still lead to a pair with ``matches`` equal coordinates.

    Every class is posted under each of its coordinate-value pairs.  Keys
    with one posting lead nowhere.  With the keys in the order of the length
    of their lists, two classes that share ``matches`` of the coordinates
    share one of the first ``coordinates - matches + 1``, so the long lists
    at the end are skipped.
    """
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = (np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, coordinates)
            key = (sig.astype(np.uint64) + salt) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)),
                 batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), coordinates)))],
                names=["key", "rep"])

    postings = classes.select("rep", "signature").mapInArrow(post, "key long, rep long")
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    ordered = postings.join(lists, "key").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys")).where(F.size("keys") >= matches)
    return ordered.select("rep", F.explode(F.slice("keys", F.lit(1), F.size("keys") - matches + 1)).alias("k")).select(
        F.col("k")["key"].alias("key"), "rep")


def _links_of_block(left: list[tuple], right: list[tuple], same: bool, matches: int, similarity: int) -> list[tuple]:
    """Links between documents of two lists of (rep, signature, set), without
    those that follow from links already found (a spanning forest).

    Each document merges its shortest lists; collisions are counted for the
    documents that it meets there and that are not connected with it yet.
    """
    docs = left if same else left + right
    parent = list(range(len(docs)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(d[2]) for d in docs], dtype=np.int64)
    owner = np.repeat(np.arange(len(docs)), sizes)
    values = np.concatenate([d[2] for d in docs])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    signatures = np.stack([d[1] for d in docs])
    coordinates = signatures.shape[1]
    # the block's inverted lists: per coordinate the documents ordered by value, and where each one's list lies
    lists = np.argsort(signatures, axis=0, kind="stable")
    ordered = np.take_along_axis(signatures, lists, axis=0)
    begin, end = np.empty(signatures.shape, dtype=np.int64), np.empty(signatures.shape, dtype=np.int64)
    for j in range(coordinates):
        begin[:, j] = np.searchsorted(ordered[:, j], signatures[:, j], side="left")
        end[:, j] = np.searchsorted(ordered[:, j], signatures[:, j], side="right")
    # sharing ``matches`` coordinates means meeting in one of this many shortest lists; the longest are skipped
    prefix = np.argsort(end - begin, axis=1, kind="stable")[:, : coordinates - matches + 1]
    first_right = 0 if same else len(left)
    roots = np.arange(len(docs))
    links = []
    for a in range(len(left)):
        met = np.concatenate([lists[begin[a, j]:end[a, j], j] for j in prefix[a]])
        root = find(a)
        met = met[(met >= max(a + 1, first_right)) & (roots[met] != root)]
        if not len(met):
            continue
        others = np.unique(met)
        collisions = (signatures[others] == signatures[a]).sum(axis=1)
        found = [b for b in others[collisions >= matches].tolist() if find(b) != root]
        if not found:
            continue
        lo = np.searchsorted(values, docs[a][2], side="left")
        n = np.searchsorted(values, docs[a][2], side="right") - lo
        steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        common = np.bincount(owner[np.repeat(lo, n) + steps], minlength=len(docs))
        for b in found:
            union = sizes[a] + sizes[b] - common[b]
            if 100 * common[b] >= similarity * union and find(a) != find(b):
                parent[find(b)] = find(a)
                links.append((docs[a][0], docs[b][0]))
        if len(links) % 64 == 0 or a % 256 == 0:
            roots = np.fromiter((find(i) for i in range(len(docs))), dtype=np.int64, count=len(docs))
    return links


def near_links(classes: DataFrame, documents: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES,
               similarity: int = SIMILARITY, block_docs: int = BLOCK_DOCS,
               block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links (u, v) between classes of equal shingle sets that connect what
    the similarity connects; every link is confirmed on the full sets.

    ``classes``: rep (a number of its own, so that a doc_id may stand for
    several texts), digest of the set, doc_id (a document that holds the
    text), n_shingles and signature.

    Classes that share a list go to the block of the list's least class, each
    with its whole set and once for all its lists.  A block that is too large
    for one task is dealt into parts and compared part by part, so no task
    holds more than two parts and no rows of pairs are made: a task returns
    at most as many links as it has documents.
    """
    postings = materialize(prefix_postings(classes, coordinates, matches), "postings")
    centers = postings.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where(
        "center < last").drop("last")
    members = postings.join(centers, "key").select("center", "rep").distinct().join(
        classes.select("rep", "n_shingles"), "rep")
    sizes = members.groupBy("center").agg(F.greatest(
        F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n_shingles") / block_shingles)).cast("int").alias("parts"))
    parted = members.join(sizes, "center").withColumn(
        "part", F.pmod(F.xxhash64("rep", "center"), F.col("parts").cast("long")).cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    # part p meets every part q: the task of (min, max) gets both
    placed = materialize(parted.select("center", "rep", "part", F.explode(other).alias("q")).select(
        "center", "rep", "part", F.least("part", "q").alias("p"), F.greatest("part", "q").alias("q")), "blocks")

    placed = placed.join(classes.select("rep", "digest", "doc_id"), "rep")
    texts = documents.select(F.col("doc_id").cast("long"), "text").join(
        placed.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = document_features(texts, coordinates, with_set=True).select(
        "doc_id", "digest", "signature", "shingles")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        sides: dict[bool, dict[int, tuple]] = {True: {}, False: {}}
        p, q = key[1].as_py(), key[2].as_py()
        for rep, part, sig, raw in zip(*(table.column(c).to_pylist() for c in ("rep", "part", "signature", "shingles")),
                                       strict=True):
            sides[part == p][rep] = (rep, np.frombuffer(sig, dtype=np.uint32), np.frombuffer(raw, dtype=np.uint64))
        left, right = ([side[r] for r in sorted(side)] for side in (sides[True], sides[False]))
        links = _links_of_block(left, right, p == q, matches, similarity) if left and (right or p == q) else []
        return pa.table({"u": pa.array([x for x, _ in links], type=pa.int64()),
                         "v": pa.array([x for _, x in links], type=pa.int64())})

    # the set of a class comes from the document that stands for it; repeated rows fall together in the task
    return placed.join(sets, ["digest", "doc_id"]).select("center", "p", "q", "rep", "part", "signature", "shingles").groupBy(
        "center", "p", "q").applyInArrow(compare, "u long, v long")


def _grouped(documents: DataFrame, coordinates: int, matches: int, similarity: int, blocks: dict) -> DataFrame:
    """doc_id, text_key, n_shingles, component (its number; null without shingles) and
    component_id of every row of ``documents``."""
    features = materialize(document_features(documents, coordinates), "features")
    # the numbers are fixed once they are written
    classes = materialize(
        features.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"),
            F.max("signature").alias("signature")).withColumn("rep", F.monotonically_increasing_id()), "classes")
    links = near_links(classes, documents, coordinates, matches, similarity, **blocks)
    components = connected_components(links)
    named = materialize(classes.join(components, classes["rep"] == components["node"], "left").select(
        "digest", "doc_id", F.coalesce("component", "rep").alias("component")), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.select("digest", "component").join(least, "component")
    return features.join(named, "digest", "left").select(
        "doc_id", "text_key", "n_shingles", "component",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def near_duplicates(documents: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES,
                    similarity: int = SIMILARITY, **blocks) -> DataFrame:
    """Component of every document under near-duplicate links.

    Documents link if the intersection of their sets of 5-word shingles is at
    least ``similarity`` percent of the union.  Returns, per row of
    ``documents``: doc_id, n_shingles, component_id (smallest doc_id
    reachable), kept (doc_id = component_id).  Equal sets are one class from
    the start, so copies never meet in pairs.  Null and empty texts and texts
    without words have no shingles and link with nothing; repeated rows are
    copies of each other (each is kept if its doc_id is); rows of one doc_id
    with different texts are documents of their own, each with the smallest
    doc_id that its text reaches; rows without a doc_id are components of
    their own, with a null component, and kept; extra columns are ignored; an
    empty table gives an empty result.
    """
    return _grouped(documents, coordinates, matches, similarity, blocks).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(documents: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES,
                         similarity: int = SIMILARITY, **blocks) -> DataFrame:
    """``documents`` with one document of each component: the one with the
    least doc_id (of several texts under it, the one with the least key).

    A doc_id that stands for different texts is judged text by text.  Of rows
    with equal doc_id and equal text one stays; so does one row for each
    doc_id and text without shingles, and every row without a doc_id.  Extra
    columns are kept, whatever their names.
    """
    rows = materialize(_grouped(documents, coordinates, matches, similarity, blocks).where("doc_id is not null"), "verdicts")
    chosen = rows.where("component is not null").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("k")).select("k.*")
    chosen = chosen.unionByName(rows.where("component is null").select("doc_id", "text_key").distinct())
    whole = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                             _text_key())
    # the chosen ids grow with the documents, so they are never broadcast
    kept = whole.join(chosen.hint("merge"), ["doc_id", "text_key"], "left_semi")
    if not rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text_key"])
    return kept.unionByName(whole.where("doc_id is null").select(*kept.columns)).select("row.*")

"""Near-duplicate vectors: inverted lists of each vector's nearest reference points."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialize
from .graph import connected_components

COSINE = 0.98
#: Reference points: about one per POINTS_PER vectors, within these bounds;
#: chosen from a sample of SAMPLE times as many, no two closer than MAX_BETWEEN.
POINTS_PER, MIN_POINTS, MAX_POINTS, SAMPLE, MAX_BETWEEN = 400, 64, 4096, 4, 0.5
#: A vector is described by its PREFIX nearest points; candidates share MIN_SHARED of them.
PREFIX, MIN_SHARED = 8, 2
#: Vectors of one side of a block that one task compares.
BLOCK = 2048


def usable(embedding: str = "embedding", label: str = "label"):
    """Rows whose vector can link: a label, and finite components that are not all zero."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def reference_points(vectors: np.ndarray, n: int, max_between: float = MAX_BETWEEN) -> np.ndarray:
    """Up to ``n`` of the unit ``vectors`` that lie apart, in their order; where
    too few do, the nearest of the others fill up."""
    chosen: list[int] = []
    closest = np.full(len(vectors), -1.0)
    for i in range(len(vectors)):
        if len(chosen) < n and closest[i] < max_between:
            chosen.append(i)
            closest = np.maximum(closest, vectors @ vectors[i])
    rest = np.setdiff1d(np.arange(len(vectors)), chosen)
    rest = rest[np.argsort(closest[rest], kind="stable")][: n - len(chosen)]
    return vectors[[*chosen, *rest.tolist()]]


def _units(raw: list) -> np.ndarray:
    x = np.array(raw, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _post(points: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _units(batch.column(2).to_pylist())
            k = min(PREFIX, len(points))
            near = np.argsort(-(unit @ points.T), axis=1, kind="stable")[:, :k].astype(np.int32)
            raw = [u.tobytes() for u in unit]
            prefix = [p.tobytes() for p in near]
            at = np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(near.ravel()), batch.column(1).take(pa.array(at)),
                 batch.column(3).take(pa.array(at)), pa.array([raw[i] for i in at], type=pa.binary()),
                 pa.array([prefix[i] for i in at], type=pa.binary())],
                names=["label", "point", "rep", "copies", "unit", "prefix"])
    return run


def _compare(threshold: float, min_shared: int, n_points: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        point, p, q = (key[i].as_py() for i in (1, 2, 3))
        part = table.column("part").to_numpy()
        order = np.lexsort((table.column("rep").to_numpy(), part != p))
        rep, copies, part = (table.column(c).to_numpy()[order] for c in ("rep", "copies", "part"))
        unit = np.stack([np.frombuffer(x, dtype=np.float64) for x in table.column("unit").to_pylist()])[order]
        prefix = np.stack([np.frombuffer(x, dtype=np.int32) for x in table.column("prefix").to_pylist()])[order]
        holds = np.zeros((len(rep), n_points), dtype=np.float32)
        np.put_along_axis(holds, prefix.astype(np.int64), 1.0, axis=1)
        n_left = int((part == p).sum())
        left, right = slice(0, n_left), (slice(0, n_left) if p == q else slice(n_left, None))
        n, root = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))
        if n_left and len(rep[right]):
            shared = holds[left] @ holds[right].T
            linked = (shared >= min_shared) & (unit[left] @ unit[right].T >= threshold)
            if p == q:
                np.fill_diagonal(linked, False)
            # a pair meets once for each shared point; it counts at the least one
            earlier = holds[left, :point] @ holds[right, :point].T
            counted = linked & (earlier == 0)
            n[left] += counted @ copies[right]
            if p != q:
                n[right] += counted.T @ copies[left]
            while True:  # least neighbour, again and again
                best = root.copy()
                best[left] = np.minimum(best[left], np.where(linked, root[right][None, :], len(rep)).min(axis=1))
                best[right] = np.minimum(best[right], np.where(linked.T, root[left][None, :], len(rep)).min(axis=1))
                best = best[best]
                if (best == root).all():
                    break
                root = best
        found = (n > 0) | (root != np.arange(len(rep)))
        return pa.table({"rep": rep[found], "n": n[found], "root": rep[root][found]})
    return run


def near_vectors(embeddings: DataFrame, threshold: float = COSINE, prefix_shared: int = MIN_SHARED,
                 points_per: int = POINTS_PER, block: int = BLOCK) -> DataFrame:
    """Links and components of vectors of the same label by cosine.

    Every vector is described by its nearest reference points, in order, and
    posted in their inverted lists (one per label and point).  Within a list,
    pairs that share at least ``prefix_shared`` points are verified in double
    precision; long lists are dealt into parts that meet block by block, and
    tasks return counts and roots per vector, never pairs.  The points come
    from a bounded sample (at most MAX_POINTS x SAMPLE vectors, the only ones
    that reach the driver); every vector is indexed.

    Returns, per row: vec_id, n_links (other rows linked directly),
    component_id (smallest vec_id reachable), kept (vec_id = component_id).
    Equal vectors of a label are one class with a count, so copies do not meet
    in pairs.  Vectors without a label, or null, empty, zero or with null or
    non-finite components link with nothing; vectors of other lengths link
    only among themselves; repeated rows are copies; rows without a vec_id
    link with nothing and are kept with a null component; extra columns are
    ignored; an empty table gives an empty result.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), "label", "embedding").withColumn(
        "ok", usable() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    classes = materialize(rows.where("ok").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    results = []
    for dim, n in sorted(map(tuple, classes.groupBy(F.size("embedding")).count().collect())):
        same = classes.where(F.size("embedding") == dim)
        n_points = int(min(MAX_POINTS, max(MIN_POINTS, 2 ** math.ceil(math.log2(max(1, n / points_per))))))
        sample = same.orderBy(F.xxhash64("rep"), "rep").limit(n_points * SAMPLE).select("embedding").collect()
        points = reference_points(_units([r[0] for r in sample]), n_points)
        kind = same.schema["label"].dataType.simpleString()
        postings = same.select("label", "rep", "embedding", "copies").mapInArrow(
            _post(points), f"label {kind}, point int, rep long, copies long, unit binary, prefix binary")
        sizes = postings.groupBy("label", "point").agg(F.count("*").alias("n")).where("n > 1").select(
            "label", "point", F.ceil(F.col("n") / block).cast("int").alias("parts"))
        parted = postings.join(sizes, ["label", "point"]).withColumn(
            "part", F.pmod(F.xxhash64("rep"), F.col("parts").cast("long")).cast("int"))
        placed = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            "label", "point", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
            "rep", "copies", "unit", "prefix", "part")
        results.append(placed.groupBy("label", "point", "p", "q").applyInArrow(
            _compare(threshold, prefix_shared, len(points)), "rep long, n long, root long"))
    spark = embeddings.sparkSession
    found = spark.createDataFrame([], "rep long, n long, root long")
    for result in results:
        found = found.unionByName(result)
    found = materialize(found, "links")
    components = connected_components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    named = classes.join(components, classes["rep"] == components["node"], "left").join(counts, "rep", "left").select(
        "label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "rep").alias("component"))
    good = rows.where("ok").join(named, ["label", "embedding"]).select("vec_id", "n", "component")
    bad = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("component"))
    return good.unionByName(bad).select(
        "vec_id", F.col("n").alias("n_links"), F.col("component").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))

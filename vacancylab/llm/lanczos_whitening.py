"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The distinct integer vectors are written once and read by every product.  One
step takes two passes over them: ``y = X v - beta u`` with its products against
all left vectors so far, then ``X'u`` after reorthogonalisation.  Left vectors
are as long as the corpus and never leave the tasks: each is ``X p`` for a short
vector ``p`` that the driver keeps, so a task makes the entries for its rows
anew from ``P``.  Both sides are reorthogonalised in full, twice.  The driver
holds vectors of the embedding's length only and takes the SVD of the small
bidiagonal matrix.

Products are summed per block of rows, then by Spark per position, so nothing
longer than a row comes back.  A Krylov space finds one vector of each
repeated singular value: when it is exhausted, or when all wanted components
have converged, a fresh start vector orthogonal to the right vectors is taken;
after convergence its whole new space must leave the wanted values unchanged.

Odd input.  Rows whose vector is null, or holds null, NaN or infinite entries,
have no result, nor have vectors whose length is not the commonest one (of
equally common ones the longest) and empty vectors.  Repeated vectors count
once in the fit and each has its result rows.  Directions without variance
have no component: one distinct vector alone gives no rows, as does an empty
table.  Entries beyond 2**46 count as 2**46.  ``deviation`` is null where it
does not fit a long.  A null vec_id and repeated ones are kept.  Columns
beyond vec_id and embedding are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import materialize

SCALE, SHIFT, LARGEST = 64.0, 1_000_000, 2.0**46
COMPONENTS = 16
#: Rows of a block in a task.
BLOCK_ROWS = 65_536
#: Share of the largest singular value below which a residual counts as zero.
TOLERANCE = 1e-14
#: Share of the largest singular value below which a direction has no variance.
NO_VARIANCE = 1e-10

RESULT = "vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the integer vectors of the rows that have one."""
    entries = F.col("embedding")
    whole = entries.isNotNull() & (F.size(entries) > 0) & F.forall(
        entries, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))

    def integer(c: Column) -> Column:
        bounded = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double")))
        return F.floor(bounded * F.lit(SCALE)) + F.lit(SHIFT)

    made = embeddings.where(whole).select("vec_id", F.transform(entries, integer).alias("x"))
    lengths = made.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    length = lengths.agg(F.max(F.struct("n", "d"))["d"].alias("d")).first()["d"]
    return made.where(F.size("x") == F.lit(length)) if length else made


def _matrix(batch: pa.RecordBatch, at: int, d: int, rows: int = BLOCK_ROWS) -> np.ndarray:
    return batch.column("x").slice(at, rows).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(fit: DataFrame, d: int, product) -> np.ndarray:
    """The sum over all blocks of ``product(x)``, a flat array of bounded length, added up per position by Spark."""
    def partial(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                made = product(_matrix(batch, at, d))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["part"])

    rows = (fit.select("x").mapInArrow(partial, "part array<double>").select(F.posexplode("part"))
            .groupBy("pos").agg(F.sum("col").alias("s")).collect())
    out = np.zeros(len(rows))
    for r in rows:
        out[r["pos"]] = r["s"]
    return out


def _exact_sums(fit: DataFrame, d: int) -> list[int]:
    """Sums per dimension; 256 entries of at most 2**53 fit a long, what is beyond is added in Python's integers."""
    def partial(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                made = _matrix(batch, at, d, 256).sum(axis=0).astype(object)
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[str(t) for t in total]], pa.list_(pa.string()))], ["part"])

    rows = (fit.select("x").mapInArrow(partial, "part array<string>").select(F.posexplode("part"))
            .groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect())
    return [int(r["s"]) for r in sorted(rows, key=lambda r: r["pos"])]


class CentredRows:
    """The fit list as the rows of a centred matrix X; products with it run as Spark jobs."""

    def __init__(self, fit: DataFrame):
        self.fit, self.n = fit, fit.count()
        self.d = len(fit.first()["x"]) if self.n else 0
        self.sums = _exact_sums(fit, self.d) if self.n else []

    def centring(self):
        """x -> x - S/n: the whole part of the mean is taken off the integers, then the rest."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return lambda x: (x - whole).astype(np.float64) - rest

    def forward(self, v: np.ndarray, p_all: np.ndarray) -> np.ndarray:
        """U'Xv with the left vectors U = X P."""
        centred = self.centring()

        def product(x):
            m = centred(x)
            return (m @ p_all).T @ (m @ v)
        return _summed(self.fit, self.d, product) if p_all.shape[1] else np.zeros(0)

    def backward(self, p: np.ndarray, p_all: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """X'u, U'u and u'u for u = X p."""
        centred, d = self.centring(), self.d

        def product(x):
            m = centred(x)
            u = m @ p
            return np.concatenate([m.T @ u, (m @ p_all).T @ u, [u @ u]])
        out = _summed(self.fit, d, product)
        return out[:d], out[d:-1], float(out[-1])

    def variance(self) -> float:
        """Trace of X'X."""
        centred = self.centring()
        return float(_summed(self.fit, self.d, lambda x: np.array([np.square(centred(x)).sum()]))[0])


def bidiagonalise(rows: CentredRows, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors of X (columns) and singular values, largest first: the wanted ones have converged."""
    d, rng = rows.d, np.random.default_rng(seed)
    v_all, p_all, g_all = (np.zeros((d, 0)) for _ in range(3))  # V, P with U = X P, X'U
    alphas: list[float] = []
    betas: list[float] = []
    block, before = 0, None  # where the last fresh start is; the wanted values at that start

    def fresh() -> np.ndarray:
        w = rng.standard_normal(d)
        for _ in range(3):
            w -= v_all @ (v_all.T @ w)
            w /= np.linalg.norm(w)
        return w

    v = fresh()
    while True:
        p = v - p_all @ rows.forward(v, p_all)
        g, again, square = rows.backward(p, p_all)
        p, g = p - p_all @ again, g - g_all @ again
        alpha = float(np.sqrt(max(square - again @ again, 0.0)))
        scale = max(alpha, *alphas, *betas) if alphas else alpha
        v_all = np.column_stack([v_all, v])
        if alpha <= NO_VARIANCE * scale:  # X v adds nothing to the span of U
            alpha, p, g, w = 0.0, np.zeros(d), np.zeros(d), np.zeros(d)
        else:
            p, g = p / alpha, g / alpha
            w = g - alpha * v
            for _ in range(2):
                w -= v_all @ (v_all.T @ w)
        p_all, g_all = np.column_stack([p_all, p]), np.column_stack([g_all, g])
        beta = float(np.linalg.norm(w))
        alphas.append(alpha)
        left, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        k = len(alphas)
        if k == d:
            return v_all @ right.T, values
        residuals = beta * np.abs(left[-1])
        done = k >= wanted and bool((residuals[:wanted] <= TOLERANCE * scale).all())
        if done and before is not None:
            newest = np.linalg.svd(np.diag(alphas[block:]) + np.diag(betas[block:], 1))
            settled = beta * abs(newest[0][-1, 0]) <= 1e-3 * max(newest[1][0], NO_VARIANCE * scale)
            if settled and np.allclose(values[:wanted], before, rtol=1e-12, atol=NO_VARIANCE * scale):
                return v_all @ right.T, values
        if beta <= TOLERANCE * scale or done and before is None:
            before, block, beta, v = values[:wanted] if done else None, k, 0.0, fresh()
        else:
            v = w / beta
        betas.append(beta)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: its whitened coordinate, with the fit's figures beside it."""
    spark = embeddings.sparkSession
    schema = RESULT.format(kind=embeddings.schema["vec_id"].dataType.simpleString())
    vectors = materialize(usable_vectors(embeddings), "vectors")
    rows = CentredRows(materialize(vectors.select("x").distinct(), "fit"))
    n, d, sums = rows.n, rows.d, rows.sums
    if n < 2:
        return spark.createDataFrame([], schema)
    basis, values = bidiagonalise(rows, min(components, d))
    kept = int((values[:components] > NO_VARIANCE * values[0]).sum()) if values[0] > 0 else 0
    basis, spread = basis[:, :kept], values[:kept] / np.sqrt(n)  # deviations along the components
    explained = (values[:kept] ** 2 / rows.variance()).tolist()
    centred = rows.centring()

    def moments(x):
        z = centred(x) @ basis / spread
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
    found = _summed(rows.fit, d, moments)
    mean = found[:kept] / n
    error = float(np.abs(found[kept:].reshape(kept, kept) / n - np.outer(mean, mean) - np.eye(kept)).max())

    def deviations(x: np.ndarray, m: np.ndarray) -> list:
        about = np.square(m).sum(axis=1) * float(n) ** 2
        if about.max() < 2.0**61 and float(np.abs(x).max()) * n < 2.0**61:
            return np.square(x * n - np.array(sums, dtype=np.int64)).sum(axis=1).tolist()
        exact = (sum((n * int(e) - s) ** 2 for e, s in zip(row, sums, strict=True)) for row in x)
        return [e if e < 2**63 else None for e in exact]

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = _matrix(batch, at, d, 4096)
                m = centred(x)
                size = len(x)
                each = pa.array(np.repeat(np.arange(size), kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, 4096).take(each),
                     pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), size)),
                     pa.array(np.full(size * kept, n)), pa.array(deviations(x, m), pa.int64()).take(each),
                     pa.array((m @ basis / spread).ravel()), pa.array(np.tile(explained, size)),
                     pa.array(np.full(size * kept, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return vectors.mapInArrow(project, schema)

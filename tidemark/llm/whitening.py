"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, each distinct one goes once into a fit table of packed blocks, and the leading eigenvectors of
its covariance V come from products V Q alone: every product is a pass over the blocks, as centred X^T (X Q), summed by entry.
A block Q of a few more columns than components is filtered by Chebyshev polynomials of V that damp the spectrum below the
block's least Ritz value, made orthonormal by QR, and rotated by Rayleigh-Ritz, until the residuals of the wanted pairs are
as small as double precision lets them be. The driver holds matrices of dimension x block, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.work import Scratch
from .names import free_prefix

COMPONENTS, GUARD, DEGREE, TOLERANCE, MOST_PASSES = 16, 24, 10, 2e-14, 400
SCALE, SHIFT = 64, 1_000_000
_LARGEST = float(1 << 50)
_ROWS = 4096


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of each entry; 64 c is held within 2^50 either way, so sums of blocks stay exact."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(_LARGEST)), F.lit(-_LARGEST))) + SHIFT)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))


@dataclass
class Whitening:
    """A fit: rows n, sums S, components as columns, their eigenvalues, trace, largest error of the whitened covariance, and
    the residuals that certify the pairs, as shares of the largest eigenvalue."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residuals: np.ndarray
    passes: int


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S exactly: int64 where that holds it, else Python's numbers."""
    widest = max([int(np.abs(x).max()) if x.size else 0, 1]) * n + max(map(abs, sums), default=0)
    return x * np.int64(n) - np.array(sums, np.int64) if widest < 1 << 62 else x.astype(object) * n - np.array(sums, object)


def _packed(vectors: DataFrame) -> DataFrame:
    """Rows ``x`` as blocks: row count, sums of the columns, and the numbers as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.column(0).slice(lo, _ROWS)
                x = part.flatten().to_numpy().reshape(len(part), -1)
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([x.sum(axis=0)], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["rows", "sums", "block"])

    return vectors.select("x").mapInArrow(pack, "rows long, sums array<long>, block binary")


def _sum_of_passes(blocks: DataFrame, n: int, sums: list[int], work, height: int, width: int) -> np.ndarray:
    """The sum, over all blocks, of ``work(centred rows)``, a matrix. Tasks add up their blocks; entries are then summed by index."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, d)
                total += work(centred(x, n, sums).astype(np.float64) / n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["i", "v"])

    rows = blocks.select("block").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(height * width)
    out[rows["i"].to_numpy()] = rows["v"].to_numpy()
    return out.reshape(height, width)


def leading_pairs(apply, d: int, k: int, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE, most: int = MOST_PASSES, seed: int = 7):
    """The k leading eigenvalues and vectors of a symmetric positive operator ``apply`` (matrix to matrix) of dimension d, the
    residuals' norms over the largest eigenvalue, and the number of products. Ends when all residuals are below
    ``tolerance``, or don't get smaller any more within three rounds below 1e-10; else an error after ``most`` products."""
    m, used = min(d, k + guard), 1
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, m)))[0]
    vq, best, stale = apply(q), np.inf, 0
    kept = None
    while True:
        h = q.T @ vq
        theta, w = np.linalg.eigh((h + h.T) / 2)
        theta, w = theta[::-1], w[:, ::-1]
        q, vq = q @ w, vq @ w
        top = max(theta[0], 0.0)
        if top == 0.0:
            return np.zeros(k), q[:, :k], np.zeros(k), used
        residuals = np.linalg.norm(vq - q * theta, axis=0) / top
        worst = residuals[:k].max()
        if worst < best:
            kept = theta[:k].copy(), q[:, :k].copy(), residuals[:k].copy()
        stale = 0 if worst < best / 2 else stale + 1
        best = min(best, worst)
        if best <= tolerance or m == d and stale >= 1 or best < 1e-10 and stale >= 3:
            return *kept, used
        if used + degree > most:
            raise ArithmeticError(f"residual {best:.1e} of the largest eigenvalue after {used} passes")
        low = max(theta[-1], 0.0)
        if m == d or low <= 1e-13 * top:  # the block holds the whole range: plain steps keep it
            y = vq
        else:
            e = c = low / 2  # the unwanted spectrum lies in [0, low]
            sigma = first = e / (top - c)
            before, y = q, (vq - c * q) * (sigma / e)
            for _ in range(degree - 1):
                after = 1 / (2 / first - sigma)
                before, y = y, (apply(y) - c * y) * (2 * after / e) - before * (sigma * after)
                sigma, used = after, used + 1
        q = np.linalg.qr(y)[0]
        vq, used = apply(q), used + 1


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, scratch: Scratch | None = None) -> Whitening | None:
    """The fit over distinct ``x`` (arrays of one length); None where there are none. Components whose eigenvalue is below
    1e-12 of the largest aren't there: the vectors have no such direction."""
    scratch = scratch or Scratch(vectors.sparkSession)
    blocks = scratch.keep(_packed(vectors.select("x").distinct()))
    whole = "decimal(38,0)"
    totals = blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast(whole)).alias("s")).collect()
    n = blocks.agg(F.sum("rows")).first()[0]
    if not n:
        return None
    sums = [int(r["s"]) for r in sorted(totals, key=lambda r: r["i"])]
    d = len(sums)
    trace = float(_sum_of_passes(blocks, n, sums, lambda x: np.array([[np.square(x).sum()]]), 1, 1)[0, 0]) / n if d else 0.0
    if trace == 0.0:
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, np.zeros(0), 1)

    def apply(q: np.ndarray) -> np.ndarray:
        return _sum_of_passes(blocks, n, sums, lambda x: x.T @ (x @ q), d, q.shape[1]) / n

    values, vecs, residuals, passes = leading_pairs(apply, d, min(components, d))
    there = values > 1e-12 * values[0]
    values, vecs, residuals = values[there], vecs[:, there], residuals[there]
    k = len(values)
    scaled = vecs / np.sqrt(values)

    def check(x: np.ndarray) -> np.ndarray:
        w = x @ scaled
        return np.concatenate([w.T @ w, w.sum(axis=0)[None]])

    got = _sum_of_passes(blocks, n, sums, check, k + 1, k) / n
    error = np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max()
    return Whitening(n, sums, vecs, values, trace, float(error), residuals, passes + 2)


def prepared(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, str]:
    """Usable rows with their whole numbers in a new column, and its name. Of vectors of several lengths, the commonest length
    stays (of equally common ones the longest): others can't have a covariance with them."""
    name = free_prefix(vectors) + "x"
    rows = vectors.where(usable(F.col(vector))).withColumn(name, whole_numbers(F.col(vector)))
    first = rows.groupBy(F.size(name).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size(name) == (first["d"] if first else 0)), name


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, fit: Whitening | None = None) -> DataFrame:
    """``vectors``, without rows that have no usable vector, and ``_whitened`` (one double a component), ``_deviation`` (the
    sum over dimensions of (n x - S)^2, exact; null beyond a long), ``_n``, ``_explained`` (array) and ``_identity_error``.

    Dropped: null vectors, vectors with null, NaN or infinite entries, vectors of another length than most. Repeated vectors
    count once in the fit and are all returned. An empty table, or one without usable vectors, gives no rows; if all vectors
    are equal, ``_whitened`` is empty, and of a rank below ``components`` it has as many entries as the rank. Equal
    eigenvalues leave their components' common rotation to the fit. Existing columns lead to names with more underscores.
    Where nothing is given as ``fit``, it is made here: some dozens of passes over the distinct vectors.
    """
    rows, x = prepared(vectors, vector)
    fit = fit or fit_whitening(rows.select(F.col(x).alias("x")), components)
    p, names = free_prefix(vectors), vectors.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    schema = f"{fields}, {p}n long, {p}deviation long, {p}whitened array<double>, {p}explained array<double>, {p}identity_error double"
    if fit is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, scaled = fit.n, fit.sums, fit.vectors / np.sqrt(fit.values)
    explained, error, at = (fit.values / fit.trace if fit.trace else fit.values).tolist(), fit.identity_error, len(names)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = centred(batch.column(at).flatten().to_numpy().reshape(batch.num_rows, -1), n, sums)
            if z.dtype != object and z.size and float(np.square(z.astype(np.float64)).sum(axis=1).max()) >= 2.0**62:
                z = z.astype(object)
            squares = (z * z).sum(axis=1) if z.size else np.zeros(batch.num_rows, np.int64)
            deviation = pa.array([int(v) if v < 1 << 63 else None for v in squares], pa.int64())
            w = (z.astype(np.float64) / n) @ scaled
            made = [pa.array([n] * len(w), pa.int64()), deviation, pa.array(list(w), pa.list_(pa.float64())), pa.array([explained] * len(w), pa.list_(pa.float64())), pa.array([error] * len(w), pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *made], [*names, *[p + c for c in ("n", "deviation", "whitened", "explained", "identity_error")]])

    return rows.select(*names, x).mapInArrow(project, schema)

"""Embedding whitening: pivoted Cholesky, then one-sided Jacobi.

Each vector is rounded to integers x = floor(256 c). The fit list is each
distinct x once; its size n, its sums S per dimension and its centred scatter
A = sum (x - S/n)(x - S/n)^T come from one pass each over that list, in blocks
inside the tasks and by partial sums between them. A pivoted Cholesky
factorisation gives A = L L^T, with as many columns as A has rank. Rotations
that make the columns of L orthogonal to each other (one-sided Jacobi) turn it
into U diag(s): the squared column norms s^2 are A's eigenvalues, the normalised
columns U its eigenvectors, the components. No product of L with itself is ever
formed, so small eigenvalues keep their digits. The driver holds A alone, whose
size is that of the dimension, whatever the number of vectors.

Defined results: a vector is left out if it is null or empty, holds a null or
an entry that is not finite (or too large for a long), or has not the
commonest length (of two, the longer one). Repeated rows are whitened each, but
fitted once. A component beyond the rank (copies of one vector have rank 0) has
``explained`` 0 and a null ``whitened``; ``identity_error`` is that of the other
components, null without any. ``deviation`` is null where a long cannot hold
it. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import written

SCALE = 256.0
COMPONENTS = 4
#: Largest dimension: the scatter on the driver has its square (32 MB there).
MAX_DIMENSION = 2048
#: Entries of the blocks that tasks work on at once.
BLOCK_ENTRIES = 1 << 20

#: Largest double below 2^63.
_LONG = float(2 ** 63 - 1024)


# ------------------------------------------------------------------ algebra

def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (d x rank) with L L^T = ``a``, the largest remaining diagonal entry
    first; it stops where that is rounding error of the trace."""
    a = a.copy()
    left = np.diag(a).copy()
    d = len(a)
    floor = np.finfo(float).eps * d * max(float(left.max(initial=0.0)), 0.0)
    out = np.zeros((d, d))
    open_rows = np.ones(d, bool)
    for k in range(d):
        pivot = int(np.argmax(np.where(open_rows, left, -np.inf)))
        if not left[pivot] > floor:
            return out[:, :k]
        column = a[:, pivot] - out[:, :k] @ out[pivot, :k]
        column /= np.sqrt(left[pivot])
        column[~open_rows] = 0.0
        column[pivot] = np.sqrt(left[pivot])
        out[:, k] = column
        open_rows[pivot] = False
        left -= column ** 2
    return out


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs (a round robin)."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:len(ring) // 2], reversed(ring[len(ring) // 2:]))
                 if max(a, b) < n]
        out.append(tuple(np.array(x, np.int64) for x in zip(*[(min(p), max(p)) for p in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return [r for r in out if r]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Rotate the columns of ``factor`` until they are orthogonal; return their
    squared norms, falling, and the normalised columns."""
    w = factor.copy()
    eps = np.finfo(float).eps
    rounds = _rounds(w.shape[1])
    for _ in range(sweeps):
        moved = False
        for i, j in rounds:
            x, y = w[:, i], w[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > eps * np.sqrt(xx * yy)
            if not turn.any():
                continue
            moved = True
            i, j, x, y = i[turn], j[turn], x[:, turn], y[:, turn]
            zeta = (yy[turn] - xx[turn]) / (2.0 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1.0 / np.hypot(1.0, t)
            s = c * t
            w[:, i], w[:, j] = c * x - s * y, s * x + c * y
        if not moved:
            break
    norms = (w * w).sum(0)
    order = np.argsort(-norms, kind="stable")
    return norms[order], w[:, order] / np.sqrt(norms[order])


# ------------------------------------------------------------------- vectors

def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each list of the column and its entries as doubles, nulls as NaN."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64())
    return offsets, values.to_numpy(zero_copy_only=False)


def _whole(offsets: np.ndarray, values: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Which rows are vectors of entries that become longs."""
    with np.errstate(over="ignore", invalid="ignore"):
        bad = np.concatenate(([0], np.cumsum(~(np.abs(values * SCALE) < _LONG))))
    n = np.diff(offsets)
    return valid & (n > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])


def _valid(column: pa.Array) -> np.ndarray:
    return column.is_valid().to_numpy(zero_copy_only=False)


def rounded(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the vectors of length ``d``, and their x as (rows, d) longs."""
    offsets, values = _entries(column)
    rows = np.flatnonzero(_whole(offsets, values, _valid(column)) & (np.diff(offsets) == d))
    if not len(rows):
        return rows, np.zeros((0, d), np.int64)
    c = values[offsets[rows][:, None] + np.arange(d)]
    return rows, np.floor(c * SCALE).astype(np.int64)


def _slices(batch: pa.RecordBatch, d: int) -> Iterator[pa.RecordBatch]:
    step = max(1, BLOCK_ENTRIES // d)
    for lo in range(0, batch.num_rows, step):
        yield batch.slice(lo, step)


def _dimension(vectors: DataFrame) -> int | None:
    """The commonest length of the usable vectors."""
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, values = _entries(batch.column(0))
            n, count = np.unique(np.diff(offsets)[_whole(offsets, values, _valid(batch.column(0)))],
                                 return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), pa.array(count.astype(np.int64))],
                                             names=["d", "n"])

    found = (vectors.mapInArrow(lengths, "d bigint, n bigint").groupBy("d").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), F.desc("d")).first())
    return found["d"] if found else None


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    column = batch.column(0)
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0]:offsets[-1]].reshape(-1, d)


# ----------------------------------------------------------------------- fit

@dataclass(frozen=True)
class Whitening:
    """What whitening needs of the fit list."""

    n: int
    sums: list[int]            # S, exact
    trace: float               # of the covariance
    values: np.ndarray         # eigenvalues of the components, falling
    components: np.ndarray     # (dimension, components), unit columns

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (x - mean) @ self.components / np.sqrt(self.values)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """n, and S exactly."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch, d)
            n += len(x)
            # halves of 32 bits cannot overflow a long in a batch
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n, np.int64)),
                 pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["at", "n", "s"])

    rows = (fit.mapInArrow(add, "at int, n bigint, s decimal(38, 0)").groupBy("at")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # one row a dimension
    by = {r["at"]: r for r in rows}
    return (by[0]["n"], [int(by[i]["s"]) for i in range(d)]) if by else (0, [0] * d)


def _scatter(fit: DataFrame, d: int, value: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of value(x) value(x)^T over the fit list; one row an entry of the
    matrix reaches the driver, and one per task the shuffle."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for part in _slices(batch, d):
                y = value(_matrix(part, d))
                total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width, dtype=np.int32)), pa.array(total.ravel())], names=["at", "v"])

    rows = (fit.mapInArrow(multiply, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
            .toArrow())
    out = np.zeros(width * width)
    out[rows.column("at").to_numpy()] = rows.column("v").to_numpy()
    return out.reshape(width, width)


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> tuple[Whitening, float | None]:
    """The whitening of a table of distinct x, and its error on that table."""
    n, sums = _sums(fit, d)
    mean = np.array([s / n for s in sums])
    scatter = _scatter(fit, d, lambda x: x - mean, d)
    norms, columns = one_sided_jacobi(pivoted_cholesky((scatter + scatter.T) / 2))
    k = min(components, len(norms))
    model = Whitening(n, sums, float(np.trace(scatter)) / n, norms[:k] / n, columns[:, :k])
    if not k:
        return model, None
    # Whitened over the fit list: its own means first, then centred products.
    ones = _scatter(fit, d, lambda x: np.concatenate((model.project(x), np.ones((len(x), 1))), axis=1), k + 1)
    own_mean = ones[k, :k] / n
    spread = _scatter(fit, d, lambda x: model.project(x) - own_mean, k) / n
    return model, float(np.abs(spread - np.eye(k)).max())


# --------------------------------------------------------------------- apply

def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exact; None beyond a long."""
    d = x.shape[1]
    largest = n * float(np.abs(x).max(initial=0)) + max(abs(float(s)) for s in sums)
    if largest * largest * d < _LONG:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 2 ** 63 else None for v in exact]


RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, see the module's text."""
    spark = vectors.sparkSession
    read = vectors.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
                          F.col(f"`{id_col}`").cast("bigint").alias("vec_id"))
    d = _dimension(read.select("v"))
    if d is None:
        return spark.createDataFrame([], RESULT)
    if d > MAX_DIMENSION:
        raise ValueError(f"vectors of {d} dimensions; the scatter is kept for at most {MAX_DIMENSION}")

    def to_x(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, d):
                _, x = rounded(part.column(0), d)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, x.size + 1, d, dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([lists], names=["x"])

    fit = written(read.select("v").mapInArrow(to_x, "x array<bigint>").distinct(), "whitening-fit")
    model, error = fit_whitening(fit, d, components)
    width = min(components, d)
    explained = np.zeros(width)
    explained[:len(model.values)] = model.values / model.trace if model.trace else 0.0

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, d):
                rows, x = rounded(part.column(0), d)
                m = len(rows)
                white = np.full((m, width), np.nan)
                white[:, :len(model.values)] = model.project(x)
                yield pa.RecordBatch.from_arrays([
                    part.column(1).take(pa.array(np.repeat(rows, width))),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * width, model.n, np.int64)),
                    pa.array([v for v in deviations(x, model.n, model.sums) for _ in range(width)], pa.int64()),
                    pa.array(white.ravel(), from_pandas=True),
                    pa.array(np.tile(explained, m)),
                    pa.array([error] * (m * width), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return read.mapInArrow(project, RESULT)

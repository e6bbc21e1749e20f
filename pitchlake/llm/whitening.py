"""Whitening of embeddings by their leading principal components.

One pass sums the vectors exactly, one adds up the centred products (a matrix a task, added by rows in two
levels), and the driver, which holds one square matrix of the vectors' length, finds the leading eigenpairs: Householder
tridiagonalisation, bisection by Sturm counts, inverse iteration with the vectors of a cluster made orthogonal
to each other. The components are broadcast (length times ``COMPONENTS``), and rows are projected where they are read. A
third sum measures the covariance of what comes out.

An entry c counts as the whole number floor(64 c) + 1 000 000. Sums and the deviation are exact.

Defined results
    A vector that is null, or holds a null or non-finite entry, or one beyond ``LARGEST`` in size, takes no part. Of
    vectors of several lengths only those of the most common length do (of two such, the longer). Null ids and
    repeated rows take part like others. Components with an eigenvalue that is zero but for rounding are left
    out, as are those beyond the length; equal vectors only, empty vectors or no rows: no rows. Deviations are
    exact up to 38 digits. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
LARGEST = 2.0**45  # of an entry, so that its whole number is exact in a double
COMPONENTS = 32
BLOCK = 1 << 20  # entries of vectors handled together
GROUP = 32  # partial sums added in one task
EPSILON = np.finfo(float).eps


# ---- Eigenpairs of a symmetric matrix -------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the reflections (first row, unit vector) of Householder's reduction."""
    a = matrix.astype(float, copy=True)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        if not np.any(v[1:]):
            continue
        kept = -np.copysign(np.linalg.norm(v), v[0])
        v[0] -= kept
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] = 0
        a[k + 1, k] = kept
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def smaller(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value, how many eigenvalues lie below it: the negative pivots of its Sturm sequence."""
    least = EPSILON * EPSILON * max(np.abs(off).max(initial=0) ** 2, np.finfo(float).tiny / EPSILON**2)
    count = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for i in range(len(diagonal)):
        pivot = diagonal[i] - at - (off[i - 1] ** 2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest ``count`` eigenvalues, falling, each halved down to neighbouring doubles."""
    n = len(diagonal)
    reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low, high = np.full(count, (diagonal - reach).min()), np.full(count, (diagonal + reach).max())
    wide = max(abs(low[0]), abs(high[0]), np.finfo(float).tiny)
    low, high = low - 4 * EPSILON * wide, high + 4 * EPSILON * wide
    wanted = n - 1 - np.arange(count)  # as many eigenvalues lie below the wanted one
    for _ in range(128):
        middle = low + (high - low) / 2
        below = smaller(diagonal, off, middle) <= wanted
        stuck = (middle <= low) | (middle >= high)
        if stuck.all():
            break
        low, high = np.where(below & ~stuck, middle, low), np.where(~below & ~stuck, middle, high)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - value) x = right by elimination with row exchanges; tiny pivots become ``least``."""
    n = len(diagonal)
    pivots = []
    a, b, x = diagonal[0] - value, off[0] if n > 1 else 0.0, right[0]
    for i in range(n - 1):
        under, d, e, y = off[i], diagonal[i + 1] - value, off[i + 1] if i + 2 < n else 0.0, right[i + 1]
        if abs(a) >= abs(under):
            a = a if abs(a) > least else least
            factor = under / a
            pivots.append((a, b, 0.0, x))
            a, b, x = d - factor * b, e, y - factor * x
        else:
            factor = a / under
            pivots.append((under, d, e, y))
            a, b, x = b - factor * d, -factor * e, x - factor * y
    out = np.zeros(n + 2)
    out[n - 1] = x / (a if abs(a) > least else least)
    for i in range(n - 2, -1, -1):
        p, q, r, y = pivots[i]
        out[i] = (y - q * out[i + 1] - r * out[i + 2]) / p
        if abs(out[i]) > 1e150:  # only the direction counts
            out *= 1e-150
            pivots[:i] = [(*row[:3], row[3] * 1e-150) for row in pivots[:i]]
    return out[:n]


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, a row for each of the falling ``values``."""
    n = len(diagonal)
    size = max(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny / EPSILON)
    least = EPSILON * size
    rng = np.random.default_rng(12)
    found = np.zeros((len(values), n))
    first = 0  # of the cluster that the current value is in
    shifted = np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * size:
            first = i
        # Equal values are told apart by a few roundings, so that each solution leans another way.
        shifted = min(value, shifted - 4 * least) if i > first else value
        x = rng.standard_normal(n)
        for _ in range(rounds):
            x = _solve(diagonal, off, shifted, x / np.linalg.norm(x), least)
            x /= np.linalg.norm(x)
            for _ in range(2):
                x -= found[first:i].T @ (found[first:i] @ x)
            x /= np.linalg.norm(x)
        found[i] = x
    return found


def leading_pairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` eigenvalues of a symmetric matrix, falling, and their unit vectors as rows.

    Values that are zero but for rounding, or negative, are left out.
    """
    n = len(matrix)
    scale = np.abs(matrix).max(initial=0)
    if n == 0 or scale == 0:
        return np.zeros(0), np.zeros((0, n))
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, min(count, n))
    values = values[values > 16 * n * EPSILON * values[0]]
    vectors = vectors_of(diagonal, off, values)
    for first, v in reversed(reflections):
        vectors[:, first:] -= 2 * np.outer(vectors[:, first:] @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return values * scale, vectors


# ---- Sums over all vectors ------------------------------------------------------------------------------


def _matrices(batch: pa.RecordBatch, length: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole numbers of a batch's vectors, in blocks of rows."""
    values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    step = max(1, BLOCK // length)
    for first in range(0, len(values), step):
        whole = np.floor(values[first: first + step] * SCALE).astype(np.int64) + SHIFT
        yield batch.column("id").slice(first, step), whole


def _added(length: int):
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * length
        for batch in batches:
            for _, x in _matrices(batch, length):
                # Halves, so that a block's sum stays within a long.
                high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
                total = [t + (h << 26) + w for t, h, w in zip(total, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(length), pa.int32()), pa.array([str(t) for t in total], pa.string())], ["dim", "total"]
        )

    return added


class Centre:
    """Count and sums of the vectors, with which a vector is centred without losing digits."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.base = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # nearest whole number of the mean
        self.rest = [s - n * int(b) for s, b in zip(sums, self.base, strict=True)]
        self.fraction = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - self.fraction

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum of (n x - S)^2 over the dimensions, exact."""
        near = x - self.base
        largest = float(np.abs(near).max(initial=0) + 1) * self.n
        if largest * largest * x.shape[1] < 2.0**62:
            t = self.n * near - np.array(self.rest, np.int64)
            return pa.array((t * t).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
        sums = [sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest, strict=True)) for row in near.tolist()]
        return pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))


def _products(length: int, made):
    """Rows of the matrix of summed products of what ``made`` gives for the vectors of a task."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for _, x in _matrices(batch, length):
                y = made(x)
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _rows(np.arange(len(total)), total, TaskContext.get().partitionId())

    return products


def _rows(dims: np.ndarray, total: np.ndarray, part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(dims, pa.int32()), pa.array([row.tobytes() for row in total], pa.binary()),
         pa.array([part] * len(total), pa.int64()), pa.array([part // GROUP] * len(total), pa.int64())],
        ["dim", "cells", "part", "group"],
    )


SUMMED = "dim int, cells binary, part long, group long"


def _sum_rows(table: pa.Table) -> pa.Table:
    """One row of the matrix from the parts of a group, in their order."""
    table = table.sort_by("part")
    cells = sum(np.frombuffer(c) for c in table.column("cells").to_pylist())
    dim, group = table.column("dim")[0].as_py(), table.column("group")[0].as_py()
    return pa.Table.from_batches([_rows(np.array([dim]), cells.reshape(1, -1), group)])


def _matrix(rows: DataFrame, length: int, made, size: int) -> np.ndarray:
    """Sum over all vectors, added row by row in two levels; ``size`` squared numbers reach the driver."""
    found = rows.mapInArrow(_products(length, made), SUMMED)
    for keys in (("dim", "group"), ("dim",)):
        found = found.groupBy(*keys).applyInArrow(_sum_rows, SUMMED)
    total = np.zeros((size, size))
    for r in found.select("dim", "cells").collect():
        total[r["dim"]] = np.frombuffer(r["cells"])
    return (total + total.T) / 2


# ---- The operator ---------------------------------------------------------------------------------------


def usable(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int, int]:
    """(id, v) of the vectors that take part, their length and their number."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) <= LARGEST)))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.col("n").desc(), F.col("length").desc()).first()
    if most is None:
        return rows, 0, 0
    return rows.where(F.size("v") == most["length"]), most["length"], most["n"]


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component."""
    spark = vectors.sparkSession
    rows, length, n = usable(vectors, vec_id, vector)
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"`{vec_id}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    if not length or not n:
        return spark.createDataFrame([], schema)
    sums = rows.mapInArrow(_added(length), "dim int, total string").groupBy("dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    ).collect()
    centre = Centre(n, [int(r["total"]) for r in sorted(sums, key=lambda r: r["dim"])])
    covariance = _matrix(rows, length, centre.centred, length) / n
    values, directions = leading_pairs(covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    turn = (directions / np.sqrt(values)[:, None]).T
    held = spark.sparkContext.broadcast((centre, turn))
    again = _matrix(rows, length, lambda x: held.value[0].centred(x) @ held.value[1], len(values)) / n
    error = float(np.abs(again - np.eye(len(values))).max())
    explained = values / np.trace(covariance)
    return rows.mapInArrow(_projected(held, length, explained, error, vec_id), schema)


def _projected(held, length: int, explained: np.ndarray, error: float, vec_id: str):
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, turn = held.value
        k = turn.shape[1]
        for batch in batches:
            for ids, x in _matrices(batch, length):
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, centre.n, np.int64)), centre.deviations(x).take(each),
                     pa.array((centre.centred(x) @ turn).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))],
                    [vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return projected

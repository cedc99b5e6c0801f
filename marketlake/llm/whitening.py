"""Whitening of vectors by shifted CholeskyQR.

Rows are centred exactly: integer vectors have exact sums, and each row loses the
rounded mean before the rest of it. Then passes over the rows follow, each of which
multiplies the centred rows by the inverse of what has been found so far, triangle by
triangle, and adds up their Gram matrix: tasks send d * d numbers each, Spark adds
them. The Cholesky factor of a Gram matrix is that pass's triangle; the first one is
taken after a shift that keeps it positive whatever the condition of the rows, later
ones bring the rows back to orthogonality. Passes end when the Gram matrix is the
identity to ``TOLERANCE``. The product R of the triangles has the rows' own singular
values and right singular vectors, without the loss of digits that their covariance
would bring: an SVD of R gives the whitening components.

The driver holds d * d numbers, never rows. Each pass reads the table anew, so a lost
executor costs its tasks alone.

Defined results: rows whose vector is null, holds null or non-finite entries, or has
another length than most vectors (ties: the longest) are dropped. Equal rows count
each. Components without variance (below ``NO_VARIANCE`` of the largest) are left
out, so a table of one row or of equal rows has none. Empty tables give no rows.
Columns other than the vector are kept, unless they bear the name of a new one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOLERANCE, MAX_PASSES = 1e-7, 6
NO_VARIANCE = 1e-13
ROWS = 4096


@dataclass(frozen=True)
class Basis:
    """What whitening needs: rows, exact sums of the columns, unit components (by row) and variances, largest first, and the sum of all variances."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        base = np.array([s // self.n for s in self.sums])
        return (x - base) - np.array([(s % self.n) / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.variances)


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are numbers."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~odd


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def summed(df: DataFrame, vector: str, shape: tuple[int, ...], kind: T.DataType, part) -> np.ndarray:
    """The sum over all batches of ``part(matrix of the vectors)``, an array of the shape: every task sends one row a cell at most."""
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("value", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                found = part(matrix(batch.column(0).slice(start, ROWS)))
                own = found if own is None else own + found
        if own is not None:
            cells = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(own.ravel()[cells])], names=["cell", "value"])

    out = np.zeros(shape, np.int64 if isinstance(kind, T.LongType) else np.float64)
    for cell, value in df.select(vector).mapInArrow(run, schema).groupBy("cell").agg(F.sum("value")).collect():
        out.ravel()[cell] = value
    return out


def divided(rows: np.ndarray, triangle: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangle, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ triangle[:j, j]) / triangle[j, j]
    return out


def triangle_of(gram: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """Upper triangle R with R'R = gram; where that fails, or at once if asked, of the gram with a shift."""
    if not shift:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    d = len(gram)
    # A bound on the rounding of a Gram matrix of n rows (Fukaya et al., Shifted Cholesky QR, 2020), with the trace for the squared norm.
    size = 11 * (d * (d + 1) + min(n, 1 << 20) * d) * np.finfo(float).eps / 2 * np.trace(gram)
    while True:
        try:
            return np.linalg.cholesky(gram + max(size, np.finfo(float).tiny) * np.eye(d)).T
        except np.linalg.LinAlgError:
            size *= 10


def fit(df: DataFrame, vector: str) -> Basis | None:
    """Components of the integer vectors of ``df``, which are all finite and of one length; None without rows."""
    d = df.select(F.size(vector)).head()
    if not d or not d[0]:
        return None
    d = d[0]
    found = summed(df, vector, (d + 1,), T.LongType(), lambda x: np.concatenate([x.sum(axis=0), [len(x)]]))
    n, sums = int(found[d]), [int(s) for s in found[:d]]
    start = Basis(n, sums, np.eye(d), np.ones(d), 0.0)

    def gram_under(triangles: list[np.ndarray]) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            rows = start.centred(x)
            for r in triangles:
                rows = divided(rows, r)
            return rows.T @ rows

        return summed(df, vector, (d, d), T.DoubleType(), part)

    gram = gram_under([])
    total = float(np.trace(gram)) / n
    if not total:
        return Basis(n, sums, np.zeros((0, d)), np.zeros(0), 0.0)
    triangles = [triangle_of(gram, n, shift=True)]
    for _ in range(MAX_PASSES):
        gram = gram_under(triangles)
        triangles.append(triangle_of(gram, n, shift=False))
        if np.abs(gram - np.eye(d)).max() <= TOLERANCE:
            break
    r = triangles[0]
    for more in triangles[1:]:
        r = more @ r
    _, sizes, components = np.linalg.svd(r)
    variances = sizes**2 / n
    some = variances > NO_VARIANCE * variances[0]
    return Basis(n, sums, components[some], variances[some], total)


def identity_error(df: DataFrame, vector: str, basis: Basis) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(basis.variances)

    def part(x: np.ndarray) -> np.ndarray:
        rows = np.column_stack([basis.whitened(x), np.ones(len(x))])
        return rows.T @ rows

    gram = summed(df, vector, (k + 1, k + 1), T.DoubleType(), part) / basis.n
    return float(np.abs(gram[:k, :k] - np.outer(gram[k, :k], gram[k, :k]) - np.eye(k)).max(initial=0.0))


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows with finite vectors of the length that most of them have."""
    df = df.where(finite(F.col(vector)))
    length = F.size(vector)
    most = df.groupBy(length.alias("length")).count().orderBy(F.desc("count"), F.desc("length")).head()
    return df.where(length == (most.length if most else 0))


def whiten(df: DataFrame, basis: Basis | None, vector: str, whitened: str = "whitened") -> DataFrame:
    """``df`` with ``whitened``: each integer vector centred, on the components, over their deviations. No basis: no rows."""
    kept = [f for f in df.schema.fields if f.name != whitened]
    schema = T.StructType([*kept, T.StructField(whitened, T.ArrayType(T.DoubleType(), False))])
    k = len(basis.variances) if basis else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = basis.whitened(matrix(batch.column(vector))) if k else np.zeros((batch.num_rows, 0))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * k, pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), rows], names=schema.names)

    return df.select(*(f.name for f in kept)).where(F.lit(basis is not None)).mapInArrow(run, schema)

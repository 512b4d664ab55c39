"""Whitening of embedding vectors by eigenvectors that are found in single and refined in higher precision.

Entries are put on a grid of whole numbers, which makes counts, sums and deviations exact. Two passes give the covariance:
the sums per dimension, then products of centred rows, a matrix per task that Spark adds up. Its eigenvectors start as
those of the matrix in float32. Ogita and Aishima's iteration corrects them: with ``R = I - X'X`` and ``S = X'AX`` every
round multiplies matrices only, in extended precision, and squares the error. Where eigenvalues lie closer together than
that error, the correction would divide by noise; such a cluster is only made orthonormal there, and a small eigenproblem
of the matrix shifted by the cluster's mean turns its vectors, so that the next round can tell them apart.

The driver holds one matrix whose side is the dimension of the vectors, whatever their number.

Vectors that are null or hold a null, NaN or infinite entry are left out, and so are those with an entry whose grid value no
long can hold and those of another length than the commonest (of equally common lengths the longest). Equal rows each get
a row. Directions in which the vectors do not vary have no component; if they vary in none, or the table is empty, there
are no components and no rows. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID = 64
SHIFT = 1_000_000
COMPONENTS = 32
ROUNDS = 12
ROWS = 2048
_HALF = 31
_LONG = 1 << 63


@dataclass
class Whitening:
    """The fit: count, exact sums, components (columns) with their eigenvalues, and the trace of the covariance."""

    dimension: int
    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return [float(value / self.trace) for value in self.variances]

    def centred(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows less the floor of the mean, as whole numbers, and less the mean, as doubles."""
        floors = np.array([total // self.n for total in self.sums], dtype=np.int64)
        rests = np.array([(total % self.n) / self.n for total in self.sums])
        whole = grid - floors
        return whole, whole - rests

    def deviations(self, grid: np.ndarray) -> list[int | None]:
        """The sum of (n x - S) squared of each row, exactly."""
        whole, _ = self.centred(grid)
        rests = np.array([total % self.n for total in self.sums], dtype=np.int64)
        squares, mixed = _dots(whole, whole), _dots(whole, np.broadcast_to(rests, whole.shape))
        rest = sum(int(r) ** 2 for r in rests.tolist())
        found = (self.n * self.n * a - 2 * self.n * b + rest for a, b in zip(squares, mixed, strict=True))
        return [value if value < _LONG else None for value in found]

    def whitened(self, grid: np.ndarray) -> np.ndarray:
        return self.centred(grid)[1] @ (self.components / np.sqrt(self.variances))


def _dots(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Exact products of the rows of two matrices of whole numbers."""
    bound = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < _LONG:
        return (left * right).sum(axis=1).tolist()
    return [sum(a * b for a, b in zip(one, two, strict=True)) for one, two in zip(left.tolist(), right.tolist(), strict=True)]


def _norm(matrix: np.ndarray) -> float:
    return float(np.linalg.norm(matrix.astype(np.float64), 2))


def _turned(matrix: np.ndarray, vectors: np.ndarray, values: np.ndarray, apart: float) -> np.ndarray:
    """``vectors`` with those of each cluster of ``values`` turned by the eigenvectors of the matrix within it."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > apart) + 1
    out = vectors.copy()
    for members in np.split(order, breaks):
        if len(members) < 2:
            continue
        own = vectors[:, members]
        inner = own.T @ (matrix @ own - values[members].mean() * own)
        inner = (inner + inner.T) / 2
        scale = np.abs(inner).max()
        if scale > 0:
            _, turn = np.linalg.eigh((inner / scale).astype(np.float64))
            out[:, members] = own @ turn.astype(own.dtype)
    return out


def refined(matrix: np.ndarray, vectors: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Approximate eigenvectors (columns) of a symmetric matrix, corrected until the corrections are rounding errors."""
    matrix, x = matrix.astype(np.longdouble), vectors.astype(np.longdouble)
    one = np.eye(len(matrix), dtype=np.longdouble)
    size = _norm(matrix)
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (matrix @ x)
        # rounding must not differ across the diagonal: divided by a small gap it would undo the orthogonality
        s, r = (s + s.T) / 2, (r + r.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        apart = 2 * (_norm(s - np.diag(values)) + size * _norm(r))
        gaps = values[None, :] - values[:, None]
        near = np.abs(gaps) <= apart
        step = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gaps))
        x = x + x @ step
        x = _turned(matrix, x, values, apart)
        if np.abs(step).max() < 8 * np.finfo(np.longdouble).eps:
            break
    return x


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns, each with its largest entry positive."""
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    scaled = (matrix + matrix.T) / (2 * scale)
    _, start = np.linalg.eigh(scaled.astype(np.float32))
    x = refined(scaled, start)
    exact = scaled.astype(np.longdouble)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (exact @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order].astype(np.float64), (values[order] * scale).astype(np.float64)
    largest = x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])]
    return values, x * np.where(largest < 0, -1.0, 1.0)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector has entries that the grid can hold, with the vector as doubles."""
    widest = float(1 << 62) / GRID
    entries = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= widest))
    return vectors.where(F.col(f"`{vector}`").isNotNull()).where(~odd).withColumn(vector, entries)


def commonest_length(vectors: DataFrame, vector: str = "embedding") -> int:
    """The commonest number of entries, of equally common ones the largest; 0 without vectors."""
    lengths = vectors.select(F.size(f"`{vector}`").alias("length")).where("length > 0")
    lengths = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("rows"))
    return lengths.agg(F.max(F.struct("rows", "length")).alias("most")).select(F.coalesce("most.length", F.lit(0))).first()[0]


def _grids(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of some thousand rows with their grid values."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            entries = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            yield batch, np.floor(GRID * entries).astype(np.int64) + SHIFT


def _totals(df: DataFrame, run, kind: str) -> list:
    """What the tasks of ``df`` yield as rows ``i, j, total``, added up."""
    found = df.mapInArrow(run, f"i int, j int, total {kind}")
    wide = "decimal(38,0)" if kind == "long" else kind
    return found.groupBy("i", "j").agg(F.sum(F.col("total").cast(wide)).alias("total")).collect()


def _cells(rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.astype(np.int32)), pa.array(columns.astype(np.int32)), pa.array(values)], ["i", "j", "total"])


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening learnt from all rows of :func:`usable`; None where there is nothing to learn from."""
    dimension = commonest_length(vectors, vector)
    if not dimension:
        return None
    rows = vectors.where(F.size(f"`{vector}`") == dimension).select(F.col(f"`{vector}`").alias("v"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # upper and lower halves apart, so that no sum can leave a long
        upper, lower, n = np.zeros(dimension, dtype=np.int64), np.zeros(dimension, dtype=np.int64), 0
        for _, grid in _grids(batches, dimension):
            upper += (grid >> _HALF).sum(axis=0)
            lower += (grid & ((1 << _HALF) - 1)).sum(axis=0)
            n += len(grid)
        at = np.arange(dimension)
        yield _cells(np.append(at, [*at, -1]), np.repeat([0, 1, 0], [dimension, dimension, 1]),
                     np.concatenate([upper, lower, [n]]))

    found = {(row["i"], row["j"]): int(row["total"]) for row in _totals(rows, sums, "long")}
    n = found[-1, 0]
    totals = [(found[i, 0] << _HALF) + found[i, 1] for i in range(dimension)]
    model = Whitening(dimension, n, totals, np.zeros((dimension, 0)), np.zeros(0), 0.0)
    upper_i, upper_j = np.triu_indices(dimension)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for _, grid in _grids(batches, dimension):
            own = model.centred(grid)[1]
            total += own.T @ own
        yield _cells(upper_i, upper_j, total[upper_i, upper_j])

    covariance = np.zeros((dimension, dimension))
    for row in _totals(rows, products, "double"):
        covariance[row["i"], row["j"]] = covariance[row["j"], row["i"]] = row["total"] / n
    values, axes = eigenvectors(covariance)
    there = values > dimension * np.finfo(float).eps * values.max()
    k = min(components, int(there.sum()))
    model.components, model.variances, model.trace = axes[:, :k], values[:k], float(np.trace(covariance))
    if not k:
        return model
    inner_i, inner_j = np.triu_indices(k)

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows are centred already: their mean is rounding, kept in column -1 and taken off below
        total, mean = np.zeros((k, k)), np.zeros(k)
        for _, grid in _grids(batches, dimension):
            own = model.whitened(grid)
            total += own.T @ own
            mean += own.sum(axis=0)
        yield _cells(np.append(inner_i, np.arange(k)), np.append(inner_j, np.full(k, -1)),
                     np.append(total[inner_i, inner_j], mean))

    measured = {(row["i"], row["j"]): row["total"] / n for row in _totals(rows, after, "double")}
    model.identity_error = max(
        abs(measured[i, j] - measured[i, -1] * measured[j, -1] - (i == j))
        for i, j in zip(inner_i.tolist(), inner_j.tolist(), strict=True))
    return model


def whiten(vectors: DataFrame, model: Whitening, vector: str = "embedding", into: str = "whitened",
           deviation: str = "deviation") -> DataFrame:
    """``vectors`` of the model's length with the arrays ``into`` instead of ``vector``, and the exact ``deviation``."""
    rest = [name for name in vectors.columns if name not in (vector, into, deviation)]
    rows = vectors.where(F.size(f"`{vector}`") == model.dimension)
    packed = rows.select(F.struct(*[F.col(f"`{name}`") for name in rest]).alias("rest"), F.col(f"`{vector}`").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, grid in _grids(batches, model.dimension):
            found = model.whitened(grid)
            ends = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel())),
                 pa.array(model.deviations(grid), type=pa.int64())], ["rest", "w", "d"])

    schema = f"rest {packed.schema['rest'].dataType.simpleString()}, w array<double>, d long"
    return packed.mapInArrow(run, schema).select("rest.*", F.col("w").alias(into), F.col("d").alias(deviation))


def components_of(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                  components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component; see the module for what is left out."""
    rows = usable(vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v")), "v")
    model = fit(rows, "v", components)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None or not len(model.variances):
        empty = rows.where(F.lit(False)).select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"))
        return empty.select(*names)
    found = whiten(rows, model, "v")
    each = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(share) for share in model.explained])
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))

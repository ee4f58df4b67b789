"""Whitening of embeddings from a covariance by polarisation.

Components become whole numbers, so every sum is exact. What is added up over
the rows is the square of each centred dimension and the square of each sum of
two centred dimensions. Variances follow from these, and half the difference
``var(a + b) - var(a) - var(b)`` is the covariance of ``a`` and ``b``. The
matrix is decomposed on the driver; its size depends on the dimension alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Whole numbers are held to this magnitude (components of 1.7e10), so that sums of squares fit decimal(38,0).
LARGEST = 1 << 40
# A component whose share of the largest variance is below this has no direction of its own.
DEGENERATE = 1e-12
EXACT = pa.decimal128(38, 0)


def usable(vector: str) -> Column:
    """Whether a vector is there, has entries, and all of them are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def whole_numbers(vectors: pa.Array, scale: int, offset: int, largest: int) -> np.ndarray:
    """Rows of equal length as ``floor(scale * c) + offset``, held to ``largest``."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.clip(np.floor(scale * values), -largest, largest - offset).astype(np.int64) + offset
    return scaled.reshape(len(vectors), -1)


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Every length that occurs, with the places of its rows."""
    lengths = np.diff(np.asarray(column.offsets))
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


@dataclass(frozen=True)
class Whitening:
    """What is known of the vectors of one length.

    ``shift`` is the whole part of each dimension's mean and ``rest`` the sum of
    what lies beyond it over all ``n`` rows, so ``mean = shift + rest / n``.
    """

    n: int
    shift: np.ndarray
    rest: list[int]
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, column: pa.Array) -> np.ndarray:
        return whole_numbers(column, SCALE, OFFSET, LARGEST) - self.shift

    def whitened(self, z: np.ndarray) -> np.ndarray:
        """Projections of unit variance; NaN where a component has no variance."""
        away = z - np.array([r / self.n for r in self.rest])
        with np.errstate(divide="ignore", invalid="ignore"):
            deviation = np.sqrt(np.where(self.variances > 0, self.variances, np.nan))
        return away @ self.axes / deviation

    def deviations(self, z: np.ndarray) -> list[int]:
        """Sum over the dimensions of ``(n * x - S)^2``, exactly: ``n * x - S`` is ``n * z - rest``."""
        n, rest = self.n, self.rest
        last = sum(r * r for r in rest)
        if _fits(z, 1, z.shape[1]):
            squares = np.einsum("ij,ij->i", z, z).tolist()
        else:
            squares = [sum(v * v for v in row) for row in z.tolist()]
        largest = max(1, int(np.abs(z).max(initial=0)))
        if largest * max(n, 1) * z.shape[1] < 1 << 62:  # every rest is below n
            mixed = (z @ np.array(rest, np.int64)).tolist()
        else:
            mixed = [sum(v * r for v, r in zip(row, rest, strict=True)) for row in z.tolist()]
        return [n * n * a - 2 * n * b + last for a, b in zip(squares, mixed, strict=True)]


def _fits(z: np.ndarray, terms: int, rows: int) -> bool:
    """Whether squares of sums of ``terms`` entries, added over ``rows``, stay within 64 bits."""
    return (terms * int(np.abs(z).max(initial=0))) ** 2 * max(rows, 1) < 1 << 62


def pair_squares(z: np.ndarray) -> list[int]:
    """For ``i <= j`` in order: the sum of ``z_i^2`` where they are equal, else of ``(z_i + z_j)^2``."""
    if not _fits(z, 2, len(z)):
        z = z.astype(object)
    found = []
    for i in range(z.shape[1]):
        both = np.concatenate([z[:, i : i + 1], z[:, i : i + 1] + z[:, i + 1 :]], axis=1)
        found += (both * both).sum(axis=0).tolist() if z.dtype == object else np.einsum("ij,ij->j", both, both).tolist()
    return [int(v) for v in found]


def covariance(n: int, squares: list[int], rest: list[int]) -> np.ndarray:
    """Covariances with divisor ``n`` from sums of squares; exact until the last division."""
    size = len(rest)
    places = [(i, j) for i in range(size) for j in range(i, size)]
    spread = {
        (i, j): n * square - (rest[i] if i == j else rest[i] + rest[j]) ** 2
        for (i, j), square in zip(places, squares, strict=True)
    }
    result = np.zeros((size, size))
    for i, j in places:
        exact = spread[i, i] if i == j else (spread[i, j] - spread[i, i] - spread[j, j]) // 2
        result[i, j] = result[j, i] = exact / (n * n)
    return result


def _added(vectors: DataFrame, work, kind: str = "decimal(38,0)") -> dict[int, dict[int, object]]:
    """Sums by length and cell of what ``work`` adds up in each task; as many numbers as a matrix has reach the driver."""
    cells = vectors.mapInArrow(work, f"length int, cell int, value {kind}")
    found: dict[int, dict[int, object]] = {}
    for row in cells.groupBy("length", "cell").agg(F.sum("value").alias("value")).collect():
        found.setdefault(row.length, {})[row.cell] = row.value
    return found


def _cells(totals: dict[int, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([length for length, values in totals.items() for _ in values], pa.int32()),
            pa.array([k for values in totals.values() for k in range(len(values))], pa.int32()),
            pa.array([Decimal(v) for values in totals.values() for v in values], EXACT),
        ],
        names=["length", "cell", "value"],
    )


def fit_whitening(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for every length that occurs among usable vectors.

    Three passes over the vectors: sums, squares, and the covariance of what
    comes out, which gives ``identity_error``. No shuffle beyond partial sums.
    """
    used = vectors.select(F.col(f"`{vector}`").alias("vector")).where(usable("vector"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for length, rows in by_length(batch.column(0)):
                x = whole_numbers(batch.column(0).take(pa.array(rows)), SCALE, OFFSET, LARGEST)
                old = totals.get(length, [0] * (length + 1))
                totals[length] = [a + b for a, b in zip(old, [len(x), *x.sum(axis=0).tolist()], strict=True)]
        yield _cells(totals)

    counted = {
        length: (int(cells[0]), [int(cells[k + 1]) for k in range(length)])
        for length, cells in _added(used, sums).items()
    }
    shifts = {length: np.array([s // n for s in total], np.int64) for length, (n, total) in counted.items()}

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for length, rows in by_length(batch.column(0)):
                z = whole_numbers(batch.column(0).take(pa.array(rows)), SCALE, OFFSET, LARGEST) - shifts[length]
                found = pair_squares(z)
                totals[length] = [a + b for a, b in zip(totals.get(length, [0] * len(found)), found, strict=True)]
        yield _cells(totals)

    models = {}
    for length, cells in (_added(used, squares) if counted else {}).items():
        n, total = counted[length]
        rest = [s - n * int(m) for s, m in zip(total, shifts[length], strict=True)]
        matrix = covariance(n, [int(cells[k]) for k in range(len(cells))], rest)
        values, axes = np.linalg.eigh(matrix)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
        values = np.where(values > DEGENERATE * max(values[0], 0), values, 0.0)
        trace = float(np.trace(matrix))
        models[length] = Whitening(n, shifts[length], rest, axes, values, values / trace if trace else values * 0)
    return _with_errors(used, models)


def _with_errors(used: DataFrame, models: dict[int, Whitening]) -> dict[int, Whitening]:
    """The models, with the largest entry of the whitened rows' covariance minus the identity."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, rows in by_length(batch.column(0)):
                model = models[length]
                w = np.nan_to_num(model.whitened(model.centred(batch.column(0).take(pa.array(rows)))))
                found = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
                totals[length] = totals.get(length, 0) + found
        for length, found in totals.items():
            yield pa.RecordBatch.from_pydict({
                "length": pa.array([length] * len(found), pa.int32()),
                "cell": pa.array(range(len(found)), pa.int32()),
                "value": found,
            })

    measured = {}
    for length, cells in (_added(used, moments, "double") if models else {}).items():
        model = models[length]
        size, live = model.axes.shape[1], model.variances > 0
        values = np.array([cells[k] for k in range(size + size * size)]) / model.n
        mean, product = values[:size], values[size:].reshape(size, size)
        away = np.abs(product - np.outer(mean, mean) - np.eye(size))[np.ix_(live, live)]
        error = float(away.max(initial=0.0))
        measured[length] = Whitening(
            model.n, model.shift, model.rest, model.axes, model.variances, model.explained, error
        )
    return measured


def whiten(
    vectors: DataFrame, models: dict[int, Whitening], id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, n, deviation, identity_error, and arrays whitened and explained, for every usable vector.

    Vectors that are null, empty or hold null or non-finite entries are left
    out. Lengths are fitted apart. Entries beyond 1.7e10 count as that bound. A
    component without variance (all vectors alike, or fewer than components)
    is null in ``whitened`` and 0 in ``explained``. ``deviation`` is an exact
    decimal, null beyond 38 digits. A null or repeated id gives a row like any
    other; no rows, no result; other columns are ignored. One pass, no shuffle.
    """
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(models)  # a matrix for each length
    used = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    used = used.where(usable("vector"))
    id_type = used.schema["vec_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for length, rows in by_length(column):
                model = shared.value[length]
                for at in range(0, len(rows), 2048):
                    some = pa.array(rows[at : at + 2048])
                    z = model.centred(column.take(some))
                    w = model.whitened(z)
                    size = w.shape[1]
                    offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * size)
                    flat = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
                    spread = [Decimal(v) if v < 10**38 else None for v in model.deviations(z)]
                    told = pa.array(np.tile(model.explained, len(z)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(some),
                            pa.array([model.n] * len(z), pa.int64()),
                            pa.array(spread, EXACT),
                            pa.array([model.identity_error] * len(z)),
                            pa.ListArray.from_arrays(offsets, flat),
                            pa.ListArray.from_arrays(offsets, told),
                        ],
                        names=["vec_id", "n", "deviation", "identity_error", "whitened", "explained"],
                    )

    return used.mapInArrow(
        work,
        f"vec_id {id_type}, n long, deviation decimal(38,0), identity_error double,"
        " whitened array<double>, explained array<double>",
    )

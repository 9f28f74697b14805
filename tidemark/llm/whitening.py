"""Embedding whitening with a spectral divide-and-conquer eigensolver.

1. *Vectors.*  Rows whose vector is null, or holds null or non-finite entries, are dropped.  An entry ``c`` becomes the
   integer ``floor(64 * c) + 1000000``; each distinct integer vector enters the fit once.
2. *Moments.*  Tasks add up the vectors, then the products of the entries centred on the integer next to the mean.  All
   sums are integers and exact, so the covariance is the same for every layout of the input, correctly rounded.  The
   driver gets one number per pair of dimensions.
3. *Divide and conquer.*  The polar factor of the covariance minus a shift, by the QR-based dynamically weighted
   Halley iteration, is the matrix sign function: ``(U + I) / 2`` projects on the eigenvectors above the shift.
   Orthonormal bases of its range and of the complement split the matrix into two; each half that holds wanted
   components is split again until single components are left.
4. *Whitening.*  The components, divided by the roots of their eigenvalues, go to all tasks: dimensions times
   components numbers.  The covariance of the whitened fit list, minus the identity, is measured on the vectors.

Fewer components than asked for come out where the covariance has a smaller rank: a component whose eigenvalue is
rounding alone cannot be scaled to one.  Components of equal eigenvalues are any orthonormal set of their space.
Vectors of another length than the commonest (of equals, the longest), and vectors whose integers do not fit 62 bits,
are dropped like non-finite ones.  Repeated rows and null ids each give their rows; further columns are ignored; an
empty table gives an empty result.  ``deviation`` is a decimal of 38 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
_LIMIT = float(1 << 56)
_EXACT = float(1 << 53)


# Spectral divide and conquer


def polar_factor(a: np.ndarray, steps: int = 30) -> np.ndarray:
    """Orthogonal polar factor of a symmetric, nonsingular matrix by QDWH."""
    n = len(a)
    norm = np.linalg.norm(a)
    x = a / norm
    # A lower bound of the least singular value; too low a bound only costs a step.
    try:
        bound = min(1.0, max(1 / np.linalg.norm(np.linalg.inv(x)), 1e-18))
    except np.linalg.LinAlgError:
        bound = 1e-18
    eye = np.eye(n)
    for _ in range(steps):
        d = np.cbrt(4 * (1 - bound**2) / bound**4)
        weight = np.sqrt(1 + d) + np.sqrt(max(8 - 4 * d + 8 * (2 - bound**2) / (bound**2 * np.sqrt(1 + d)), 0)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(c) * x, eye)))
        new = b / c * x + (weight - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        bound = min(1.0, bound * (weight + b * bound**2) / (1 + c * bound**2))
        if moved < 1e-13 * np.sqrt(n):
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift; None if all eigenvalues are equal up to rounding.

    A shift that hits an eigenvalue gives no clean split, so the next one is tried; the cleanest counts.
    """
    n = len(a)
    diagonal = np.sort(np.diag(a))
    spread = np.linalg.norm(a - np.trace(a) / n * np.eye(n))
    if spread <= 64 * np.finfo(float).eps * np.linalg.norm(a):
        return None
    best, residue = None, np.inf
    for shift in (np.median(diagonal), np.trace(a) / n, *(np.trace(a) / n + spread * f / np.sqrt(n) for f in (0.1, -0.1, 0.3, -0.3, 0.7, -0.7))):
        u = polar_factor(a - shift * np.eye(n))
        projector = (u + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-10 * n:
            continue
        # Range and complement: one step of subspace iteration from the projector's own largest columns.
        order = np.argsort(-np.diag(projector), kind="stable")
        start = projector[:, order[:rank]]
        for _ in range(2):
            q, _ = np.linalg.qr(start, mode="complete")
            start = projector @ q[:, :rank]
        q, _ = np.linalg.qr(start, mode="complete")
        above, below = q[:, :rank], q[:, rank:]
        left = np.linalg.norm(below.T @ a @ above)
        if left < residue:
            best, residue = (above, below), left
        if residue <= 4 * n * np.finfo(float).eps * np.linalg.norm(a):
            break
    return best


def spectral_components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    n = len(a)
    wanted = min(wanted, n)
    if wanted <= 0:
        return np.zeros(0), np.zeros((n, 0))
    if n == 1:
        return a[0].copy(), np.ones((1, 1))
    halves = _split(a)
    if halves is None:  # any orthonormal set will do
        order = np.argsort(-np.diag(a), kind="stable")[:wanted]
        return np.diag(a)[order], np.eye(n)[:, order]
    found_values, found_vectors = [], []
    for basis in halves:
        left = wanted - sum(map(len, found_values))
        part = basis.T @ a @ basis
        values, vectors = spectral_components((part + part.T) / 2, left)
        found_values.append(values)
        found_vectors.append(basis @ vectors)
    return np.concatenate(found_values), np.column_stack(found_vectors)


# Moments


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Equally long lists as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _sums(fit: DataFrame, dims: int, products: Callable[[np.ndarray], Iterator[np.ndarray]], labels: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """Exact sums of integer arrays over all vectors, one Python integer per label.

    Each task adds up whole numbers of any size and hands on their upper and lower bits apart, so that the sums over
    tasks fit 38 digits.
    """
    first = pa.array([i for i, _ in labels], pa.int32())
    second = pa.array([j for _, j in labels], pa.int32())
    wide = pa.decimal128(38, 0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(labels), object)
        for batch in batches:
            for part in products(_matrix(batch.column("x"))):
                total = total + part.astype(object)
        high = pa.array([Decimal(int(v) >> 40) for v in total], wide)
        low = pa.array([Decimal(int(v) & ((1 << 40) - 1)) for v in total], wide)
        yield pa.RecordBatch.from_arrays([first, second, high, low], ["i", "j", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    added = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r["i"], r["j"]): (int(r["high"]) << 40) + int(r["low"]) for r in added.collect()}


def _totals(x: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(x), 64):  # 64 numbers of 57 bits fit 63 bits
        yield x[at : at + 64].sum(axis=0)


def _products(centre: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> Callable[[np.ndarray], Iterator[np.ndarray]]:
    """Sums of products of centred entries; floating-point products as long as they are exact integers."""

    def run(x: np.ndarray) -> Iterator[np.ndarray]:
        if not len(x):
            return
        y = x - centre
        largest = max(int(np.abs(y).max()), 1)
        rows = int(_EXACT) // (largest * largest)
        if rows >= 1:
            y = y.astype(np.float64)
            for at in range(0, len(y), rows):
                part = y[at : at + rows]
                yield (part.T @ part)[pairs].astype(np.int64)
        else:  # entries of more than 26 bits: whole numbers of any size
            wide = y.astype(object)
            yield np.array([sum(wide[:, i] * wide[:, j]) for i, j in zip(*pairs, strict=True)], object)

    return run


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its size, the mean as integer and rest, and the components."""

    n: int
    centre: np.ndarray  # integers next to the mean
    rest: np.ndarray  # sums of the vectors less n times the centre, as Python integers
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # components as columns
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        y = (x - self.centre).astype(np.float64) - self._offset
        return y @ (self.vectors / np.sqrt(self.values))

    @property
    def _offset(self) -> np.ndarray:
        return np.array([float(r / self.n) if isinstance(r, int) else r / self.n for r in self.rest.tolist()])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) ** 2, exact."""
        y = x - self.centre
        top = max((int(np.abs(y).max()) if y.size else 0) * self.n + max((abs(r) for r in self.rest.tolist()), default=0), 1)
        if top * top * max(y.shape[1], 1) < 1 << 63:
            z = y * np.int64(self.n) - self.rest.astype(np.int64)
            return (z * z).sum(axis=1).tolist()
        rest = self.rest.tolist()
        return [sum((v * self.n - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in y.tolist()]


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    entry = F.transform("embedding", lambda c: c.cast("double") * SCALE)
    fits = F.forall("y", lambda c: F.coalesce(F.abs(c) < _LIMIT, F.lit(False)) & ~F.isnan(c))
    x = F.transform("y", lambda c: F.floor(c) + SHIFT)
    return embeddings.select("vec_id", entry.alias("y")).where(F.col("y").isNotNull() & fits).select("vec_id", x.alias("x"))


def fit(rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The whitening of the distinct vectors, and those vectors; None without any."""
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).head()
    if lengths is None or lengths["dims"] == 0:
        return None, rows.select("x").limit(0)
    dims = lengths["dims"]
    vectors = stored(rows.where(F.size("x") == dims).select("x").distinct(), "whitening-vectors")
    n = vectors.count()
    sums = _sums(vectors, dims, _totals, [(i, 0) for i in range(dims)])
    s = [sums[i, 0] for i in range(dims)]
    centre = [(2 * v + n) // (2 * n) for v in s]
    rest = [v - n * c for v, c in zip(s, centre, strict=True)]
    pairs = np.triu_indices(dims)
    labels = list(zip(pairs[0].tolist(), pairs[1].tolist(), strict=True))
    moments = _sums(vectors, dims, _products(np.array(centre, np.int64), pairs), labels)
    covariance = np.zeros((dims, dims))
    for i, j in labels:  # whole numbers; the division rounds once
        covariance[i, j] = covariance[j, i] = (n * moments[i, j] - rest[i] * rest[j]) / (n * n)
    values, directions = spectral_components(covariance, components)
    usable = values > dims * np.finfo(float).eps * max(float(values[0]) if len(values) else 0.0, 0.0)
    model = Whitening(n, np.array(centre, np.int64), np.array(rest, object), values[usable], directions[:, usable], float(np.trace(covariance)))
    return model, vectors


def identity_error(model: Whitening, vectors: DataFrame) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, measured on the vectors."""
    k = len(model.values)
    if not k:
        return 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whitened(_matrix(batch.column("x")).reshape(-1, len(model.centre)))
            total, square = total + w.sum(axis=0), square + w.T @ w
        cells = np.concatenate((total, square.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "value"])

    added = vectors.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    cells = np.zeros(k + k * k)
    for r in added:
        cells[r["cell"]] = r["value"] / model.n
    mean, square = cells[:k], cells[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


_WHITENED = "vec_id long, deviation decimal(38,0), whitened array<double>"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row: vec_id, n, deviation, whitened, explained (arrays by component), identity_error."""
    rows = quantised(embeddings.withColumn("vec_id", F.col("vec_id").cast("long")))
    model, vectors = fit(rows, components)
    if model is None:
        none = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
        return rows.sparkSession.createDataFrame([], none)
    error = identity_error(model, vectors)
    dims = len(model.centre)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x")).reshape(-1, dims)
            w = model.whitened(x)
            offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            deviations = pa.array([Decimal(d) for d in model.deviations(x)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviations, pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], ["vec_id", "deviation", "whitened"])

    found = rows.where(F.size("x") == dims).mapInArrow(run, _WHITENED)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return found.select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).cast("double").alias("identity_error")
    )

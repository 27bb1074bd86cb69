"""Whitening of embeddings by polarisation covariance (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024.0, 100_000  # an entry c is counted as floor(SCALE * c) + OFFSET
LARGEST = float(1 << 52)  # entries whose scaled value lies beyond are not exact and count as not finite
COMPONENTS = 8
ROWS = 1 << 13  # whose products are summed up at once
LIMB = 24  # bits of the lower part of a value that is squared
SUM = pa.decimal128(38, 0)


@dataclass
class Whitening:
    """What is learnt from the fit list: its exact sums and the components of its covariance.

    ``vectors`` holds one unit eigenvector per row, numbered by falling eigenvalue, each with the
    sign that makes its largest entry positive. ``trace`` is the sum of all variances.
    """

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S of every row, exact: 64-bit integers where they suffice, else Python's."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if bound < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def positive(self, components: int) -> np.ndarray:
        """Which of the first components have any variance beyond rounding errors."""
        values = self.values[:components]
        return values > max(self.trace, 0.0) * self.size * np.finfo(float).eps

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        """Whitened rows; components without variance are 0."""
        centred = self.centred(x).astype(float) / self.n
        real = self.positive(components)
        scale = np.where(real, np.sqrt(np.where(real, self.values[:components], 1.0)), np.inf)
        return centred @ self.vectors[:components].T / scale


def usable(vector: str) -> F.Column:
    """Not null, not empty, and every entry is a finite number of a size that is counted exactly."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * SCALE < LARGEST))
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))


def _remaining(vectors: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int, int]:
    """Usable rows of the commonest length (of equally common ones the longest), that length, and their number."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vector")).filter(usable("vector"))
    most = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size, n = (most["size"], most["count"]) if most else (0, 0)
    return rows.filter(F.size("vector") == size), size, n


def _entries(column: pa.Array, size: int) -> np.ndarray:
    """The counted values of a batch of vectors, one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(flat * SCALE).astype(np.int64) + OFFSET


def _sums(rows: DataFrame, size: int) -> list[int]:
    """Exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [0] * size
        for batch in batches:
            x = _entries(batch.column("vector"), size)
            # Two halves, so that no sum of a batch overflows.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            found = [f + (h << 32) + v for f, h, v in zip(found, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(found, SUM)], ["place", "value"])

    total = rows.select("vector").mapInArrow(run, "place int, value decimal(38,0)").groupBy("place").agg(F.sum("value").alias("value"))
    found = {r["place"]: int(r["value"]) for r in total.collect()}
    return [found[k] for k in range(size)]


def squares(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per column the exact sum of squares, as (a, b, c) for a * 2**48 + b * 2**25 + c.

    Values below 2**48 are cut into two halves of 24 bits, so that no sum over ``ROWS`` rows
    overflows 64 bits; others go through Python's integers.
    """
    if z.dtype == object or (len(z) and int(np.abs(z).max(initial=0)) >= 1 << 2 * LIMB):
        whole = (z.astype(object) ** 2).sum(axis=0) if len(z) else np.zeros(z.shape[1], dtype=object)
        return whole >> 48, whole * 0, whole & ((1 << 48) - 1)
    size = np.abs(z)
    high, low = size >> LIMB, size & ((1 << LIMB) - 1)
    return (high * high).sum(axis=0), (high * low).sum(axis=0), (low * low).sum(axis=0)


def pair_squares(z: np.ndarray) -> np.ndarray:
    """For every dimension pair i <= j, in order, the exact sum of the squares of z_i + z_j (of z_i, if i = j), in three parts."""
    parts = []
    for i in range(z.shape[1]):
        sums = z[:, i:] + z[:, i : i + 1]
        sums[:, 0] = z[:, i]
        parts.append(np.array([p.astype(object) for p in squares(sums)]))
    return np.concatenate(parts, axis=1)


def _covariance(rows: DataFrame, model: Whitening) -> np.ndarray:
    """The covariance by polarisation: 2 cov(i, j) = var(x_i + x_j) - var(x_i) - var(x_j).

    Tasks return the exact sum of squares of every dimension and dimension-pair sum, all centred
    before they are squared; their totals, of a number that the dimension alone decides, are the
    only thing that reaches the driver.
    """
    size, n = model.size, model.n
    pairs = size * (size + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, pairs), dtype=object)
        for batch in batches:
            x = _entries(batch.column("vector"), size)
            for start in range(0, len(x), ROWS):
                total += pair_squares(model.centred(x[start : start + ROWS]))
        columns = [pa.array(range(pairs), pa.int32()), *(pa.array(list(t), SUM) for t in total)]
        yield pa.RecordBatch.from_arrays(columns, ["pair", "a", "b", "c"])

    found = rows.select("vector").mapInArrow(run, "pair int, a decimal(38,0), b decimal(38,0), c decimal(38,0)")
    found = found.groupBy("pair").agg(*[F.sum(c).alias(c) for c in "abc"]).collect()
    exact = {r["pair"]: (int(r["a"]) << 48) + (int(r["b"]) << 25) + int(r["c"]) for r in found}
    matrix, variance, pair = np.empty((size, size)), [0] * size, 0
    for i in range(size):
        variance[i] = exact[pair]
        pair += size - i
    pair = 0
    for i in range(size):
        for j in range(i, size):
            doubled = 2 * variance[i] if i == j else exact[pair] - variance[i] - variance[j]
            matrix[i, j] = matrix[j, i] = doubled / (2 * n**3)  # one rounding: both are integers
            pair += 1
    return matrix


def _fitted(rows: DataFrame, size: int, n: int) -> Whitening:
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    model = Whitening(n, _sums(rows, size), np.zeros(0), np.zeros((0, 0)), 0.0)
    covariance = _covariance(rows, model)
    values, columns = np.linalg.eigh(covariance)
    vectors = columns.T[::-1]
    signs = np.sign(vectors[np.arange(size), np.abs(vectors).argmax(axis=1)])
    model.values, model.vectors = values[::-1].copy(), vectors * signs[:, None]
    model.trace = float(np.trace(covariance))
    return model


def fit(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> Whitening:
    """The whitening of all usable vectors; see :func:`whiten` for which these are."""
    return _fitted(*_remaining(vectors, id_column, vector))


def _identity_error(rows: DataFrame, model: Whitening, components: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    wide = min(components, model.size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide + 1, wide))
        for batch in batches:
            y = model.project(_entries(batch.column("vector"), model.size), wide)
            total[0] += y.sum(axis=0)
            total[1:] += y.T @ y
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["place", "value"])

    summed = rows.select("vector").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = {r["place"]: r["value"] for r in summed.collect()}
    total = np.array([found[k] for k in range((wide + 1) * wide)]).reshape(wide + 1, wide) / model.n
    error = total[1:] - np.outer(total[0], total[0]) - np.diag(model.positive(wide).astype(float))
    return float(np.abs(error).max())


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``n``, ``deviation``, ``whitened`` and ``explained`` (both an array over components) and ``identity_error``.

    An entry c is counted as x = floor(1024 c) + 100000. Sums, deviations and the squares from which
    the covariance follows are exact; the only roundings are the division that gives a covariance,
    the eigenvectors and the projections. ``deviation`` is a row's sum over dimensions of
    (n x - S)^2 as a decimal of 38 digits (null beyond them). ``whitened`` holds the first
    ``components`` components, or all if the vectors have fewer dimensions; ``explained`` their shares
    of the trace (0 if the trace is 0). A component without variance, as with a single row or equal
    dimensions, is 0 in every row, and the identity has 0 in its place.

    Rows are left out, of the fit and of the result, if their vector is null, empty, of another
    length than the commonest (of equally common ones the longest), or holds an entry that is null,
    not finite or too large to be counted exactly (2**42 and more). Repeated ids and rows count one
    by one, a null id is kept, other columns are ignored, and an empty table gives an empty result.
    """
    rows, size, n = _remaining(vectors, id_column, vector)
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"
    model = _fitted(rows, size, n)
    shown = min(components, size)
    error = _identity_error(rows, model, components) if shown else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _entries(batch.column("vector"), size)
            z = model.centred(x)
            large = z.dtype == object or int(np.abs(z).max(initial=0)) ** 2 * size >= 1 << 63
            deviation = ((z.astype(object) if large else z) ** 2).sum(axis=1).tolist()
            deviation = pa.array([v if v < 10**38 else None for v in deviation], SUM)
            flat = pa.array(model.project(x, shown).ravel())
            places = pa.array(np.arange(len(x) + 1, dtype=np.int32) * shown)
            yield pa.RecordBatch.from_arrays([batch.column("id"), deviation, pa.ListArray.from_arrays(places, flat)], ["vec_id", "deviation", "whitened"])

    shares = [float(v) / model.trace if model.trace > 0 else 0.0 for v in np.maximum(model.values[:shown], 0.0)]
    made = rows.mapInArrow(run, schema) if n else vectors.sparkSession.createDataFrame([], schema)
    return made.select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(s) for s in shares]).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"),
    )

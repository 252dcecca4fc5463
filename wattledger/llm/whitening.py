"""Whitening of embeddings by polarisation of exact variances.

Entries become integers, so every sum is exact. One pass adds up each dimension, a second the
squares of the centred values of every dimension and of every sum of two dimensions. A
covariance is half of what the variance of such a sum exceeds the two variances by: no product of
two dimensions is formed, and no digit is lost to the large offset of the values. The matrix of one
row and column per dimension is put together on the driver, in whole numbers, and only then
divided and decomposed. Vectors never leave the tasks; a task sends sums, as many as there are
pairs of dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

UNITS, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries beyond this many units count as this many, so that differences fit a long.
FARTHEST = 1 << 60
#: Rows whose pairs of dimensions are squared at once.
ROWS = 4096
_LONG = 1 << 63


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows whose vector has entries, none of them null, infinite or not a number."""
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & (F.abs(F.coalesce(c, F.lit(0.0))) < F.lit(float("inf"))))
    return rows.where((F.size("vector") > 0) & finite)


def whole(column: pa.Array) -> np.ndarray:
    """The integers of a batch of vectors of one length, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        units = np.clip(np.floor(UNITS * flat), -FARTHEST, FARTHEST)
    return units.astype(np.int64).reshape(len(column), -1) + OFFSET


def _exact(x: np.ndarray, most: int) -> np.ndarray:
    """``x``, as Python integers where values up to ``most`` would not fit a long."""
    return x.astype(object) if most >= _LONG else x


PARTS = "place int, high decimal(38,0), low decimal(38,0)"


def _sent(parts: dict[int, int]) -> pa.RecordBatch:
    """A task's sums by place, each in two parts, as Spark's decimals end at 38 digits."""
    exact = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([Decimal(v >> 60) for v in parts.values()], exact),
                                       pa.array([Decimal(v & ((1 << 60) - 1)) for v in parts.values()], exact)], names=["place", "high", "low"])


def _total(parts: DataFrame) -> dict[int, int]:
    summed = parts.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {r["place"]: (int(r["high"]) << 60) + int(r["low"]) for r in summed}


def sums(rows: DataFrame) -> dict[int, int]:
    """The exact sum of every dimension."""

    def run(batches):
        total = 0
        for batch in batches:
            if batch.num_rows:
                x = whole(batch.column(1))
                total = total + _exact(x, int(np.abs(x).max()) * len(x)).sum(0).astype(object)
        if not np.isscalar(total):
            yield _sent(dict(enumerate(total)))

    return _total(rows.mapInArrow(run, PARTS))


def squares(rows: DataFrame, centre: np.ndarray) -> dict[int, int]:
    """The exact sums of (x - centre) squared: for each dimension i at place i * d + i, for the sum of
    dimensions i < j at i * d + j."""
    d = len(centre)

    def run(batches):
        total: list | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = whole(batch.column(1).slice(at, ROWS)) - centre
                y = _exact(y, (2 * int(np.abs(y).max())) ** 2 * len(y))
                total = total or [0] * d
                for i in range(d):
                    pair = y[:, i:] + y[:, i:i + 1]
                    pair[:, 0] = y[:, i]
                    total[i] = total[i] + (pair * pair).sum(0).astype(object)
        if total:
            yield _sent({i * d + i + k: v for i, row in enumerate(total) for k, v in enumerate(row)})

    return _total(rows.mapInArrow(run, PARTS))


@dataclass
class Fit:
    """What the vectors' covariance is made of, and its leading components (rows of ``axes``, each divided
    by the root of its eigenvalue)."""

    n: int
    totals: list[int]
    covariance: np.ndarray
    axes: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centre = np.array([s // self.n for s in self.totals], dtype=np.int64)
        rest = np.array([s % self.n / self.n for s in self.totals])
        centred = (x - centre).astype(np.float64) - rest
        return centred @ self.axes.T

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of (n * x - S) squared; null where a long cannot hold it."""
        most = self.n * (int(np.abs(x).max()) + max(map(abs, self.totals)) // self.n + 1)
        s = np.array(self.totals, dtype=object)
        y = _exact(x, most) * self.n - (s if most >= _LONG else s.astype(np.int64))
        most = max(abs(int(y.max())), abs(int(y.min())))
        y = _exact(y, most * most * y.shape[1])
        return [v if v < _LONG else None for v in (y * y).sum(1).tolist()]


def fit(rows: DataFrame, n: int, components: int = COMPONENTS) -> Fit:
    """Covariance (divisor n) of usable rows of one length and its components by falling eigenvalue.

    Components without variance (eigenvalues that rounding alone explains) are left out.
    """
    totals = [v for _, v in sorted(sums(rows).items())]
    d = len(totals)
    centre = np.array([s // n for s in totals], dtype=np.int64)
    rest = [s - n * int(c) for s, c in zip(totals, centre)]
    square = squares(rows, centre)
    # n * n times the variance of each dimension and of each sum of two
    variance = {i: n * square[i * d + i] - rest[i] ** 2 for i in range(d)}
    matrix = np.empty((d, d))
    for i in range(d):
        matrix[i, i] = variance[i] / n ** 2
        for j in range(i + 1, d):
            both = n * square[i * d + j] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - variance[i] - variance[j]) / (2 * n ** 2)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1].T
    keep = int((values[:components] > d * np.finfo(float).eps * max(values[0], 0)).sum())
    axes = vectors[:keep]
    if keep:
        axes = axes * np.sign(axes[np.arange(keep), np.abs(axes).argmax(1)])[:, None]
    return Fit(n, totals, matrix, axes / np.sqrt(values[:keep])[:, None], values[:keep] / np.trace(matrix) if keep else values[:0])


def identity_error(rows: DataFrame, fitted: Fit) -> float:
    """The largest distance of an entry of the whitened vectors' covariance from the identity, measured on all of them."""
    k = len(fitted.axes)

    def run(batches):
        # the mean of whitened values is 0 but for rounding; it is taken off all the same
        total, cross = np.zeros(k), np.zeros((k, k))
        seen = False
        for batch in batches:
            if batch.num_rows:
                w = fitted.whitened(whole(batch.column(1)))
                total, cross, seen = total + w.sum(0), cross + w.T @ w, True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k, dtype=np.int32)), pa.array(np.concatenate([total, cross.ravel()]))],
                                             names=["place", "part"])

    got = rows.mapInArrow(run, "place int, part double").groupBy("place").agg(F.sum("part").alias("part")).collect()
    flat = np.zeros(k * k + k)
    for r in got:
        flat[r["place"]] = r["part"]
    mean, cross = flat[:k] / fitted.n, flat[k:].reshape(k, k) / fitted.n
    return float(np.abs(cross - np.outer(mean, mean) - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: its place on the component in units of the deviation there.

    A vector that is null, empty or holds a null, infinite or not-a-number entry is left out, of the
    fit too. Where lengths differ, those of the most frequent length are taken (the longer at a
    tie). Repeated rows count each, a null key stays null, other columns are not looked at. Without a
    usable vector, or where all are equal, there is no component and so no row; components that have
    no variance have none either. ``deviation`` is null where a long cannot hold it.
    """
    rows = usable(vectors, key, vector)
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.col("count").desc(), F.col("length").desc()).first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    rows, n = rows.where(F.size("vector") == lengths["length"]), lengths["count"]
    fitted = fit(rows, n, components)
    k = len(fitted.axes)
    if not k:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    error = identity_error(rows, fitted)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = whole(part.column(1))
                owner = pa.array(np.repeat(np.arange(len(x)), k))
                deviation = pa.array(fitted.deviation(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(x) * k, n, np.int64)), deviation.take(owner), pa.array(fitted.whitened(x).ravel()),
                     pa.array(np.tile(fitted.explained, len(x))), pa.array(np.full(len(x) * k, error))],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)

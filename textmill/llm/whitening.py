"""Whitening of embeddings on their leading principal components.

Three passes over the vectors, each map-side with one small result per task: exact sums per dimension; the centred
covariance, summed by cell; the projection. Between them the covariance, whose size is set by the
vectors' length and not by their number, is reduced to tridiagonal form by Householder reflections on the driver. Its
leading eigenvalues are bracketed by bisection on Sturm counts; eigenvectors come from inverse iteration, orthogonalised
again within clusters of close eigenvalues, and are turned back by the reflections. The basis is broadcast.

Components c become whole numbers x = floor(1024 * c) + 100000, so sums and deviations are exact. Deviations from the
mean are formed before anything is multiplied: x - S/n is (x - floor(S/n)) - (S mod n)/n.

Defined results. Rows whose vector is null or empty or holds a null, NaN or infinite entry are dropped, as are vectors
whose length is not the most frequent one (the longer one of equals). Rows with a null or repeated id stay. x is cut off at 2**61 on both sides.
A deviation beyond a long is null. A component without variance (as many as the rows leave free) has whitened and explained 0 and
takes no part in the identity error. An empty table gives no rows. Further columns take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import spread, stage

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
CUT_OFF = 2**61
# Partial sums that reach the shuffle; tasks beyond that read several splits.
PARTIAL_SUMS = 4096
_LONG = 2**63 - 1
_EPS = float(np.finfo(np.float64).eps)


# --- eigenvectors of a symmetric matrix -------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the Householder vectors that reduce ``matrix``."""
    a = np.array(matrix, np.float64)
    d = len(a)
    reflections = []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        size = np.sqrt(v @ v)
        v[0] += math.copysign(size, v[0])
        length = np.sqrt(v @ v)
        if length > 0:
            v /= length
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (p @ v) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= 2 * (v @ a[k + 1 :, k]) * v
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues are below each of ``at``."""
    least = _EPS * (np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0)) * _EPS + np.finfo(np.float64).tiny
    q = diagonal[0] - at
    count = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diagonal[i] - at - off[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection from Gershgorin's bounds."""
    d = len(diagonal)
    reach = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    spare = _EPS * d * max(np.abs(low).max(), np.abs(high).max())
    low, high = low - spare, high + spare
    wanted = d - 1 - np.arange(k)  # eigenvalues below the j-th largest
    while True:
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        below = count_below(diagonal, off, middle) <= wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float):
    """x with (T - shift) x = b, by elimination with row exchanges."""
    d = len(diagonal)
    a, b, c = (diagonal - shift).tolist(), off.tolist() + [0.0], [0.0] * d
    below = off.tolist()
    swap, factor = [False] * d, [0.0] * d
    for i in range(d - 1):
        if abs(below[i]) > abs(a[i]):
            swap[i] = True
            a[i], below[i] = below[i], a[i]
            b[i], a[i + 1] = a[i + 1], b[i]
            c[i], b[i + 1] = b[i + 1], 0.0
        if a[i] == 0:
            a[i] = least
        factor[i] = below[i] / a[i]
        a[i + 1] -= factor[i] * b[i]
        b[i + 1] -= factor[i] * c[i]
    if abs(a[-1]) < least:
        a[-1] = least

    def solve(right: np.ndarray) -> np.ndarray:
        x = right.tolist()
        for i in range(d - 1):
            if swap[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor[i] * x[i]
        for i in range(d - 1, -1, -1):
            s = x[i]
            if i + 1 < d:
                s -= b[i] * x[i + 1]
            if i + 2 < d:
                s -= c[i] * x[i + 2]
            x[i] = s / a[i]
        return np.array(x)

    return solve


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns, by inverse iteration; ``values`` are falling.

    Eigenvalues closer than a thousandth of the norm are a cluster: each vector is made orthogonal
    to those before it in every step, and equal eigenvalues are set a little apart.
    """
    d = len(diagonal)
    norm = float(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0)) or 1.0
    out = np.zeros((d, len(values)))
    start, shift = 0, math.inf
    for j, value in enumerate(values.tolist()):
        if j and values[j - 1] - value > 1e-3 * norm:
            start = j
        shift = min(value, shift - 10 * _EPS * norm) if j > start else value
        solve = _solver(diagonal, off, shift, _EPS * norm)
        x = np.random.default_rng(j).standard_normal(d)
        for _ in range(6):
            largest = np.abs(x).max()
            x = solve(x / largest)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, start:j] @ (out[:, start:j].T @ x)
            x /= np.sqrt(x @ x)
        out[:, j] = x
    return out


def principal(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors as columns.

    Of the two signs, the one that makes the entry of largest size positive.
    """
    size = float(np.abs(matrix).max(initial=0)) or 1.0
    diagonal, off, reflections = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, k)
    x = vectors_of(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        x[i + 1 :] -= 2 * np.outer(v, v @ x[i + 1 :])
    x *= np.where(x[np.abs(x).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    return values * size, x


# --- passes over the vectors ------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _whole(c: np.ndarray) -> np.ndarray:
    y = np.floor(SCALE * c.astype(np.float64))
    return np.clip(y, -float(CUT_OFF), float(CUT_OFF)).astype(np.int64) + np.where(np.abs(y) < CUT_OFF, SHIFT, 0)


@dataclass
class Mean:
    """S / n by dimension, as floor and remainder: exact for any number of rows."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def away(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n


def _few(rows: DataFrame) -> DataFrame:
    return rows.coalesce(PARTIAL_SUMS)


def _exact_sums(rows: DataFrame) -> Mean | None:
    """Sums by dimension; halves of 32 bits keep every partial sum within a long."""
    def run(batches):
        n, high, low = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _whole(_matrix(batch.column("vector")))
                n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(high)), pa.int32()), pa.array([n] * len(high), pa.int64()), pa.array(high), pa.array(low)],
                ["i", "n", "high", "low"])

    wide = "decimal(38,0)"
    part = _few(rows).select("vector").mapInArrow(run, "i int, n long, high long, low long")
    total = F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")
    found = part.groupBy("i").agg(F.sum("n").alias("n"), *total).orderBy("i").collect()
    if not found:
        return None
    n = int(found[0].n)
    sums = [(int(r.high) << 32) + int(r.low) for r in found]
    return Mean(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.float64))


def _covariance(rows: DataFrame, n: int, width: int, centred) -> np.ndarray:
    """Mean product of every two entries of ``centred(matrix)`` over all rows."""
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                y = centred(_matrix(batch.column("vector")))
                total += y.T @ y
        if total.any():
            upper = [total[i, i:] for i in range(width)]
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(upper, pa.list_(pa.float64()))], ["i", "row"])

    part = _few(rows).select("vector").mapInArrow(run, "i int, row array<double>")
    cells = part.select("i", F.posexplode("row").alias("k", "v")).groupBy("i", "k").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in cells.collect():  # width * width / 2 cells
        out[r.i, r.i + r.k] = out[r.i + r.k, r.i] = r.v / n
    return out


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, vector: the rows that take part."""
    x = F.col("vector")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(F.size("vector") > 0)

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf))

    rows = rows.where(F.forall(x, finite))
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return spread(rows.where(F.size("vector") == (length[0].d if length else 0)))


def whitened(vectors: DataFrame, components: int = COMPONENTS, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each remaining row and component (from 1): vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    mean = _exact_sums(rows)
    schema = "vec_id long, deviation long, vector array<double>"
    if mean is None:
        n, explained, error = 0, [0.0], 0.0
        scored = spark.createDataFrame([], schema)
    else:
        n, d = mean.n, len(mean.whole)
        cov = _covariance(rows, n, d, lambda c: mean.away(_whole(c)))
        trace = float(np.trace(cov))
        values, basis = principal(cov, min(components, d))
        real = values > d * _EPS * trace
        explained = np.where(real, values / (trace or 1.0), 0.0).tolist()
        basis = np.where(real, basis / np.sqrt(np.where(real, values, 1.0)), 0.0)
        scored = stage(_projected(rows, mean, basis, schema), "whitened")
        centre = scored.select(F.posexplode("vector").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("v")).orderBy("i").collect()
        centre = np.array([r.v for r in centre])
        away = np.abs(_covariance(scored, n, len(values), lambda w: w - centre) - np.eye(len(values)))
        error = float(away[np.ix_(real, real)].max(initial=0))
    return scored.select("vec_id", "deviation", F.posexplode("vector").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, explained)), F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))


def _projected(rows: DataFrame, mean: Mean, basis: np.ndarray, schema: str) -> DataFrame:
    n, whole, rest = mean.n, mean.whole, mean.rest
    sent = rows.sparkSession.sparkContext.broadcast((whole, rest, basis))  # length x components

    def deviations(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> list[int | None]:
        """sum of (n * x - S) ** 2, exact."""
        t = x - whole
        about = ((n * t.astype(np.float64) - rest) ** 2).sum(1)
        if about.max(initial=0) < 2**62 and n * float(np.abs(t).max(initial=0)) < 2**62:
            return ((n * t - rest.astype(np.int64)) ** 2).sum(1).tolist()
        exact = [sum((n * a - int(b)) ** 2 for a, b in zip(r, rest.tolist())) for r in t.tolist()]
        return [v if v <= _LONG else None for v in exact]

    def run(batches):
        whole, rest, basis = sent.value
        for batch in batches:
            if batch.num_rows:
                x = _whole(_matrix(batch.column("vector")))
                y = ((x - whole).astype(np.float64) - rest / n) @ basis
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * y.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(deviations(x, whole, rest), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))],
                    ["vec_id", "deviation", "vector"])

    return rows.mapInArrow(run, schema)

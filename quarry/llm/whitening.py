"""Whitening of embeddings.

The covariance is a sum over tasks of products of centred vectors.  Its
leading eigenvalues come from a Householder reduction to a tridiagonal
matrix and bisection with Sturm counts, its components from inverse
iteration, orthogonal within clusters of near eigenvalues.  Only matrices
of (dimensions)^2 numbers reach the driver; every vector is projected where
it is read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stash

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Scaled entries of this size or more count as not finite: they have no exact sums.
LARGEST = 2.0**52
#: Eigenvalues nearer than this share of the matrix's norm form a cluster.
CLUSTER = 1e-3


# --- leading eigenpairs of a symmetric matrix

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Householder reduction: diagonal, off-diagonal and the mirrors (place,
    unit vector) whose product turns ``a`` into that matrix."""
    a, n, mirrors = a.copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = math.sqrt(float(x @ x))
        if size == 0 or not x[1:].any():
            continue
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        v /= math.sqrt(float(v @ v))
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2 * (v @ x) * v
        mirrors.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_count(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of eigenvalues of the tridiagonal matrix below each of ``x``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q, below = d[0] - x, np.zeros(len(x), int)
    for i in range(len(d)):
        if i:
            q = d[i] - x - e[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(d: np.ndarray, e: np.ndarray, m: int) -> np.ndarray:
    """The ``m`` largest eigenvalues, falling, by bisection to the last bit."""
    radius = np.abs(np.append(e, 0)) + np.abs(np.append(0, e))
    rank = len(d) - 1 - np.arange(m)
    lo, hi = np.full(m, (d - radius).min()), np.full(m, (d + radius).max())
    pad = np.finfo(float).eps * max(abs(lo[0]), abs(hi[0]), np.finfo(float).tiny)
    lo, hi = lo - pad, hi + pad
    while True:
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi) | (hi - lo <= pad / 4)).all():
            return mid
        above = sturm_count(d, e, mid) > rank
        lo, hi = np.where(above, lo, mid), np.where(above, mid, hi)


def solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """Solve (T - shift) y = b by elimination with exchanged rows; a pivot of
    zero becomes a tiny one."""
    n = len(d)
    least = np.finfo(float).eps * max(np.abs(d).max(), np.abs(e).max() if n > 1 else 0, np.finfo(float).tiny)
    diag, b = (d - shift).tolist(), b.tolist()
    up, low, up2 = [*e.tolist(), 0.0], e.tolist(), [0.0] * n
    for i in range(n - 1):
        if abs(low[i]) > abs(diag[i]):  # the next row leads
            diag[i], up[i], up2[i], here = low[i], diag[i + 1], up[i + 1], (diag[i], up[i])
            f = here[0] / diag[i]
            diag[i + 1], up[i + 1] = here[1] - f * up[i], -f * up2[i]
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
        else:
            if abs(diag[i]) < least:
                diag[i] = least
            f = low[i] / diag[i]
            diag[i + 1] -= f * up[i]
            b[i + 1] -= f * b[i]
    if abs(diag[-1]) < least:
        diag[-1] = least
    y = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        y[i] = (b[i] - up[i] * y[i + 1] - up2[i] * y[i + 2]) / diag[i]
    return np.array(y[:n])


def leading_pairs(v: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``m`` largest eigenvalues of the symmetric matrix ``v``, falling,
    and their unit eigenvectors as rows."""
    scale = float(np.abs(v).max())
    d, e, mirrors = tridiagonal(v / scale)
    values = leading_values(d, e, m)
    norm = max(np.abs(d).max(), np.abs(e).max() if len(e) else 0)
    eps = np.finfo(float).eps
    rng, vectors, cluster, last = np.random.default_rng(1), [], 0, math.inf
    for j, value in enumerate(values):
        if last - value > CLUSTER * norm:
            cluster = j
        shift = min(value, (last if j > cluster else math.inf) - 4 * eps * norm)  # equal values are parted
        last, y = shift, rng.standard_normal(len(d))
        for _ in range(6):
            for _ in range(2):
                for other in vectors[cluster:]:
                    y -= (other @ y) * other
                y /= np.abs(y).max()
                y /= math.sqrt(float(y @ y))
            z = solve_shifted(d, e, shift, y)
            y = z / np.abs(z).max()
        for _ in range(2):
            for other in vectors[cluster:]:
                y -= (other @ y) * other
            y /= math.sqrt(float(y @ y))
        vectors.append(y)
    out = np.array(vectors)
    for at, mirror in reversed(mirrors):
        out[:, at:] -= 2 * np.outer(out[:, at:] @ mirror, mirror)
    out /= np.sqrt((out * out).sum(axis=1, keepdims=True))
    values = ((out @ v) * out).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], out[order]


# --- passes over the vectors

def whole_numbers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of ``size`` finite entries, and their whole
    numbers (n x size)."""
    at = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), size), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), size) * SCALE
    with np.errstate(invalid="ignore"):
        good = (np.abs(flat) < LARGEST).all(axis=1)
    return at[good], np.floor(flat[good]).astype(np.int64) + SHIFT


def _sums(batches):
    """One row (size, n, sums as decimals) per length of vector of a task."""
    found: dict = {}
    for b in batches:
        column = b.column(0)
        for size in set(pc.unique(pc.list_value_length(column)).to_pylist()) - {None}:
            at, x = whole_numbers(column, size)
            n, s = found.get(size, (0, 0))
            if size:
                # halves keep the sums of a batch within 64 bits
                s = s + (x >> 26).sum(axis=0).astype(object) * 2**26 + (x & (2**26 - 1)).sum(axis=0).astype(object)
            found[size] = n + len(at), s
    for size, (n, s) in found.items():
        sums = [Decimal(int(v)) for v in s] if size and n else [Decimal(0)] * size
        yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.decimal128(38, 0)))],
                                         names=["size", "n", "sums"])


def _products(base: np.ndarray, rest: np.ndarray):
    """mapInArrow function: the upper half of the sum of a task's products of
    centred vectors, one row (i, values from i on) per dimension."""
    def run(batches):
        total, size = 0, len(base)
        for b in batches:
            z = whole_numbers(b.column(0), size)[1] - base - rest
            total = total + z.T @ z
        if not isinstance(total, int):
            rows = [total[i, i:] for i in range(size)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["i", "v"])
    return run


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n*x - S)^2 of every row, exactly."""
    base = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, base, strict=True)]
    y = x - np.array(base, np.int64)
    top = max(int(np.abs(y).max()), 1) if y.size else 1
    r = np.array(rest, np.int64)
    if top * max(top, n) * max(x.shape[1], 1) >= 2**62:
        y, r = y.astype(object), r.astype(object)
    squares, mixed, own = (y * y).sum(axis=1), (y * r).sum(axis=1), sum(v * v for v in rest)
    return [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, mixed, strict=True)]


def _project(n: int, sums: list[int], base: np.ndarray, rest: np.ndarray, axes: np.ndarray):
    """mapInArrow function: the first column with deviation and whitened."""
    def run(batches):
        for b in batches:
            at, x = whole_numbers(b.column(1), len(base))
            w = (x - base - rest) @ axes.T
            deviation = [Decimal(v) if v < 10**38 else None for v in exact_deviation(x, n, sums)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * len(axes), pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(deviation, pa.decimal128(38, 0)), lists],
                                             names=["key", "deviation", "whitened"])
    return run


@dataclass
class Whitening:
    """What was fitted, and ``rows``: key, deviation (decimal, null from
    10^38 on) and whitened, one number per component."""

    rows: DataFrame
    n: int
    values: list[float]
    axes: np.ndarray
    trace: float
    identity_error: float


def whiten(vectors: DataFrame, column: str = "embedding", key: Column | str = "vec_id", components: int = COMPONENTS) -> Whitening:
    """Whiten ``column`` of ``vectors`` on its first ``components`` components.

    Dropped are vectors that are null, hold a null, a non-finite entry or one
    of 2**52 / SCALE or more in size, or have another length than most (of
    equally many, the longest counts).  Components whose eigenvalue is zero
    to rounding are left out, so there may be fewer than ``components``, and
    none for one vector, equal vectors or an empty table (no rows then).
    Repeated rows count each time; null keys stay; other columns are not
    read.

    The vectors are read three times and never shuffled: for their sums, for
    the products of centred vectors, and to be projected."""
    spark = vectors.sparkSession
    vectors = vectors.select((F.col(key) if isinstance(key, str) else key).alias("key"), F.col(column).cast("array<double>").alias("vector"))
    one = vectors.select("vector")
    sums = stash(one.mapInArrow(_sums, "size int, n bigint, sums array<decimal(38,0)>"), "vector-sums")
    most = sums.where("size > 0").groupBy("size").agg(F.sum("n").alias("n")).where("n > 0").orderBy(F.desc("n"), F.desc("size")).first()
    none = spark.createDataFrame([], T.StructType([vectors.schema["key"], T.StructField("deviation", T.DecimalType(38, 0)),
                                                   T.StructField("whitened", T.ArrayType(T.DoubleType()))]))
    if not most:
        return Whitening(none, 0, [], np.zeros((0, 0)), 0.0, 0.0)
    n, size = most["n"], most["size"]
    total = sums.where(F.col("size") == size).select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()
    s = [int(r.s) for r in sorted(total, key=lambda r: r.i)]
    base = np.array([v // n for v in s], np.int64)
    rest = np.array([v % n for v in s], float) / n
    half = one.mapInArrow(_products(base, rest), "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v")) \
        .groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    v = np.zeros((size, size))
    i = half["i"].to_numpy(int)
    v[i, i + half["j"].to_numpy(int)] = half["v"].to_numpy() / n
    v = np.triu(v) + np.triu(v, 1).T
    trace = float(np.trace(v))
    if trace <= 0:
        return Whitening(none, n, [], np.zeros((0, size)), trace, 0.0)
    values, axes = leading_pairs(v, min(components, size))
    real = values > size * np.finfo(float).eps * values[0]
    values, axes = values[real], axes[real]
    rows = vectors.mapInArrow(_project(n, s, base, rest, axes / np.sqrt(values)[:, None]), none.schema)
    rows = stash(rows, "whitened")
    m = len(values)
    mean = rows.agg(*[F.avg(F.get("whitened", F.lit(a))) for a in range(m)]).first()
    pairs = [(a, b) for a in range(m) for b in range(a, m)]
    centred = [F.get("whitened", F.lit(a)) - F.lit(mean[a]) for a in range(m)]
    covariance = rows.agg(*[F.avg(centred[a] * centred[b]) for a, b in pairs]).first()
    error = max(abs(c - (a == b)) for (a, b), c in zip(pairs, covariance, strict=True))
    return Whitening(rows, n, [float(x) for x in values], axes, trace, error)

"""Whitening: vectors centred, projected on the leading components of their covariance, and scaled to variance 1.

Fit. Components become integers, ``floor(64 * c) + 1000000``; their sums, and the products of the entries centred
on the nearest integer to the mean, are exact whole numbers, summed per task and then by Spark, so the
covariance does not depend on partitioning. What is left of the mean is taken out of the sum of products exactly.
Its matrix is reduced to tridiagonal form by Householder reflections; the leading eigenvalues are bracketed by
Sturm counts and bisection; inverse iteration gives each component of the tridiagonal matrix, where
eigenvalues that lie close together are orthogonalised against each other in every step; the reflections carry the
components back. This runs in extended precision on one matrix of the vectors' width. Apply. Centre and components
are broadcast and every vector is projected where it lies.

Scale. Four passes over the table (sums, products, the check of the identity, output), none of which shuffles
vectors: a task sends one row per pair of dimensions at the most. What reaches the driver, and what is
broadcast, has the square of the width as its bound and does not grow with the table. A task holds one Arrow batch.

Defined results: vectors that are null, empty, hold null or non-finite entries, or one of 2^44 or more in
magnitude take no part, nor those of another width than most (the larger of equals). Repeated rows count, and
return, as often as they are there, rows without an id too. Components whose eigenvalue is not above rounding
(equal vectors, fewer vectors than components) are not returned. A deviation beyond 64 bits is null. An empty table gives
an empty result. Only id and vector are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import matrix, whole_vectors

COMPONENTS, FACTOR, SHIFT = 32, 64, 1_000_000
#: Integers are below this in magnitude, so that a difference of two is exact in a double.
LIMIT = 1 << 50
#: Eigenvalues whose distance is below this part of the largest are one cluster.
CLUSTER = 1e-3


@dataclass
class Whitening:
    n: int
    sums: list[int]                 # exact, per dimension
    values: np.ndarray              # leading eigenvalues, falling
    components: np.ndarray          # one unit column per eigenvalue
    trace: float


# ------------------------------------------------------------------ exact sums
def exact_products(d: np.ndarray) -> np.ndarray:
    """``d.T @ d`` of whole numbers, exact: by floating point where no sum can round, by Python's integers otherwise."""
    most = int(np.abs(d).max(initial=0))
    if most * most * len(d) < 1 << 53:
        f = d.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    big = d.astype(object)
    return big.T @ big


def column_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, dtype=object)
        for batch in batches:
            x = matrix(batch.column("x"), width)
            n, total = n + len(x), total + (x.sum(axis=0).astype(object) if len(x) < 4096 else x.astype(object).sum(axis=0))
        yield whole_numbers([(-1, n), *enumerate(total)], ["at", "total"])

    found = rows.select("x").mapInArrow(add, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total")).collect()
    by_place = {r["at"]: int(r["total"]) for r in found}
    return by_place.get(-1, 0), [by_place.get(i, 0) for i in range(width)]


def whole_numbers(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows whose last column is an exact whole number of any size."""
    from decimal import Decimal
    *places, totals = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([*[pa.array(p, type=pa.int32()) for p in places],
                                       pa.array([Decimal(int(t)) for t in totals], type=pa.decimal128(38, 0))], names=names)


def product_sums(rows: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Exact sums over all rows of the products of centred entries, per pair of dimensions."""
    width = len(centre)
    upper = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), dtype=object)
        for batch in batches:
            total = total + exact_products(matrix(batch.column("x"), width) - centre)
        yield whole_numbers(list(zip(*(u.tolist() for u in upper), total[upper])), ["i", "j", "total"])

    found = rows.select("x").mapInArrow(add, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    out = np.zeros((width, width), dtype=object)
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["total"])
    return out


def covariance(n: int, sums: list[int], centre: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Covariance with divisor n in extended precision, from exact sums."""
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    out = np.zeros(products.shape, dtype=np.longdouble)
    for i in range(len(rest)):
        for j in range(i, len(rest)):
            exact = Fraction(n * int(products[i, j]) - rest[i] * rest[j], n * n)
            high = float(exact)
            out[i, j] = out[j, i] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    return out


# ------------------------------------------------------------------ eigenvectors
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, the one beside it, and the unit Householder vectors that reduce a symmetric matrix to them."""
    a, n, mirrors = a.copy(), len(a), []
    for k in range(n - 2):
        v = np.zeros(n, dtype=a.dtype)
        v[k + 1:] = a[k + 1:, k]
        v[k + 1] += np.copysign(np.sqrt((v * v).sum()), v[k + 1])
        length = np.sqrt((v * v).sum())
        if length > 0:
            v /= length
            p = a @ v
            q = 2 * (p - (v * p).sum() * v)
            a -= np.outer(v, q) + np.outer(q, v)
        mirrors.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), mirrors


def sturm_count(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point: the negative terms of the Sturm sequence."""
    tiny = np.finfo(diagonal.dtype).tiny ** 0.5
    count, q = np.zeros(len(at), dtype=np.int64), np.ones(len(at), dtype=diagonal.dtype)
    for i in range(len(diagonal)):
        q = diagonal[i] - at - (beside[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection of all of them at once."""
    n = len(diagonal)
    around = np.zeros(n, dtype=diagonal.dtype)
    around[1:] += np.abs(beside)
    around[:-1] += np.abs(beside)
    low = np.full(count, (diagonal - around).min() - 1, dtype=diagonal.dtype)
    high = np.full(count, (diagonal + around).max() + 1, dtype=diagonal.dtype)
    wanted = n - 1 - np.arange(count)          # eigenvalues below the one looked for
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = sturm_count(diagonal, beside, middle) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def solve_shifted(diagonal: np.ndarray, beside: np.ndarray, shift, right: np.ndarray) -> np.ndarray:
    """Solution of ``(T - shift) x = right`` for a tridiagonal T, by elimination with row exchanges."""
    n = len(diagonal)
    tiny = np.finfo(diagonal.dtype).eps * max(np.abs(diagonal).max(), np.abs(beside).max(initial=0), np.finfo(diagonal.dtype).tiny)
    d, up, upper, b, low = diagonal - shift, np.append(beside, 0), np.zeros(n, dtype=diagonal.dtype), right.copy(), beside.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            d[i], low[i] = low[i], d[i]
            up[i], d[i + 1] = d[i + 1], up[i]
            upper[i], up[i + 1] = up[i + 1], 0
            b[i], b[i + 1] = b[i + 1], b[i]
        if d[i] == 0:
            d[i] = tiny
        factor = low[i] / d[i]
        d[i + 1] -= factor * up[i]
        up[i + 1] -= factor * upper[i]
        b[i + 1] -= factor * b[i]
    for i in range(n):
        if abs(d[i]) < tiny:
            d[i] = tiny
    x = np.zeros(n, dtype=diagonal.dtype)
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - (up[i] * x[i + 1] if i + 1 < n else 0) - (upper[i] * x[i + 2] if i + 2 < n else 0)) / d[i]
    return x


def leading_components(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    diagonal, beside, mirrors = tridiagonal(a)
    values = leading_values(diagonal, beside, count)
    scale = np.abs(values).max(initial=0)
    vectors = np.zeros((len(a), count), dtype=a.dtype)
    random, first = np.random.default_rng(1), 0
    for k in range(count):
        if k and values[k - 1] - values[k] > CLUSTER * scale:
            first = k
        near = vectors[:, first:k]
        # Equal values are told apart by a shift of a few roundings, as the systems would be the same.
        shift = values[k] - (k - first) * 4 * np.finfo(a.dtype).eps * scale
        x = random.standard_normal(len(a)).astype(a.dtype)
        for _ in range(5):
            for _ in range(2):                 # orthogonal to rounding takes two passes
                x = x - near @ (near.T @ x)
            x = x / np.sqrt((x * x).sum())
            x = solve_shifted(diagonal, beside, shift, x)
            x = x / np.abs(x).max()
        for _ in range(2):
            x = x - near @ (near.T @ x)
        vectors[:, k] = x / np.sqrt((x * x).sum())
    for v in reversed(mirrors):
        vectors -= 2 * np.outer(v, v @ vectors)
    return values, vectors


# ------------------------------------------------------------------ fit and apply
def integer_rows(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Columns vec_id and x of the vectors that take part, and their width."""
    rows, width = whole_vectors(vectors, vector, FACTOR, LIMIT, F.col(key).cast("long").alias("vec_id"))
    return rows.withColumn("x", F.transform("x", lambda c: c + SHIFT)), width


def fit(rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of integer rows (x): mean, covariance, leading components."""
    n, sums = column_sums(rows, max(width, 1))
    if n == 0:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    nearest = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    v = covariance(n, sums, nearest, product_sums(rows, nearest))
    values, columns = leading_components(v, min(components, width))
    # What is left of a covariance without rank is its last digits.
    real = values > np.finfo(np.float64).eps * width * max(values.max(initial=0), 0) if len(values) else values > 0
    return Whitening(n, sums, values[real].astype(np.float64), columns[:, real].astype(np.float64), float(np.trace(v)))


def plain(model: Whitening) -> tuple:
    """What tasks need, without a class of this package: n, nearest whole means below, the fractions above
    them, what the sums have beyond n times those, and the scaled components."""
    centre = [s // model.n for s in model.sums]
    rest = [s - model.n * c for s, c in zip(model.sums, centre)]
    scaled = model.components / np.sqrt(model.values)
    return model.n, np.array(centre, dtype=np.int64), np.array([float(Fraction(r, model.n)) for r in rest]), np.array(rest, dtype=np.int64), scaled


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(plain(model))
    width, count = model.components.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, centre, offset, _, scaled = shared.value
        first, second = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            w = ((matrix(batch.column("x"), width) - centre) - offset) @ scaled
            first, second = first + w.sum(axis=0), second + w.T @ w
        i, j = np.indices((count, count)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.full(count, -1), i), type=pa.int32()), pa.array(np.append(np.arange(count), j), type=pa.int32()),
                                          pa.array(np.append(first, second.ravel()))], names=["i", "j", "total"])

    found = rows.select("x").mapInArrow(add, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    total = {(r["i"], r["j"]): r["total"] / model.n for r in found}
    return max((abs(total[i, j] - total[-1, i] * total[-1, j] - (i == j)) for i in range(count) for j in range(count)), default=0.0)


def deviations(d: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """Sums of ``(n * x - S) ** 2`` per row of centred entries, exact; None beyond 64 bits."""
    most = (int(np.abs(d).max(initial=0)) + 1) * n
    if most * most * d.shape[1] < 1 << 62:
        far = d * n - rest
        return (far * far).sum(axis=1).tolist()
    far = d.astype(object) * n - rest.astype(object)
    return [int(t) if t < 1 << 63 else None for t in (far * far).sum(axis=1)]


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """Integer rows (vec_id, x) to vec_id, deviation, whitened (array, one value per component)."""
    if model.n == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    shared = rows.sparkSession.sparkContext.broadcast(plain(model))
    width = model.components.shape[0]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, centre, offset, rest, scaled = shared.value
        for batch in batches:
            d = matrix(batch.column("x"), width) - centre
            w = (d - offset) @ scaled
            ends = pa.array(np.arange(len(w) + 1) * w.shape[1], type=pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviations(d, n, rest), type=pa.int64()),
                                              pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(project, "vec_id long, deviation long, whitened array<double>")


def whitened_rows(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows, width = integer_rows(vectors, key, vector)
    model = fit(rows, width, components)
    error = identity_error(rows, model) if len(model.values) else 0.0
    part = F.array(*[F.lit(float(e) / model.trace) for e in model.values]).cast("array<double>")
    return whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(part, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"))

"""Whitening of embeddings by the leading components of their covariance.

Entries become whole numbers, so counts and sums are exact at any size. The centred covariance is
summed by task and then by Spark. The matrix, as wide as a vector, is made tridiagonal by Householder
reflections; leading eigenvalues are found by bisection on Sturm counts, their vectors by inverse
iteration, with vectors of close eigenvalues made orthogonal again. The components are broadcast and
every row is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import spark_schema, stored

#: Rows of a batch that are worked on at once.
_ROWS = 1024
_EPS = np.finfo(float).eps
#: Least share of the variance that a component has: below, rounding would show in the whitened covariance.
_LEAST = 1e5 * _EPS


def whole(entries: np.ndarray, scale: int = 64, shift: int = 1_000_000) -> np.ndarray:
    """floor(scale * c) + shift; entries too large for that keep their sign and stay below 2^50 in size."""
    return np.clip(np.floor(scale * entries.astype(float)), -(2.0**50), 2.0**50).astype(np.int64) + shift


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, side diagonal and the Householder reflections (first row, unit vector) of a symmetric matrix."""
    a = matrix.astype(float).copy()
    reflections = []
    for k in range(len(a) - 2):
        column = a[k + 1 :, k].copy()
        size = np.abs(column).max()
        if size == 0 or not np.abs(column[1:]).max() > 0:
            continue
        column /= size
        column[0] += np.copysign(np.linalg.norm(column), column[0])
        v = column / np.linalg.norm(column)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        edge = a[k + 1 :, k] - 2 * v * (v @ a[k + 1 :, k])
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = edge[0]
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each of `at`."""
    least = _EPS * max(float(np.abs(diagonal).max()), float(np.abs(side).max(initial=0.0)), np.finfo(float).tiny)
    count = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (side[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least * _EPS, -least * _EPS, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of Gershgorin's interval until it stops shrinking."""
    n = len(diagonal)
    reach = np.concatenate(([0.0], np.abs(side))) + np.concatenate((np.abs(side), [0.0]))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    slack = 4 * _EPS * max(abs(low), abs(high), np.finfo(float).tiny)
    lows, highs = np.full(k, low - slack), np.full(k, high + slack)
    rank = n - 1 - np.arange(k)  # eigenvalues below the one sought
    for _ in range(1100):
        middle = lows + (highs - lows) / 2
        if not ((middle > lows) & (middle < highs)).any():
            break
        left = below(diagonal, side, middle) <= rank
        lows, highs = np.where(left, middle, lows), np.where(left, highs, middle)
    return lows + (highs - lows) / 2


def _solve(diagonal: np.ndarray, side: np.ndarray, value: float, b: np.ndarray) -> np.ndarray:
    """(T - value) x = b by elimination with row exchanges; a vanishing pivot counts as a tiny one."""
    n = len(diagonal)
    tiny = _EPS * max(float(np.abs(diagonal).max()), float(np.abs(side).max(initial=0.0)), np.finfo(float).tiny)
    main, upper, second, x = diagonal - value, np.append(side, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        lower = side[i]
        if abs(lower) > abs(main[i]):
            main[i], upper[i], second[i], main[i + 1], upper[i + 1], factor = lower, main[i + 1], upper[i + 1], upper[i], 0.0, main[i] / lower
            x[i], x[i + 1] = x[i + 1], x[i]
            main[i + 1] -= factor * upper[i]
            upper[i + 1] -= factor * second[i]
        else:
            if abs(main[i]) < tiny:
                main[i] = tiny
            factor = lower / main[i]
            main[i + 1] -= factor * upper[i]
        x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        if abs(main[i]) < tiny:
            main[i] = np.copysign(tiny, main[i])
        rest = upper[i] * x[i + 1] if i + 1 < n else 0.0
        rest += second[i] * x[i + 2] if i + 2 < n else 0.0
        x[i] = (x[i] - rest) / main[i]
        if abs(x[i]) > 1e150:  # a solution is wanted up to a factor
            x *= 1e-150
    return x


def leading_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues by inverse iteration.

    A vector is made orthogonal to those before it whose eigenvalues are close in a chain.
    """
    size = max(float(np.abs(diagonal).max()) + 2 * float(np.abs(side).max(initial=0.0)), np.finfo(float).tiny)
    vectors = np.zeros((len(diagonal), len(values)))
    rng = np.random.default_rng(1)
    cluster, used = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            cluster = k
        used = min(value, used - 4 * _EPS * size) if k > cluster else value  # equal ones a little apart
        near = vectors[:, cluster:k]
        x = rng.uniform(-1, 1, len(diagonal))
        for _ in range(8):
            x /= np.linalg.norm(x)
            before, x = x, _solve(diagonal, side, used, x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= near @ (near.T @ x)
            x /= np.linalg.norm(x)
            if min(np.abs(x - before).max(), np.abs(x + before).max()) < 4 * _EPS:
                break
        vectors[:, k] = x
    return vectors


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to `most` eigenvalues of a covariance, falling, and unit eigenvectors (columns).

    Directions without variance beyond rounding are left out. A vector's largest entry is positive.
    """
    trace = float(np.trace(matrix)) if len(matrix) else 0.0
    if not trace > 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, side, reflections = tridiagonal(matrix)
    values = leading_values(diagonal, side, min(most, len(matrix)))
    values = values[values > _LEAST * trace]
    vectors = leading_vectors(diagonal, side, values)
    for first, v in reversed(reflections):
        vectors[first:] -= 2 * np.outer(v, v @ vectors[first:])
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole entries) of _ROWS rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part.column(0), whole(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))


_ENTRIES = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])


def _summed(rows: DataFrame, width: int, product) -> np.ndarray:
    """The sum over all rows of product(whole entries), a small matrix: by task, then by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, width):
            made = product(x)
            total = made if total is None else total + made
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], schema=_ENTRIES)

    sums = rows.mapInArrow(partial, spark_schema(_ENTRIES)).groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((max(sums["i"].to_pylist(), default=-1) + 1, max(sums["j"].to_pylist(), default=-1) + 1))
    out[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["value"].to_numpy()
    return out


_PARTS = pa.schema([("dimension", pa.int32()), ("n", pa.int64()), ("s", pa.decimal128(38, 0))])


def _sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for _, x in _blocks(batches, width):
            n += len(x)
            total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]  # within a long for _ROWS entries below 2^50
        if n:
            columns = [list(range(width)), [n] * width, [Decimal(t) for t in total]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARTS)], schema=_PARTS)

    sums = rows.mapInArrow(partial, spark_schema(_PARTS)).groupBy("dimension").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    by = {r["dimension"]: r for r in sums}
    return (by[0]["n"], [int(by[d]["s"]) for d in range(width)]) if by else (0, [0] * width)


def fit_rows(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the rows that take part, stored, and the width of their vectors.

    Vectors that are null, empty or hold null or non-finite entries do not take part, and where
    widths differ only those of the commonest width do (of equally common ones the larger).
    """
    entry = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(rows.filter((F.size("embedding") > 0) & F.forall("embedding", entry)), "vectors")
    widths = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    return rows.filter(F.size("embedding") == width), width


_WHITENED = [("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]


def whitened(vectors: DataFrame, components: int = 32) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    vectors: vec_id and embedding (an array of numbers); other columns are not read. fit_rows says
    which rows take part. Components without variance are left out: equal vectors, a single vector
    and an empty table give no rows. Repeated rows and null ids are rows like any other. deviation
    is null where it does not fit a long.
    """
    rows, width = fit_rows(vectors)
    schema = pa.schema([("vec_id", to_arrow_type(rows.schema["vec_id"].dataType)), *_WHITENED])
    n, s = _sums(rows, width)
    base = np.array([t // max(n, 1) for t in s], np.int64)
    left = np.array([t % max(n, 1) for t in s], np.int64)  # the mean is base + left / n
    share = left / max(n, 1)

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - base) - share

    covariance = _summed(rows, width, lambda x: centred(x).T @ centred(x)) / max(n, 1)
    covariance = (covariance + covariance.T) / 2
    values, axes = leading(covariance, components)
    k = len(values)
    if k == 0:
        return rows.sparkSession.createDataFrame([], spark_schema(schema))
    axes = rows.sparkSession.sparkContext.broadcast(axes / np.sqrt(values))

    def project(x: np.ndarray) -> np.ndarray:
        return centred(x) @ axes.value

    middle = _summed(rows, width, lambda x: project(x).sum(axis=0, keepdims=True))[0] / n
    identity = _summed(rows, width, lambda x: (project(x) - middle).T @ (project(x) - middle)) / n
    error = float(np.abs(identity - np.eye(k)).max())
    explained = values / float(np.trace(covariance))

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, width):
            m = len(x)
            off = x - base
            near = np.square(n * off.astype(float) - left).sum(axis=1) < 9e18
            off[~near] = 0
            deviation = pa.array(np.square(n * off - left).sum(axis=1), mask=~near)
            each = np.repeat(np.arange(m), k)
            columns = [ids.take(pa.array(each)), np.tile(np.arange(1, k + 1), m), np.full(m * k, n), deviation.take(pa.array(each))]
            columns += [project(x).ravel(), np.tile(explained, m), np.full(m * k, error)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(project_rows, spark_schema(schema))

"""Whitening of vectors (operator 12): centred covariance over all rows, own eigenvalues and components.

Entries are scaled to whole numbers, so sums and products of them are exact and don't depend on how rows
are dealt: each task adds up products of its centred rows, Spark adds up the tasks' sums, and only the
covariance (as large as the square of the dimension, whatever the number of rows) reaches the driver.
There it is brought to tridiagonal form by Householder reflections; the leading eigenvalues come from
bisection on Sturm counts, their vectors from inverse iteration, made orthogonal within clusters.  Mean
and components go to all tasks, which project their rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.llm.common import int_array, pieces, stored

SCALE = 256
COMPONENTS = 4
#: Eigenvalues nearer than this share of the matrix norm are one cluster: their vectors are kept orthogonal.
CLUSTER = 1e-3
_EPS = np.finfo(float).eps
_WIDTHS = ("<i2", "<i4", "<i8")
_EXACT = pa.decimal128(38, 0)


# --- eigenvalues and components of a symmetric matrix -------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit Householder vectors (reflection i acts on rows i + 1 and on) of symmetric ``a``."""
    a, n, mirrors = np.array(a, float), len(a), []
    for i in range(n - 2):
        x = a[i + 1 :, i].copy()
        norm = np.linalg.norm(x)
        v = x.copy()
        v[0] += math.copysign(norm, x[0])
        size = np.linalg.norm(v)
        v = v / size if size else v
        mirrors.append(v)
        if not size:
            continue
        p = a[i + 1 :, i + 1 :] @ v
        w = p - (p @ v) * v
        a[i + 1 :, i + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[i + 1 :, i] = a[i, i + 1 :] = 0
        a[i + 1, i] = a[i, i + 1] = -math.copysign(norm, x[0])
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def below(d: list[float], e2: list[float], x: float, tiny: float) -> int:
    """Sturm count: how many eigenvalues of the tridiagonal matrix are less than ``x``."""
    q, count = 1.0, 0
    for i, di in enumerate(d):
        q = di - x - (e2[i - 1] / q if i else 0.0)
        if abs(q) < tiny:
            q = -tiny
        count += q < 0
    return count


def leading(d: np.ndarray, e: np.ndarray, k: int) -> list[float]:
    """The k largest eigenvalues, falling, each bisected until its bounds are neighbouring numbers."""
    radius = np.abs(np.concatenate(([0.0], e))) + np.abs(np.concatenate((e, [0.0])))
    low, high = float((d - radius).min()), float((d + radius).max())
    norm = max(abs(low), abs(high))
    low, high = low - 4 * _EPS * norm, high + 4 * _EPS * norm
    tiny = max(norm * _EPS * _EPS, np.finfo(float).tiny)
    dl, e2, n, out = d.tolist(), (e * e).tolist(), len(d), []
    for i in range(k):
        a, b = low, out[-1] if out else high
        # eigenvalue i from the top: at most n - 1 - i lie below it
        while (mid := a + (b - a) / 2) not in (a, b) and b - a > _EPS * norm / 8:
            if below(dl, e2, mid, tiny) > n - 1 - i:
                b = mid
            else:
                a = mid
        out.append(a + (b - a) / 2)
    return out


def _factored(d: list[float], e: list[float], shift: float, tiny: float):
    """Rows of the upper factor (three bands), multipliers and row swaps of the shifted tridiagonal matrix."""
    n = len(d)
    u, low, swap = [[0.0, 0.0, 0.0] for _ in range(n)], [0.0] * n, [False] * n
    row = [d[0] - shift, e[0] if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        under = [e[i], d[i + 1] - shift, e[i + 1] if i + 2 < n else 0.0]
        if abs(under[0]) > abs(row[0]):
            row, under, swap[i] = under, [row[0], row[1], row[2]], True
        pivot = row[0] if abs(row[0]) > tiny else math.copysign(tiny, row[0])
        u[i] = [pivot, row[1], row[2]]
        low[i] = under[0] / pivot
        row = [under[1] - low[i] * row[1], under[2] - low[i] * row[2], 0.0]
    u[n - 1] = [row[0] if abs(row[0]) > tiny else math.copysign(tiny, row[0]), 0.0, 0.0]
    return u, low, swap


def _solved(factor, b: np.ndarray) -> np.ndarray:
    u, low, swap = factor
    y, n = b.tolist(), len(b)
    for i in range(n - 1):
        if swap[i]:
            y[i], y[i + 1] = y[i + 1], y[i]
        y[i + 1] -= low[i] * y[i]
    for i in range(n - 1, -1, -1):
        rest = y[i]
        if i + 1 < n:
            rest -= u[i][1] * y[i + 1]
        if i + 2 < n:
            rest -= u[i][2] * y[i + 2]
        y[i] = rest / u[i][0]
    return np.array(y)


def eigenpairs(a: np.ndarray, k: int, rounds: int = 6, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of symmetric ``a``, falling, and their unit vectors as columns."""
    n = len(a)
    k = min(k, n)
    scale = float(np.abs(a).max()) if n else 0.0
    if not scale:
        return np.zeros(k), np.eye(n, k)
    d, e, mirrors = tridiagonal(a / scale)
    values = leading(d, e, k)
    norm = max(abs(v) for v in (*d.tolist(), *e.tolist(), *values))
    rng, vectors, cluster = np.random.default_rng(seed), [], 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            cluster = i
        factor = _factored(d.tolist(), e.tolist(), value, _EPS * norm)
        y = rng.standard_normal(n)
        for _ in range(rounds):
            y = _solved(factor, y / np.abs(y).max())
            for _ in range(2):
                for v in vectors[cluster:]:
                    y = y - (v @ y) * v
            y = y / np.linalg.norm(y)
        vectors.append(y)
    out = np.array(vectors).T
    for i in range(n - 3, -1, -1):
        v = mirrors[i]
        out[i + 1 :] -= 2 * np.outer(v, v @ out[i + 1 :])
    return np.array(values) * scale, out


# --- rows ---------------------------------------------------------------------------------------------

@dataclass
class Model:
    """What the fit list says: its size, sums, the whitening matrix (a row per dimension) and shares."""

    n: int
    sums: list[int]
    matrix: np.ndarray
    values: np.ndarray
    explained: list[float | None]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 c) as long; beyond the longs, the nearest long."""
    scaled = np.floor(SCALE * x)
    top = scaled >= 2.0**63
    out = np.where(top, 0, np.maximum(scaled, -(2.0**63))).astype(np.int64)
    out[top] = 2**63 - 1
    return out


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _keys(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Each vector as bytes, in the least of three widths that holds it: equal vectors have equal bytes."""
    for batch in pieces(batches, 8192):
        x = whole(_vectors(batch.column(0), width))
        low, high = x.min(1), x.max(1)
        need = np.where((low >= -(2**15)) & (high < 2**15), 0, np.where((low >= -(2**31)) & (high < 2**31), 1, 2))
        for at, kind in enumerate(_WIDTHS):
            rows = np.ascontiguousarray(x[need == at].astype(kind))
            if not len(rows):
                continue
            step = rows.itemsize * width
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(step)
            data = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
            yield pa.RecordBatch.from_arrays([data], ["key"])


def _decoded(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The whole numbers of ``_keys`` again, as rows of longs."""
    for batch in pieces(batches, 8192):
        column = batch.column(0).cast(pa.binary())
        sizes = pc.binary_length(column)
        for kind in _WIDTHS:
            rows = column.filter(pc.equal(sizes, np.dtype(kind).itemsize * width))
            if len(rows):
                yield np.frombuffer(b"".join(rows.to_pylist()), kind).reshape(-1, width).astype(np.int64)


def _exact(values) -> pa.Array:
    """Whole numbers as decimals; null beyond 38 digits."""
    return pa.array([Decimal(v) if abs(v) < 10**38 else None for v in map(int, values)], _EXACT)


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """One row a dimension: the sum of its entries; dimension -1 has the number of rows."""
    high, low, n = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
    for x in _decoded(batches, width):
        high += (x >> 32).sum(0)
        low += (x & 0xFFFFFFFF).sum(0)
        n += len(x)
    total = [n] + [(int(h) << 32) + int(v) for h, v in zip(high, low)]
    yield pa.RecordBatch.from_arrays([int_array(np.arange(-1, width)), _exact(total)], ["i", "total"])


def _products(batches: Iterator[pa.RecordBatch], width: int, centre: list[int]) -> Iterator[pa.RecordBatch]:
    """One row a pair of dimensions: the exact sum of the products of their entries, centred first."""
    c, total = np.array(centre, object), np.zeros((width, width), object)
    for x in _decoded(batches, width):
        least, most = int(x.min()), int(x.max())
        far = max(abs(least - m) for m in (min(centre), max(centre)))
        far = max(far, *(abs(most - m) for m in (min(centre), max(centre))))
        if far < 2**26:
            y = (x - c.astype(np.int64)).astype(float)
            # so many products add up to a whole number that a double holds exactly
            step = max(1, 2**52 // max(1, far * far))
            for at in range(0, len(y), step):
                part = y[at : at + step]
                total += (part.T @ part).astype(np.int64)
        else:
            y = x.astype(object) - c
            total += y.T.dot(y)
    i, j = np.triu_indices(width)
    yield pa.RecordBatch.from_arrays([int_array(i), int_array(j), _exact(total[i, j])], ["i", "j", "total"])


def _whitened(x: np.ndarray, model: Model, mean: np.ndarray) -> np.ndarray:
    return (x.astype(float) - mean) @ model.matrix


def _check(batches: Iterator[pa.RecordBatch], width: int, model: Model) -> Iterator[pa.RecordBatch]:
    """Sums of whitened values (j = -1) and of their products about the task's mean, with that mean's share."""
    mean, k = model.mean, model.matrix.shape[1]
    first, second, n = np.zeros(k), np.zeros((k, k)), 0
    for x in _decoded(batches, width):
        w = _whitened(x, model, mean)
        first += w.sum(0)
        own = w.mean(0)
        second += (w - own).T @ (w - own) + len(w) * np.outer(own, own)
        n += len(w)
    i, j = np.triu_indices(k)
    yield pa.RecordBatch.from_arrays(
        [int_array(np.concatenate((np.arange(k), i))), int_array(np.concatenate((np.full(k, -1), j))),
         pa.array(np.concatenate((first, second[i, j])), pa.float64())], ["i", "j", "total"])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum over dimensions of (n * x - S) ** 2 of each row: n² Σx² - 2n Σ xS + ΣS²."""
    own = sum(s * s for s in sums)
    most = int(max(abs(int(x.min())), abs(int(x.max())))) if x.size else 0
    if most >= 2**26:
        return [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    squares, mixed = [0] * len(x), [0] * len(x)
    for at in range(0, x.shape[1], 512):  # 2**9 products of 2**52 fit in a long
        part, s = x[:, at : at + 512], sums[at : at + 512]
        squares = [a + b for a, b in zip(squares, (part * part).sum(1).tolist())]
        shift = 0
        rest = [abs(v) for v in s]
        sign = np.array([-1 if v < 0 else 1 for v in s], np.int64)
        while any(rest):
            limb = np.array([v & (2**26 - 1) for v in rest], np.int64) * sign
            mixed = [a + (b << shift) for a, b in zip(mixed, (part @ limb).tolist())]
            rest, shift = [v >> 26 for v in rest], shift + 26
    return [n * n * a - 2 * n * b + own for a, b in zip(squares, mixed)]


def _project(batches: Iterator[pa.RecordBatch], width: int, model: Model) -> Iterator[pa.RecordBatch]:
    mean, k = model.mean, len(model.values)
    defined = model.matrix.shape[1]
    for batch in pieces(batches, 4096):
        x = whole(_vectors(batch.column(1), width))
        w = np.zeros((len(x), k))
        w[:, :defined] = _whitened(x, model, mean)
        none = np.zeros((len(x), k), bool)
        none[:, defined:] = True
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(w.ravel(), pa.float64(), mask=none.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), _exact(deviations(x, model.n, model.sums)), values], ["vec_id", "deviation", "whitened"])


def finite(vector: str) -> Column:
    """Vectors that aren't null or empty and hold no null or non-finite entry."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def covariance(n: int, sums: list[int], centre: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance (divisor n) out of exact sums of products about ``centre``: each entry is rounded once."""
    off, width = [s - n * c for s, c in zip(sums, centre)], len(sums)
    v = np.zeros((width, width))
    for (i, j), p in products.items():
        v[i, j] = v[j, i] = float(Fraction(n * p - off[i] * off[j], n * n))
    return v


def fit(keys: DataFrame, width: int, components: int = COMPONENTS) -> tuple[Model, float | None] | None:
    """The model of a stored fit list (``key``: vectors as bytes, each once) and its identity error; None without rows.

    The driver gets one row a dimension and one a pair of dimensions.  Components whose eigenvalue is not above
    rounding have no whitened values.  The error is the largest absolute entry of the covariance of the fit
    list's whitened values minus the identity.
    """
    total = {r.i: int(r.total) for r in keys.mapInArrow(partial(_sums, width=width), "i long, total decimal(38,0)")
             .groupBy("i").agg(F.sum("total").alias("total")).collect()}
    n = total.get(-1, 0)
    if not n:
        return None
    sums = [total[i] for i in range(width)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = keys.mapInArrow(partial(_products, width=width, centre=centre), "i long, j long, total decimal(38,0)")
    found = {(r.i, r.j): int(r.total) for r in products.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    v = covariance(n, sums, centre, found)
    trace = float(np.trace(v))
    values, vectors = eigenpairs(v, components)
    defined = int((values > width * _EPS * max(values[0], 0.0)).sum()) if trace > 0 else 0
    matrix = vectors[:, :defined] / np.sqrt(values[:defined])
    model = Model(n, sums, matrix, values, [float(max(e, 0.0) / trace) if trace > 0 else None for e in values])
    if not defined:
        return model, None
    sums2 = keys.mapInArrow(partial(_check, width=width, model=model), "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    got = {(r.i, r.j): r.total / n for r in sums2.collect()}
    return model, max(abs(got[i, j] - got[i, -1] * got[j, -1] - (i == j)) for i in range(defined) for j in range(i, defined))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened, explained, identity_error of each usable row.

    vectors: (vec_id, embedding).  Rows whose vector is null, empty, or holds a null or non-finite entry take
    no part, nor do those of another length than most (of equally many, the longest).  Entries count as
    x = floor(256 c); beyond the longs, as the nearest long.  The fit list is each distinct x once: ``n`` of them.
    deviation is the exact sum over dimensions of (n * x - S) ** 2, a decimal, null beyond 38 digits.  whitened
    and explained have an element per component, by falling eigenvalue, fewer than asked for if the
    dimension is smaller; where the eigenvalue isn't above rounding (fewer distinct vectors than components,
    say), whitened is null, and without any variance explained and identity_error are null as well.  Null and
    repeated ids and repeated rows stay, one row each.  No usable rows give no rows.  Other columns aren't read.

    The driver and each task hold the square of the dimension, and nothing that grows with the rows.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x")).where(finite("x"))
    shape = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("width")).first()
    columns = f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"
    result = ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    if shape is None:
        return spark.createDataFrame([], f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")
    width = shape.width
    rows = rows.where(F.size("x") == width)
    keys = stored(rows.select("x").mapInArrow(partial(_keys, width=width), "key binary").distinct(), "vectors")
    model, error = fit(keys, width, components)
    out = rows.mapInArrow(partial(_project, width=width, model=model), columns)
    shares = F.array(*(F.lit(e).cast("double") for e in model.explained))
    return out.withColumns({"n": F.lit(model.n).cast("long"), "explained": shares, "identity_error": F.lit(error).cast("double")}).select(*result)

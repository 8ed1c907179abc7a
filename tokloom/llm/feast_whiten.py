"""Whitening of embeddings by their leading components, found by contour integration (FEAST).

1. Every vector becomes whole numbers x = floor(64 c) + 1000000. The distinct vectors are the fit list: written
   once, counted and summed by one aggregation, then their centred products by a second.
2. The covariance, as large as the square of the dimension whatever the number of rows, goes to the driver. Its
   spectrum is cut into intervals by inertia counts (Sturm sequences of the tridiagonal form): the least place
   above which the wanted number of eigenvalues lies, then halves until an interval holds few.
3. For each interval a quadrature over a circle through its ends sums solutions of complex shifted systems
   (zI - V) Y; the sum is a projection onto the interval's eigenvectors. Rayleigh-Ritz in that subspace gives
   them, and is repeated until the residuals vanish. The inertia count tells whether any is missing; then
   the subspace grows.
4. Every row is centred and projected inside its task; no row is shuffled for it. The covariance of the whitened
   fit list is measured by a third aggregation (partial means and centred products), not inferred.

Nothing but sums of d or d * d numbers reaches the driver. Vectors travel as their smallest whole
numbers, two bytes an entry where they fit.

Edge cases: rows whose vector is null or holds a null or non-finite entry are dropped; so are those whose vector has
another length than most of the fit list (the shorter of equals). 64 c is held within 2^53. Components with no more than
1e-12 of the largest eigenvalue have no variance to divide by and are left out, so equal vectors, a single one, empty
ones or an empty table give no rows. A deviation beyond 64 bits is null. Rows that repeat an id, or have
none, are whitened row by row. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokloom.llm.common import named_rows, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: A component whose eigenvalue is a smaller part of the largest is left out.
LEAST_PART = 1e-12
NODES = 8
IN_INTERVAL = 6
ROUNDS = 40
SEED = 13
_EDGE = 2.0 ** 53
_SLICE = 1 << 19  # entries handled at a time


def whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x - SHIFT of these rows), by length of the vectors, of all rows without faults."""
    size = np.array(column.value_lengths().fill_null(-1))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    starts = np.append(0, np.cumsum(np.maximum(size, 0)))
    for dim in np.unique(size[size >= 0]):
        row = np.flatnonzero(size == dim)
        for at in range(0, len(row), max(1, _SLICE // max(1, int(dim)))):
            some = row[at:at + max(1, _SLICE // max(1, int(dim)))]
            c = flat[starts[some][:, None] + np.arange(dim)]
            fine = np.isfinite(c).all(axis=1)
            with np.errstate(over="ignore"):
                yield some[fine], np.clip(np.floor(SCALE * c[fine]), -_EDGE, _EDGE).astype(np.int64)


def _keys(batches):
    for batch in batches:
        for _, x in whole_vectors(batch.column("embedding")):
            short = (np.abs(x) < 2 ** 15).all(axis=1)
            for part, kind in ((x[short], "<i2"), (x[~short], "<i8")):
                if len(part):
                    key = [r.tobytes() for r in part.astype(kind)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), x.shape[1], np.int32)), pa.array(key, pa.binary())],
                        ["dim", "key"])


def _fit_rows(batches, dim: int) -> Iterator[np.ndarray]:
    """x - SHIFT of the fit list, some rows at a time."""
    for batch in batches:
        key = batch.column("key")
        size = np.array(pc.binary_length(key))
        for width, kind in ((2, "<i2"), (8, "<i8")):
            row = np.flatnonzero(size == width * dim)
            step = max(1, _SLICE // dim)
            for at in range(0, len(row), step):
                data = b"".join(key.take(pa.array(row[at:at + step])).to_pylist())
                yield np.frombuffer(data, kind).reshape(-1, dim).astype(np.int64)


def fit_list(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(dim, key): each distinct vector once, of the commonest length; and that length."""
    keys = stored(vectors.select("embedding").mapInArrow(_keys, "dim int, key binary").distinct(), "fit-list")
    most = keys.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    return keys.filter(F.col("dim") == dim), dim


def sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors of the fit list, and the exact sum of x - SHIFT of each dimension."""
    def run(batches):
        n, total = 0, [0] * dim
        for x in _fit_rows(batches, dim):
            for at in range(0, len(x), 512):  # 512 entries of 2^53 fit in 64 bits
                some = x[at:at + 512]
                total = [a + b for a, b in zip(total, some.sum(axis=0).tolist())]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                 pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))], ["i", "n", "s"])

    got = (fit.mapInArrow(run, "i int, n long, s decimal(38, 0)").groupBy("i")
           .agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38, 0)").alias("s")).orderBy("i").collect())
    return got[0]["n"], [int(r["s"]) for r in got]


@dataclass
class Centre:
    n: int
    total: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as whole numbers; Python's own where 64 bits might not do."""
        largest = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.total), default=0)
        kind = np.int64 if largest < 2 ** 62 else object
        return x.astype(kind) * self.n - np.array(self.total, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(float) / self.n


def _matrix(parts: DataFrame, dim: int) -> np.ndarray:
    """The sum of partial symmetric matrices given as (i, j, v) of the upper half."""
    out = np.zeros((dim, dim))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _upper(m: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(m))
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                       pa.array(m[i, j])], ["i", "j", "v"])


def covariance(fit: DataFrame, dim: int, centre: Centre) -> np.ndarray:
    def run(batches):
        total = np.zeros((dim, dim))
        for x in _fit_rows(batches, dim):
            c = centre.centred(x)
            total += c.T @ c
        yield _upper(total)

    return _matrix(fit.mapInArrow(run, "i int, j int, v double"), dim) / centre.n


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix, by Householder."""
    a = v.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm:
            x[0] += np.copysign(norm, x[0])
            x /= np.linalg.norm(x)
            a[k + 1:] -= 2 * np.outer(x, x @ a[k + 1:])
            a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """How many eigenvalues of a symmetric matrix lie above a place."""

    def __init__(self, v: np.ndarray):
        self.a, self.b = tridiagonal(v)
        reach = np.append(np.abs(self.b), 0) + np.append(0, np.abs(self.b))
        self.top = float((self.a + reach).max())
        self.tiny = np.finfo(float).tiny + np.finfo(float).eps ** 2 * abs(self.top)

    def above(self, place: float) -> int:
        """Positive pivots of the tridiagonal matrix less ``place`` on the diagonal."""
        found, pivot = 0, 1.0
        for k in range(len(self.a)):
            pivot = self.a[k] - place - (self.b[k - 1] ** 2 / pivot if k else 0.0)
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            found += pivot > 0
        return found

    def clear_of(self, place: float, gap: float) -> float:
        """A place at or below ``place`` with no eigenvalue within ``gap``, if one is near."""
        for k in range(8):
            at = place - 3 * k * gap
            if self.above(at - gap) == self.above(at + gap):
                return at
        return place


def intervals(inertia: Inertia, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) that together hold the ``wanted`` largest eigenvalues."""
    top = inertia.top * (1 + 1e-9)
    low, high = inertia.top * LEAST_PART, top
    wanted = min(wanted, inertia.above(low))
    if not wanted:
        return []
    while inertia.above(low) > wanted and high - low > 1e-7 * top:
        middle = (low + high) / 2
        low, high = (middle, high) if inertia.above(middle) >= wanted else (low, middle)
    low = max(inertia.clear_of(low, 1e-8 * top), inertia.top * LEAST_PART)
    todo, out = [(low, top)], []
    while todo:
        a, b = todo.pop()
        inside = inertia.above(a) - inertia.above(b)
        middle = inertia.clear_of((a + b) / 2, 1e-3 * (b - a))
        if inside > IN_INTERVAL and b - a > 1e-7 * top:
            todo += [(a, middle), (middle, b)]
        elif inside:
            out.append((a, b, inside))
    return sorted(out, reverse=True)


def _ritz(v: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, _ = np.linalg.qr(y)
    value, u = np.linalg.eigh(q.T @ v @ q)
    return value, q @ u


def _one_interval(v: np.ndarray, low: float, high: float, inside: int, room: int) -> np.ndarray | None:
    """The eigenvectors of one interval, or None if ``room`` vectors do not find as many as the count says."""
    d = len(v)
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi * (1 + x) / 2)
    middle, radius = (low + high) / 2, (high - low) / 2
    shifted = [(middle + radius * t) * np.eye(d) - v for t in turn]
    y = np.random.default_rng(SEED).normal(size=(d, room))
    bound = 1e-14 * d ** 0.5 * np.abs(v).sum(axis=1).max()
    best, least = None, np.inf
    for _ in range(ROUNDS):
        q = sum(0.5 * wk * (radius * t * np.linalg.solve(m, y)).real for wk, t, m in zip(w, turn, shifted))
        value, y = _ritz(v, q)
        hit = (value > low) & (value <= high)
        if hit.sum() != inside:
            continue
        off = np.linalg.norm(v @ y[:, hit] - y[:, hit] * value[hit], axis=0).max()
        if off < least:
            best, least = y[:, hit], off
        elif least < 100 * bound:
            return best  # no longer getting better: the limit of rounding
        if off < bound / 100:
            return best
    return best if least < 100 * bound else None


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    d = len(v)
    if not d or not np.abs(v).max():
        return np.zeros(0), np.zeros((d, 0))
    parts = []
    for low, high, inside in intervals(Inertia(v), wanted):
        room, found = min(d, inside + inside // 2 + 4), None
        while found is None:
            found = _one_interval(v, low, high, inside, room)
            if found is None and room == d:
                raise ArithmeticError(f"no {inside} components between {low} and {high}")
            room = min(d, 2 * room)
        parts.append(found)
    if not parts:
        return np.zeros(0), np.zeros((d, 0))
    value, vector = _ritz(v, np.concatenate(parts, axis=1))  # makes the intervals' vectors orthogonal too
    order = np.argsort(-value, kind="stable")[:wanted]
    value, vector = value[order], vector[:, order]
    sign = np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(len(value))])
    return value, vector * sign


def identity_error(fit: DataFrame, dim: int, centre: Centre, project: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = project.shape[1]

    def run(batches):
        n, mean, total = 0, np.zeros(k), np.zeros((k, k))
        for x in _fit_rows(batches, dim):
            w = centre.centred(x) @ project
            m = w.mean(axis=0)
            total += (w - m).T @ (w - m) + np.outer(m - mean, m - mean) * (n * len(w) / (n + len(w)))
            mean += (m - mean) * (len(w) / (n + len(w)))
            n += len(w)
        # one more row and column: the sum of the means, and the products of the part's mean with itself
        out = np.zeros((k + 1, k + 1))
        out[:k, :k] = total + n * np.outer(mean, mean)
        out[:k, k] = n * mean
        yield _upper(out)

    got = _matrix(fit.mapInArrow(run, "i int, j int, v double"), k + 1) / centre.n
    return float(np.abs(got[:k, :k] - np.outer(got[:k, k], got[:k, k]) - np.eye(k)).max())


def deviations(scaled: np.ndarray) -> pa.Array:
    """Exact sum of squares of each row of whole numbers; null where 64 bits do not hold it."""
    if scaled.dtype != object and (scaled.astype(float) ** 2).sum(axis=1).max(initial=0) < 2.0 ** 62:
        return pa.array((scaled * scaled).sum(axis=1))
    exact = [sum(int(v) ** 2 for v in row) for row in scaled]
    return pa.array([e if e < 2 ** 63 else None for e in exact], pa.int64())


_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    vectors = named_rows(vectors, vec_id="long", embedding="array<double>")
    fit, dim = fit_list(vectors)
    if not dim:
        return spark.createDataFrame([], _RESULT)
    centre = Centre(*sums(fit, dim))
    v = covariance(fit, dim, centre)
    value, vector = leading(v, components)
    if not len(value):
        return spark.createDataFrame([], _RESULT)
    project = vector / np.sqrt(value)
    error = identity_error(fit, dim, centre, project)
    model = spark.sparkContext.broadcast((centre, project, value / np.trace(v), error))

    def run(batches):
        centre, project, explained, error = model.value
        k = project.shape[1]
        for batch in batches:
            for row, x in whole_vectors(batch.column("embedding")):
                if x.shape[1] != len(project) or not len(row):
                    continue
                scaled = centre.scaled(x)
                each = np.repeat(np.arange(len(row)), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(row)).take(pa.array(each)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(row))),
                     pa.array(np.full(len(each), centre.n)), deviations(scaled).take(pa.array(each)),
                     pa.array(((scaled.astype(float) / centre.n) @ project).reshape(-1)),
                     pa.array(np.tile(explained, len(row))), pa.array(np.full(len(each), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, _RESULT)

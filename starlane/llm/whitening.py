"""Embedding whitening: leading components by FEAST contour integration.

Entries become the whole numbers floor(256 * c). The fit list holds each
distinct vector once. Its count, sums and products are whole numbers added up
exactly by Spark, so the covariance does not depend on partitions and loses
nothing to cancellation: n * sum(x_i x_j) - S_i S_j is n * n times the centred
product's mean. Only that matrix (dimensions squared, whatever the rows) comes
to the driver. There

- inertia counts (signs of the pivots of L D L^T of V - s I) place an interval
  around the leading eigenvalues, with its lower end in the gap below them;
- FEAST projects a block of vectors on the interval's eigenspace: Gauss
  quadrature over a circle of solves with z I - V, then Rayleigh-Ritz, repeated
  until the residuals are at rounding level;
- the eigenvalues found are held against the inertia count: none is missed.

The rows are then projected in Arrow batches; whitened rows are centred before
their products are summed for ``identity_error``.

Defined cases: rows whose vector is null, or holds a null or non-finite entry,
are left out. Vectors of another length than most of those left (of the longer,
if two lengths are as frequent) do not belong to the table's space and are left
out as well. Entries beyond the range of a long stop at its ends. A component
exists only where the eigenvalue is above rounding level: fewer than four
dimensions or distinct vectors give fewer components, and one distinct vector
or an empty table no rows. Repeated rows and null ids give rows of their own.
``deviation`` is null where it exceeds a long. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.common import materialize

SCALE = 256.0
COMPONENTS = 4
# Nodes of the quadrature on the upper half of the circle.
NODES = 12
ROUNDS = 60
_LONG = 2**63
# Whole numbers up to here are exact as doubles, and so are sums that stay below.
_EXACT = 2**53


def whole_entries(vector: Column) -> Column:
    """floor(256 * c) of each entry, as longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id, x of the usable rows of the table's most frequent length."""
    v = F.col(f"`{column}`")
    rows = vectors.where(usable(v))
    sizes = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return rows.where(F.size(v) == size).select(F.col(f"`{id_column}`").cast("long").alias("id"), whole_entries(v).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), np.int64)
    return values.reshape(len(column), -1)


def _products(x: np.ndarray) -> list[int]:
    """1, each x_i and each x_i * x_j with i <= j, summed over the rows exactly."""
    n, d = x.shape
    upper = np.triu_indices(d)
    most = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    rows = _EXACT // (most * most) if most else n
    if rows >= 1:  # a block's sums of products are exact as doubles
        sums, total = [0] * d, np.zeros(len(upper[0]), object)
        for at in range(0, n, min(rows, 1 << 16)):
            part = x[at : at + min(rows, 1 << 16)].astype(np.float64)
            sums = [a + int(b) for a, b in zip(sums, part.sum(0))]
            total = total + (part.T @ part)[upper].astype(np.int64).astype(object)
        return [n, *sums, *total.tolist()]
    wide = x.astype(object)
    return [n, *wide.sum(0).tolist(), *[(wide[:, i] * wide[:, j]).sum() for i, j in zip(*upper)]]


@dataclass(frozen=True)
class Moments:
    n: int
    sums: list[int]
    covariance: np.ndarray


def moments(fit: DataFrame) -> Moments:
    """Count, sums and covariance of the rows of ``fit`` (x), from exact sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] | None = None
        for batch in batches:
            if batch.num_rows:
                cells = _products(_matrix(batch.column("x")))
                total = cells if total is None else [a + b for a, b in zip(total, cells)]
        if total is not None:
            at = pa.array(range(len(total)), pa.int32())
            # Two parts of a whole number that may exceed a long.
            high, low = zip(*(divmod(c, 1 << 62) for c in total))
            yield pa.RecordBatch.from_arrays([at, pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["at", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "at int, high long, low long")
    whole = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    cells = [int(r.high) * (1 << 62) + int(r.low) for r in parts.groupBy("at").agg(*whole).orderBy("at").collect()]
    if not cells:
        return Moments(0, [], np.zeros((0, 0)))
    d = next(d for d in range(1, len(cells)) if 1 + d + d * (d + 1) // 2 == len(cells))
    n, sums = cells[0], cells[1 : d + 1]
    cov = np.zeros((d, d))
    for value, i, j in zip(cells[d + 1 :], *np.triu_indices(d)):
        cov[i, j] = cov[j, i] = (n * value - sums[i] * sums[j]) / (n * n)
    return Moments(n, sums, cov)


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``v`` are above ``shift``: the
    positive pivots of L D L^T of v - shift I (Sylvester's law of inertia).

    Pivots are 1 x 1, or 2 x 2 where the diagonal is too small beside the
    largest entry of its column (Bunch and Kaufman's choice).
    """
    a = v - shift * np.eye(len(v))
    alpha, positive = (1 + 17**0.5) / 8, 0
    tiny = np.finfo(float).tiny
    while len(a):
        n = len(a)
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if n > 1 else 0
        largest = column[r - 1] if n > 1 else 0.0
        two = False
        if abs(a[0, 0]) < alpha * largest:
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() < alpha * largest**2:
                if abs(a[r, r]) >= alpha * row.max():
                    a[[0, r]] = a[[r, 0]]
                    a[:, [0, r]] = a[:, [r, 0]]
                else:
                    two = True
                    a[[1, r]] = a[[r, 1]]
                    a[:, [1, r]] = a[:, [r, 1]]
        if two:  # such a block is indefinite: one eigenvalue of either sign
            positive += 1
            block, side = a[:2, :2], a[2:, :2]
            a = a[2:, 2:] - side @ np.linalg.solve(block, side.T)
        else:
            pivot = a[0, 0] if abs(a[0, 0]) > tiny else -tiny
            positive += pivot > 0
            side = a[1:, 0]
            a = a[1:, 1:] - np.outer(side, side / pivot) if largest > 0 else a[1:, 1:]
    return int(positive)


def _edge(v: np.ndarray, wanted: int, low: float, high: float, close: float) -> tuple[float, float]:
    """(below, above) the ``wanted``-th largest eigenvalue, no further apart than ``close``."""
    while high - low > close:
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if count_above(v, middle) >= wanted:
            low = middle
        else:
            high = middle
    return low, high


def feast(v: np.ndarray, low: float, high: float, count: int, nodes: int = NODES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` between ``low`` and ``high``, falling.

    A block of more vectors than that is filtered by the quadrature of
    (z I - v)^-1 over the circle on the interval, and Rayleigh-Ritz takes the
    eigenpairs out of its span; the filtered block starts the next round.
    """
    d = len(v)
    size = min(d, max(2 * count, count + 8))
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(nodes)
    turns = np.exp(1j * np.pi / 2 * (1 - x))
    norm = max(np.abs(v).sum(0).max(), np.finfo(float).tiny)
    block = np.random.default_rng(1).standard_normal((d, size))
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for _ in range(rounds):
        filtered = np.zeros((d, size))
        for turn, weight in zip(turns, w):
            solved = np.linalg.solve((centre + radius * turn) * np.eye(d) - v, block.astype(complex))
            filtered += (weight / 2 * radius * turn * solved).real
        q, _ = np.linalg.qr(filtered)
        values, inner = np.linalg.eigh(q.T @ v @ q)
        block = q @ inner
        inside = np.flatnonzero((values > low) & (values < high))[::-1]
        if len(inside) == count:
            e, vectors = values[inside], block[:, inside]
            residual = float(np.abs(v @ vectors - vectors * e).max())
            if best is not None and residual >= best[0] / 2 and best[0] <= 1e-10 * norm:
                break
            if best is None or residual < best[0]:
                best = residual, e, vectors
            if residual <= d * np.finfo(float).eps * norm / 8:
                break
    if best is None or best[0] > 1e-9 * norm:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, but the iteration did not find them all")
    return best[1], best[2]


def leading_components(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest eigenvalues above rounding level, falling, and their unit vectors."""
    d = len(v)
    top = float(np.abs(v).sum(0).max()) if d else 0.0
    floor = 8 * d * np.finfo(float).eps * top
    wanted = min(wanted, count_above(v, floor)) if top > 0 else 0
    if wanted == 0:
        return np.zeros(0), np.zeros((d, 0))
    high = top * (1 + 1e-6)
    low, _ = _edge(v, wanted, floor, high, 1e-9 * top)
    count = count_above(v, low)
    # The interval ends in the middle of the gap below its last eigenvalue.
    if count < d:
        below, _ = _edge(v, count + 1, -floor, low, 1e-9 * top)
        low = (low + below) / 2
    values, vectors = [], []
    for bottom, upper in _slices(v, low, high):
        inside = count_above(v, bottom) - count_above(v, upper)
        if inside:
            e, x = feast(v, bottom, upper, inside)
            values.append(e)
            vectors.append(x)
    e = np.concatenate(values)
    if len(e) != count:
        raise ArithmeticError("an eigenvalue of the interval was missed")
    return e[:wanted], np.hstack(vectors)[:, :wanted]


def _slices(v: np.ndarray, low: float, high: float) -> list[tuple[float, float]]:
    """The interval in parts whose ends differ by a factor of about eight, from
    the top, each cut away from eigenvalues: within one circle eigenvalues of
    very unequal size would lie side by side at its edge."""
    found, upper = [], high
    while low < upper / 16:
        cuts = [upper / 8 * (1 + 0.06 * i) for i in range(16)]
        clear = [c for c in cuts if count_above(v, c * 0.99) == count_above(v, c * 1.01)]
        found.append(((clear or cuts)[0], upper))
        upper = found[-1][0]
    return [*found, (low, upper)]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Sum over the dimensions of (n x - S)^2 of each row, as whole numbers."""
    most = int(max(abs(int(x.max())), abs(int(x.min()))))
    largest = max(map(abs, sums))
    if most * max(most, largest) * x.shape[1] < _LONG:
        squares, crossed = (x * x).sum(1), x @ np.array(sums, np.int64)
    else:
        wide = x.astype(object)
        squares, crossed = (wide * wide).sum(1), wide @ np.array(sums, object)
    return n * n * squares.astype(object) - 2 * n * crossed.astype(object) + sum(s * s for s in sums)


@dataclass(frozen=True)
class Whitening:
    moments: Moments
    eigenvalues: np.ndarray
    vectors: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Centred rows on the components, each over the root of its eigenvalue."""
        mean = np.array([s / self.moments.n for s in self.moments.sums])
        return (x.astype(np.float64) - mean) @ self.vectors / np.sqrt(self.eigenvalues)

    def explained(self) -> list[float]:
        return (self.eigenvalues / np.trace(self.moments.covariance)).tolist()


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit rows' covariance minus the identity."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, k + 1))
        for batch in batches:
            if batch.num_rows:
                w = model.apply(_matrix(batch.column("x")))
                sums += np.hstack([w.T @ w, w.sum(0)[:, None]])
        flat = sums.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["at", "part"])

    rows = fit.select("x").mapInArrow(run, "at int, part double").groupBy("at").agg(F.sum("part").alias("s")).orderBy("at").collect()
    sums = np.array([r.s for r in rows]).reshape(k, k + 1) / model.moments.n
    mean = sums[:, k]
    return float(np.abs(sums[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def fit_whitening(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct vectors of ``rows`` (x), and those vectors."""
    fit = materialize(spark, rows.select("x").distinct(), "whitening-fit")
    found = moments(fit)
    return Whitening(found, *leading_components(found.covariance, components)), fit


def whitened(spark: SparkSession, vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = whole_vectors(vectors, id_column, column)
    model, fit = fit_whitening(spark, rows)
    error, explained = identity_error(fit, model), model.explained() if len(model.eigenvalues) else []
    k, n = len(explained), model.moments.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch.column("x"))
            deviation = [int(v) if v < _LONG else None for v in _deviations(x, n, model.moments.sums)]
            each = np.repeat(np.arange(len(x)), k)
            columns = {
                "vec_id": batch.column("id").take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(each), n, np.int64)),
                "deviation": pa.array(deviation, pa.int64()).take(pa.array(each)),
                "whitened": pa.array(model.apply(x).ravel()),
                "explained": pa.array(np.tile(explained, len(x))),
                "identity_error": pa.array(np.full(len(each), error)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)

"""Embedding whitening by spectrum slicing.

Vectors become whole numbers; sums over the distinct ones and their centred products
are added up per task and then per row of the covariance. Leading eigenvalues are told
apart by counting: the pivots of the LDLᵀ factors of a shifted matrix have the signs
of its eigenvalues, so bisection finds, for each number, an interval that holds that
eigenvalue alone. Rayleigh quotient iteration converges from there, and counts on both
sides of its value certify the number. Counts use the tridiagonal form of the covariance,
which has the same inertia at every shift; the iteration uses the covariance itself.

All that reaches the driver is one covariance per width of vectors.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import staged

COMPONENTS = 16
STEP, BASE = 64, 1_000_000
# Whole numbers beyond this are not told apart by doubles; entries stop there.
FARTHEST = 1 << 53
EPSILON = np.finfo(float).eps


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix, by reflections."""
    a = v.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ x
        p -= (x @ p) * x
        rest -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
    return a.diagonal().copy(), a.diagonal(1).copy()


class Inertia:
    """Counts of eigenvalues above a shift."""

    def __init__(self, v: np.ndarray):
        diagonal, off = tridiagonal(v)
        beside = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
        self.low, self.high = float((diagonal - beside).min()), float((diagonal + beside).max())
        self.rounding = EPSILON * max(abs(self.low), abs(self.high), 1e-300) * len(v)
        self.low, self.high = self.low - self.rounding, self.high + self.rounding
        self.rows = list(zip(diagonal.tolist(), [0.0, *(off ** 2).tolist()], strict=True))
        self.least = 1e-300 + EPSILON * EPSILON * max(self.high, 0.0)

    def above(self, shift: float) -> int:
        """The number of positive pivots of LDLᵀ of the matrix less ``shift``."""
        count, pivot = 0, 1.0
        for on, beside in self.rows:
            pivot = on - shift - beside / pivot
            if abs(pivot) < self.least:
                pivot = -self.least
            count += pivot > 0
        return count


def _orthogonal(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in found:
            x = x - (other @ x) * other
    return x / np.linalg.norm(x)


def _iterated(v: np.ndarray, shift: float, x: np.ndarray, found: list, rounding: float):
    """Rayleigh quotient iteration from a shift: value, vector and residual of the best step."""
    best = None
    for step in range(30):
        try:
            x = np.linalg.solve(v - shift * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            x = np.linalg.solve(v - (shift + rounding) * np.eye(len(v)), x)
        x = _orthogonal(x / np.linalg.norm(x), found)
        value = float(x @ v @ x)
        residual = float(np.linalg.norm(v @ x - value * x))
        if best is not None and step > 3 and residual >= best[2] / 2:
            break
        if best is None or residual < best[2]:
            best = value, x, residual
        # The first steps stay at the middle of the interval, so that it is left for no neighbour.
        if step >= 2:
            shift = value
    return best


def leading(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix in falling order, and their unit vectors as rows.

    Of equal eigenvalues any orthogonal vectors are taken. A vector's greatest entry is positive.
    """
    most = min(most, len(v))
    scale = float(np.abs(v).max(initial=0.0))
    if not scale:
        return np.zeros(most), np.eye(len(v))[:most]
    v = v / scale
    inertia = Inertia(v)
    narrow = 4 * inertia.rounding
    seeded = np.random.default_rng(7)
    values, found = [], []
    for k in range(most):
        low, high = inertia.low, inertia.high
        while True:
            # The k-th eigenvalue lies in (low, high]; alone, once the counts differ by one.
            while high - low > narrow and not (
                inertia.above(low) == k + 1 and inertia.above(high) == k and high - low < abs(high) / 8
            ):
                low, high = _halved(inertia, low, high, k)
            start = _orthogonal(seeded.normal(size=len(v)), found)
            value, x, residual = _iterated(v, (low + high) / 2, start, found, inertia.rounding)
            slack = 4 * residual + narrow
            sure = inertia.above(value - slack) > k >= inertia.above(value + slack)
            if sure and low - slack <= value <= high + slack:
                break
            if high - low <= narrow:
                raise ArithmeticError(f"eigenvalue {k + 1} cannot be certified")
            for _ in range(4):
                low, high = _halved(inertia, low, high, k)
        values.append(value)
        found.append(x)
    vectors = np.array(found).reshape(len(found), len(v))
    if len(vectors):
        top = np.abs(vectors).argmax(axis=1)
        vectors *= np.sign(vectors[np.arange(len(vectors)), top])[:, None]
    return np.array(values) * scale, vectors


def _halved(inertia: Inertia, low: float, high: float, k: int) -> tuple[float, float]:
    middle = (low + high) / 2
    return (middle, high) if inertia.above(middle) > k else (low, middle)


@dataclass(frozen=True)
class Fit:
    """What vectors of one width are whitened by."""

    n: int
    sums: tuple          # exact, as Python integers
    vectors: np.ndarray  # a row per component
    values: np.ndarray
    trace: float
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the nearest whole number first, so that nothing is rounded before it is small."""
        whole, rest = self._centre()
        return (x - whole).astype(np.float64) - np.array([float(r) for r in rest]) / self.n

    def _centre(self) -> tuple[np.ndarray, list[int]]:
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), [s - self.n * w for s, w in zip(self.sums, whole, strict=True)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """A column per component; not a number where a component has no variance."""
        scale = np.where(self.varies(), np.sqrt(np.maximum(self.values, 0)), np.nan)
        return self.centred(x) @ self.vectors.T / scale

    def varies(self) -> np.ndarray:
        return self.values > 64 * len(self.sums) * EPSILON * max(float(self.values.max(initial=0)), 0.0)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The exact sums of squares of n*x - S; None beyond 64 bits."""
        whole, rest = self._centre()
        far = int(np.abs(x - whole).max(initial=0)) * self.n + self.n
        if far * far * max(len(rest), 1) < 1 << 63:
            return ((self.n * (x - whole) - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [
            sum((self.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in (x - whole).tolist()
        ]
        return [d if d < 1 << 63 else None for d in exact]


def _matrices(batches, column: str):
    """Arrays of the rows of one width each, and which rows of the batch these are."""
    for batch in batches:
        lists = batch.column(column)
        widths = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(widths)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            yield batch, rows, flat[(ends[rows] - width)[:, None] + np.arange(width)]


def whole(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(STEP * x), -FARTHEST, FARTHEST).astype(np.int64) + BASE


def _points(batches):
    for _, _, found in _matrices(batches, "embedding"):
        x = whole(found)
        ends = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["x"])


def _sums(batches):
    held: dict[int, list] = {}
    for _, _, x in _matrices(batches, "x"):
        n, sums = held.setdefault(x.shape[1], [0, [0] * x.shape[1]])
        # Halves of the numbers are summed apart, so that no sum of a batch overflows.
        high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
        held[x.shape[1]] = [n + len(x), [s + (h << 32) + i for s, h, i in zip(sums, high, low, strict=True)]]
    for width, (n, sums) in held.items():
        yield pa.RecordBatch.from_pydict({
            "width": pa.array([width] * width, pa.int32()), "i": pa.array(range(width), pa.int32()),
            "n": pa.array([n] * width, pa.int64()), "high": pa.array([s >> 32 for s in sums], pa.int64()),
            "low": pa.array([s & 0xFFFFFFFF for s in sums], pa.int64()),
        })


def _products(batches, fits: dict[int, Fit], made):
    held: dict[int, np.ndarray] = {}
    for _, _, x in _matrices(batches, "x"):
        c = made(fits[x.shape[1]], x)
        held[x.shape[1]] = held.get(x.shape[1], 0.0) + c.T @ c
    yield from _as_rows({(w, i): row for w, m in held.items() for i, row in enumerate(m)})


def _added(batches):
    held: dict[tuple, np.ndarray] = {}
    for batch in batches:
        keys = zip(batch.column("width").to_pylist(), batch.column("i").to_pylist(), strict=True)
        for key, row in zip(keys, batch.column("row"), strict=True):
            held[key] = held.get(key, 0.0) + row.values.to_numpy()
    yield from _as_rows(held)


def _as_rows(held: dict):
    if held:
        width, i = zip(*held, strict=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(width, pa.int32()), pa.array(i, pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))
        ], ["width", "i", "row"])


def _second_moments(points: DataFrame, fits: dict[int, Fit], made) -> dict[int, np.ndarray]:
    """Sums of products of what ``made`` gives, per width: added up in each task, then by row of the matrix."""
    kind = "width int, i int, row array<double>"
    parts = points.mapInArrow(partial(_products, fits=fits, made=made), kind)
    out: dict[int, dict] = {}
    for row in parts.repartition("width", "i").mapInArrow(_added, kind).collect():
        out.setdefault(row["width"], {})[row["i"]] = row["row"]
    return {w: np.array([rows[i] for i in sorted(rows)]) for w, rows in out.items()}


def fitted(points: DataFrame, most: int = COMPONENTS) -> dict[int, Fit]:
    """Per width what the distinct vectors ``x`` of ``points`` are whitened by."""
    sums = points.mapInArrow(_sums, "width int, i int, n long, high long, low long").groupBy("width", "i").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    ).collect()
    exact: dict[int, dict] = {}
    for row in sums:
        exact.setdefault(row["width"], {})[row["i"]] = (row["n"], (int(row["high"]) << 32) + int(row["low"]))
    none = np.zeros((0, 0))
    fits = {
        w: Fit(found[0][0], tuple(found[i][1] for i in range(w)), none, none, 0.0) for w, found in exact.items()
    }
    for w, products in _second_moments(points, fits, Fit.centred).items():
        v = products / fits[w].n
        values, vectors = leading((v + v.T) / 2, most)
        fits[w] = replace(fits[w], values=values, vectors=vectors, trace=float(np.trace(v)))
    for w, products in _second_moments(points, fits, _scaled).items():
        kept = np.flatnonzero(fits[w].varies())
        off = np.abs(products / fits[w].n - np.eye(len(products)))[np.ix_(kept, kept)]
        fits[w] = replace(fits[w], error=float(off.max(initial=0.0)))
    return fits


def _scaled(fit: Fit, x: np.ndarray) -> np.ndarray:
    return np.nan_to_num(fit.whitened(x))


def _out(batches, fits: dict[int, Fit]):
    for batch, rows, found in _matrices(batches, "embedding"):
        fit, x = fits[found.shape[1]], whole(found)
        k = len(fit.values)
        white = fit.whitened(x)
        share = np.where(fit.varies(), fit.values / (fit.trace or 1.0), 0.0)
        yield pa.RecordBatch.from_arrays([
            batch.column("vec_id").take(pa.array(np.repeat(rows, k))),
            pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
            pa.array(np.full(len(rows) * k, fit.n)),
            pa.array(fit.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
            pa.array(white.ravel(), from_pandas=True), pa.array(np.tile(share, len(rows))),
            pa.array(np.full(len(rows) * k, fit.error)),
        ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whitened(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row per component of every vector of ``rows`` whose entries are all there and finite.

    ``vec_id, component, n, deviation, whitened, explained, identity_error``. Each
    width of vectors is fitted by itself; an empty vector has no component. A component
    without variance, as when fewer distinct vectors than components are left, has a
    null ``whitened`` and explains 0. A ``deviation`` that 64 bits cannot hold
    is null. Rows repeated under one id, or without an id, are each returned.
    """
    finite = F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )
    vectors = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(finite & (F.size("embedding") > 0))
    points = staged(vectors.select("embedding").mapInArrow(_points, "x array<long>").distinct(), "points")
    return vectors.mapInArrow(partial(_out, fits=fitted(points, most)), (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    ))

"""Embedding whitening: eigenvectors of the covariance, updated vector by vector in every partition.

A partition keeps the eigenvalues and eigenvectors of its scatter matrix. Each vector changes that
matrix by one centred rank-one term, and the new spectrum comes from the secular equation. Spectra
of partitions meet in a tree: the eigenpairs of one enter the other as rank-one terms, and so does
the difference of the means. A last pass over all vectors projects them on the basis found and
solves the small projected problem (Rayleigh-Ritz), which takes the rounding of the updates out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm.folding import PART, folded, row
from millpond.session import materialise

SCALE = 64
COMPONENTS = 16
#: Integers that a double holds exactly.
LARGEST = float(1 << 53)
_EPS = np.finfo(float).eps


def _roots(d: np.ndarray, z2: np.ndarray, rho: float, turns: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)) for ascending poles ``d``, and the differences d[i] - root[j].

    Each root is sought as an offset from its nearer pole, so that differences to poles keep their
    digits. Steps fit a function with poles on both sides (the middle way) and fall back to halving
    the bracket whenever they leave it.
    """
    k = len(d)
    index = np.arange(k)
    above = np.append(d[1:], d[-1] + rho * z2.sum())
    middle = (d + above) / 2
    at_middle = 1 + rho * (z2[:, None] / (d[:, None] - middle)).sum(0)
    right = (at_middle < 0) & (index < k - 1)
    origin = np.where(right, index + 1, index)
    delta = d[:, None] - d[origin]
    half = (above - d) / 2
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    low[-1], high[-1] = (0.0, 2 * half[-1]) if at_middle[-1] >= 0 else (half[-1], 2 * half[-1])
    if at_middle[-1] >= 0:
        high[-1] = half[-1]
    upto = (index[:, None] <= index).astype(float)  # poles at or below each root
    left_pole, right_pole = d - d[origin], above - d[origin]
    x = (low + high) / 2
    weights, live, delta_ = rho * z2, index, delta
    for _ in range(turns):
        t, lo, hi = x[live], low[live], high[live]
        inverse = 1.0 / (delta_ - t)
        below = inverse * upto
        psi, psi_ = weights @ below, weights @ (below * inverse)
        all_, all__ = weights @ inverse, weights @ (inverse * inverse)
        f = 1 + all_
        lo, hi = np.where(f < 0, t, lo), np.where(f >= 0, t, hi)
        low[live], high[live] = lo, hi
        size = 1 + np.abs(psi) + np.abs(all_ - psi)
        open_ = (np.abs(f) > 8 * k * _EPS * size) & (hi - lo > 4 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        one, two = left_pole[live] - t, right_pole[live] - t
        a = (one + two) * f - one * two * all__
        b = one * two * f
        c = f - one * psi_ - two * (all__ - psi_)
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(all="ignore"):
            new = t + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
        x[live] = np.where(open_, new, t)
        if 2 * open_.sum() < len(live):  # the last few roots are sought alone
            live = live[open_]
            if not len(live):
                break
            delta_, upto = delta_[:, open_], upto[:, open_]
    return d[origin] + x, delta - x


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of basis @ diag(values) @ basis.T + rho * v v', for rho >= 0.

    Deflation: a direction that ``v`` hardly touches keeps its eigenpair, and of two eigenvalues
    that are all but equal a rotation takes one out. The rest solve the secular equation; their
    vectors come from weights recomputed from the roots, which keeps them orthogonal.
    """
    z = v @ basis
    norm2 = float(z @ z)
    if rho * norm2 <= 0.0:
        return values, basis
    z, rho = z / np.sqrt(norm2), rho * norm2
    tiny = 8 * _EPS * max(abs(values[0]), abs(values[-1]), rho)
    live = rho * np.abs(z) > tiny
    if (np.diff(values[live]) <= tiny).any():
        basis, z = basis.copy(), z.copy()
        last = -1
        for i in np.flatnonzero(live):
            if last >= 0:
                r = np.hypot(z[last], z[i])
                c, s = z[i] / r, z[last] / r
                if abs((values[i] - values[last]) * c * s) <= tiny:
                    z[i], z[last], live[last] = r, 0.0, False
                    basis[:, last], basis[:, i] = c * basis[:, last] - s * basis[:, i], s * basis[:, last] + c * basis[:, i]
            last = i
    d, w = values[live], z[live]
    if not len(d):
        return values, basis
    roots, gap = _roots(d, w * w, rho)
    spread = d[:, None] - d
    np.fill_diagonal(spread, 1.0)
    again = np.sqrt(np.abs(np.prod(gap / spread, axis=1))) * np.sign(w)
    turn = again[:, None] / gap
    turn /= np.sqrt((turn * turn).sum(0))
    out_values, out_basis = values.copy(), basis.copy()
    out_values[live], out_basis[:, live] = roots, basis[:, live] @ turn
    order = np.argsort(out_values, kind="stable")
    return out_values[order], out_basis[:, order]


@dataclass
class Spectrum:
    """Count, exact sums, mean, and the eigenpairs of the scatter matrix of the vectors seen."""

    width: int
    n: int = 0
    sums: list[int] = field(default_factory=list)
    mean: np.ndarray = None
    values: np.ndarray = None
    basis: np.ndarray = None

    def __post_init__(self):
        if self.mean is None:
            self.mean, self.values, self.basis = np.zeros(self.width), np.zeros(self.width), np.eye(self.width)
            self.sums = [0] * self.width

    def add(self, points: np.ndarray) -> None:
        """One centred rank-one update per row of integers."""
        for x in points.astype(np.float64):
            away = x - self.mean
            self.values, self.basis = rank_one(self.values, self.basis, away, self.n / (self.n + 1))
            self.n += 1
            self.mean += away / self.n
        if len(points):
            small = int(np.abs(points).max()) * len(points) < 1 << 62
            self.sums = [a + int(b) for a, b in zip(self.sums, (points if small else points.astype(object)).sum(0))]

    def meet(self, other: Spectrum) -> None:
        """Takes in all that ``other`` has seen: its eigenpairs, then the difference of the means."""
        if not other.n:
            return
        away = other.mean - self.mean
        for value, vector in zip(other.values, other.basis.T):
            self.values, self.basis = rank_one(self.values, self.basis, vector, max(value, 0.0))
        self.values, self.basis = rank_one(self.values, self.basis, away, self.n * other.n / (self.n + other.n))
        self.n += other.n
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]
        self.mean = self.mean + away * (other.n / self.n)


def _meet(payloads: Sequence[bytes]) -> bytes:
    first, *rest = map(pickle.loads, payloads)
    for other in rest:
        first.meet(other)
    return pickle.dumps(first)


def _add(payloads: Sequence[bytes]) -> bytes:
    return sum(np.frombuffer(p) for p in payloads).tobytes()


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): each vector as longs floor(64 * c), less the contract's offset, which cancels.

    Left out are null and empty vectors, null or non-finite components, and components whose
    integer a double cannot hold.
    """
    odd = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * SCALE >= LARGEST))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE))
    return vectors.filter((F.size("embedding") > 0) & ~odd).select("vec_id", x.alias("x"))


def _points(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _part() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def spectrum(fit: DataFrame, width: int) -> Spectrum | None:
    """The spectrum of all rows of ``fit``, by updates within partitions and a tree of meetings."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(width)
        for batch in batches:
            own.add(_points(batch))
        yield row(_part(), pickle.dumps(own))

    found = folded(fit.mapInArrow(update, PART), _meet, "spectra")
    return None if found is None else pickle.loads(found)


def _products(fit: DataFrame, project, label: str, width: int) -> np.ndarray:
    """Sum over all rows of the outer products of ``project(points)``, with the sums as a last row."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            y = project(_points(batch))
            total += np.vstack([y.T @ y, y.sum(0)])
        yield row(_part(), total.tobytes())

    return np.frombuffer(folded(fit.mapInArrow(multiply, PART), _add, label)).reshape(width + 1, width)


@dataclass
class Whitener:
    """What whitens a vector: exact count and sums, components by falling eigenvalue, and how good they are."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(points: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitening of the different vectors among ``points`` (x array<long>, all of one width); None without any.

    Copies are folded by a map-side aggregate, so a vector that a third of the rows hold reaches
    the fit once. The fit list is dealt into as many parts as the session shuffles into, since a
    vector is few bytes but much work. The driver gets one spectrum and two matrices, all of a size
    that follows the width alone. Components of numerically no variance are left out.
    """
    different = materialise(points.select("x").distinct(), "fit-list")
    first = different.select(F.size("x").alias("width")).first()
    if first is None:
        return None
    width = first["width"]
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = spectrum(different.repartition(parts, "x"), width)
    n, exact = seen.n, seen.sums
    low = np.array([s // n for s in exact])
    rest = np.array([float(s - n * w) for s, w in zip(exact, low.tolist())]) / n
    centred = lambda x: (x - low).astype(np.float64) - rest
    basis = np.linalg.qr(seen.basis[:, ::-1])[0]
    ritz = _products(different, lambda x: centred(x) @ basis, "ritz", width)[:width] / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    alive = values > 8 * width * _EPS * max(values[0], 0.0)
    k = min(components, int(alive.sum()))
    white = vectors[:, :k] / np.sqrt(values[:k])
    sums = _products(different, lambda x: centred(x) @ white, "identity", k) if k else np.zeros((1, 0))
    mean = sums[k] / n
    error = float(np.abs(sums[:k] / n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))
    return Whitener(n, exact, vectors[:, :k], values[:k], values[:k] / np.trace(ritz), error)


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows of ``RESULT``: each remaining vector's value on each of the first components.

    Rows whose vector is null, empty or holds null or non-finite components are dropped. Vectors of
    another width than the commonest (the smaller of equally common ones) lie in another space and
    are dropped too. Repeated rows are whitened each but fitted once. Where fewer directions have
    variance than ``components`` there are fewer rows per vector: none for one different vector or
    an empty table. A deviation too large for a long is null.
    """
    spark = vectors.sparkSession
    whole = materialise(whole_vectors(vectors), "whole-vectors")
    widths = whole.groupBy(F.size("x").alias("width")).count()
    common = widths.orderBy(F.desc("count"), "width").first()
    if common is None:
        return spark.createDataFrame([], RESULT)
    whole = whole.filter(F.size("x") == common["width"])
    model = fit(whole, components)
    n, k = model.n, len(model.values)
    if not k:
        return spark.createDataFrame([], RESULT)
    low = np.array([s // n for s in model.sums])
    rest = [s - n * w for s, w in zip(model.sums, low.tolist())]
    mean_rest = np.array([float(r) for r in rest]) / n
    white = model.components / np.sqrt(model.values)

    def deviation(points: np.ndarray) -> list[int | None]:
        away = points - low  # n * x - S, less n * low from both
        most = n * int(np.abs(away).max(initial=0)) + max(map(abs, rest))
        if common["width"] * most**2 < 1 << 63:
            return ((n * away - np.array(rest)) ** 2).sum(1).tolist()
        exact = (sum((n * a - r) ** 2 for a, r in zip(line, rest)) for line in away.tolist())
        return [x if x < 1 << 63 else None for x in exact]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch)
            value = ((points - low).astype(np.float64) - mean_rest) @ white
            each = np.repeat(np.arange(len(points)), k)
            columns = [
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(points))),
                pa.array(np.full(len(each), n, np.int64)),
                pa.array(deviation(points), pa.int64()).take(pa.array(each)),
                pa.array(value.ravel()),
                pa.array(np.tile(model.explained, len(points))),
                pa.array(np.full(len(each), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    return whole.mapInArrow(project, RESULT)

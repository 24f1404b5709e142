"""Whitening of embeddings by incremental eigendecomposition.

Every partition keeps the spectrum (eigenvalues and eigenvectors) of the scatter matrix of the vectors it has
seen, and their mean. A vector changes the scatter by a centred rank-one matrix; the new eigenvalues are
the roots of its secular equation, found between the old ones, after deflation: equal eigenvalues are rotated
until the update touches one of them, and directions that it does not touch stay. Spectra of partitions are
combined in a tree, sixteen at a time, each by successive rank-one updates with the other's eigenvectors and one
for the distance of the means. A last pass over all vectors projects them on the combined basis and sums
their products (Rayleigh-Ritz), which takes out what rounding has left: the components are eigenvectors to double precision.

Entries c become whole numbers x = floor(1024 * c) + 100000, the first term saturated at +-2^31. Sums are exact, and
vectors are centred exactly before they are multiplied. The driver holds one spectrum and one square matrix, whose
size follows from the dimension alone.

Rows whose vector is null or holds null or non-finite entries are dropped, and rows whose vector is not as long as most are
(the longer one of equally many). Repeated rows count and are returned as often as they occur, null ids too.
Components without variance (rank deficiency, a single vector) whiten to 0 and are left out of the identity error; with
equal eigenvalues any orthonormal basis of their space may come. Signs: the largest entry of a component is positive.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle, stage
from .common import batch_of, rows
from .hard_negatives import _lists, finite

SCALE, SHIFT, LIMIT = 1024, 100_000, float(1 << 31)
COMPONENTS, FAN_IN = 8, 16
EPS = float(np.finfo(np.float64).eps)
#: Components whose share of the variance is below this have none.
NO_VARIANCE = 1e-13
SPECTRUM = "slot long, n long, mean binary, values binary, basis binary"


# --- rank-one updates ---------------------------------------------------------------------------

def secular(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of diag(d) + rho z z^T; d ascending and apart, no entry of z zero, rho > 0.

    Each root lies between two poles and is found as a distance from the nearer one, by rational
    interpolation with bisection as a safeguard. The eigenvectors come from the z that has exactly these roots."""
    m = len(d)
    if m == 1:
        return d + rho * z * z, np.ones((1, 1))
    weight = rho * z * z
    bound = np.append(d[1:], d[-1] + weight.sum())
    middle = (d + bound) / 2
    at_middle = 1 + (weight / (d - middle[:, None])).sum(axis=1)
    i = np.arange(m)
    right = (at_middle < 0) & (i < m - 1)
    origin = i + right
    delta = d - d[origin][:, None]
    far = bound - d[origin]
    lo = np.where(right, middle - bound, 0.0)
    hi = np.where(right, 0.0, np.where(i < m - 1, middle - d, bound - d))
    tau = (lo + hi) / 2
    left = i <= i[:, None]
    for _ in range(100):
        gap = delta - tau[:, None]
        inverse = 1 / gap
        term = weight * inverse
        f = 1 + term.sum(axis=1)
        slope = term * inverse
        psi = (slope * left).sum(axis=1)
        phi = slope.sum(axis=1) - psi
        lo, hi = np.where(f < 0, tau, lo), np.where(f > 0, tau, hi)
        near, next_ = gap[i, i], far - tau
        a = (near + next_) * f - near * next_ * (psi + phi)
        b = near * next_ * f
        c = f - near * psi - next_ * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(all="ignore"):
            new = tau + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = np.where((new > lo) & (new < hi), new, (lo + hi) / 2)
        settled = (np.abs(f) <= m * EPS * (1 + np.abs(term).sum(axis=1))) | (np.abs(new - tau) <= EPS * np.abs(new))
        tau = np.where(settled, tau, new)
        if settled.all():
            break
    gap = delta - tau[:, None]  # d[j] - root[i]
    apart = np.abs(d - d[:, None])
    np.fill_diagonal(apart, 1.0)
    fitted = np.sign(z) * np.exp((np.log(np.abs(gap)).sum(axis=0) - np.log(apart).sum(axis=0)) / 2)
    vectors = (fitted / gap).T
    return d[origin] + tau, vectors / np.sqrt((vectors * vectors).sum(axis=0))


def rank_one(d: np.ndarray, basis: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of basis diag(d) basis^T + rho v v^T; d ascending, rho >= 0."""
    z = basis.T @ v
    size = float(np.sqrt(z @ z))
    tol = 8 * EPS * max(float(np.abs(d).max()), rho * size * size)
    if rho * size * size <= tol:
        return d, basis
    basis = basis.copy()
    run_ends = np.append(np.flatnonzero(np.diff(d) > tol), len(d) - 1)
    start = 0
    for end in run_ends:
        if end > start:  # equal eigenvalues: a reflection leaves the last direction of them to the update
            run = slice(start, end + 1)
            h = z[run].copy()
            norm = float(np.sqrt(h @ h))
            if norm > 0:
                h[-1] += np.copysign(norm, h[-1])
                h /= np.sqrt(h @ h)
                basis[:, run] -= 2 * np.outer(basis[:, run] @ h, h)
                last = -np.copysign(norm, z[end])
                z[run] = 0.0
                z[end] = last
        start = end + 1
    live = np.flatnonzero(rho * np.abs(z) * size > tol)
    if not len(live):
        return d, basis
    d = d.copy()
    values, vectors = secular(d[live], z[live], rho)
    basis[:, live] = basis[:, live] @ vectors
    d[live] = values
    order = np.argsort(d, kind="stable")
    return d[order], basis[:, order]


@dataclass
class Spectrum:
    """Mean and spectrum of the scatter matrix of n vectors."""

    size: int
    n: int = 0
    mean: np.ndarray = field(default=None)
    values: np.ndarray = field(default=None)
    basis: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        if self.mean is None:
            self.mean, self.values, self.basis = np.zeros(self.size), np.zeros(self.size), np.eye(self.size)

    def _moved(self, n: int, mean: np.ndarray) -> None:
        """Account for n more vectors with that mean and no scatter."""
        away, both = mean - self.mean, self.n + n
        if self.n:
            self.values, self.basis = rank_one(self.values, self.basis, away, self.n * n / both)
        self.mean = self.mean + away * (n / both)
        self.n = both

    def add(self, v: np.ndarray) -> None:
        self._moved(1, v)

    def combine(self, other: Spectrum) -> None:
        for value, direction in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, direction, float(value))
        self._moved(other.n, other.mean)

    def batch(self, slot: int) -> pa.RecordBatch:
        whole = {n: (pa.binary(), [np.ascontiguousarray(getattr(self, n)).tobytes()]) for n in ("mean", "values", "basis")}
        return batch_of({"slot": (pa.int64(), [slot]), "n": (pa.int64(), [self.n])} | whole)


def _spectrum(n: int, mean: bytes, values: bytes, basis: bytes) -> Spectrum:
    size = len(mean) // 8
    return Spectrum(size, n, np.frombuffer(mean), np.frombuffer(values), np.frombuffer(basis).reshape(size, size))


# --- passes over the vectors --------------------------------------------------------------------

@dataclass(frozen=True)
class Fit:
    """Exact count and sums of the vectors; `centred` is n * x - S, divided by n where it is not wanted exact."""

    n: int
    sums: tuple[int, ...]

    @property
    def size(self) -> int:
        return len(self.sums)

    def exact(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = x - whole
        if self.n * (int(np.abs(away).max(initial=0)) + 1) >= 1 << 62:
            away, rest = away.astype(object), rest.astype(object)
        return self.n * away - rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(np.float64) / self.n


def _vectors(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return _lists(batch.column("x"), np.int64)[0].reshape(-1, size)


def _sums(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            total += _vectors(batch, size).sum(axis=0).astype(object)
        yield batch_of({"dim": (pa.int32(), np.arange(size)), "total": (pa.decimal128(38, 0), list(total))})

    return run


def _partial_spectra(fit: Fit):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum(fit.size)
        for batch in batches:
            for v in fit.centred(_vectors(batch, fit.size)):
                spectrum.add(v)
        if spectrum.n:
            yield spectrum.batch(TaskContext.get().partitionId())

    return run


def _combined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("slot", "n", "mean", "values", "basis")
    for slot, group in groupby(rows(batches, *names), lambda r: r[0] // FAN_IN):
        first, *others = (_spectrum(*r[1:]) for r in group)
        for other in others:
            first.combine(other)
        yield first.batch(slot)


def spectrum_of(vectors: DataFrame, fit: Fit) -> Spectrum:
    """The spectrum of all vectors (column x)."""
    level = stage(vectors.mapInArrow(_partial_spectra(fit), SPECTRUM), "spectra")
    while level.count() > 1:
        group = F.floor(F.col("slot") / FAN_IN)
        level = stage(level.repartition(group).sortWithinPartitions("slot").mapInArrow(_combined, SPECTRUM), "spectra")
    return _spectrum(*level.select("n", "mean", "values", "basis").first())


def _products(fit: Fit, basis: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((fit.size, fit.size))
        for batch in batches:
            y = fit.centred(_vectors(batch, fit.size)) @ basis
            total += y.T @ y
        i, j = np.triu_indices(fit.size)
        yield batch_of({"i": (pa.int32(), i), "j": (pa.int32(), j), "v": (pa.float64(), total[i, j])})

    return run


def refine(vectors: DataFrame, fit: Fit, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: eigenvalues, falling, and eigenvectors of the covariance seen through `basis`."""
    basis, _ = np.linalg.qr(basis)
    sums = vectors.mapInArrow(_products(fit, basis), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    seen = np.zeros((fit.size, fit.size))
    for i, j, v in sums.collect():  # one row per entry of the matrix
        seen[i, j] = seen[j, i] = v / fit.n
    values, turn = np.linalg.eigh(seen)
    found = (basis @ turn)[:, ::-1]
    largest = found[np.abs(found).argmax(axis=0), np.arange(fit.size)]
    return values[::-1], found * np.where(largest < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Whitener:
    fit: Fit
    values: np.ndarray
    directions: np.ndarray
    total: float

    @property
    def scale(self) -> np.ndarray:
        """1 / sqrt of each eigenvalue, 0 without variance."""
        known = self.values > NO_VARIANCE * self.total
        return np.where(known, 1 / np.sqrt(np.where(known, self.values, 1.0)), 0.0)


def _whitened(w: Whitener):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = w.fit.exact(_vectors(batch, w.fit.size))
            if exact.dtype != object and w.fit.size * (int(np.abs(exact).max(initial=0)) ** 2) >= 1 << 62:
                exact_square = (exact.astype(object) ** 2).sum(axis=1)
            else:
                exact_square = (exact * exact).sum(axis=1)
            deviation = [int(v) if v < 10**38 else None for v in exact_square.tolist()]
            white = exact.astype(np.float64) / w.fit.n @ w.directions * w.scale
            lists = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]).cast(pa.list_(pa.float64()))
            yield batch_of({"vec_id": (pa.int64(), batch.column("vec_id")), "deviation": (pa.decimal128(38, 0), deviation), "white": (pa.list_(pa.float64()), lists)})

    return run


def clean(vectors: DataFrame) -> DataFrame:
    """vec_id, x of the rows that take part."""
    c = F.col("embedding").cast("array<double>")
    ready = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c")).where(finite(F.col("c")))
    whole = lambda v: F.floor(F.least(F.greatest(v * SCALE, F.lit(-LIMIT)), F.lit(LIMIT))) + SHIFT
    table = stage(ready.select("vec_id", F.transform("c", whole).alias("x")), "whole-vectors")
    sizes = table.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.where("size > 0").orderBy(F.desc("n"), F.desc("size")).limit(1).select("size").first()
    return table.where(F.size("x") == (usual.size if usual else -1))


def fit_of(table: DataFrame) -> Fit | None:
    """None for an empty table."""
    one = table.select(F.size("x").alias("size")).first()
    if one is None:
        return None
    sums = table.mapInArrow(_sums(one.size), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    by_dim = {r.dim: int(r.total) for r in sums.collect()}  # one row per dimension
    return Fit(table.count(), tuple(by_dim[k] for k in range(one.size)))


def identity_error(white: DataFrame, w: Whitener) -> float:
    """Largest absolute entry of the covariance of what was whitened, minus the identity."""
    live = [int(k) for k in np.flatnonzero(w.scale)]
    if not live:
        return 0.0
    value = lambda i: F.get("white", F.lit(i))
    pairs = [(i, j) for i in live for j in live if i <= j]
    sums = [F.sum(value(i)).alias(f"m{i}") for i in live] + [F.sum(value(i) * value(j)).alias(f"p{i}_{j}") for i, j in pairs]
    s, n = white.agg(*sums).first(), w.fit.n
    return max(abs(s[f"p{i}_{j}"] / n - s[f"m{i}"] * s[f"m{j}"] / n**2 - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error of every row and component."""
    return settle(vectors.sparkSession, "whitened", lambda: _whiten(vectors, components))


def _whiten(vectors: DataFrame, components: int) -> DataFrame:
    spark = vectors.sparkSession
    table = clean(vectors)
    fit = fit_of(table)
    if fit is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    values, found = refine(table, fit, spectrum_of(table, fit).basis)
    total = float(np.maximum(values, 0.0).sum())
    w = Whitener(fit, values[:components], found[:, :components], total)
    white = stage(table.mapInArrow(_whitened(w), "vec_id long, deviation decimal(38,0), white array<double>"), "white")
    error = identity_error(white, w)
    share = F.array(*[F.lit(float(max(v, 0.0) / total) if total else 0.0) for v in w.values])
    each = white.select("vec_id", "deviation", F.posexplode("white").alias("k", "whitened"))
    return each.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("k")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )

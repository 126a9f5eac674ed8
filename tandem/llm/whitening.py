"""Embedding whitening by incremental eigendecomposition.

Vectors become integers x = floor(64 * c) + offset.  Passes over the rows, each
map-only with a bounded partial result a task:

1. count and exact sums a dimension (n, S);
2. every task keeps the spectrum (mean, eigenvalues, eigenvectors) of the scatter
   of the rows it has read, and folds in each row by a centred rank-one update
   m / (m + 1) * d d', d = row - mean: the secular equation
   1 + rho * sum(z_i^2 / (l_i - t)) = 0 is solved for all roots at once,
   components with a negligible z and equal eigenvalues are deflated, and z is
   recomputed from the roots so that eigenvectors stay orthogonal.  Of more than
   two rows a dimension that are at hand together, a QR step first makes as many
   rows as dimensions with the same scatter, so a row costs far less than an update;
3. spectra of tasks are combined in a tree: each eigenpair of the one is a
   rank-one update of the other, and so is the difference of their means;
4. Rayleigh-Ritz: with the basis Q found so far, Q' V Q is summed over the tasks
   from exactly centred rows, and its small eigenproblem turns Q into the
   eigenvectors to double precision, whatever rounding 2 and 3 left behind;
5. the covariance of the whitened rows is summed and compared with the identity.

Then rows are projected.  Nothing of the size of the input is shuffled or sent
to the driver; what reaches it is a few d x d matrices.

Cases: vectors that are null, empty or hold a null or non-finite component are
dropped, and so are those not of the most frequent length (ties: the longer),
as they have no covariance with the others; integers beyond +-2^46 stay at that
bound; ids are not looked at (null and equal ones too are rows); components
whose eigenvalue is at most 1e-11 of the largest (constant or dependent
dimensions, too few rows) cannot be whitened and are left out; a deviation that
does not fit a long is null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import load, stored
from tandem.llm.vectors import grid, matrices

COMPONENTS = 32
OFFSET = 1_000_000
FAN_IN = 8
_MOST = 1 << 46
_RANK = 1e-11
_EPS = np.finfo(np.float64).eps


# ---- rank-one updates of a symmetric eigenproblem ---------------------------

def secular_roots(lam: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """Roots of 1 + rho * sum(z_i^2 / (lam_i - t)) = 0 for ascending, distinct
    ``lam``, nonzero ``z`` and rho > 0, as the matrix root_j - lam_i.

    Root j lies between lam_j and lam_j+1 (the last one below lam_k + rho|z|^2).
    All are found together, each measured from the pole it is nearer to, by
    two-pole rational interpolation kept inside a bracket that halves when a
    step leaves it."""
    k, w = len(lam), rho * z * z
    ends = np.append(lam[1:], lam[-1] + w.sum())
    gap = ends - lam
    mid = lam + gap / 2
    at_mid = 1.0 + (w[None, :] / (lam[None, :] - mid[:, None])).sum(axis=1)
    right = at_mid < 0                      # the root is in the upper half
    right[-1] = False                       # the last root has no pole above it
    origin = np.where(right, ends, lam)
    delta = lam[None, :] - origin[:, None]  # poles as seen from each root's origin
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    if at_mid[-1] < 0:
        low[-1], high[-1] = gap[-1] / 2, gap[-1]
    else:
        high[-1] = gap[-1] / 2
    tau = (low + high) / 2
    d1 = np.where(right, -gap, 0.0)         # own pole and the one above, from the origin
    d2 = np.where(right, 0.0, gap)
    lower = (np.arange(k)[None, :] <= np.arange(k)[:, None]).astype(np.float64)
    with np.errstate(all="ignore"):
        for _ in range(80):
            diff = delta - tau[:, None]
            term = w[None, :] / diff
            slope = term / diff
            psi, dpsi = np.einsum("ji,ji->j", lower, term), np.einsum("ji,ji->j", lower, slope)
            phi, dphi = term.sum(axis=1) - psi, slope.sum(axis=1) - dpsi
            f = 1.0 + psi + phi
            low, high = np.where(f < 0, tau, low), np.where(f >= 0, tau, high)
            done = np.abs(f) <= 2 * _EPS * (1.0 + np.abs(psi) + np.abs(phi))
            done |= high - low <= _EPS * np.abs(tau)
            if done.all():
                break
            e1, e2 = d1 - tau, d2 - tau
            a = (e1 + e2) * f - e1 * e2 * (dpsi + dphi)
            b = e1 * e2 * f
            c = f - e1 * dpsi - e2 * dphi
            disc = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - disc) / (2 * c), 2 * b / (a + disc))
            new = tau + step
            inside = np.isfinite(new) & (new > low) & (new < high)
            tau = np.where(done, tau, np.where(inside, new, (low + high) / 2))
    return tau[:, None] - delta


def rank_one(lam: np.ndarray, vecs: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of vecs diag(lam) vecs' + rho v v' (rho >= 0, ``lam`` ascending,
    eigenvectors in columns)."""
    z = vecs.T @ v
    size = float(np.sqrt(z @ z))
    if rho * size * size == 0.0:
        return lam, vecs
    tol = 8 * _EPS * max(np.abs(lam).max(), rho * size * size)
    # deflation 1: equal eigenvalues; a reflection moves their z into one component
    near = np.diff(lam) <= tol
    if near.any():
        vecs, z = vecs.copy(), z.copy()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
        for start, stop in zip(edges[::2], edges[1::2] + 1):
            part = z[start:stop]
            length = np.sqrt(part @ part)
            if length == 0.0:
                continue
            length = length if part[-1] >= 0 else -length
            mirror = part.copy()
            mirror[-1] += length
            mirror /= np.sqrt(mirror @ mirror)
            vecs[:, start:stop] -= 2.0 * np.outer(vecs[:, start:stop] @ mirror, mirror)
            z[start:stop] = 0.0
            z[stop - 1] = -length
    # deflation 2: components that the update does not move
    live = rho * np.abs(z) * size > tol
    if not live.any():
        return lam, vecs
    l, zl = lam[live], z[live]
    moved = secular_roots(l, zl, rho)                    # root_j - l_i, by [j, i]
    # z that has exactly these roots
    poles = l[None, :] - l[:, None]                      # l_i - l_j, by [j, i]
    np.fill_diagonal(poles, 1.0)
    ratio = np.abs(moved / poles)
    exact = np.sqrt(ratio.prod(axis=0) / rho) * np.sign(zl)
    turn = exact[:, None] / -moved.T                     # [i, j]
    turn /= np.sqrt((turn * turn).sum(axis=0))[None, :]
    out_lam, out_vecs = lam.copy(), vecs.copy()
    out_lam[live] = l + np.diag(moved)
    out_vecs[:, live] = vecs[:, live] @ turn
    order = np.argsort(out_lam, kind="stable")
    return out_lam[order], out_vecs[:, order]


@dataclass
class Spectrum:
    """Scatter of ``m`` rows about their mean, by its eigenpairs."""
    m: int
    mean: np.ndarray
    lam: np.ndarray
    vecs: np.ndarray

    @classmethod
    def empty(cls, d: int) -> "Spectrum":
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, row: np.ndarray) -> None:
        diff = row - self.mean
        if self.m:
            self.lam, self.vecs = rank_one(self.lam, self.vecs, self.m / (self.m + 1.0), diff)
        self.m += 1
        self.mean = self.mean + diff / self.m

    def add_rows(self, rows: np.ndarray) -> None:
        """Fold in many rows: those of the triangle of their QR decomposition,
        which has the same scatter about their mean, and the shift of the mean."""
        if len(rows) <= 2 * rows.shape[1]:
            for row in rows:
                self.add(row)
            return
        mean = rows.mean(axis=0)
        for row in np.linalg.qr(rows - mean, mode="r"):
            self.lam, self.vecs = rank_one(self.lam, self.vecs, 1.0, row)
        self._shift(len(rows), mean)

    def _shift(self, m: int, mean: np.ndarray) -> None:
        """Take in ``m`` rows whose scatter about their mean is in already."""
        diff, total = mean - self.mean, self.m + m
        if self.m:
            self.lam, self.vecs = rank_one(self.lam, self.vecs, self.m * m / total, diff)
        self.mean, self.m = self.mean + diff * (m / total), total

    def merge(self, other: "Spectrum") -> None:
        if not other.m:
            return
        if not self.m:
            self.m, self.mean, self.lam, self.vecs = other.m, other.mean, other.lam, other.vecs
            return
        for value, vec in zip(other.lam, other.vecs.T):
            if value > 0:
                self.lam, self.vecs = rank_one(self.lam, self.vecs, float(value), vec)
        self._shift(other.m, other.mean)


# ---- passes -----------------------------------------------------------------

def fit_rows(column, dim: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x) of the vectors that count."""
    for d, rows, m in matrices(column):
        if d == dim:
            ok = np.isfinite(m).all(axis=1)
            if ok.any():
                yield rows[ok], grid(m[ok], _MOST) + offset


def length_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (dim, n) of the whole vectors."""
    n: dict[int, int] = {}
    for batch in batches:
        for d, _, m in matrices(batch.column("vec")):
            n[d] = n.get(d, 0) + int(np.isfinite(m).all(axis=1).sum())
    yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64())],
                                     names=["dim", "n"])


def dim_sums(dim: int, offset: int):
    """Task function: (d, s) of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, any_row = np.zeros(dim, dtype=np.int64), False
        for batch in batches:
            for _, x in fit_rows(batch.column("vec"), dim, offset):
                s, any_row = s + x.sum(axis=0), True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(s, pa.int64())], names=["d", "s"])
    return run


def centred(x: np.ndarray, n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S exactly (long, or Python integers where a long is too short), and x - S / n."""
    if n * (int(np.abs(x).max()) + 1) < 1 << 61:
        exact = n * x - np.array(total, dtype=np.int64)
        return exact, exact / float(n)
    exact = n * x.astype(object) - np.array(total, dtype=object)
    return exact, (exact / n).astype(np.float64)


SPECTRUM = "part long, m long, mean array<double>, lam array<double>, vecs array<double>"


def _row(part: int, s: Spectrum) -> pa.RecordBatch:
    many = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([s.m], pa.int64()), pa.array([s.mean], many), pa.array([s.lam], many),
         pa.array([s.vecs.ravel()], many)], names=["part", "m", "mean", "lam", "vecs"])


def _spectrum(m: int, mean: list, lam: list, vecs: list) -> Spectrum:
    d = len(mean)
    return Spectrum(m, np.array(mean), np.array(lam), np.array(vecs).reshape(d, d))


def partition_spectra(dim: int, offset: int, n: int, total: list[int]):
    """Task function: the spectrum of the task's rows, about the overall mean as origin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum.empty(dim)
        for batch in batches:
            for _, x in fit_rows(batch.column("vec"), dim, offset):
                s.add_rows(centred(x, n, total)[1])
        if s.m:
            context = TaskContext.get()
            yield _row(context.partitionId() if context else 0, s)
    return run


def merge_spectra(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    s = Spectrum.empty(len(rows[0]["mean"]))
    for r in rows:
        s.merge(_spectrum(r["m"], r["mean"], r["lam"], r["vecs"]))
    return pa.Table.from_batches([_row(rows[0]["part"], s)])


def gram(dim: int, offset: int, n: int, total: list[int], basis: np.ndarray):
    """Task function: rows (i, g) of basis' Y' Y basis, Y the centred rows of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, any_row = np.zeros((basis.shape[1],) * 2), False
        for batch in batches:
            for _, x in fit_rows(batch.column("vec"), dim, offset):
                y = centred(x, n, total)[1] @ basis
                g, any_row = g + y.T @ y, True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(g)), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))],
                                             names=["i", "g"])
    return run


def _sum_rows(table: pa.Table) -> pa.Table:
    total = np.array(table.column("g").to_pylist()).sum(axis=0)
    return pa.table({"i": table.column("i").slice(0, 1), "g": pa.array([total], pa.list_(pa.float64()))})


@dataclass
class Whitening:
    """n, exact sums, eigenvectors (columns) and eigenvalues by falling value, trace, and the identity error."""
    dim: int
    n: int
    total: list[int]
    vecs: np.ndarray
    values: np.ndarray
    trace: float
    error: float


def whitening(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS, offset: int = OFFSET,
              fan_in: int = FAN_IN) -> Whitening | None:
    """Fit on all rows; None if no vector counts or all are equal."""
    vec = df.select(F.col(vec_col).alias("vec"))
    sizes = vec.mapInArrow(length_counts, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).where("n > 0")
    top = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    if top is None:
        return None
    dim, n = top.dim, top.n
    sums = vec.mapInArrow(dim_sums(dim, offset), "d int, s long").groupBy("d").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    total = [int(r.s) for r in sorted(sums, key=lambda r: r.d)]

    level = stored(vec.mapInArrow(partition_spectra(dim, offset, n, total), SPECTRUM), "spectra")
    # a group of a level holds the spectra of fan_in groups of the level before
    size = fan_in
    while level.count() > 1:
        level = stored(level.selectExpr(f"part div {size} as g", "part", "m", "mean", "lam", "vecs").groupBy("g")
                       .applyInArrow(merge_spectra, SPECTRUM).selectExpr("part", "m", "mean", "lam", "vecs"), "spectra")
        size *= fan_in
    last = level.first()
    basis, _ = np.linalg.qr(_spectrum(last.m, last.mean, last.lam, last.vecs).vecs[:, ::-1])

    def summed(q: np.ndarray) -> np.ndarray:
        rows = (vec.mapInArrow(gram(dim, offset, n, total, q), "i int, g array<double>").groupBy("i")
                .applyInArrow(_sum_rows, "i int, g array<double>").collect())
        g = np.array([r.g for r in sorted(rows, key=lambda r: r.i)]) / n
        return (g + g.T) / 2

    values, turn = np.linalg.eigh(summed(basis))
    values, vecs = values[::-1], (basis @ turn)[:, ::-1]
    keep = min(components, int((values > _RANK * max(values[0], 0.0)).sum())) if values[0] > 0 else 0
    if not keep:
        return None
    scaled = vecs[:, :keep] / np.sqrt(values[:keep])
    error = float(np.abs(summed(scaled) - np.eye(keep)).max())
    return Whitening(dim, n, total, vecs[:, :keep], values[:keep], float(values.sum()), error)


WHITENED = ("id {id}, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           offset: int = OFFSET, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row that counts and component."""
    kind = WHITENED.format(id=df.schema[id_col].dataType.simpleString())
    w = whitening(df, vec_col, components, offset, fan_in)
    if w is None:
        return df.sparkSession.createDataFrame([], kind)
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    return rows.mapInArrow(_project(w, offset), kind)


def deviations(exact: np.ndarray) -> list[int | None]:
    """Row sums of squares, exact; None beyond a long."""
    if exact.dtype != object and float(np.abs(exact).max()) ** 2 * exact.shape[1] < 2.0 ** 62:
        return (exact * exact).sum(axis=1).tolist()
    sums = [sum(v * v for v in row) for row in exact.tolist()]
    return [v if v < 1 << 63 else None for v in sums]


def _project(w: Whitening, offset: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    k, explained = len(w.values), w.values / w.trace
    scaled = w.vecs / np.sqrt(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in fit_rows(batch.column("vec"), w.dim, offset):
                for i in range(0, len(rows), 2000):
                    exact, y = centred(x[i:i + 2000], w.n, w.total)
                    m = len(y)
                    each = np.repeat(np.arange(m), k)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(rows[i:i + 2000][each])),
                         pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, w.n), pa.int64()),
                         pa.array(deviations(exact), pa.int64()).take(pa.array(each)),
                         pa.array((y @ scaled).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, w.error))],
                        names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def op13_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")

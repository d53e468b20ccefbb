"""Embedding whitening: leading eigenvectors of the covariance by FEAST contour integration.

Spark sums the vectors, then the products of the centred vectors, so only a
matrix of dimension x dimension reaches the driver.  Inertia counts (signs of
a pivoted L D L^T of ``V - sigma I``) cut the spectrum into slices of a few
eigenvalues.  For each slice a Gauss-Legendre quadrature over a half circle
around its interval sums complex shifted solves ``(z I - V)^-1 Y``; that
filters a random block onto the slice's eigenvectors, and Rayleigh-Ritz takes
them out.  A slice is done when it holds as many Ritz values as the inertia
counts of its two ends say, all with small residuals: none is missed.  The
solves of all slices and quadrature points are rows of one Spark job a round.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.common import map_arrow, ship, sum_vectors

#: Fixed point of the entries: floor(SCALE * c) + SHIFT.  Entries of SCALE * c beyond LARGEST count as not finite.
SCALE, SHIFT, LARGEST = 64.0, 1_000_000, 2.0**52
#: Vectors of more entries are refused: the covariance is held in memory by the driver and by each task.
MAX_DIMENSION = 4096
#: Points of the quadrature, eigenvalues that a slice should hold at most, shifts counted in one round.
POINTS, SLICE_MOST, SHIFTS = 8, 12, 32
#: Residual, as a share of the largest eigenvalue, at which a slice is done; rounds at most.
RESIDUAL, ROUNDS = 1e-13, 40
#: Eigenvalues up to this share of the largest count as zero: there is nothing to divide by.
ZERO = 1e-12


def fit_list(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, v) of the usable vectors, and their dimension.

    Left out are null vectors and those with a null or non-finite entry, and
    vectors whose length is not the most common one (of equals the longest).
    """
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LARGEST))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & sound)
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = size["d"] if size else 0
    if d > MAX_DIMENSION:
        raise ValueError(f"vectors of {d} entries; at most {MAX_DIMENSION}")
    return rows.where(F.size("v") == d), d


def fixed_point(column: pa.ListArray, d: int) -> np.ndarray:
    """The rows of a batch as long integers: floor(64 c) + 1000000."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * flat).astype(np.int64) + SHIFT


def _partial(rows: DataFrame, sums: Callable[[np.ndarray], np.ndarray], d: int) -> dict[int, np.ndarray]:
    """Sums over all rows of the matrix that ``sums`` gives for a batch, by matrix row; one row of it per task and matrix row is sent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                now = sums(fixed_point(batch.column(0), d))
                total = now if total is None else total + now
        if total is not None:
            part = [TaskContext.get().partitionId()] * len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int64()), pa.array(part, pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], ["key", "part", "values"]
            )

    found = sum_vectors(map_arrow(rows.select("v"), run, "key long, part long, values array<double>"))
    return {r["key"]: np.array(r["values"]) for r in found.collect()}  # at most d rows of d numbers


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                total += fixed_point(batch.column(0), d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["dim", "s"])

    found = map_arrow(rows.select("v"), run, "dim int, s long").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["dim"]: int(r["s"]) for r in found}
    return by.get(-1, 0), [by.get(i, 0) for i in range(d)]


# --- spectrum -------------------------------------------------------------------------


def above(v: np.ndarray, sigma: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``sigma``: the positive pivots of a pivoted L D L^T of v - sigma I (Bunch and Kaufman)."""
    a = v - sigma * np.eye(len(v))
    alpha, count, k, n = (1 + math.sqrt(17)) / 8, 0, 0, len(v)
    while k < n:
        col = np.abs(a[k + 1 :, k])
        lam = col.max() if len(col) else 0.0
        pivot, two = k, False
        if lam > 0 and abs(a[k, k]) < alpha * lam:
            r = k + 1 + int(col.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            if abs(a[k, k]) * row.max() >= alpha * lam * lam:
                pass
            elif abs(a[r, r]) >= alpha * row.max():
                pivot = r
            else:
                two = True
                _swap(a, k + 1, r)
        if two:
            e = a[k : k + 2, k : k + 2].copy()
            c = a[k + 2 :, k : k + 2].copy()
            if len(c):
                a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(e, c.T)
            count += int((np.linalg.eigvalsh(e) > 0).sum())
            k += 2
            continue
        _swap(a, k, pivot)
        if a[k, k] > 0:
            count += 1
        if a[k, k] != 0 and k + 1 < n:
            c = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(c, c / a[k, k])
        k += 1
    return count


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def quadrature(low: float, high: float) -> list[tuple[complex, complex]]:
    """(shift, weight) on the upper half of the circle over [low, high]; the lower half is the conjugate."""
    x, w = np.polynomial.legendre.leggauss(POINTS)
    r = (high - low) / 2
    turn = r * np.exp(-0.5j * np.pi * (x - 1))
    return [(complex((low + high) / 2 + t), complex(0.5 * h * t)) for t, h in zip(turn, w, strict=True)]


class Spectrum:
    """Counts and contour solves of one matrix, run as small Spark jobs (one row a shift or quadrature point)."""

    def __init__(self, spark: SparkSession, v: np.ndarray):
        ship(spark)
        self.spark, self.v = spark, v
        self.sent = spark.sparkContext.broadcast(v)  # dimension squared, bounded by MAX_DIMENSION
        self.counts: dict[float, int] = {}

    def count(self, shifts: list[float]) -> None:
        sent = self.sent
        todo = sorted(set(shifts) - self.counts.keys())

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sigmas = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([above(sent.value, s) for s in sigmas], pa.int32())], ["sigma", "n"])

        if todo:
            rows = self.spark.createDataFrame([(s,) for s in todo], "sigma double").repartition(min(len(todo), SHIFTS))
            self.counts |= {r["sigma"]: r["n"] for r in rows.mapInArrow(run, "sigma double, n int").collect()}

    def solves(self, slices: list[tuple[float, float, np.ndarray]]) -> list[np.ndarray]:
        """For each (low, high, Y) the filtered block: the weighted sum over the contour of Re((z I - V)^-1 Y)."""
        sent, blocks = self.sent, self.spark.sparkContext.broadcast([y for _, _, y in slices])
        rows = [(k, z.real, z.imag, w.real, w.imag) for k, (low, high, _) in enumerate(slices) for z, w in quadrature(low, high)]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for k, zr, zi, wr, wi in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    v, y = sent.value, blocks.value[k]
                    q = (complex(wr, wi) * np.linalg.solve(complex(zr, zi) * np.eye(len(v)) - v, y.astype(complex))).real
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zr]), pa.array([q.ravel()], pa.list_(pa.float64()))], ["k", "at", "q"])

        frame = self.spark.createDataFrame(rows, "k int, zr double, zi double, wr double, wi double").repartition(min(len(rows), 4 * SHIFTS))
        out = [np.zeros_like(y) for _, _, y in slices]
        for r in sorted(frame.mapInArrow(run, "k int, at double, q array<double>").collect(), key=lambda r: (r["k"], r["at"])):
            out[r["k"]] += np.array(r["q"]).reshape(out[r["k"]].shape)
        return out


def _cuts(s: Spectrum, top: float, k: int) -> list[float]:
    """Falling shifts from above the largest eigenvalue to below the k-th, with few eigenvalues between neighbours."""
    floor = top * ZERO
    s.count([top, floor, *np.geomspace(top, floor, SHIFTS).tolist()])
    k = min(k, s.counts[floor])

    def split(low: float, high: float) -> list[float]:
        return (np.linspace if high < 4 * low else np.geomspace)(high, low, 10)[1:-1].tolist()

    for _ in range(14):
        grid = sorted(s.counts, reverse=True)
        gaps = [(b, a) for a, b in zip(grid, grid[1:], strict=False) if s.counts[a] < k and s.counts[b] - s.counts[a] > 1 and a - b > 1e-9 * top]
        gaps = [(b, a) for b, a in gaps if s.counts[b] > k or s.counts[b] - s.counts[a] > SLICE_MOST]
        if not gaps:
            break
        s.count([x for b, a in gaps for x in split(b, a)])
    cuts, grid = [top], sorted(s.counts, reverse=True)
    while s.counts[cuts[-1]] < k:
        rest = [x for x in grid if x < cuts[-1]]
        # A slice spans a factor of 4 at most, so that what lies below it (zeros, say) is far from its contour.
        near = [x for x in grid if cuts[-1] / 4 <= x < cuts[-1]]
        fit = [x for x in near if s.counts[x] - s.counts[cuts[-1]] <= SLICE_MOST and s.counts[x] <= k] or near[:1] or rest[:1]
        best = s.counts[fit[-1]]
        same = [x for x in fit if s.counts[x] == best]
        cuts.append(same[len(same) // 2])  # amid the shifts with this count: away from the eigenvalues
    return cuts


def leading(spark: SparkSession, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a positive semidefinite matrix (falling) and unit eigenvectors (columns); fewer if the rest is zero."""
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)  # Gershgorin
    if not top > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    s = Spectrum(spark, v)
    cuts = _cuts(s, top, k)
    ends = [(low, high, s.counts[low] - s.counts[high]) for high, low in zip(cuts, cuts[1:], strict=False) if s.counts[low] > s.counts[high]]
    random = np.random.default_rng(7)
    blocks = [random.standard_normal((len(v), min(len(v), math.ceil(1.5 * m) + 8))) for _, _, m in ends]
    found: list[np.ndarray | None] = [None] * len(ends)
    worst = [math.inf] * len(ends)
    for _ in range(ROUNDS):
        todo = [i for i in range(len(ends)) if found[i] is None]
        if not todo:
            break
        filtered = s.solves([(ends[i][0], ends[i][1], blocks[i]) for i in todo])
        for i, q in zip(todo, filtered, strict=True):
            low, high, m = ends[i]
            u, size, _ = np.linalg.svd(q, full_matrices=False)
            u = u[:, size > 1e-14 * size[0]]
            e, w = np.linalg.eigh(u.T @ v @ u)
            x = u @ w
            own = (e > low) & (e <= high)
            error = np.linalg.norm(v @ x[:, own] - x[:, own] * e[own], axis=0).max(initial=0.0) / top
            # Done: as many as the inertia counts say, and residuals that are small or no longer fall.
            if own.sum() == m and (error <= RESIDUAL or error <= 1e-11 and error > 0.3 * worst[i]):
                found[i] = x[:, own]
            worst[i] = error if own.sum() == m else math.inf
            fill = random.standard_normal((len(v), blocks[i].shape[1] - x.shape[1]))
            blocks[i] = np.hstack([x, fill])
    if any(f is None for f in found):
        raise RuntimeError("eigenvalues are missing from a slice after the last round")
    # One Rayleigh-Ritz over all slices makes eigenvectors of neighbouring slices orthogonal too.
    u = np.linalg.qr(np.hstack(found))[0]
    e, w = np.linalg.eigh(u.T @ v @ u)
    order = np.argsort(-e, kind="stable")[:k]
    x = u @ w[:, order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), range(x.shape[1])])
    return e[order], x * sign


# --- operator -------------------------------------------------------------------------


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error, eigenvalue.

    Entries become floor(64 c) + 1000000.  ``deviation`` (decimal, exact) is
    the sum of (n x - S)^2; ``whitened`` the centred vector projected on the
    component, over the root of its eigenvalue; ``explained`` the eigenvalue's
    share of the trace; ``identity_error`` the largest entry of the covariance
    of ``whitened`` minus the identity, measured over all rows.

    Left out are null vectors, vectors with null, non-finite or (beyond 2^46)
    unrepresentable entries, and vectors whose length is not the most common
    one.  Null or repeated identifiers are rows like any other.  Components
    whose eigenvalue is zero are left out, so equal vectors only, a single
    vector or an empty table give no rows.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows, d = fit_list(vectors, id_col, vector_col)
    n, total = exact_sums(rows, d) if d else (0, [])
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, eigenvalue double"
    if not n:
        return spark.createDataFrame([], schema)
    base = [s // n for s in total]
    rest = np.array([s - n * b for s, b in zip(total, base, strict=True)], np.int64)  # S/n = base + rest/n
    low, part = np.array(base, np.int64), rest / n

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - low).astype(float) - part

    got = _partial(rows, lambda x: (c := centred(x)).T @ c, d)
    v = np.array([got[i] for i in range(d)]) / n
    v = (v + v.T) / 2
    values, axes = leading(spark, v, min(components, d))
    keep = values > ZERO * max(values.max(initial=0.0), 0.0)
    values, axes = values[keep], axes[:, keep]
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    project = axes / np.sqrt(values)
    # First row: sums of whitened; then the products of whitened.
    whole = _partial(rows, lambda x: np.vstack([(w := centred(x) @ project).sum(axis=0), w.T @ w]), d)
    mean = whole[0] / n
    error = float(np.abs(np.array([whole[i + 1] for i in range(k)]) / n - np.outer(mean, mean) - np.eye(k)).max())
    share = values / np.trace(v)
    exact = [int(s) for s in total]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(exact, object)
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = fixed_point(batch.column(1), d)
            w = centred(x) @ project
            far = int(np.abs(x - low).max() + 1) * n
            if d * far * far < 2**62:
                deviation = ((n * (x - low) - rest) ** 2).sum(axis=1).tolist()
            else:
                deviation = ((n * x.astype(object) - s) ** 2).sum(axis=1).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array([decimal.Decimal(int(y)) for y in deviation], pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(w.ravel()),
                    pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, error)),
                    pa.array(np.tile(values, m)),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"],
            )

    return map_arrow(rows.select("id", "v"), run, schema)

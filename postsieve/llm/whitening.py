"""Whitening of embeddings by Jacobi-Davidson with distributed, matrix-free products.

The covariance is never formed.  A pass over the stored vectors gives V times a few
columns: each task centres its rows and returns one row per dimension, which Spark adds
up.  The driver keeps only the search space, some columns as long as a vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import keyed, stored

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
# Entries of 2**52 or more in size are taken as 2**52.
LARGEST = float(1 << 52)
# A component with less than this part of the first one's variance cannot be scaled to 1.
FLAT = 1e-10

Product = Callable[[np.ndarray], np.ndarray]


def entries(embedding: Column) -> Column:
    """floor(1024 c) + 100000 of each entry as long; NULL for NULL vectors and such with NULL, NaN or infinity."""
    bad = F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    bounded = F.transform(embedding, lambda c: F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST)))
    return F.when(embedding.isNotNull() & ~bad, F.transform(bounded, lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT)))


@dataclass
class Fit:
    """Bounded facts of the fit list: rows, exact sums, and the centre m + r / n they give."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = [s % self.n for s in self.sums]
        self.part = np.array([float(Fraction(r, self.n)) for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the whole part goes off exactly, so nothing of the shift is left in the rounding."""
        return (x - self.whole).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact; by Python integers where a long could overflow."""
        near = x - self.whole
        largest = int(np.abs(near).max(initial=0)) + 1
        if x.shape[1] * (self.n * largest) ** 2 < 1 << 63:
            off = near * self.n - np.array(self.rest, dtype=np.int64)
            return (off * off).sum(axis=1).tolist()
        off = near.astype(object) * self.n - np.array(self.rest, dtype=object)
        return (off * off).sum(axis=1).tolist()


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(rows: DataFrame, d: int, width: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``add(x)``, a (height, width) array per batch of x.

    Each task returns one sum; Spark adds them line by line, so the driver gets
    height lines whatever the number of tasks.
    """
    names = [f"v{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(_matrix(batch, d))
                total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(np.arange(len(total), dtype=np.int32))] + [pa.array(c) for c in np.ascontiguousarray(total.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", *names])

    parts = rows.select("x").mapInArrow(run, "i int, " + ", ".join(f"{c} double" for c in names))
    lines = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect()
    return np.array([[line[c] for c in names] for line in sorted(lines, key=lambda line: line.i)])


def _fit(rows: DataFrame, d: int) -> Fit:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, d)
                n += len(x)
                # 1,000 entries of at most 2**62 do not fit a long; their halves' sums do.
                high, low = (x >> 31).sum(axis=0).tolist(), (x & ((1 << 31) - 1)).sum(axis=0).tolist()
                total = [t + (h << 31) + w for t, h, w in zip(total, high, low, strict=True)]
        if n:
            sums = pa.array([str(t) for t in total]).cast(pa.decimal128(38, 0))
            counts = pa.array([n] * d, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), counts, sums], names=["i", "n", "s"])

    parts = rows.select("x").mapInArrow(run, "i int, n long, s decimal(38,0)")
    lines = sorted(parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect(), key=lambda line: line.i)
    return Fit(lines[0].n, [int(line.s) for line in lines])


def minres(apply: Product, right: np.ndarray, steps: int, goal: float = 0.05) -> np.ndarray:
    """MINRES for several right sides at once, each with its own recurrences.

    One product a step serves all columns.  Ends after ``steps``, or when every
    residual is below ``goal`` of its right side.
    """
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    first = beta.copy()
    live = beta > 0
    before, v = np.zeros_like(right), right / np.where(live, beta, 1.0)
    w_before, w = np.zeros_like(right), np.zeros_like(right)
    k = right.shape[1]
    cs, sn, cs_before, sn_before = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    eta, beta_old = beta.copy(), np.zeros(k)
    for _ in range(steps):
        z = apply(v)
        alpha = (v * z).sum(axis=0)
        z = z - v * alpha - before * beta_old
        beta = np.linalg.norm(z, axis=0)
        # The new column of the tridiagonal matrix, turned by the two rotations before.
        delta = cs * alpha - cs_before * sn * beta_old
        gamma_2 = sn * alpha + cs_before * cs * beta_old
        gamma_3 = sn_before * beta_old
        gamma = np.hypot(delta, beta)
        live &= gamma > 0
        safe = np.where(live, gamma, 1.0)
        cs_before, sn_before = cs, sn
        cs, sn = delta / safe, beta / safe
        w_before, w = w, (v - gamma_3 * w_before - gamma_2 * w) / safe
        x += np.where(live, cs * eta, 0.0) * w
        eta = np.where(live, -sn * eta, 0.0)
        live &= beta > 1e-14 * first
        if not live.any() or (np.abs(eta) <= goal * first).all():
            break
        before, v = v, z / np.where(live, beta, 1.0) * live
        beta_old = np.where(live, beta, 0.0)
    return x


def _orthogonal(block: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``others``."""
    block = block / np.maximum(np.linalg.norm(block, axis=0), 1e-300)
    for _ in range(2):
        for other in others:
            block = block - other @ (other.T @ block)
        q, r = np.linalg.qr(block)
        block = q[:, np.abs(np.diag(r)) > 1e-8]
    return block


def jacobi_davidson(product: Product, d: int, want: int, inner: int = 8, rounds: int = 100, seed: int = 11):
    """The ``want`` largest eigenvalues of a symmetric matrix, unit vectors and residual norms.

    Every round solves the projected correction equations of all pairs not yet locked
    by inner MINRES, adds the corrections to the search space, and takes its Ritz pairs.  A leading pair
    is locked once its residual is rounding: 8 sqrt(d) units in the last place of the largest eigenvalue, or,
    where sums round more, when five rounds have not halved a residual of at most 1e-11 of it.
    """
    most = min(d, max(40, 4 * want))
    basis = _orthogonal(np.random.default_rng(seed).normal(size=(d, min(d, want + 4))))
    images = product(basis)
    locked, values, norms = np.zeros((d, 0)), [], []
    best, stale = np.inf, 0
    for _ in range(rounds):
        inside = basis.T @ images
        theta, turn = np.linalg.eigh((inside + inside.T) / 2)
        turn = turn[:, ::-1]
        theta, basis, images = theta[::-1], basis @ turn, images @ turn
        residuals = images - basis * theta
        residuals -= locked @ (locked.T @ residuals)
        size = np.linalg.norm(residuals, axis=0)
        largest = max([*values, float(theta[0]) if len(theta) else 0.0, 0.0])
        goal = 8 * np.sqrt(d) * np.finfo(float).eps * largest
        stale = 0 if size[0] < best / 2 else stale + 1
        best = min(best, float(size[0]))
        full = basis.shape[1] + locked.shape[1] >= d
        done = 0
        while len(values) + done < want and done < len(theta) and (
            size[done] <= goal or full or (stale >= 5 and size[done] <= 1e-11 * largest)
        ):
            done += 1
        if done:
            locked = np.hstack((locked, basis[:, :done]))
            values += theta[:done].tolist()
            norms += size[:done].tolist()
            basis, images, residuals, theta = basis[:, done:], images[:, done:], residuals[:, done:], theta[done:]
            best, stale = np.inf, 0
        if len(values) == want:
            order = np.argsort(-np.array(values), kind="stable")
            return np.array(values)[order], locked[:, order], np.array(norms)[order]
        active = want - len(values)
        if basis.shape[1] > most - active and basis.shape[1] > 2 * active:
            basis, images = basis[:, : 2 * active], images[:, : 2 * active]
        ritz, near = basis[:, :active], theta[:active]
        held = np.hstack((locked, ritz))

        def projected(t, held=held):
            return t - held @ (held.T @ t)

        width = ritz.shape[1]
        steps = min(inner, d - held.shape[1])
        found = minres(lambda t: projected(product(t) - t * near[: t.shape[1]]), -projected(residuals[:, :width]), steps)  # noqa: B023
        fresh = _orthogonal(projected(found), locked, basis)
        if fresh.shape[1] == 0:
            fresh = _orthogonal(np.random.default_rng(seed + len(values)).normal(size=(d, 1)), locked, basis)
        basis, images = np.hstack((basis, fresh)), np.hstack((images, product(fresh)))
    raise RuntimeError(f"{len(values)} of {want} eigenpairs after {rounds} rounds")


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_exact string, residual double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: its whitened coordinate, and how good the whitening is.

    Vectors that are NULL, empty, or hold NULL, NaN or infinity take no part, nor do such of another
    length than the most common one (ties: the longer).  Rows without vec_id and repeated
    rows take part like others.  Vectors of fewer dimensions than
    ``components`` give as many components as dimensions.  A component whose variance is
    below 1e-10 of the first one's has NULL as ``whitened`` and is left out of
    ``identity_error``.  ``deviation`` is NULL where the number does not fit a long;
    ``deviation_exact`` always has it.  An empty table gives no rows.
    """
    usable = keyed(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), entries(F.col("embedding")).alias("x")
    )
    rows = stored(usable.where("x IS NOT NULL AND size(x) > 0"))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    common = lengths.agg(F.max(F.struct("n", "d")).alias("m")).first().m
    if common is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    d = common.d
    rows = rows.where(F.size("x") == d)
    fit = _fit(rows, d)
    n = fit.n
    spread = _summed(rows, d, 1, lambda x: (fit.centred(x) ** 2).sum(axis=0)[:, None]).sum() / n

    def product(block: np.ndarray) -> np.ndarray:
        def add(x: np.ndarray) -> np.ndarray:
            c = fit.centred(x)
            return c.T @ (c @ block)

        return _summed(rows, d, block.shape[1], add) / n

    values, axes, norms = jacobi_davidson(product, d, min(components, d))
    good = values > FLAT * values[0] if spread > 0 else np.zeros(len(values), dtype=bool)
    scaled = axes[:, good] / np.sqrt(values[good])
    k = scaled.shape[1]
    error = None
    if k:
        mean = _summed(rows, d, 1, lambda x: (fit.centred(x) @ scaled).sum(axis=0)[:, None])[:, 0] / n

        def squares(x: np.ndarray) -> np.ndarray:
            w = fit.centred(x) @ scaled - mean
            return w.T @ w

        error = float(np.abs(_summed(rows, d, k, squares) / n - np.eye(k)).max())
    explained = values / spread if spread > 0 else np.zeros(len(values))
    count = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if m == 0:
                continue
            x = _matrix(batch, d)
            whitened = np.zeros((m, count))
            whitened[:, good] = fit.centred(x) @ scaled
            exact = fit.deviations(x)
            longs = [v if v < 1 << 63 else None for v in exact]
            each = np.repeat(np.arange(m), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, n)),
                    pa.array(longs, pa.int64()).take(pa.array(each)),
                    pa.array(whitened.ravel(), mask=np.tile(~good, m)),
                    pa.array(np.tile(explained, m)),
                    pa.array([error] * (m * count), pa.float64()),
                    pa.array([str(v) for v in exact], pa.string()).take(pa.array(each)),
                    pa.array(np.tile(norms, m)),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(run, SCHEMA)

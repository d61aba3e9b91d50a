"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it: every step
is one distributed pass over the fit vectors that multiplies a block Q of a few
dozen columns by the centred covariance, V Q = sum of (x - mean)((x - mean) . Q) / n.
A task keeps one running dims x columns matrix, which Spark sums by row number, so what
reaches the driver is dims x columns numbers at any size of the table.

1. Mean and trace by exact integer sums.  A short Lanczos run of one vector gives the
   lower end of the spectrum.
2. Rayleigh-Ritz on the block (V Q is also the first step of the next filter).
3. Chebyshev filter: the three-term recurrence, one pass a step, grows everything
   above the smallest Ritz value of the block and damps the interval below it.
   The degree is kept so low that the block's columns stay independent in doubles.
4. QR, and again from 2 until the residuals |V q - value q| of all wanted columns are
   at most ``tolerance`` times the largest value, or, within 1000 times that, no longer fall.

The block has ``OVERSAMPLE`` columns beyond the wanted ones, so that a crowded spectrum
still leaves a gap to the damped interval.  Centring subtracts before it multiplies:
n x - S is an exact integer.

Each entry c of a vector becomes the integer floor(``scale`` c) + ``shift``.  The fit
list holds each distinct integer vector once (a frequent vector never leaves its tasks
more than once each).

Defined results: rows whose vector is null, empty, or holds null, NaN or infinity
are dropped; repeated rows stay repeated; vectors of unequal lengths and entries beyond
2**52 / ``scale`` are an error; fewer components come out if the vectors have fewer
dimensions or vary in fewer directions (an eigenvalue of at most 1e-12 of the largest is no
direction); an empty table, or one vector alone, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS, OVERSAMPLE = 16, 32
#: Residual asked for, relative to the largest eigenvalue; most sweeps of the filter.
TOLERANCE, SWEEPS = 1e-14, 200
#: Steps of the Lanczos run; bound on how much one filter may spread the block's columns.
LANCZOS, SPREAD = 8, 1e9


def integer_vectors(df: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE,
                    shift: int = SHIFT) -> DataFrame:
    """(key, x) of the rows with a whole finite vector."""
    bad = F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    x = F.transform(vector, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long") + F.lit(shift))
    far = F.exists(vector, lambda e: F.abs(e.cast("double")) * scale > float(1 << 52))
    ok = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))
    kept = df.where(ok)
    refuse = F.raise_error(F.lit(f"an entry of {vector} is beyond 2**52 / {scale}"))
    return kept.select(F.col(key), F.when(far, refuse.cast("array<bigint>")).otherwise(x).alias("x"))


def _block(column: pa.Array) -> np.ndarray:
    """The integer vectors of a batch as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def summed(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], kind=np.float64) -> np.ndarray:
    """Sum over all batches of ``part(rows)``, a matrix of ``shape``: a running matrix in
    each task, the tasks' matrices summed row by row by Spark."""
    name = "long" if kind is np.int64 else "double"

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(shape, kind)
        seen = False
        for b in batches:
            if b.num_rows:
                total += part(_block(b.column(0)))
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape[0], dtype=np.int32))]
                                             + [pa.array(np.ascontiguousarray(c)) for c in total.T],
                                             ["i", *(f"c{j}" for j in range(shape[1]))])

    cols = [f"c{j}" for j in range(shape[1])]
    parts = fit.select("x").mapInArrow(run, ", ".join(["i int", *(f"{c} {name}" for c in cols)]))
    out = np.zeros(shape, kind)
    for row in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in cols]).collect():  # one row per matrix row
        out[row["i"]] = row[1:]
    return out


@dataclass
class Basis:
    """What was fitted: n fit vectors with per-dimension sums, the components (columns)
    with their eigenvalues, and how it was reached."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - mean, from the exact integer n x - S."""
    return (x * n - sums) / float(n)


class _Covariance:
    """Products of the centred covariance of the fit list with a block."""

    def __init__(self, fit: DataFrame, n: int, sums: np.ndarray):
        self.fit, self.n, self.sums, self.passes = fit, n, sums, 0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        n, sums = self.n, self.sums

        def part(x):
            c = centred(x, n, sums)
            return c.T @ (c @ q)

        self.passes += 1
        return summed(self.fit, part, q.shape) / n


def _lower_end(cov: _Covariance, d: int, rng: np.random.Generator, steps: int) -> float:
    """A value near and below the smallest eigenvalue, by Lanczos with full reorthogonalisation."""
    basis = [q / np.linalg.norm(q) for q in [rng.standard_normal(d)]]
    alpha, beta = [], []
    for _ in range(min(steps, d)):
        w = cov(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(map(abs, alpha)):
            break
        basis.append(w / beta[-1])
    k = len(alpha)
    t, s = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:k - 1], 1) + np.diag(beta[:k - 1], -1))
    return max(0.0, float(t[0] - abs(beta[k - 1] * s[-1, 0])))


def _chebyshev(cov: _Covariance, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float,
               degree: int) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` on [low, high], scaled to 1 at ``top``, of the
    covariance, applied to q; ``vq`` is the first product."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (vq - middle * q) * (sigma / half)
    for _ in range(2, degree + 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (cov(now) - middle * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def fit_basis(rows: DataFrame, components: int = COMPONENTS, oversample: int = OVERSAMPLE,
              tolerance: float = TOLERANCE, seed: int = 20) -> Basis | None:
    """The leading components of the distinct vectors ``x`` of ``rows``; None without any."""
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    size = fit.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    n, d = size["n"], size["high"]
    if not n:
        return None
    if size["low"] != d:
        raise ValueError(f"vectors of {size['low']} to {d} entries: they must all have the same length")
    sums = summed(fit, lambda x: x.sum(0)[:, None], (d, 1), np.int64)[:, 0]
    trace = float(summed(fit, lambda x: (centred(x, n, sums) ** 2).sum(0)[:, None], (d, 1)).sum()) / n
    if trace == 0:
        return None
    cov, rng = _Covariance(fit, n, sums), np.random.default_rng(seed)
    block, want = min(d, components + oversample), min(d, components)
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    low = _lower_end(cov, d, rng, LANCZOS) if block < d else 0.0
    best = math.inf
    for _ in range(SWEEPS):
        vq = cov(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        worst = float(np.linalg.norm(vq[:, :want] - q[:, :want] * values[:want], axis=0).max()) / values[0]
        stalled = worst <= 1000 * tolerance and worst > best / 2
        best = min(best, worst)
        high = float(values[-1])
        if worst <= tolerance or stalled or block == d and worst <= 1000 * tolerance:
            break
        floor = min(low, 0.9 * high)
        t = (2 * float(values[0]) - high - floor) / (high - floor) if high > floor else math.inf
        degree = int(math.log(2 * SPREAD) / math.acosh(t)) if 1 < t < math.inf else 1
        degree = max(2, min(degree, 40))
        q = np.linalg.qr(_chebyshev(cov, q, vq, floor, high, float(values[0]), degree) if high > floor else vq)[0]
    else:
        raise RuntimeError(f"not certified after {SWEEPS} sweeps: relative residual {worst:.2e}")
    keep = values[:want] > 1e-12 * values[0]
    values, vectors = values[:want][keep], q[:, :want][:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    vectors = vectors * sign
    p, scaled = len(values), vectors / np.sqrt(values)

    def second(x):  # sum and second moments of the whitened fit vectors
        z = centred(x, n, sums) @ scaled
        return np.vstack([z.sum(0), z.T @ z])

    moments = summed(fit, second, (p + 1, p)) / n
    error = float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(p)).max())
    return Basis(n, sums, vectors, values, trace, error, best, cov.passes)


def whiten(rows: DataFrame, basis: Basis, key: str = "vec_id") -> DataFrame:
    """(key, deviation decimal(38,0), whitened array<double>) of every row."""
    n, sums, scaled = basis.n, basis.sums, basis.vectors / np.sqrt(basis.values)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            off = _block(b.column(1)) * n - sums
            if float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0 ** 62:
                square = (off * off).sum(1).tolist()
            else:
                square = [sum(v * v for v in r) for r in off.tolist()]
            z = (off / float(n)) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([Decimal(v) for v in square], pa.decimal128(38, 0)), lists],
                [key, "deviation", "whitened"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "x").mapInArrow(run, f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>")


def whitened(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS,
             oversample: int = OVERSAMPLE) -> DataFrame:
    """One row per vector and component: key, component, n, deviation, whitened,
    explained, identity_error."""
    rows = stored(integer_vectors(df, vector, key), "whitening-rows")
    basis = fit_basis(rows, components, oversample)
    if basis is None:
        kind = rows.schema[key].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation decimal(38,0), "
                                                   "whitened double, explained double, identity_error double")
    share = F.array(*[F.lit(float(e) / basis.trace) for e in basis.values])
    each = whiten(rows, basis, key).select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(key, (F.col("at") + 1).cast("int").alias("component"), F.lit(basis.n).cast("long").alias("n"),
                       "deviation", "whitened", F.get(share, "at").alias("explained"),
                       F.lit(basis.identity_error).alias("identity_error"))

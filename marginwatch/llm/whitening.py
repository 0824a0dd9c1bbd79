"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers and are written once, in blocks. The covariance is never formed: a pass over the
blocks multiplies a thin matrix Q by centred X'X, each task adding up what it reads. A short Lanczos run bounds
the spectrum from below. Then a three-term recurrence of passes applies a Chebyshev polynomial that is small
between that bound and the least Ritz value, the unwanted spectrum, and grows fast above it; QR and a
Rayleigh-Ritz step follow, until the residuals |VQ - QE| of all wanted components certify them. The matrices that
reach the driver have a row for each dimension and a column for each vector of the subspace; rows never do.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

SCALE, SHIFT = 1024, 100_000
#: Vectors of a block; vectors of the subspace beyond the wanted ones; passes of the Lanczos run.
BLOCK, GUARD, LANCZOS = 2_048, 24, 12
#: Residual of a wanted component, over the largest eigenvalue, that ends the iteration; what it may end with
#: where rounding allows no better; rounds at most.
RESIDUAL, ACCEPTED, ROUNDS = 2e-14, 1e-11, 60
#: Largest degree of the polynomial, and how far it may pull the wanted components apart before QR.
DEGREE, SPREAD = 12, 1e6
#: Share of the largest eigenvalue below which a component has no variance to be divided by.
EMPTY = 1e-12


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows that take part: x = floor(SCALE * c) + SHIFT as longs."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return v.where("coalesce(size(v) > 0 and forall(v, c -> coalesce(abs(c) < double('inf'), false) and not isnan(c)), false)").select(
        "vec_id", F.expr(f"transform(v, c -> floor({SCALE}D * c) + {SHIFT}L)").alias("x"))


def blocks_of(rows: DataFrame, dim: int) -> DataFrame:
    """(ids, x): little-endian longs of up to BLOCK rows."""
    def run(batches):
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                some = batch.slice(a, BLOCK)
                x = pc.list_flatten(some.column("x")).to_numpy().astype("<i8").reshape(len(some), dim)
                yield pa.RecordBatch.from_arrays([pa.array([some.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    return staged(rows.where(F.size("x") == dim).select("vec_id", "x").mapInArrow(run, "ids array<long>, x binary"), "white-blocks")


def _numbers(column, dim: int):
    for x in column:
        yield np.frombuffer(x.as_buffer(), "<i8").reshape(-1, dim)


def _summed(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the tasks' matrices, handed over as (at, value); aggregated map-side and by place."""
    out = np.zeros(int(np.prod(shape)))
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out.reshape(shape)


class Passes:
    """Products of the covariance with thin matrices; one job over the blocks each."""

    def __init__(self, blocks: DataFrame, dim: int) -> None:
        self.blocks, self.dim = blocks, dim

        def totals(batches):
            n, s = 0, np.zeros(dim, object)
            for batch in batches:
                for x in _numbers(batch.column("x"), dim):
                    n += len(x)
                    s = s + x.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array([*(int(v) for v in s), n], pa.int64())], ["at", "value"])

        exact = {r["at"]: int(r["value"]) for r in blocks.select("x").mapInArrow(totals, "at int, value long").groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
        self.n, self.sums = exact.get(dim, 0), [exact.get(j, 0) for j in range(dim)]
        self.mean = np.array([s / max(self.n, 1) for s in self.sums])
        self.passes = 0

    def _run(self, part, shape: tuple[int, int]) -> np.ndarray:
        mean, dim = self.mean, self.dim

        def run(batches):
            total = np.zeros(shape)
            for batch in batches:
                for x in _numbers(batch.column("x"), dim):
                    total += part(x.astype(float) - mean)
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["at", "value"])

        self.passes += 1
        return _summed(self.blocks.select("x").mapInArrow(run, "at int, value double"), shape) / self.n

    def times(self, q: np.ndarray) -> np.ndarray:
        return self._run(lambda x: x.T @ (x @ q), (self.dim, q.shape[1]))

    def second_moments(self, u: np.ndarray) -> np.ndarray:
        """Of the projections on the columns of u; and the trace of the covariance follows from times()."""
        return self._run(lambda x: (x @ u).T @ (x @ u), (u.shape[1], u.shape[1]))

    def trace(self) -> float:
        return float(self._run(lambda x: np.array([[np.einsum("ij,ij->", x, x)]]), (1, 1))[0, 0])


def least_eigenvalue(times, dim: int, steps: int, rng: np.random.Generator) -> float:
    """A bound below the spectrum that is seldom missed: the least Ritz value of a Lanczos run less its residual."""
    q, before, beta = rng.normal(size=(dim, 1)), np.zeros((dim, 1)), 0.0
    q /= np.linalg.norm(q)
    basis, diagonal, beside = [q], [], []
    for _ in range(min(steps, dim)):
        w = times(q) - beta * before
        diagonal.append(float((q.T @ w)[0, 0]))
        w -= diagonal[-1] * q
        for b in basis:
            w -= b * (b.T @ w)
        before, beta = q, float(np.linalg.norm(w))
        beside.append(beta)
        if beta <= 1e-14 * max(diagonal[0], 1e-300):
            break
        q = w / beta
        basis.append(q)
    t = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, float(values[0] - beside[-1] * abs(vectors[-1, 0])))


def filtered(times, q: np.ndarray, low: float, high: float, degree: int, top: float) -> np.ndarray:
    """The Chebyshev polynomial of the degree, scaled to 1 at top, of the covariance times q; it is at most
    about 1 / T(top) between low and high."""
    centre, half = (high + low) / 2, (high - low) / 2
    sigma = half / (top - centre)
    first = sigma
    before, now = q, (times(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def leading_components(passes: Passes, wanted: int, guard: int = GUARD, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, unit eigenvectors as columns, and the largest residual over the largest eigenvalue."""
    dim, rng = passes.dim, np.random.default_rng(seed)
    wanted = min(wanted, dim)
    k = min(dim, wanted + guard)

    def ritz(q):
        y = passes.times(q)
        values, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        return values, q @ turn, np.linalg.norm((y @ turn - q @ turn * values)[:, :wanted], axis=0)

    values, q, residual = ritz(np.linalg.qr(rng.normal(size=(dim, k)))[0])
    low = least_eigenvalue(passes.times, dim, LANCZOS, rng) if k < dim else 0.0
    best = None
    for _ in range(ROUNDS):
        top = max(float(values[0]), 0.0)
        off = float(residual.max()) / top if top > 0 else 0.0
        stuck = best is not None and off <= ACCEPTED and off > 0.5 * best[0]
        if best is None or off < best[0]:
            best = off, values[:wanted], q[:, :wanted]
        if off <= RESIDUAL or stuck or k == dim:
            break
        high = max(float(values[-1]), low + 1e-9 * top)
        if float(values[wanted - 1]) <= high * (1 + 1e-12):  # nothing stands out yet, or a flat spectrum
            high = low + 0.9 * (float(values[wanted - 1]) - low) if values[wanted - 1] > low else high
        # The degree that pulls the wanted components apart by SPREAD at most, so that QR keeps the least of them.
        grow = lambda value: np.arccosh(max(1.0, (2 * value - high - low) / max(high - low, 1e-300)))
        apart = max(grow(top) - grow(float(values[wanted - 1])), 1e-9)
        degree = int(np.clip(np.log(SPREAD) / apart, 1, DEGREE))
        q = np.linalg.qr(filtered(passes.times, q, low, high, degree, top))[0]
        values, q, residual = ritz(q)
    if best[0] > ACCEPTED:
        raise RuntimeError(f"components not certified: residual {best[0]:.1e} of the largest eigenvalue after {passes.passes} passes")
    return best[1], best[2], best[0]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row that takes part and each
    component: whitened is the row's projection on the component over its standard deviation, so that the
    whitened columns have the identity as covariance (identity_error is the largest entry they miss it by).

    A vector that is null or empty, or holds a null or a number that is not finite, takes no part, nor does one
    of another dimension than the most common. Repeated rows count as often as they are there. A component
    without variance (equal rows, a single row, columns that depend on each other) has nothing to be divided
    by and is left out; with fewer dimensions than components there are that many. Equal eigenvalues have
    some orthogonal vectors of their space. A number or a deviation that does not fit into a long is an error.
    An empty table gives no row; other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = whole_numbers(vectors.withColumn(id_col, F.col(id_col).cast("long")), id_col, vector_col)
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common.dim
    blocks = blocks_of(rows, dim)
    passes = Passes(blocks, dim)
    trace = passes.trace()
    if trace == 0:
        return spark.createDataFrame([], schema)
    values, u, _ = leading_components(passes, components)
    some = values > EMPTY * values[0]
    values, u = values[some], u[:, some]
    turn = u / np.sqrt(values)
    error = float(np.abs(passes.second_moments(turn) - np.eye(len(values))).max())
    n, mean, sums = passes.n, passes.mean, passes.sums
    explained = values / trace
    k = len(values)

    def run(batches):
        s = np.array(sums, object)
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _numbers(batch.column("x"), dim)):
                if np.abs(x).max() * n + max(map(abs, sums)) < 2 ** 62:
                    far = x * n - s.astype(np.int64)
                    far = far if dim * int(np.abs(far).max()) ** 2 < 2 ** 63 else far.astype(object)
                else:
                    far = x.astype(object) * n - s
                deviation = pa.array([int(v) for v in (far * far).sum(axis=1)], pa.int64()).to_numpy()
                w = (x.astype(float) - mean) @ turn
                m = len(x)
                yield pa.RecordBatch.from_arrays([ids.values.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(np.repeat(deviation, k)),
                                                  pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], [f.split()[0] for f in schema.split(", ")])

    return blocks.mapInArrow(run, schema)

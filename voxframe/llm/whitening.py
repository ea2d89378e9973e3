"""Embedding whitening: leading principal components by Chebyshev-filtered subspace iteration over distributed passes.

Only d x d-free products leave the executors: a pass sends a block Q of d x q numbers to the tasks, which return the sums of
their centred X'XQ, d x q numbers each, added up by a shuffle. The recurrence, QR and the Rayleigh-Ritz step work on such blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MOST = 1 << 40
DEGREE = 24
SPREAD = 12.0
SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


class Centre:
    """n rows and their exact sums S, kept as whole means and remainders: x - S/n then loses nothing to a large mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S) ** 2, exact: in 64 bits where these hold it, else in Python integers."""
        off = x - self.whole
        far = int(np.abs(off).max(initial=0)) + 1
        if far * far * self.n * self.n * x.shape[1] < 1 << 62:
            d = off * self.n - self.rest
            return pa.array((d * d).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
        d = off.astype(object) * self.n - self.rest.astype(object)
        return pa.array((d * d).sum(axis=1).tolist(), pa.decimal128(38, 0))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dim)


def _sums(dim: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, dtype=object)
        for batch in batches:
            x = _matrix(batch, dim)
            n += len(x)
            for at in range(0, len(x), 1 << 20):
                total += x[at : at + (1 << 20)].sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(total.tolist(), pa.decimal128(38, 0))], ["i", "n", "s"])

    return run


def _product(centre: Centre, q: np.ndarray, whitened: bool = False) -> Callable:
    """Rows of this task's X'XQ, or of Q'X'XQ if `whitened`; the last column is the sum of squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, wide = q.shape
        y, n = np.zeros((wide if whitened else dim, wide + 1)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = centre.apply(_matrix(batch, dim))
            p = x @ q
            y[:, :wide] += (p if whitened else x).T @ p
            y[:, wide] += ((p if whitened else x) ** 2).sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(y)), pa.int32()), *(pa.array(c) for c in y.T)], ["i", *(f"y{j}" for j in range(wide + 1))])

    return run


def _pass(rows: DataFrame, centre: Centre, q: np.ndarray, whitened: bool = False) -> tuple[np.ndarray, float]:
    """(V Q, trace of V) by one job; V is the covariance of all rows."""
    names = [f"y{j}" for j in range(q.shape[1] + 1)]
    parts = rows.mapInArrow(_product(centre, q, whitened), "i int, " + ", ".join(f"{c} double" for c in names))
    got = parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    y = np.column_stack([got.column(c).to_numpy() for c in names])[np.argsort(got.column("i").to_numpy())] / centre.n
    return y[:, :-1], float(y[:, -1].sum())


def leading(times: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, k: int, tol: float = 1e-13, passes: int = 2000, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit eigenvectors, trace) of the k leading pairs of a positive semidefinite matrix V, given Q -> (VQ, trace).

    The block has 2k + 16 columns, or all. Each round damps the interval from 0 to the block's least Ritz value by a Chebyshev
    polynomial, whose degree is bounded so that columns stay independent, and ends with QR and Rayleigh-Ritz. Pairs
    whose residual is below tol times the largest eigenvalue are locked and taken out of the products. All k must get there:
    more than `passes` products are an error.
    """
    wide = min(dim, 2 * k + 16)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, wide)))[0]
    locked, values, used = np.zeros((dim, 0)), np.zeros(0), 0
    most = trace = 0.0

    def product(b: np.ndarray) -> np.ndarray:
        nonlocal used, trace
        used += 1
        if used > passes:
            raise RuntimeError(f"{len(values)} of {k} components certified after {passes} passes")
        y, trace = times(b)
        return y - locked @ (values[:, None] * (locked.T @ b))

    while True:
        vq = product(q)
        e, r = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        e, r = e[::-1], r[:, ::-1]
        q, vq = q @ r, vq @ r
        most = max(most, float(e[0]), *values) if len(values) else max(most, float(e[0]))
        left = np.linalg.norm(vq - q * e, axis=0)
        good = 0
        while len(values) + good < k and good < len(e) and left[good] <= tol * most:
            good += 1
        locked, values = np.column_stack([locked, q[:, :good]]), np.r_[values, e[:good]]
        if len(values) >= min(k, dim) or good == len(e) or most == 0:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order], trace
        q, e, left = q[:, good:], e[good:], left[good:]
        need = k - len(values)
        half = max(float(e[-1]), tol * most) / 2
        rate = np.arccosh(np.maximum(e / half - 1, 1.0))
        gain = max(float(rate[need - 1]), 1e-3)
        apart = max(float(rate[0] - rate[need - 1]), 1e-9)
        want = np.log(max(float(left[:need].max()) / (tol * most), 10.0)) / gain
        degree = int(np.clip(want + 1, 2, max(2, min(DEGREE, SPREAD / apart))))
        # three-term recurrence, scaled by its value at the largest Ritz value so that nothing overflows
        sigma = first = half / max(float(e[0]) - half, half)
        before, now = q, (product(q) - half * q) * (sigma / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - sigma)
            before, now = now, (product(now) - half * now) * (2 * after / half) - before * (sigma * after)
            sigma = after
        now -= locked @ (locked.T @ now)
        now /= np.maximum(np.linalg.norm(now, axis=0), np.finfo(float).tiny)
        q = np.linalg.qr(now)[0]
        q -= locked @ (locked.T @ q)
        q = np.linalg.qr(q)[0]


def _projected(centre: Centre, basis: np.ndarray, explained: np.ndarray, error: float) -> Callable:
    k = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, len(basis))
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), centre.n, dtype=np.int64)),
                    centre.deviations(x).take(pa.array(rows)),
                    pa.array((centre.apply(x) @ basis).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(vectors: DataFrame, k: int = 8, scale: float = 1024.0, shift: int = 100_000, id_col: str = "vec_id", vec_col: str = "embedding", tol: float = 1e-13) -> DataFrame:
    """Whitened coordinates of every vector on the k leading components: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries c become x = floor(scale * c) + shift. Vectors that are null or empty, or hold an entry that is null, not finite or
    beyond 2 ** 40 in x, take no part. The covariance is that of all others, divisor n; vectors of another length are whitened by
    themselves, with their own n. Rows that repeat count as often, whatever their ids; a null id stays null. There are as
    many components as V has eigenvalues above rounding, k at most: none for equal vectors or a single one, which then
    give no rows. deviation is exact, with up to 38 digits. Signs make the largest entry of a component positive. identity_error
    is measured by one more pass over the whitened rows. The driver holds d x (2k + 16) numbers. Other columns are ignored.
    """
    x = F.col(vec_col)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double") * scale) >= float(MOST - abs(shift))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long"))
    rows = vectors.filter(x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(odd, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))
    rows = staged(rows, "whitening")
    found = None
    for r in rows.groupBy(F.size("x").alias("dim")).count().orderBy("dim").toLocalIterator():
        part = _of_length(rows.filter(F.size("x") == r.dim), r.dim, k, tol)
        found = part if found is None else found.union(part)
    return vectors.sparkSession.createDataFrame([], SCHEMA) if found is None else found


def _of_length(rows: DataFrame, dim: int, k: int, tol: float) -> DataFrame:
    sums = rows.mapInArrow(_sums(dim), "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    centre = Centre(sums[0].n, [int(r.s) for r in sums])
    e, basis, trace = leading(lambda q: _pass(rows, centre, q), dim, min(k, dim), tol)
    real = e > max(trace, 0.0) * 1e-12
    e, basis = e[real], basis[:, real]
    if not len(e):
        return rows.sparkSession.createDataFrame([], SCHEMA)
    basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(len(e))]) / np.sqrt(e)
    error = float(np.abs(_pass(rows, centre, basis, whitened=True)[0] - np.eye(len(e))).max())
    return rows.mapInArrow(_projected(centre, basis, e / trace, error), SCHEMA)

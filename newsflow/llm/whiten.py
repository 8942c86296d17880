"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V is never formed. A pass over the stored fit list (each distinct
vector once) gives V Q for a block Q of a few vectors: every task adds up
Xc' (Xc Q) of its centred rows, and the tasks' sums are added along a tree, so the
driver holds matrices of the dimension times the block only. An iteration

1. projects V on the block (Rayleigh-Ritz), which needs one pass;
2. stops when the wanted pairs are certified: the residual |V q - t q| of each is
   within rounding of the largest eigenvalue, or has reached the floor that rounding
   allows and is under ``LOOSE``;
3. else filters the block by the Chebyshev polynomial, in a three-term recurrence of
   one pass a degree, that stays small on the unwanted part of the spectrum and grows
   quickly above it, and orthonormalises the block (QR).

The unwanted part ends at the block's smallest Ritz value. Where it begins is bounded
by a Lanczos run on one more column that takes part in the filter's passes (its least
Ritz value less its residual); a bound that is too high only slows the iteration down,
as the residuals decide.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, stored

SCALE = 256                      # entries become floor(SCALE * c)
COMPONENTS = 4
SPARE = 20                       # columns of the block beyond the wanted components
DEGREE = 10                      # passes of a filter
ROUNDS = 60                      # iterations at most; then an error, never an uncertified result
TIGHT, LOOSE = 2e-15, 1e-10      # residual over the largest eigenvalue, times sqrt(dimension): certified, certified at the floor
TINY = 1e-12                     # an eigenvalue under this part of the trace counts as zero
ROWS = 4096                      # rows that are centred and multiplied at a time
LONG = 2**63 - 1

SCHEMA = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whole_vectors(rows: DataFrame, column: str = "embedding", d: int | None = None) -> DataFrame:
    """The rows whose vector is not null and has only finite entries, with ``_x array<bigint>``, its scaled entries rounded down.

    Vectors of another length than ``d``, or if that is not given than most (ties: the shorter), are left out too, as are vectors without entries."""
    v = F.col(column)
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = rows.where(v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(odd, F.lit(True)))
    if d is None:
        most = whole.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").first()
        d = most.d if most else 0
    return (whole.where(F.size(v) == d)
            .withColumn("_x", F.transform(v, lambda c: (F.floor(c.cast("double") * SCALE) + F.lit(0)).cast("bigint"))))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _sum_over(frame: DataFrame, partial) -> np.ndarray | None:
    """The sum of ``partial(matrix)`` over all blocks of ``frame(_x)``: one array a task, added along a tree."""
    def run(batches):
        total = None
        for b in batches:
            x = _matrix(b.column(0))
            for a in range(0, len(x), ROWS):
                part = partial(x[a:a + ROWS])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [total.astype("<f8").tobytes()]})

    def add(a, b):
        return (np.frombuffer(a, "<f8") + np.frombuffer(b, "<f8")).tobytes()
    parts = frame.select("_x").mapInArrow(run, "part binary").rdd.map(lambda r: bytes(r.part))
    total = parts.treeAggregate(b"", lambda a, b: add(a, b) if a else b, lambda a, b: add(a, b) if a and b else a or b)
    return np.frombuffer(total, "<f8") if total else None


class Fit:
    """The fit list, stored, with its exact sums."""

    def __init__(self, whole: DataFrame):
        bounded_batches(whole.sparkSession)
        self.list = stored(whole.select("_x").distinct(), "whiten-fit")
        sums = (self.list.select(F.posexplode("_x").alias("i", "v"))
                .groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"),
                                  F.max(F.abs(F.col("v").cast("decimal(38,0)"))).alias("m"))
                .orderBy("i").collect())                      # a row for each dimension
        self.d = len(sums)
        self.n = sums[0].n if sums else 0
        self.sums = [int(r.s) for r in sums]
        self.largest = max((int(r.m) for r in sums), default=0)
        self.mean = np.array([s / self.n for s in self.sums])

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q, one pass over the fit list."""
        mean, n = self.mean, self.n

        def partial(x):
            c = x - mean
            return (c.T @ (c @ q)).ravel()
        return _sum_over(self.list, partial).reshape(q.shape) / n

    def trace(self) -> float:
        mean = self.mean
        total = _sum_over(self.list, lambda x: np.array([((x - mean) ** 2).sum()]))
        return float(total[0]) / self.n

    def covariance_of(self, project: np.ndarray) -> np.ndarray:
        """The covariance of the fit list's projections on the columns of ``project``, centred anew."""
        mean, n, k = self.mean, self.n, project.shape[1]

        def partial(x):
            y = (x - mean) @ project
            return np.concatenate([y.sum(0), (y.T @ y).ravel()])
        total = _sum_over(self.list, partial)
        m = total[:k] / n
        return total[k:].reshape(k, k) / n - np.outer(m, m)


class Lanczos:
    """A bound on the least eigenvalue from one column of the filter's passes."""

    def __init__(self, d: int):
        v = np.random.default_rng(2).standard_normal(d)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    def take(self, product: np.ndarray) -> None:
        """``product`` is V times the last vector of the basis."""
        v, w = self.basis[-1], product.copy()
        self.alpha.append(float(v @ w))
        for _ in range(2):
            for u in self.basis:
                w -= (u @ w) * u
        self.beta.append(float(np.linalg.norm(w)))
        self.basis.append(w / self.beta[-1] if self.beta[-1] > 0 else w)

    def floor(self) -> float:
        if len(self.alpha) < 3:
            return 0.0
        t = np.diag(self.alpha) + np.diag(self.beta[:-1], 1) + np.diag(self.beta[:-1], -1)
        e, u = np.linalg.eigh(t)
        return max(0.0, float(e[0]) - self.beta[-1] * abs(float(u[-1, 0])))

    def going(self) -> bool:
        return len(self.alpha) < min(30, len(self.basis[0]) - 1) and (not self.beta or self.beta[-1] > 1e-8 * max(self.alpha))


def eigenpairs(times, d: int, wanted: int, spare: int = SPARE, degree: int = DEGREE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, list]:
    """The largest ``wanted`` eigenvalues (falling) and unit eigenvectors of the symmetric, positive semi-definite operator
    ``times`` of dimension ``d``, and the residuals of each iteration. Each call of ``times`` is a pass."""
    k = min(d, wanted + spare)
    wanted = min(wanted, d)
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((d, k)))
    lanczos, history, best = Lanczos(d), [], math.inf
    for _ in range(rounds):
        product = times(q)                                    # Rayleigh-Ritz
        e, u = np.linalg.eigh((q.T @ product + product.T @ q) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, product = q @ u, product @ u
        scale = max(float(e[0]), np.finfo(float).tiny)
        worst = float(np.linalg.norm(product - q * e, axis=0)[:wanted].max()) / scale / math.sqrt(d)
        history.append(worst)
        stuck = worst > 0.5 * best
        best = min(best, worst)
        if worst <= TIGHT or k == d or e[0] <= 0 or (stuck and worst <= LOOSE):
            return e[:wanted], q[:, :wanted], history
        high, low = float(e[-1]), min(lanczos.floor(), 0.98 * float(e[-1]))
        centre, half = (high + low) / 2, max((high - low) / 2, 1e-14 * scale)
        # scaled by its value at the largest eigenvalue, so that nothing overflows
        first = half / (scale - centre)
        sigma = first
        old, new = q, (product - centre * q) * (sigma / half)
        for _ in range(degree - 1):
            if lanczos.going():
                both = times(np.column_stack([new, lanczos.basis[-1]]))
                lanczos.take(both[:, -1])
                vn = both[:, :-1]
            else:
                vn = times(new)
            following = 1 / (2 / first - sigma)
            old, new = new, (vn - centre * new) * (2 * following / half) - old * (sigma * following)
            sigma = following
        q, _ = np.linalg.qr(new)
    raise RuntimeError(f"no certified components after {rounds} iterations; residuals {history[-3:]}")


class Whitening:
    """Mean, components and scales, from ``fit``; ``explained`` and ``identity_error`` describe them."""

    def __init__(self, fit: Fit, components: int):
        self.n, self.sums, self.mean = fit.n, fit.sums, fit.mean
        bound = fit.n * fit.largest + max(map(abs, fit.sums), default=0)
        self.small = fit.d * bound * bound <= LONG               # deviations fit 64-bit arithmetic
        trace = fit.trace() if fit.n else 0.0
        if trace <= 0:
            self.values, self.project, self.explained, self.identity_error, self.history = np.zeros(0), np.zeros((fit.d, 0)), np.zeros(0), 0.0, []
            return
        e, q, self.history = eigenpairs(fit.times, fit.d, components)
        e, q = e[e > TINY * trace], q[:, e > TINY * trace]
        q = q * np.sign(q[np.abs(q).argmax(0), np.arange(q.shape[1])])       # the largest entry of a component is positive
        self.values, self.project, self.explained = e, q / np.sqrt(e), e / trace
        self.identity_error = float(np.abs(fit.covariance_of(self.project) - np.eye(len(e))).max())


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """A ``Whitening`` of ``rows``. Repeated vectors count once; components without variance are left out."""
    return Whitening(Fit(whole_vectors(rows, column).select("_x")), components)


def _deviation(x: np.ndarray, w: Whitening) -> list:
    if w.small:
        return ((w.n * x - np.array(w.sums, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((w.n * v - s) ** 2 for v, s in zip(r, w.sums, strict=True)) for r in x.tolist()]
    return [v if v <= LONG else None for v in exact]


def apply(rows: DataFrame, w: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key`` and ``SCHEMA``: for each usable row and each component, its coordinate in units of the component's deviation.

    A deviation over the largest long is null. Repeated rows are returned each for itself, null keys too; without
    a component of any variance (one distinct vector, an empty table) there are no rows."""
    def run(batches):
        k = len(w.values)
        for b in batches:
            x = _matrix(b.column(1))
            m = len(x)
            y = (x - w.mean) @ w.project
            pick = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pick), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n, np.int64)),
                 pa.array(_deviation(x, w), pa.int64()).take(pick), pa.array(y.ravel()), pa.array(np.tile(w.explained, m)),
                 pa.array(np.full(m * k, w.identity_error))], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    spark: SparkSession = rows.sparkSession
    bounded_batches(spark)
    kind = rows.schema[key].dataType.simpleString()
    if not len(w.values):
        return spark.createDataFrame([], f"`{key}` {kind}, {SCHEMA}")
    return whole_vectors(rows.select(key, column), column, len(w.sums)).select(key, "_x").mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")

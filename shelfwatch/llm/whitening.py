"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are put on a grid of integers first, x = floor(1024 * c) + 100000 for each
component c, so that counts and sums over all rows are exact. The centred rows form
a tall matrix C. Starting from a unit vector v, each step takes the distributed
products u = Cv and Cᵀu, both made orthogonal to all earlier ones, and adds a column
to an upper bidiagonal matrix B with CV = UB. The singular values and vectors of the
small B give the principal components of C and their deviations.

The left vectors u are as long as the table, so they are never stored: a row's
entries follow from the row and a few numbers of each earlier step, and each task
works them out again in the same order. A step is one pass over the integer table:
it sums the new entries' products with the earlier ones and with the rows, as many
numbers as a vector has components. The driver holds the right vectors, B, and no
row. A lost executor only repeats its part of a pass.

All dimensions are worked off if there are at most ``least`` of them; beyond that the
steps end when the leading components stand still. A step that finds nothing new (a
repeated or zero singular value) goes on from a fresh direction.

A vector is left out if it is null or empty, holds a null or non-finite component or
one of 2^30 or more (whose integer has no exact place in a sum), or has another
length than most (of equally common lengths the longest counts). Components whose
eigenvalue is zero up to rounding have no whitened values and no rows; so a table of
equal vectors, or an empty one, gives none. Repeated rows and ids are rows of their
own. Deviations beyond 38 digits are null. Result columns replace input columns of
the same name, the others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.runtime import Scratch

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 30)
ADDED = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
_X = "__x"
_EXACT = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Centre:
    """Rows, and their exact sum in each dimension."""

    n: int
    sums: tuple[int, ...]

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean: the whole part exactly, then the fraction."""
        return (x - self.floors).astype(np.float64) - self.rests / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2 of each row, exact."""
        near = x - self.floors
        widest = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if x.shape[1] * widest * widest < 1 << 63:
            z = self.n * near - self.rests
            return pa.array((z * z).sum(axis=1)).cast(_EXACT)
        z = self.n * near.astype(object) - self.rests.astype(object)
        sums = (z * z).sum(axis=1)
        return pa.array([Decimal(v) if v < 10**38 else None for v in sums], _EXACT)


@dataclass(frozen=True)
class Whitening:
    """What the fit found: unit components as columns, their eigenvalues, and the trace."""

    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def integers(rows: DataFrame, vector: str) -> DataFrame:
    """The rows that remain, with their vector as integers in ``__x``."""
    value = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = rows.withColumn(_X, value).filter(F.col(_X).isNotNull() & (F.size(_X) > 0))
    rows = rows.filter(F.forall(_X, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))))
    whole = F.transform(_X, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("bigint"))
    return rows.withColumn(_X, whole)


def _totals(table: DataFrame, numbers: int, work) -> np.ndarray:
    """Sums over all batches of the *numbers* doubles that *work* makes of a matrix."""

    def run(batches):
        total = np.zeros(numbers)
        for b in batches:
            if b.num_rows:
                total += work(_matrix(b.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(numbers)), pa.array(total)], ["i", "value"])

    parts = table.select(_X).mapInArrow(run, "i bigint, value double")
    out = np.zeros(numbers)
    # As many rows as numbers: a few times the length of a vector.
    for r in parts.groupBy("i").agg(F.sum("value").alias("value")).collect():
        out[r["i"]] = r["value"]
    return out


def centre_of(table: DataFrame, dim: int) -> Centre:
    """Count and exact sums; dim + 1 numbers reach the driver."""

    def run(batches):
        total = [0] * (dim + 1)
        for b in batches:
            x = _matrix(b.column(0)) if b.num_rows else np.zeros((0, dim), np.int64)
            total[0] += len(x)
            for i, s in enumerate(x.sum(axis=0)):
                total[i + 1] += int(s)
        sums = pa.array([Decimal(t) for t in total], _EXACT)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim + 1)), sums], ["i", "value"])

    parts = table.select(_X).mapInArrow(run, "i bigint, value decimal(38,0)")
    got = {r["i"]: int(r["value"]) for r in parts.groupBy("i").agg(F.sum("value").alias("value")).collect()}
    return Centre(got.get(0, 0), tuple(got.get(i + 1, 0) for i in range(dim)))


class _Bidiagonal:
    """The state of the bidiagonalisation: right vectors, B, and how to redo the left ones."""

    def __init__(self, dim: int, seed: int):
        self.dim = dim
        self.random = np.random.default_rng(seed)
        self.right = np.zeros((dim, 0))
        self.alphas: list[float] = []
        self.betas: list[float] = []
        #: Per step, the parts of earlier left vectors taken out of the new one.
        self.taken: list[np.ndarray] = []
        #: Cᵀu of each left vector.
        self.back = np.zeros((dim, 0))
        self._append(self._fresh())

    def _append(self, v: np.ndarray) -> None:
        self.right = np.column_stack([self.right, v])

    def _orthogonal(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - self.right @ (self.right.T @ v)
        return v

    def _fresh(self) -> np.ndarray:
        v = self._orthogonal(self.random.standard_normal(self.dim))
        return v / np.linalg.norm(v)

    def step(self, table: DataFrame, centre: Centre) -> None:
        """One u = Cv and one Cᵀu, in one pass over the table."""
        j, right = len(self.alphas), self.right
        alphas, betas, taken = list(self.alphas), list(self.betas), list(self.taken)

        def work(x):
            c = centre.centred(x)
            products = c @ right
            left = np.zeros((len(x), j))
            for k in range(j + 1):
                u = products[:, k]
                if k:
                    u = u - betas[k - 1] * left[:, k - 1]
                if k < j:
                    u = u - left[:, :k] @ taken[k]
                    left[:, k] = u / alphas[k] if alphas[k] else 0.0
            return np.concatenate([[u @ u], left.T @ u, c.T @ u])

        got = _totals(table, 1 + j + self.dim, work)
        square, dots, back = got[0], got[1 : 1 + j], got[1 + j :]
        # What is left of u, and of Cᵀu, without the earlier left vectors.
        alpha = float(np.sqrt(max(square - dots @ dots, 0.0)))
        back = back - self.back @ dots
        if alpha <= 1e-13 * max([*self.alphas, alpha, 1e-300]):
            alpha, back = 0.0, np.zeros(self.dim)
        else:
            back = back / alpha
        self.alphas.append(alpha)
        self.taken.append(dots)
        self.back = np.column_stack([self.back, back])
        if j + 1 == self.dim:
            self.betas.append(0.0)
            return
        v = self._orthogonal(back - alpha * right[:, j])
        beta = float(np.linalg.norm(v))
        if beta <= 1e-13 * max(*self.alphas, 1e-300):
            self.betas.append(0.0)
            self._append(self._fresh())
        else:
            self.betas.append(beta)
            self._append(v / beta)

    def leading(self, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Components, singular values, and how far the worst is from standing still."""
        k = len(self.alphas)
        b = np.diag(self.alphas) + np.diag(self.betas[: k - 1], 1)
        left, s, right = np.linalg.svd(b)
        some = s[:wanted]
        gaps = np.abs(np.diff(s, append=0.0))[: len(some)]
        loose = np.abs(self.betas[-1] * left[-1, : len(some)]) / np.maximum(gaps, 1e-300)
        return self.right[:, :k] @ right[: len(some)].T, some, float(loose.max(initial=0.0))


def fit(table: DataFrame, dim: int, wanted: int = 8, least: int = 64, seed: int = 13) -> Whitening | None:
    """The leading components of the table's integer vectors; None without any spread."""
    centre = centre_of(table, dim)
    if not centre.n:
        return None
    trace = float(_totals(table, 1, lambda x: np.square(centre.centred(x)).sum(keepdims=True).ravel())[0])
    if not trace:
        return None
    job = _Bidiagonal(dim, seed)
    while True:
        job.step(table, centre)
        steps = len(job.alphas)
        if steps == dim:
            break
        if steps >= max(least, wanted) and job.leading(wanted)[2] <= 1e-13:
            break
    components, singular, _ = job.leading(wanted)
    eigenvalues = singular**2 / centre.n
    real = eigenvalues > 1e-20 * dim * trace / centre.n
    return Whitening(centre, components[:, real], eigenvalues[real], trace / centre.n)


def identity_error(table: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    k = len(model.eigenvalues)

    def work(x):
        w = model.project(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = _totals(table, k + k * k, work) / model.centre.n
    covariance = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str = "embedding", wanted: int = 8, least: int = 64) -> DataFrame:
    """One row per remaining vector and component; the vector's column goes."""
    spark = rows.sparkSession
    job = Scratch(spark, "whitening")
    rest = [c for c in rows.columns if c != vector and c not in ADDED]
    schema = T.StructType([
        *[rows.schema[c] for c in rest],
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ])
    table = job.write(integers(rows.select(*rest, vector), vector).select(*rest, _X), "integers")
    # One row per length that occurs is sorted, one reaches the driver.
    usual = table.groupBy(F.size(_X).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    table = table.filter(F.size(_X) == usual["dim"])
    model = fit(table, usual["dim"], wanted, least)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(table, model)
    k, n = len(model.eigenvalues), model.centre.n
    explained = model.eigenvalues / model.trace

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(_X))
            each = pa.array(np.repeat(np.arange(b.num_rows), k))
            size = b.num_rows * k
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c).take(each) for c in rest],
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                    pa.array(np.full(size, n, np.int64)),
                    model.centre.deviations(x).take(each),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(explained, b.num_rows)),
                    pa.array(np.full(size, error)),
                ],
                schema.names,
            )

    return table.select(*rest, _X).mapInArrow(run, schema)

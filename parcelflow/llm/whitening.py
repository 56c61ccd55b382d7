"""Whitening of embeddings by shifted Cholesky QR.

Method: distinct integer vectors are the fit list A, centred by its exact
means. A pass over A sums the Gram matrix of the rows; its Cholesky factor R1
(shifted, so that it exists whatever the rounding) gives better conditioned
rows A R1^-1 through a triangular solve, whose Gram matrix gives R2, and so on
until the rows are orthonormal. The product R of the factors satisfies
A = Q R, and its singular vectors and values are those of A: components and,
squared over n, the eigenvalues of the covariance. The covariance itself is
never formed, so small eigenvalues keep their digits.

Every pass is one map over the stored fit list that emits the sums of a task,
added up by index on the workers; the driver holds a few matrices of the
embeddings' dimension, never rows.

Cases: vectors that are null or hold a null, NaN or infinite entry are
dropped. A vector shorter than the longest one counts as filled up with zeros.
Entries beyond 2^53/256 in size are beyond exact doubles: they stop at a long's
range. Repeated vectors count once in the fit list and have a row each in the
result. Directions without variance have no component, so fewer than 4
components come back from few or dependent vectors, and none from one distinct
vector or an empty table. A deviation beyond a long's range is null. Other
columns are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import short_batches, stored, table

SCALE = 256
COMPONENTS = 4
PASSES = 6  # of Gram matrices at most; two or three do
ORTHONORMAL = 1e-12
EPS = np.finfo(np.float64).eps
ROWS = 512  # vectors that a task turns into doubles at once


@dataclass
class Fit:
    """What the scoring needs: a few vectors of the embeddings' dimension."""

    n: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray  # a unit eigenvector per row
    eigenvalues: np.ndarray
    explained: np.ndarray


def integers(rows: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, x``: the vectors without null or non-finite entries, as longs."""
    usable = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("_v"))
    finite = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return usable.where(F.col("_v").isNotNull() & finite).select(
        "vec_id", F.transform("_v", lambda c: F.floor(c * SCALE).cast("long")).alias("x")
    )


def matrices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their vectors as a matrix of longs."""
    for lo in range(0, len(batch), ROWS):
        part = batch.slice(lo, ROWS)
        column = part.column("x")
        lengths = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if (lengths == width).all():
            yield part, flat.reshape(-1, width)
        else:
            x = np.zeros((len(part), width), np.int64)
            x[np.arange(width) < lengths[:, None]] = flat
            yield part, x


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums of the columns; halves of the numbers are added apart, so nothing overflows."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low, strict=True)]


def sums(fit: DataFrame, width: int) -> list[int]:
    """Exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            for _, x in matrices(batch, width):
                total = [a + b for a, b in zip(total, exact_sums(x), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(map(str, total))], ["i", "v"])

    added = short_batches(fit).mapInArrow(run, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    by_place = {r["i"]: int(r["v"]) for r in added.collect()}  # one row per dimension
    return [by_place[i] for i in range(width)]


def gram(fit: DataFrame, width: int, rows_of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over the fit list of the outer products of ``rows_of(x)``, ``size`` numbers a row."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in matrices(batch, width):
                rows = rows_of(x)
                total += rows.T @ rows
        i, j = (pa.array(k.astype(np.int32)) for k in upper)
        yield pa.RecordBatch.from_arrays([i, j, pa.array(total[upper])], ["i", "j", "v"])

    added = short_batches(fit).mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for r in added.collect():  # one row per pair of dimensions
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows R1^-1 R2^-1 ...`` by substitution, column after column of each upper triangular factor."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(len(r)):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of ``g`` plus the least of a few growing shifts for which there is one."""
    least = 11 * len(g) * (len(g) + 1) * EPS * np.trace(g)
    for more in (shift, *(least * 10.0**k for k in range(12))):
        try:
            return np.linalg.cholesky(g + more * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            continue
    raise ValueError("Gram matrix without a Cholesky factor")


def orthogonalised(fit: DataFrame, width: int, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``R`` with ``A = Q R``, and the Gram matrix of ``Q`` (the identity but for directions without variance)."""
    factors: list[np.ndarray] = []
    product = np.eye(width)
    for k in range(PASSES):
        done = list(factors)
        g = gram(fit, width, lambda x: solved(x - mean, done), width)
        if not g.any():  # no variance at all
            break
        # what lies in no direction stays so; in all others the rows must be orthonormal
        values = np.linalg.eigvalsh(g)
        varied = values[values > width * EPS * values[-1]]
        if k and np.abs(varied - 1).max() < ORTHONORMAL:
            break
        if k == PASSES - 1:
            break
        r = _factor(g, 11 * width * (width + 1) * EPS * np.trace(g) if k == 0 else 0.0)
        factors.append(r)
        product = r @ product
    return product, g


def fitted(fit: DataFrame, n: int, width: int, components: int = COMPONENTS) -> Fit:
    """Components of the fit list, the largest eigenvalue first."""
    total = sums(fit, width)
    mean = np.array([float(Fraction(s, n)) for s in total])
    product, left = orthogonalised(fit, width, mean)
    # the last Gram matrix as a root of its own, so that a direction without variance has a singular value of 0
    values, vectors = np.linalg.eigh(left)
    root = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
    _, singular, axes = np.linalg.svd(root @ product)
    some = singular > 16 * width * EPS * singular[0] if singular[0] > 0 else np.zeros(width, bool)
    eigenvalues = singular**2 / n
    share = eigenvalues / eigenvalues.sum() if some.any() else eigenvalues
    most = min(components, int(some.sum()))
    return Fit(n, total, mean, axes[:most], eigenvalues[:most], share[:most])


def projected(x: np.ndarray, fit: Fit) -> np.ndarray:
    """Whitened coordinates of integer vectors."""
    return (x - fit.mean) @ fit.components.T / np.sqrt(fit.eigenvalues)


def identity_error(rows: DataFrame, fit: Fit) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    most = len(fit.components)
    size = most + 1  # a column of ones gives the sums
    g = gram(rows, len(fit.mean), lambda x: np.hstack((projected(x, fit), np.ones((len(x), 1)))), size)
    mean = g[:most, most] / fit.n
    return float(np.abs(g[:most, :most] / fit.n - np.outer(mean, mean) - np.eye(most)).max())


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """``sum((n x - S)^2)`` of every row, exact; None beyond a long's range."""
    most = max(n * int(np.abs(x).max(initial=0)) + max(map(abs, total)), 1)
    if most * most * max(len(total), 1) < 1 << 62:
        apart = n * x - np.array(total, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, total, strict=True)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(rows: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = integers(rows, column, key)
    width = x.agg(F.max(F.size("x"))).first()[0] or 0
    # shorter vectors are the same as their filled-up form
    filled = F.when(F.size("x") == width, F.col("x")).otherwise(
        F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    )
    fit_rows = stored(x.select(filled.alias("x")).distinct(), "fit_list") if width else None
    n = fit_rows.count() if width else 0
    fit = fitted(fit_rows, n, width, components) if n else None
    if fit is None or not len(fit.components):
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(fit_rows, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = len(fit.components)
        for batch in batches:
            for part, x in matrices(batch, width):
                k = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(np.repeat(np.arange(k), most))),
                        pa.array(np.tile(np.arange(1, most + 1, dtype=np.int32), k)),
                        pa.array(np.full(k * most, n, np.int64)),
                        pa.array([v for v in deviations(x, n, fit.sums) for _ in range(most)], pa.int64()),
                        pa.array(projected(x, fit).ravel()),
                        pa.array(np.tile(fit.explained, k)),
                        pa.array(np.full(k * most, error)),
                    ],
                    [c.split()[0] for c in schema.split(", ")],
                )

    return short_batches(x).mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))

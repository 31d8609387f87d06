"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, the fit list is each distinct vector once, and its centred rows are the matrix X.  Every
step is one pass over the fit list, whose tasks form u = X c for a vector c of the driver and add up X'u and the
products of u with all earlier ones.  An earlier u is not stored: as X times a known vector it is formed again beside the
new one, so that a lost executor loses nothing.  Both sides are orthogonalised against all earlier vectors; where a
direction is used up, a random one that is orthogonal to all goes on.  After as many steps as a vector has entries the
bidiagonal matrix holds all of X, repeated singular values included; its SVD on the driver, which is that small, gives
components and deviations.  The driver holds some square matrices of the vector's length and never a row.

Rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are vectors of another length
than the most frequent one (of several, the longest) and those with an entry too large for its whole number.  Repeated
rows and null ids are rows of the result each, and equal vectors count once in the fit.  Components whose deviation is zero (fewer
different vectors than entries, constant entries) cannot be scaled and are left out; without rows, or with one vector
only, the result is empty.  Only ``vec_id`` and ``embedding`` are read, so further columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.llm.common import ship, table
from regionpulse.session import stage

COMPONENTS = 16
GRID = 64
OFFSET = 1_000_000
SEED = 29
#: Deviations below this part of the largest count as zero; so do entries of the bidiagonal matrix, far below it.
ZERO, TINY = 1e-6, 1e-10
#: Rows that a task multiplies at a time.
ROWS = 4096


@dataclass
class Fit:
    """Number of fit rows, their sums, components as columns, eigenvalues, and the trace of the covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float


def on_grid(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the whole numbers of each vector that can be used."""
    number = lambda e: e.cast("double")
    far = float(1 << 53)
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(number(e)) | (F.abs(number(e)) * GRID >= far))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when((F.size("embedding") > 0) & ~bad, F.col("embedding")).alias("embedding"))
    x = F.transform("embedding", lambda e: F.floor(number(e) * GRID) + F.lit(OFFSET))
    return rows.where("embedding IS NOT NULL").select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Portions of rows and their vectors, which stand in column ``at``."""
    for batch in batches:
        for k in range(0, len(batch), ROWS):
            part = batch.slice(k, ROWS)
            if len(part):
                yield part, _matrix(part.column(at))


def _added(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum of ``of(block)``, an array of fixed length, over all blocks of vectors of ``rows`` (x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, 0):
            total = of(x) if total is None else total + of(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))], ["part"])

    parts = rows.select("x").mapInArrow(run, f"part array<{kind}>").select(F.posexplode("part").alias("at", "value"))
    found = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    return np.array([r.value for r in sorted(found, key=lambda r: r.at)], np.int64 if kind == "long" else np.float64)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows less the mean: the subtraction is exact."""
    return (x * n - sums) / n


def deviations(x: np.ndarray, fit: Fit) -> pa.Array:
    """The sum of squares of n x - S of each row, exact; one that does not fit a long stops the job."""
    off = x * fit.n - fit.sums
    large = (off.astype(np.float64) ** 2).sum(1).max(initial=0) >= float(1 << 62)
    return pa.array(((off.astype(object) if large else off) ** 2).sum(1).tolist(), pa.int64())


def bidiagonal(product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]], d: int) -> tuple[np.ndarray, np.ndarray]:
    """The bidiagonal matrix B and the vectors V (columns), with X = U B V'.

    ``product(c, C)`` gives X'u, the products of X C with u, and u'u, for u = X c.
    """
    rng = np.random.default_rng(SEED)

    def fresh(found: np.ndarray) -> np.ndarray:
        v = rng.normal(size=d)
        for _ in range(3):
            v -= found @ (found.T @ v)
            v /= np.linalg.norm(v)
        return v

    v_all, b = np.zeros((d, d)), np.zeros((d, d))
    # The vector c of each u = X c, and X'u.
    c_all, y_all = np.zeros((d, d)), np.zeros((d, d))
    v, largest = fresh(v_all[:, :0]), 0.0
    for k in range(d):
        v_all[:, k] = v
        c = v - b[k - 1, k] * c_all[:, k - 1] if k else v
        y, overlap, square = product(c, c_all[:, :k])
        largest = max(largest, square)
        # Earlier u are taken out of the new one, in the vectors that stand for them.
        c, y, square = c - c_all[:, :k] @ overlap, y - y_all[:, :k] @ overlap, square - overlap @ overlap
        if square > TINY**2 * largest:
            b[k, k] = alpha = np.sqrt(square)
            c_all[:, k], y_all[:, k] = c / alpha, y / alpha
        if k + 1 == d:
            break
        rest = y_all[:, k] - b[k, k] * v
        for _ in range(2):
            rest -= v_all[:, : k + 1] @ (v_all[:, : k + 1].T @ rest)
        beta = np.linalg.norm(rest)
        if beta > TINY * np.sqrt(largest):
            b[k, k + 1], v = beta, rest / beta
        else:
            v = fresh(v_all[:, : k + 1])
    return b, v_all


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fits on the distinct vectors of ``rows`` (x), all of one length, as a table in the shared folder."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first.d
    fit = _added(rows, lambda x: np.append(x.sum(0), len(x)), "long")
    sums, n = fit[:-1], int(fit[-1])

    def product(c: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def of(x: np.ndarray) -> np.ndarray:
            rows = centred(x, n, sums)
            u = rows @ c
            return np.concatenate([rows.T @ u, (rows @ earlier).T @ u, [u @ u]])

        out = _added(rows, of, "double")
        return out[:d], out[d:-1], float(out[-1])

    b, v = bidiagonal(product, d)
    _, deviations, turn = np.linalg.svd(b)
    values = deviations**2 / n
    good = values > ZERO**2 * values[0]
    shown = np.flatnonzero(good)[:components]
    return Fit(n, sums, (v @ turn.T)[:, shown], values[shown], float(values.sum()))


def identity_error(rows: DataFrame, fit: Fit) -> float:
    """The largest difference between the covariance of the whitened fit rows and the identity."""
    k = len(fit.values)

    def of(x: np.ndarray) -> np.ndarray:
        z = centred(x, fit.n, fit.sums) @ fit.components / np.sqrt(fit.values)
        return np.append((z.T @ z).ravel(), z.sum(0))

    out = _added(rows, of, "double")
    mean = out[k * k :] / fit.n
    return float(np.abs(out[: k * k].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained and identity_error."""
    rows = on_grid(vectors)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == lengths.d)
    distinct = stage(rows.select("x").distinct())
    fit = fitted(distinct, components)
    if not len(fit.values):
        return spark.createDataFrame([], schema)
    scale, names = fit.components / np.sqrt(fit.values), ["vec_id", "deviation", "whitened"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 1):
            z = centred(x, fit.n, fit.sums) @ scale
            bounds = pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), deviations(x, fit), pa.ListArray.from_arrays(bounds, pa.array(z.ravel()))], names)

    error = identity_error(distinct, fit)
    out = rows.mapInArrow(project, "vec_id long, deviation long, whitened array<double>")
    explained = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
    return out.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened components of every vector."""
    return whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ship(__name__)

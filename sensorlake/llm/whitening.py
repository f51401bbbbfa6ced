"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Spark finds the distinct vectors, their sums and their scatter; every task adds up its own rows and hands on one small matrix.
The vectors are whole numbers (``round_entries``), so sums and scatter are exact: rows are centred at the nearest whole mean
before they are multiplied, and what the mean has beyond that is taken off in exact arithmetic. Only the square matrix of the
dimensions comes to the driver. It is factored there, P'VP = LL', and the columns of L are turned until they are at right angles:
their lengths are the roots of the eigenvalues and their directions the components. Small eigenvalues keep their digits, since
the covariance of the factor is never formed again. Rows are projected in tasks, with the components broadcast.

Defined results: vectors that are null or hold null or non-finite entries are dropped, as are empty ones and those whose length
is not the commonest (the longer of two equally common). Entries beyond 2^40 in size after rounding are held at 2^40. Repeated vectors are
fitted once and all returned; a null id is returned as null; other columns, whatever their names, are left out. Components
beyond the rank (one distinct vector, an empty table) are not returned, so such tables give no rows. A deviation too large for
a long is null. Components of equal eigenvalues are any basis of their space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.shared import kept, table

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 40
COMPONENTS = 16
LONG = np.iinfo(np.int64).max


def round_entries(vector: Column) -> Column:
    """The vector in whole numbers."""
    held = lambda c: F.least(F.greatest(F.floor(c.cast("double") * SCALE), F.lit(-LARGEST)), F.lit(LARGEST))
    return F.transform(vector, lambda c: held(c).cast("long") + OFFSET)


def sound(vector: Column) -> Column:
    """True for vectors without null and non-finite entries."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def whole_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x) of the rows that remain."""
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    rows = rows.where(sound(F.col("vector")) & (F.size("vector") > 0))
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is not None:
        rows = rows.where(F.size("vector") == lengths["d"])
    return rows.select("vec_id", round_entries(F.col("vector")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column whose arrays all have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a'b in whole numbers: in floats where none can be rounded, in longs where they fit, else in Python's integers."""
    largest = float(max(abs(int(a.max())), abs(int(a.min())))) * float(max(abs(int(b.max())), abs(int(b.min())))) * len(a)
    if largest < 2**53:
        return (a.T.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if largest < 2**63:
        return a.T @ b
    return a.astype(object).T.dot(b.astype(object))


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and the sum of each dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                part = _exact(np.ones((len(x), 1), np.int64), x)[0].astype(object)
                n, total = n + len(x), part if total is None else total + part
        if n:
            values = [Decimal(int(n)), *[Decimal(int(v)) for v in total]]
            yield pa.record_batch({"i": pa.array(range(len(values)), pa.int32()), "v": pa.array(values, pa.decimal128(38, 0))})

    parts = fit.mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    values = [int(r["v"]) for r in parts]
    return (values[0], values[1:]) if values else (0, [])


def _scatter(fit: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """n^2 times the covariance, exactly: n * sum of (x - m)(x - m)' - rr', with m the whole part of the mean and r the rest."""
    d = len(sums)
    m = np.array([s // n for s in sums], np.int64)
    r = [s - n * int(c) for s, c in zip(sums, m)]
    i, j = np.triu_indices(d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x")) - m
                part = _exact(x, x)[i, j].astype(object)
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({
                "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                "v": pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0)),
            })

    found = [[0] * d for _ in range(d)]
    # One row per pair of dimensions, whatever the number of vectors.
    pairs = fit.mapInArrow(add, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    for a, b, v in zip(*[c.to_pylist() for c in pairs.columns]):
        found[a][b] = found[b][a] = n * int(v) - r[a] * r[b]
    return found


def _extended(values: list[list[int]], divisor: int) -> np.ndarray:
    """Quotients of whole numbers in the longest floats there are."""
    def one(v: int) -> np.longdouble:
        whole, rest = divmod(v, divisor)
        high = float(whole)
        return np.longdouble(high) + np.longdouble(float(whole - int(high))) + np.longdouble(rest / divisor)

    return np.array([[one(v) for v in row] for row in values], np.longdouble)


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with v[order][:, order] = LL', largest pivot first; L has as many columns as v has rank."""
    a, d = v.copy(), len(v)
    order = np.arange(d)
    lower = np.zeros((d, d), a.dtype)
    least = 4 * d * np.finfo(a.dtype).eps * max(float(a.diagonal().max(initial=0)), 0.0)
    rank = 0
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= least:
            break
        if p != k:
            a[[k, p]] = a[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
            lower[[k, p]] = lower[[p, k]]
            order[[k, p]] = order[[p, k]]
        lower[k, k] = np.sqrt(a[k, k])
        lower[k + 1 :, k] = a[k + 1 :, k] / lower[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(lower[k + 1 :, k], lower[k + 1 :, k])
        rank = k + 1
    return lower[:, :rank], order


def one_sided_jacobi(columns: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns turned in pairs until all are at right angles; disjoint pairs are turned together."""
    g = columns.copy()
    k = g.shape[1]
    if k < 2:
        return g
    near = 4 * np.finfo(g.dtype).eps
    ring = list(range(k + k % 2))
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[:half], ring[: half - 1 : -1]) if max(p, q) < k]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = np.array(pairs).T
            a, b = g[:, p], g[:, q]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            on = np.abs(gamma) > near * np.sqrt(alpha * beta)
            if not on.any():
                continue
            turned = True
            p, q, a, b, alpha, beta, gamma = p[on], q[on], a[:, on], b[:, on], alpha[on], beta[on], gamma[on]
            zeta = (beta - alpha) / (2 * gamma)
            t = np.where(zeta >= 0, 1, -1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    return g


@dataclass
class Whitening:
    """A fitted transform: ``vectors`` holds one component per row, largest eigenvalue first."""

    n: int
    whole: np.ndarray  # whole part of the mean
    rest: list[int]  # n times what the mean has beyond it
    eigenvalues: np.ndarray
    trace: float
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exactly."""
        y = x - self.whole
        largest = (max(abs(int(y.max())), abs(int(y.min()))) + 1) * self.n
        if largest * largest * x.shape[1] <= LONG:
            z = y * self.n - np.array(self.rest, np.int64)
            return (z * z).sum(1).tolist()
        z = y.astype(object) * self.n - np.array(self.rest, object)
        return [int(v) if v <= LONG else None for v in (z * z).sum(1)]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit to distinct whole vectors ``x``; None if there are none or all have the same place."""
    n, sums = _sums(fit)
    if n < 2:
        return None
    covariance = _extended(_scatter(fit, n, sums), n * n)
    lower, order = pivoted_cholesky(covariance)
    turned = one_sided_jacobi(lower)
    lengths = np.sqrt((turned * turned).sum(0))
    first = np.argsort(-lengths, kind="stable")[:components]
    vectors = np.zeros((len(first), len(covariance)))
    vectors[:, order] = (turned[:, first] / lengths[first]).T.astype(np.float64)
    whole = np.array([s // n for s in sums], np.int64)
    return Whitening(
        n, whole, [s - n * int(c) for s, c in zip(sums, whole)], (lengths[first] ** 2).astype(np.float64),
        float(covariance.trace()), vectors,
    )


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity, from the rows themselves."""
    k = len(model.eigenvalues)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(_matrix(batch.column("x")))
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        i, j = np.indices(total.shape)
        yield pa.record_batch({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "v": pa.array(total.ravel())})

    total = np.zeros((k + 1, k))
    for p in fit.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[p["i"], p["j"]] = p["v"]
    mean = total[k] / model.n
    return float(np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array) of rows (vec_id, x)."""
    schema = T.StructType([rows.schema["vec_id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                w = model.whitened(x)
                places = pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(model.deviations(x), pa.int64()), pa.ListArray.from_arrays(places, pa.array(w.ravel()))],
                    names=["vec_id", "deviation", "whitened"],
                )

    return rows.mapInArrow(project, schema)


def embedding_whitening(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    x = whole_vectors(rows, vec_id, vector)
    fit = kept(x.select("x").distinct(), "distinct-vectors")
    model = fit_whitening(fit, components)
    if model is None or not len(model.eigenvalues):
        model = Whitening(1, np.zeros(1, np.int64), [0], np.ones(1), 1.0, np.zeros((1, 1)))
        x, error = x.limit(0), 0.0
    else:
        error = identity_error(fit, model)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    out = whiten(x, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening(table(spark, sf_dir, "embeddings"))

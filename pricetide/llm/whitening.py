"""Whitened embeddings, from exact covariances by polarisation.

A covariance is never summed as a product. What Spark sums are squares of centred whole numbers: one total for every
dimension, one for the sum of every two dimensions. ``var(a + b) = var(a) + var(b) + 2 cov(a, b)`` then gives all
covariances. Entries are integers in fixed point and all totals are exact, so the result depends neither on the order of
rows nor on the number of tasks, and nothing is lost where a mean is far greater than the spread.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.words import small_batches
from pricetide.sources.paths import stage

# Fixed values of the task: fixed point, and the number of components.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
# Entries beyond this size, 64 times a number of 13 digits, count as this size.
LIMIT = float(1 << 40)
# A component below this share of the greatest eigenvalue, by dimension, is rounding error.
NOISE = 4 * np.finfo(float).eps


def integer_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is whole and finite, with ``x``, its entries in fixed point (``floor(64 c) + 1000000``)."""
    v = F.col(f"`{vector}`")
    broken = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    fixed = F.transform(
        v,
        lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + SHIFT,
    )
    return df.filter(v.isNotNull() & ~broken).withColumn("x", fixed)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _exact(m: np.ndarray, bound: int) -> np.ndarray:
    """As it is where sums up to ``bound`` fit 64 bits, else as Python integers."""
    return m if bound < 1 << 62 else m.astype(object)


def _totals(vectors: DataFrame, dims: int, size: int, part: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """``size`` exact totals over all vectors; each task sends one number for each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=object)
        for batch in batches:
            total += part(_matrix(batch, dims)).astype(object)
        said = pa.array([str(t) for t in total], type=pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(range(size), type=pa.int32()), said], ["at", "total"])

    summed = (
        vectors.select("x")
        .mapInArrow(add, "at int, total string")
        .groupBy("at")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    found = {r["at"]: int(r["total"]) for r in summed}
    return [found.get(at, 0) for at in range(size)]


def _squares(u: np.ndarray) -> np.ndarray:
    """Sums of squares of every dimension, then of the sum of every two, in order."""
    u = _exact(u, 4 * int(np.abs(u).max(initial=0)) ** 2 * max(1, len(u)))
    parts = [(u * u).sum(axis=0)]
    for i in range(u.shape[1] - 1):
        pair = u[:, i : i + 1] + u[:, i + 1 :]
        parts.append((pair * pair).sum(axis=0))
    return np.concatenate(parts)


@dataclass(frozen=True)
class Whitening:
    n: int
    mean: np.ndarray  # (dims,) whole part of the mean
    rest: np.ndarray  # (dims,) n times what the mean has beyond that
    values: np.ndarray  # (components,) eigenvalues, falling
    vectors: np.ndarray  # (dims, components)
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of integer vectors."""
        centred = (x - self.mean) - self.rest / self.n
        return centred @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Squared distance of ``n`` times each vector from the sum of all, exact."""
        u = x - self.mean
        widest = self.n * (int(np.abs(u).max(initial=0)) + 1)
        u = _exact(u, max(1, u.shape[1]) * widest**2)
        return [int(d) for d in ((u * self.n - self.rest.astype(u.dtype)) ** 2).sum(axis=1)]


def dimension(vectors: DataFrame) -> int:
    """The length that most vectors have, the greater one of a tie; 0 without vectors."""
    lengths = vectors.groupBy(F.size("x").alias("size")).count()
    most = lengths.filter("size > 0").orderBy(F.desc("count"), F.desc("size")).first()
    return most["size"] if most else 0


def fit(vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Learn from the distinct ``x`` of ``dims`` entries, each counted once.

    The driver gets one number per dimension and per pair of dimensions, and as many for the check of the result; none of it
    grows with the rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    distinct = stage(vectors.filter(F.size("x") == dims).select("x").distinct())
    n, *sums = _totals(distinct, dims, dims + 1, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]))
    if not n:
        return Whitening(0, np.zeros(dims, dtype=np.int64), np.zeros(dims), np.zeros(0), np.zeros((dims, 0)), 0.0)
    mean = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s % n for s in sums]
    squares = _totals(distinct, dims, dims * (dims + 1) // 2, lambda x: _squares(x - mean))

    # n**3 times the variances, exact: the sum of (n y - S)**2 over the list, times n
    single = [n * n * q - n * r * r for q, r in zip(squares, rest)]
    v = np.zeros((dims, dims))
    at = dims
    for i in range(dims):
        v[i, i] = single[i] / n**3
        for j in range(i + 1, dims):
            both = n * n * squares[at] - n * (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = (both - single[i] - single[j]) / (2 * n**3)
            at += 1
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > values[0] * dims * NOISE).sum())) if values[0] > 0 else 0
    axes = axes[:, :kept]
    model = Whitening(n, mean, np.array(rest, dtype=float if n >= 1 << 53 else np.int64), values[:kept].copy(), axes, float(np.trace(v)))
    return Whitening(**{**model.__dict__, "identity_error": _identity_error(distinct, dims, model)})


def _identity_error(distinct: DataFrame, dims: int, model: Whitening) -> float:
    """Largest entry, in size, of the covariance of the whitened list minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            w = model.project(_matrix(batch, dims))
            total += w.T @ np.concatenate([w, np.ones((len(w), 1))], axis=1)
        cells = total.reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), type=pa.int32()), pa.array(cells)], ["at", "total"])

    rows = distinct.mapInArrow(add, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    total = np.array([r["total"] for r in sorted(rows)]).reshape(k, k + 1) / model.n
    covariance = total[:, :k] - np.outer(total[:, k], total[:, k])
    return float(round(np.abs(covariance - np.eye(k)).max(), 12))


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: ``key``, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries are left out, and so are those of another length than most
    have (of two lengths equally frequent, the greater counts). Repeated rows come out repeated, equal vectors count
    once in what is learned. Components without any variance do not come out: fewer than 16 dimensions, or few
    distinct vectors, give fewer; a single distinct vector, or an empty table, gives no row. ``deviation`` is
    decimal(38,0). Other columns are ignored.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = integer_vectors(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v")), "v").select("key", "x")
    dims = dimension(rows)
    model = fit(rows, dims, components)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("deviation string, whitened array<double>")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            x = np.stack(column.to_list()).astype(np.int64) if len(column) else np.zeros((0, dims), dtype=np.int64)
            yield pd.DataFrame(
                {
                    "deviation": [str(d) for d in shared.value.deviations(x)],
                    "whitened": list(shared.value.project(x)),
                }
            )

    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.values)).cast("array<double>")
    return (
        rows.filter(F.size("x") == dims)
        .select("key", judged("x").alias("found"))
        .select("key", "found.deviation", F.posexplode("found.whitened").alias("at", "whitened"))
        .select(
            F.col("key").alias(key),
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(model.n).cast("bigint").alias("n"),
            F.col("deviation").cast("decimal(38,0)").alias("deviation"),
            "whitened",
            F.get(explained, F.col("at")).alias("explained"),
            F.lit(model.identity_error).alias("identity_error"),
        )
    )

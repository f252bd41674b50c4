"""Whitening of embeddings by the leading principal components.

Entries become whole numbers first, so counts, sums and deviations are exact. Two passes give
the covariance: sums per dimension, then products of the vectors centred at S/n. Tasks add up
the products of their own vectors and hand over one matrix each, which a shuffle sums per
cell; only the finished matrix, of the size of a vector squared, reaches the driver, where
``eigen`` finds the components. They go back to all tasks as a broadcast of
``components`` x dimension numbers, and a last two passes measure the covariance of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.eigen import leading_eigenpairs
from headway.sources.scratch import new_folder, written

# Entries become floor(STEPS * c) + OFFSET.
STEPS, OFFSET = 64, 1_000_000
# Dimensions up to which the covariance (8 bytes a cell) may come to the driver.
MOST_DIMENSIONS = 4096
# Eigenvalues below this share of the largest are rounding and count as zero.
_NO_SPREAD = 1e-10


class Fit(NamedTuple):
    """What is measured over the vectors: count, exact sums, variance in all, eigenvalues
    (falling) and components (unit vectors as rows)."""

    count: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows that take part; a vector that is null, without entries, or holds a
    null or non-finite entry does not."""
    entries = F.col(vector_col).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(entries, lambda c: F.floor(c * STEPS) + OFFSET)
    return table.where((F.size(entries) > 0) & finite).select(F.col(id_col).alias("id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _exact_sums(x: np.ndarray) -> list[int]:
    """Sums over rows of any 64-bit numbers, by halves that cannot overflow."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [int(h) * 2**32 + int(w) for h, w in zip(high, low)]


def column_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension of a whole-number column ``x``.

    Vectors of different lengths have no common dimensions and raise an error.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            column = batch.column(0)
            for long in set(pa.compute.list_value_length(column).to_pylist()):
                own = column.filter(pa.compute.equal(pa.compute.list_value_length(column), long))
                sums = _exact_sums(_matrix(own))
                totals[long] = [a + b for a, b in zip(totals.get(long, [0] * long), sums)]
                counts[long] = counts.get(long, 0) + len(own)
        rows = [(long, i, counts[long], str(s)) for long, sums in totals.items() for i, s in enumerate(sums)]
        if rows:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(columns, names=["long", "i", "n", "s"])

    parts = vectors.select("x").mapInArrow(add, "long bigint, i bigint, n bigint, s string")
    found = parts.groupBy("long", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sorted(found.limit(MOST_DIMENSIONS + 1).collect())
    if len(rows) > MOST_DIMENSIONS or len({r["long"] for r in rows}) > 1:
        raise ValueError(f"vectors need one length of at most {MOST_DIMENSIONS}")
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def centred(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """x - S/n in double precision: the whole part of the mean is taken away exactly."""
    whole = np.array([s // count for s in sums])
    rest = np.array([(s % count) / count for s in sums])
    return (x - whole) - rest


def _mean_products(vectors: DataFrame, count: int, size: int, centre) -> np.ndarray:
    """The mean over all rows of the outer product of ``centre`` (a function from a batch's
    vectors to centred ones) with itself."""
    upper = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                z = centre(_matrix(batch.column(0)))
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            columns = [pa.array(upper[0]), pa.array(upper[1]), pa.array(total[upper])]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "v"])

    parts = vectors.select("x").mapInArrow(add, "i bigint, j bigint, v double")
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    mean = np.zeros((size, size))
    mean[cells["i"], cells["j"]] = cells["v"] / count
    return mean + np.triu(mean, 1).T


def fit(vectors: DataFrame, components: int = 32) -> Fit:
    """Measures (id, x) rows; components without spread are left out."""
    count, sums = column_sums(vectors)
    if count == 0:
        return Fit(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    covariance = _mean_products(vectors, count, len(sums), lambda x: centred(x, count, sums))
    values, found = leading_eigenpairs(covariance, components)
    spread = values > _NO_SPREAD * max(values.max(initial=0), 0)
    return Fit(count, sums, float(np.trace(covariance)), values[spread], found[spread])


def whitened(x: np.ndarray, model: Fit) -> np.ndarray:
    return centred(x, model.count, model.sums) @ (model.components / np.sqrt(model.values)[:, None]).T


def identity_error(vectors: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the result's covariance minus the identity."""
    size = len(model.values)
    if size == 0:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += whitened(_matrix(batch.column(0)), model).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["i", "s"])

    parts = vectors.select("x").mapInArrow(add, "i bigint, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    mean = np.array([r["s"] for r in sorted(parts)]) / model.count
    covariance = _mean_products(vectors, model.count, size, lambda x: whitened(x, model) - mean)
    return float(np.abs(covariance - np.eye(size)).max())


def _deviations(x: np.ndarray, count: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - S) squared, exactly."""
    near = np.array([s // count for s in sums])
    rest = np.array([s % count for s in sums])
    apart = x - near  # n * x - S = n * apart - rest
    if (int(np.abs(apart).max(initial=0)) + 1) ** 2 * count**2 * x.shape[1] < 2**63:
        y = apart * count - rest
        return (y * y).sum(axis=1).tolist()
    y = apart.astype(object) * count - rest.astype(object)
    return (y * y).sum(axis=1).tolist()


def project(vectors: DataFrame, model: Fit) -> DataFrame:
    """(id, deviation, whitened): one number per component of the fit."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            w = whitened(x, model)
            offsets = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            apart = pa.array([str(d) for d in _deviations(x, model.count, model.sums)])
            columns = [batch.column(0), apart, pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "deviation", "whitened"])

    kind = vectors.schema["id"].dataType.simpleString()
    found = vectors.select("id", "x").mapInArrow(apply, f"id {kind}, deviation string, whitened array<double>")
    return found.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32
) -> tuple[DataFrame, Fit, float]:
    """(id, deviation, whitened) of every row that takes part, the fit, and the largest error
    of the result's covariance.

    Rows whose vector is null, has no entries, or holds a null or non-finite entry take no part.
    A null identifier, repeated rows and equal vectors are rows like any other. An empty
    table, a single vector, or equal vectors have no spread and so no components: their rows
    have an empty ``whitened``. Vectors of several lengths raise an error. Other columns are
    not read.
    """
    vectors = written(whole_vectors(table, id_col, vector_col), new_folder(table.sparkSession, "vectors"))
    model = fit(vectors, components)
    error = identity_error(vectors, model)
    return project(vectors, model), model, error


def by_component(found: DataFrame, model: Fit, error: float) -> DataFrame:
    """One row per vector and component: id, component (from 1), n, deviation, whitened,
    explained, identity_error."""
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values)).cast("array<double>")
    return found.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.count).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

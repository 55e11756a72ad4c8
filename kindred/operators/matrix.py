"""Tall matrices as tables of rows: QR factors, singular vectors, covariance, sampled column similarities.

A matrix has many rows, dealt to many tasks, and few columns. What a task makes of its rows is as small as columns times
columns; these small matrices are merged in a tree, so neither a task nor the driver sees one from every partition.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kindred.session import materialise

#: Small matrices that one task merges.
FAN_IN = 16
_PART = "part long, cells array<double>"


def _batch_rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("row").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _tree(vectors: DataFrame, column: str, dim: int, start: Callable[[np.ndarray], np.ndarray], merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One small array for all rows: ``start`` of every batch, ``merge`` of those of a task, then of ``FAN_IN`` tasks at a time. None without rows."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            if batch.num_rows:
                part = start(_batch_rows(batch, dim))
                found = part if found is None else merge([found, part])
                number = batch.column("part")[0].as_py()
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([found.ravel()], pa.list_(pa.float64()))], names=["part", "cells"])

    def merged(table: pa.Table) -> pa.Table:
        parts = [np.array(c).reshape(-1, dim) for c in table.column("cells").to_pylist()]
        number = table.column("part")[0].as_py() // FAN_IN
        return pa.Table.from_arrays([pa.array([number], pa.int64()), pa.array([merge(parts).ravel()], pa.list_(pa.float64()))], names=["part", "cells"])

    rows = vectors.select(F.spark_partition_id().cast("long").alias("part"), F.col(column).cast("array<double>").alias("row")).where(F.size("row") == dim)
    parts = materialise(rows.mapInArrow(local, _PART))
    while True:
        last = parts.agg(F.max("part")).first()[0]
        if last is None:
            return None
        parts = materialise(parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(merged, _PART))
        if last < FAN_IN:
            return np.array(parts.first()["cells"]).reshape(-1, dim)


def r_factor(vectors: DataFrame, column: str, dim: int) -> np.ndarray:
    """R of the QR factors, columns times columns, with a diagonal of zero or more; zeros without rows."""
    factor = lambda rows: np.linalg.qr(rows, mode="r")
    found = _tree(vectors, column, dim, factor, lambda parts: factor(np.vstack(parts)))
    full = np.zeros((dim, dim))
    if found is not None:
        full[: len(found)] = found
    return full * np.where(np.diag(full) < 0, -1.0, 1.0)[:, None]


def times(vectors: DataFrame, key: str, column: str, matrix: np.ndarray, name: str) -> DataFrame:
    """``(key, name)``: every row times a small matrix."""
    dim = len(matrix)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _batch_rows(batch, dim) @ matrix
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(made), pa.list_(pa.float64()))], names=[key, name])

    rows = vectors.select(key, F.col(column).cast("array<double>").alias("row")).where(F.size("row") == dim)
    return rows.mapInArrow(each, f"`{key}` {dict(vectors.dtypes)[key]}, `{name}` array<double>")


def tall_qr(vectors: DataFrame, key: str, column: str, dim: int) -> tuple[DataFrame, np.ndarray]:
    """``(key, q)`` of the rows of Q, and R. Columns that depend on each other are an error, as Q is not defined by them."""
    r = r_factor(vectors, column, dim)
    diagonal = np.abs(np.diag(r))
    if diagonal.min() <= dim * np.finfo(float).eps * diagonal.max():
        raise ValueError("the columns depend on each other, or there are fewer rows than columns")
    return times(vectors, key, column, np.linalg.inv(r), "q"), r


def svd(vectors: DataFrame, key: str, column: str, dim: int, k: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``(key, u)`` of the rows of the left singular vectors, the ``k`` largest singular values, and the right vectors as columns.

    The values are those of R, so none are lost by squaring. Values that are zero but for rounding are left out.
    """
    _, values, right = np.linalg.svd(r_factor(vectors, column, dim))
    kept = min(k, int((values > dim * np.finfo(float).eps * max(values[0], np.finfo(float).tiny)).sum()))
    v = right[:kept].T
    return times(vectors, key, column, v / values[:kept], "u"), values[:kept], v


def covariance(vectors: DataFrame, column: str, dim: int) -> np.ndarray:
    """Sample covariance of the columns; rows are centred by the mean of their task first, so large means lose no digits. NaN for fewer than two rows."""

    def start(rows: np.ndarray) -> np.ndarray:
        mean = rows.mean(axis=0)
        return np.vstack([np.full(dim, len(rows)), mean, (rows - mean).T @ (rows - mean)])

    def merge(parts: list[np.ndarray]) -> np.ndarray:
        count, mean, products = parts[0][0, 0], parts[0][1], parts[0][2:]
        for other in parts[1:]:
            n, step = other[0, 0], other[1] - mean
            products = products + other[2:] + np.outer(step, step) * count * n / (count + n)
            mean, count = mean + step * n / (count + n), count + n
        return np.vstack([np.full(dim, count), mean, products])

    found = _tree(vectors, column, dim, start, merge)
    return np.full((dim, dim), np.nan) if found is None or found[0, 0] < 2 else found[2:] / (found[0, 0] - 1)


def _uniform(seeds: np.ndarray, dim: int) -> np.ndarray:
    """A number from 0 to 1 for every row and column, made of the row's seed alone."""
    x = seeds.view(np.uint64)[:, None] + np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) / 2.0**64


def sampled_column_cosines(vectors: DataFrame, key: str, column: str, dim: int, threshold: float, seed: int = 0) -> DataFrame:
    """``(i, j, cosine, products)`` for i < j: unbiased estimates, good for cosines above ``threshold``, and how many products they took.

    Entries should be of size one at most; the error grows with their size.
    An entry takes part with a probability of about 1 over the norm of its column, so long columns cost no more products than
    short ones. What a row keeps depends on its key only, so a task that runs again keeps the same entries. Only sums of
    columns times columns are shuffled.
    """
    rows = vectors.select(F.xxhash64(F.col(key), F.lit(seed)).alias("seed"), F.col(column).cast("array<double>").alias("row")).where(F.size("row") == dim)
    squares = rows.agg(*[F.sum(F.get("row", F.lit(j)) * F.get("row", F.lit(j))).alias(f"c{j}") for j in range(dim)]).first()
    norms = np.sqrt(np.array([x or 0.0 for x in squares]))
    limit = math.sqrt(10 * math.log(max(dim, 2)) / threshold)
    keep = np.minimum(1.0, limit / np.maximum(norms, np.finfo(float).tiny))
    scale = np.where(norms > 0, 1 / np.maximum(np.minimum(limit, norms), np.finfo(float).tiny), 0.0)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros((dim, dim)), np.zeros((dim, dim))
        for batch in batches:
            x = _batch_rows(batch, dim)
            kept = (_uniform(batch.column("seed").to_numpy(), dim) < keep) & (x != 0)
            x = np.where(kept, x, 0.0) * scale
            total += x.T @ x
            products += kept.T.astype(np.float64) @ kept
        i, j = np.triu_indices(dim, 1)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j]), pa.array(products[i, j].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "cosine", "products"])

    sums = rows.mapInArrow(each, "i int, j int, cosine double, products long").groupBy("i", "j")
    return sums.agg(F.sum("cosine").alias("cosine"), F.sum("products").alias("products"))

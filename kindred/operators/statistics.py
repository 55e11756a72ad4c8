"""Statistics that need ranks or products over whole tables, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kindred.session import materialise


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``stretch``, the number of the sorted range a row lies in. Written, as the bounds come from a sample."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.repartitionByRange(parts, *order).withColumn("stretch", F.spark_partition_id()))


def _carried(totals: DataFrame, *sums: str) -> DataFrame:
    """``(stretch, c_<sum>...)``: sums over all earlier ranges. There are as many ranges as shuffle partitions, one array holds them."""
    types = dict(totals.dtypes)
    listed = totals.agg(F.collect_list(F.struct("stretch", *sums)).alias("found"))

    def earlier(own: Column, s: str) -> Column:
        before = F.filter("found", lambda t: t["stretch"] < own["stretch"])
        return F.aggregate(before, F.lit(0).cast(types[s]), lambda a, t: (a + F.coalesce(t[s], F.lit(0))).cast(types[s])).alias(f"c_{s}")

    return listed.select(F.inline(F.transform("found", lambda own: F.struct(own["stretch"].alias("stretch"), *[earlier(own, s) for s in sums]))))


def cumulative(df: DataFrame, value: str, *sums: str) -> DataFrame:
    """``(value, sums, before_<sum>...)``: totals per distinct value and over all smaller values.

    Distinct values are sorted into ranges of about equal size; windows run inside the ranges.
    """
    per = _ranged(df.groupBy(value).agg(*[F.sum(s).alias(s) for s in sums]), value)
    carried = _carried(per.groupBy("stretch").agg(*[F.sum(s).alias(s) for s in sums]), *sums)
    inside = Window.partitionBy("stretch").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return per.join(carried, "stretch").select(
        value, *sums, *[(F.coalesce(F.sum(s).over(inside), F.lit(0)) + F.col(f"c_{s}")).alias(f"before_{s}") for s in sums]
    )


def positions(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``position``: the place of every row in the order of ``order`` over the whole table, from 0."""
    rows = _ranged(df, *order)
    carried = _carried(rows.groupBy("stretch").agg(F.count("*").alias("n")), "n")
    inside = Window.partitionBy("stretch").orderBy(*order)
    return rows.join(carried, "stretch").select(*df.columns, (F.row_number().over(inside) - 1 + F.col("c_n")).alias("position"))


def ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """``(value, name)``: mean rank of every distinct value."""
    counted = cumulative(df.withColumn("n", F.lit(1)), value, "n")
    return counted.select(value, (F.col("before_n") + (F.col("n") + 1) / 2).alias(name))


def gram(vectors: DataFrame, column: str, dim: int) -> DataFrame:
    """``(i, row)``: Gram matrix of a tall table of vectors, one row per dimension.

    Every task multiplies its batches; the sums of these small matrices are shuffled, not the vectors.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            total += x.T.astype(np.float64) @ x
        rows = pa.array(list(total), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), rows], ["i", "row"])

    partial = vectors.select(F.col(column).cast("array<double>")).mapInArrow(multiply, "i int, row array<double>")
    sums = [F.sum(F.get("row", F.lit(j))) for j in range(dim)]
    return partial.groupBy("i").agg(F.array(*sums).alias("row"))


def column_cosines(gram_rows: DataFrame) -> DataFrame:
    """``(i, j, cosine)`` for i < j from a Gram matrix, which has a fixed small size."""
    cells = gram_rows.select("i", F.posexplode("row").alias("j", "g"))
    norms = cells.where("i = j").select("i", F.sqrt("g").alias("norm"))
    return (
        cells.where("i < j").join(norms, "i")
        .join(norms.select(F.col("i").alias("j"), F.col("norm").alias("norm_j")), "j")
        .select("i", "j", (F.col("g") / (F.col("norm") * F.col("norm_j"))).alias("cosine"))
    )


def singular_values(gram_rows: DataFrame, k: int) -> list[float]:
    """Largest singular values; the Gram matrix is small enough for the driver."""
    matrix = np.array([r.row for r in gram_rows.orderBy("i").collect()])
    return [float(v) for v in np.sqrt(np.clip(np.linalg.eigvalsh(matrix)[::-1][:k], 0, None))]

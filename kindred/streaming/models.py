"""Models trained on a stream: a small model in a written table per batch, distributed batch statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kindred.session import materialise, work_dir
from kindred.streaming.runs import run_batches


_STATE = "name string, shape array<int>, cells array<double>"


def _number_array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)


def nearest(vector: Column, centres: np.ndarray) -> Column:
    """Index of the nearest of ``k`` centres."""
    gaps = F.array(*[
        F.struct((float(c @ c) - 2 * _dot(vector, _number_array(c))).alias("gap"), F.lit(i).alias("i"))
        for i, c in enumerate(centres)
    ])
    return F.array_min(gaps)["i"]


class BatchState:
    """Arrays kept between batches: one small written table per batch, so that a restarted run goes on from its last batch.

    A batch that is run again after a failure starts from the state before it and replaces its own.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder.rstrip("/")

    def read(self, batch: int) -> dict[str, np.ndarray]:
        """The state after ``batch``; empty before the first one."""
        if batch < 0:
            return {}
        rows = self._spark.read.schema(_STATE).parquet(f"{self._folder}/batch={batch}").collect()
        return {r.name: np.array(r.cells).reshape(r.shape) for r in rows}

    def write(self, batch: int, state: dict[str, np.ndarray]) -> None:
        rows = [(name, list(values.shape), [float(v) for v in values.ravel()]) for name, values in state.items()]
        self._spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{self._folder}/batch={batch}")

    def last(self) -> dict[str, np.ndarray]:
        newest = self._spark.read.schema(_STATE + ", batch int").parquet(self._folder).agg(F.max("batch")).first()[0]
        return {} if newest is None else self.read(newest)


def stream_kmeans(vectors: DataFrame, k: int, decay: float = 0.8, seed: int = 5, state: str | None = None, checkpoint: str | None = None) -> np.ndarray:
    """Centres after all batches. A batch updates each centre with the mean of its points; older
    weight decays. Only sums per centre, ``k`` rows, come to the driver. ``state`` and ``checkpoint`` are
    the folders from which a later run goes on."""
    spark = vectors.sparkSession
    kept = BatchState(spark, state or work_dir(spark))

    def update(batch: DataFrame, number: int) -> None:
        known = kept.read(number - 1)
        points = materialise(batch.select("vec"))
        dim = points.select(F.max(F.size("vec"))).first()[0]
        if dim is not None:
            centres = known.get("centres", np.random.default_rng(seed).normal(0, 0.1, (k, dim)))
            weight = known.get("weight", np.zeros(k)) * decay
            means = [F.avg(F.get("vec", F.lit(i)).cast("double")) for i in range(dim)]
            rows = points.groupBy(nearest(F.col("vec"), centres).alias("c")).agg(F.count("*").alias("n"), F.array(*means).alias("mean")).collect()
            for row in rows:
                old = weight[row.c]
                centres[row.c] = (centres[row.c] * old + np.array(row.mean) * row.n) / (old + row.n)
                weight[row.c] = old + row.n
            known = {"centres": centres, "weight": weight}
        kept.write(number, known)

    run_batches(vectors, "append", update, checkpoint)
    return kept.last()["centres"]


def stream_logistic(vectors: DataFrame, steps: int = 5, rate: float = 1.0, state: str | None = None, checkpoint: str | None = None) -> np.ndarray:
    """Weights of a logistic regression on ``(vec, label)``; some gradient steps per batch."""
    spark = vectors.sparkSession
    kept = BatchState(spark, state or work_dir(spark))

    def update(batch: DataFrame, number: int) -> None:
        known = kept.read(number - 1)
        points = materialise(batch.select("vec", F.col("label").cast("double").alias("label")))
        dim = points.select(F.max(F.size("vec"))).first()[0]
        if dim is not None:
            weights = known.get("weights", np.zeros(dim))
            for _step in range(steps):
                gap = F.col("label") - logistic(F.col("vec"), weights)
                gradient = points.withColumn("gap", gap).agg(*[F.avg(F.col("gap") * F.get("vec", F.lit(i))) for i in range(dim)]).first()
                weights = weights + rate * np.array(gradient)
            known = {"weights": weights}
        kept.write(number, known)

    run_batches(vectors, "append", update, checkpoint)
    return kept.last()["weights"]


def logistic(vector: Column, weights: np.ndarray) -> Column:
    return 1 / (1 + F.exp(-_dot(vector, _number_array(weights))))

"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. Every shard of the vectors holds an inverted file: for each
pivot, the vectors that list it, by rank. A query reads the files of its own pivots, which gives the
footrule distance of its order to those of all vectors, and compares the vectors with the smallest ones exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import ceil_div
from kindred.session import materialise

#: Pivots, how many of them a vector lists, share of a shard that is compared exactly and its least number.
PIVOTS, LISTED, RERANK, LEAST = 256, 64, 0.1, 500
#: Vectors in a shard and queries in a block, in expectation.
SHARD, BLOCK = 8192, 2048


def clean(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part: no null id, vector or component, all finite, not all zero."""
    rows = vectors.select(vectors[key].cast("long").alias("vec_id"), vectors[vector].cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def _unit(part: pa.Array | pd.Series) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so that no square leaves the range of doubles."""
    rows = np.array(part.to_pylist() if isinstance(part, pa.Array) else part.tolist(), np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def orders(unit: np.ndarray, pivots: np.ndarray, listed: int) -> np.ndarray:
    """Numbers of the ``listed`` nearest pivots of every row, nearest first, ties to the lower number."""
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :listed].astype(np.int16)


def nearest(unit: np.ndarray, order: np.ndarray, queries: np.ndarray, asked: np.ndarray, pivots: int, count: int) -> list[np.ndarray]:
    """For every query the ``count`` rows whose orders have the smallest footrule distance (all of them if fewer)."""
    listed = order.shape[1]
    # the inverted files: rows by pivot, each with its rank there
    flat = np.argsort(order, axis=None, kind="stable")
    ends = np.cumsum(np.bincount(order.ravel(), minlength=pivots))
    rows, ranks = flat // listed, (flat % listed).astype(np.int32)
    found = []
    for query in asked:
        # the footrule distance is a constant less twice these sums
        near = np.zeros(len(unit), np.int32)
        for rank, pivot in enumerate(query.tolist()):
            part = slice(ends[pivot - 1] if pivot else 0, ends[pivot])
            near[rows[part]] += listed - np.maximum(ranks[part], rank)
        found.append(np.argpartition(-near, count - 1)[:count] if count < len(unit) else np.arange(len(unit)))
    return found


def search(vectors: DataFrame, is_query, neighbours: int = 5, pivots: int = PIVOTS, listed: int = LISTED, rerank: float = RERANK, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest rows by cosine of each row of ``vectors`` where the column ``is_query`` holds.

    ``vectors`` has ``vec_id`` and ``embedding``. Rows that cannot take part are left out (see ``clean``). Equal vectors are
    one vector of the index with its ``neighbours + 1`` smallest ids, which is all that a query can return of
    them. Vectors of another length than the most common one take no part. Repeated rows count once; an id with several
    vectors is one candidate with its best score, and never its own neighbour. Pivots are a bounded sample,
    the vectors of the smallest hashes; every vector is indexed.

    Queries are dealt to blocks and vectors to shards by hash. Each pair of block and shard is one task of bounded size, which
    compares at least the share ``rerank`` of the shard.
    """
    rows = clean(vectors)
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("embedding") == (length["n"] if length else 0)).distinct()
    place = Window.partitionBy("embedding").orderBy("vec_id")
    kept = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= neighbours + 1)
    grouped = kept.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # a number of its own for each vector, written: an id may have several vectors
    single = materialise(grouped.withColumn("first", F.monotonically_increasing_id()))
    asked = materialise(rows.where(is_query).join(single.select("embedding", "first"), "embedding"))
    total, queries = single.count(), asked.select("first").distinct().count()
    if not queries:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chosen = np.array([r[0] for r in single.orderBy(F.xxhash64("embedding"), F.element_at("ids", 1)).limit(pivots).select("embedding").collect()])
    chosen = _unit(pd.Series(list(chosen)))
    listed = min(listed, len(chosen))
    shards, blocks = ceil_div(total, shard), ceil_div(queries, block)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = orders(_unit(batch.column("embedding")), chosen, listed) if batch.num_rows else np.zeros((0, listed), np.int16)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([o.tobytes() for o in order], pa.binary())], names=[*batch.schema.names, "pivots"])

    spread = lambda df, own, n, other, m: df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    schema = "id long, embedding array<double>, ids array<long>, pivots binary"
    posted = single.select(F.col("first").alias("id"), "embedding", "ids").mapInArrow(index, schema)
    wanted = asked.groupBy("first").agg(F.first("embedding").alias("embedding")).select(F.col("first").alias("id"), "embedding", F.array().cast("array<long>").alias("ids")).mapInArrow(index, schema)
    left = spread(posted, "shard", shards, "block", blocks)
    right = spread(wanted.drop("ids"), "block", blocks, "shard", shards)

    def compare(key: tuple, held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"first": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(held) or not len(asking):
            return empty
        held = held.sort_values("id").reset_index(drop=True)
        unit, query = _unit(held["embedding"]), _unit(asking["embedding"])
        order, want = (np.frombuffer(b"".join(p["pivots"]), np.int16).reshape(len(p), listed) for p in (held, asking))
        count = min(len(held), max(LEAST, int(np.ceil(rerank * len(held)))))
        out = []
        for i, near in enumerate(nearest(unit, order, query, want, len(chosen), count)):
            # sums in the order of the components, so that equal vectors score alike in every task
            scores = (unit[near] * query[i]).cumsum(axis=1)[:, -1]
            cut = np.partition(scores, -neighbours - 1)[-neighbours - 1] if len(scores) > neighbours + 1 else -np.inf
            for j in np.flatnonzero(scores >= cut).tolist():
                out += [(int(asking["id"].iloc[i]), int(v), float(scores[j])) for v in held["ids"].iloc[near[j]]]
        return pd.DataFrame(out, columns=["first", "vec_id", "score"]) if out else empty

    near = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(compare, "first long, vec_id long, score double")
    # one more than asked for, as the query's own id is among them
    top = Window.partitionBy("first").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("place", F.row_number().over(top)).where(F.col("place") <= neighbours + 1).drop("place")
    joined = asked.select("first", F.col("vec_id").alias("query_id")).join(best, "first").where("query_id != vec_id")
    joined = joined.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return joined.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= neighbours)

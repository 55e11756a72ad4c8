"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import permutation_index


def force(ids, vectors, queries, count):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries:
        scores = unit @ unit[ids.index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(scores[i], 12), ids[i]))
        out[q] = [ids[i] for i in order[:count]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append(r["vec_id"])
    return out


def test_everything_compared_is_exact(spark):
    random = np.random.default_rng(0)
    vectors = random.normal(size=(300, 8)).astype(np.float32).astype(float)
    vectors[100:140] = vectors[3]  # a frequent vector
    vectors[150] = vectors[4] * 2
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, id int")
    got = answers(permutation_index.search(df, F.col("vec_id") % 20 == 0, rerank=1.0, shard=64, block=4))
    assert got == force(list(range(300)), vectors, range(0, 300, 20), 5)


def shards_of_noise(spark):
    """More vectors than a shard holds, without clusters."""
    vectors = np.random.default_rng(9).normal(size=(20_000, 16)).astype(np.float32)
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(8)


@pytest.mark.parametrize("source", ["embeddings", "noise"])
def test_recall(spark, source):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet") if source == "embeddings" else shards_of_noise(spark)
    rows = sorted((r["vec_id"], r["embedding"]) for r in df.collect())
    ids, vectors = [i for i, _ in rows], np.array([v for _, v in rows], float)
    queries = [i for i in ids if i % 50 == 0][:60]
    want = force(ids, vectors, queries, 5)
    got = answers(permutation_index.search(df, (F.col("vec_id") % 50 == 0) & (F.col("vec_id") <= queries[-1])))
    assert sum(len(set(want[q]) & set(got[q])) for q in queries) / (5 * len(queries)) >= 0.9


def test_an_id_with_two_vectors_asks_with_both(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), *[(i, [1.0, i / 10]) for i in range(1, 5)], *[(i, [i / 100, 1.0]) for i in range(11, 14)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = permutation_index.search(df, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    want = {}
    for i, v in rows[2:]:
        want[i] = max(np.dot(v, q) / np.linalg.norm(v) for q in ([1.0, 0.0], [0.0, 1.0]))
    assert [r["vec_id"] for r in got] == sorted(want, key=lambda i: (-want[i], i))[:5]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [2.0, 0.0]), (7, [1.0]), (8, []), (9, [-1.0, 1e-9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = permutation_index.search(df, F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 6, 1.0), (0, 2, 9, -1.0)]
    assert permutation_index.search(df.where("false"), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("count", [1, 5])
def test_footrule_order(count):
    random = np.random.default_rng(2)
    unit = random.normal(size=(50, 6))
    order = permutation_index.orders(unit, random.normal(size=(12, 6)), 5)
    rank = np.full((50, 12), 5)
    np.put_along_axis(rank, order.astype(int), np.arange(5)[None, :].repeat(50, 0), axis=1)
    for i, near in enumerate(permutation_index.nearest(unit, order, unit, order, 12, count)):
        footrule = np.abs(rank - rank[i]).sum(axis=1)
        assert sorted(footrule[near]) == sorted(footrule)[:count]

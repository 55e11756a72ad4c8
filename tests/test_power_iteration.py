from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import functions as F

from kindred.contract import ml_queries
from kindred.operators import graph

LINKS = [(a, b, 1.0 + (a * b) % 4) for g in (0, 100, 300) for a in range(g, g + 12) for b in range(g, g + 12) if a < b] + [(3, 105, 0.02), (110, 301, 0.01), (5, 5, 9.0), (0, 1, 2.0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "src long, dst long, weight double")


def by_hand(links, x, iterations):
    ids = sorted({v for a, b, _ in links if a != b for v in (a, b)})
    at = {v: i for i, v in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for a, b, s in links:
        if a != b:
            w[at[a], at[b]] += s
            w[at[b], at[a]] += s
    w /= w.sum(axis=1, keepdims=True)
    v = np.array([x[i] for i in ids])
    v /= np.abs(v).sum()
    for _ in range(iterations):
        v = w @ v
        v /= np.abs(v).sum()
    return dict(zip(ids, v.tolist(), strict=True))


@pytest.mark.parametrize("hub", [graph.HUB, 4])
def test_vector_by_hand(spark, hub):
    x = {v: ((v * 37) % 11) - 4.5 for a, b, _ in LINKS for v in (a, b)}
    start = spark.createDataFrame(list(x.items()), "id long, x double")
    got = {r.id: r.x for r in graph.power_iteration(frame(spark, LINKS), 4, start, hub).collect()}
    assert got == pytest.approx(by_hand(LINKS, x, 4), abs=1e-12)


def test_start_is_normal_and_goes_with_the_id(spark):
    numbers = spark.range(20_000).select("id", graph.gaussian(F.col("id")).alias("x"))
    mean, spread, tail = numbers.agg(F.avg("x"), F.stddev("x"), F.avg((F.abs("x") > 1.96).cast("int"))).first()
    assert abs(mean) < 0.03 and abs(spread - 1) < 0.03 and abs(tail - 0.05) < 0.01
    assert sorted(numbers.repartition(5).collect()) == sorted(numbers.collect())


def test_clusters_are_those_of_spark_where_they_are_clear(spark):
    rows = [r for r in LINKS if r[:2] not in {(3, 105), (110, 301)}]
    groups = lambda found: {frozenset(v for v, c in found if c == k) for k in {c for _, c in found}}
    mine = groups([tuple(r) for r in graph.power_iteration_clusters(frame(spark, rows), 3, 30).collect()])
    theirs = groups([(r.id, r.cluster) for r in PowerIterationClustering(k=3, maxIter=30, weightCol="weight").assignClusters(frame(spark, rows)).collect()])
    assert mine == theirs == {frozenset(range(g, g + 12)) for g in (0, 100, 300)}


@pytest.mark.parametrize("row", [(1, 2, -1.0), (1, 2, float("nan")), (None, 2, 1.0), (1, None, 1.0)])
def test_wrong_links_raise(spark, row):
    with pytest.raises(ValueError, match="links need"):
        graph.power_iteration(frame(spark, [(1, 2, 1.0), row]), 2)


def test_query_keeps_no_large_graph_in_the_executors(spark, tmp_path, monkeypatch):
    """the graph of every round was kept in the executors, whatever its size."""
    rng = np.random.default_rng(4)
    rows = [(int(p), int(s), float(q)) for p, s, q in zip(rng.integers(0, 60, 900), rng.integers(0, 12, 900), rng.integers(1, 50, 900), strict=True)]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(ml_queries, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(ml_queries.K, "PowerIterationClustering", None)
    found = ml_queries.ml_power_iteration(spark, str(tmp_path)).collect()
    assert sum(r.n for r in found) == len({("p", p) for p, _, _ in rows} | {("s", s) for _, s, _ in rows}) and len(found) <= 3

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import graph, joins, statistics as st


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def random_pairs(n: int, m: int, seed: int = 2):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


def test_pagerank_by_hand(spark):
    got = {r.id: r.rank for r in graph.pagerank(edges(spark, [(1, 2), (1, 3), (2, 1), (3, 1), (4, 1), (4, 1)]), 2).collect()}
    # first round: 1 gets 1 + 1 + 1, 2 and 3 get a half; second round: 4 has no in-links and is gone
    one = 0.15 + 0.85 * 3
    side = 0.15 + 0.85 * 0.5
    assert got == pytest.approx({1: 0.15 + 0.85 * 2 * side, 2: 0.15 + 0.85 * one / 2, 3: 0.15 + 0.85 * one / 2})


def test_pagerank_until_is_a_fixed_point(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (1, 3), (4, 1)]
    rank = {r.id: r.rank for r in graph.pagerank_until(edges(spark, pairs), 1e-6).collect()}
    out = {s: sum(1 for a, _ in pairs if a == s) for s, _ in pairs}
    for v in rank:
        assert rank[v] == pytest.approx(0.15 + 0.85 * sum(rank[a] / out[a] for a, b in pairs if b == v), abs=1e-5)


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)]
    got = {r.id: r.component for r in graph.components(edges(spark, pairs)).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 7 for i in range(200, 260))


def test_closure(spark):
    got = {tuple(r) for r in graph.transitive_closure(edges(spark, [(1, 2), (2, 3), (3, 2), (5, 5)])).collect()}
    assert got == {(1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3), (5, 5)}


def test_triangles_by_brute_force(spark):
    pairs = random_pairs(25, 120) + [(0, i) for i in range(1, 25)]
    links = {frozenset(p) for p in pairs if p[0] != p[1]}
    want: dict[int, int] = {}
    for a in range(25):
        for b in range(a):
            for c in range(b):
                if {frozenset((a, b)), frozenset((b, c)), frozenset((a, c))} <= links:
                    for v in (a, b, c):
                        want[v] = want.get(v, 0) + 1
    assert {r.id: r.n for r in graph.triangles(edges(spark, pairs)).collect()} == want


def test_shortest_paths(spark):
    links = spark.createDataFrame([(1, 2, 5.0), (1, 3, 1.0), (3, 2, 1.0), (2, 4, 1.0), (9, 1, 1.0)], "src long, dst long, weight double")
    assert {r.id: r.distance for r in graph.shortest_paths(links, 1).collect()} == {1: 0.0, 2: 2.0, 3: 1.0, 4: 3.0}


def test_asof_by_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    events = [(i, 1 if rng.random() < 0.6 else rng.randrange(5), i * 37, rng.random() < 0.3, rng.random()) for i in range(400)]
    df = spark.createDataFrame(events, "id int, k int, t int, src boolean, v double")
    got = {r.id: r.last_value for r in joins.asof_last(df, "k", "t", F.floor(F.col("t") / 500), F.col("src"), "v").collect()}
    for i, k, t, _, _ in events:
        earlier = [e for e in events if e[1] == k and e[2] < t and e[3]]
        assert got[i] == (max(earlier, key=lambda e: e[2])[4] if earlier else None)


def test_salted_forms_equal_the_plain_ones(spark):
    big = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("k"), "id")
    small = spark.range(11).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert joins.salted_join(big, small, "k").exceptAll(big.join(small, "k")).isEmpty()
    plain = big.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("total"))
    assert joins.salted_sum(big, "k", "id").exceptAll(plain).isEmpty()


def test_ranks_and_gram(spark):
    values = [3.0, 1.0, 3.0, 250.0, 7.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.x: r.r for r in st.ranks(df, "x", "r").collect()}
    assert got == {1.0: 1.0, 3.0: 2.5, 7.5: 4.0, 250.0: 5.0}
    placed = st.positions(df.select("x", F.monotonically_increasing_id().alias("id")), "x", "id")
    assert sorted((r.position, r.x) for r in placed.collect()) == list(enumerate(sorted(values)))
    assert "SinglePartition" not in placed.select("x", "position")._jdf.queryExecution().sparkPlan().toString()
    assert st.positions(df.where("x < 0"), "x").isEmpty() and st.cumulative(df.where("x < 0").withColumn("n", F.lit(1)), "x", "n").isEmpty()
    vectors = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "v array<double>").repartition(2)
    assert {r.i: r.row for r in st.gram(vectors, "v", 2).collect()} == {0: [10.0, 14.0], 1: [14.0, 20.0]}


@pytest.fixture(scope="module")
def hubs(spark):
    """Two hubs, one of them a source and one a target, in a random graph."""
    return edges(spark, [(0, i) for i in range(1, 900)] + [(i, 1) for i in range(100, 700)] + random_pairs(300, 500) + [(2000, 2001)])


def test_links_of_a_hub_lie_in_many_places(spark, hubs):
    links, found = graph.placed_links(hubs.distinct(), "src", hub=25)
    assert {r.src for r in found.collect()} >= {0} and links.count() == hubs.distinct().count()
    sizes = sorted(r["count"] for r in links.groupBy("src", "part").count().collect())
    assert sizes[-1] <= 2 * 25
    state = links.select("src").distinct().withColumn("x", F.col("src") * 2)
    met = graph.meet(links, found, state, "src")
    assert met.count() == links.count() and met.where("x <> 2 * src").isEmpty()
    # every task has about as many links as the others
    tasks = [r["count"] for r in links.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) < 2 * sorted(tasks)[len(tasks) // 2]


def test_hubs_change_no_result(spark, hubs):
    def rows(df):
        return {r[0]: pytest.approx(r[1]) for r in df.collect()}

    weighted = hubs.distinct().withColumn("weight", (F.col("dst") % 5 + 1).cast("double"))
    for job in (lambda hub: graph.pagerank(hubs, 6, hub=hub), lambda hub: graph.pagerank_until(hubs, 1e-4, hub=hub), lambda hub: graph.components(hubs, hub=hub), lambda hub: graph.shortest_paths(weighted, 0, hub=hub)):
        assert rows(job(25)) == rows(job(10**6))


def test_links_of_vertices_that_nobody_links_are_summed_once(spark, monkeypatch):
    pairs = [(i, i % 7) for i in range(10, 200)] + [(i, (i + 1) % 7) for i in range(7)] + [(3, 500)]
    placed, rows = graph.placed_links, []
    monkeypatch.setattr(graph, "placed_links", lambda links, *rest: rows.append(links.count()) or placed(links, *rest))
    got = {r.id: r.rank for r in graph.pagerank_until(edges(spark, pairs), 1e-9).collect()}
    links, rank = set(pairs), dict.fromkeys({v for p in pairs for v in p}, 0.15)
    out = {v: sum(s == v for s, _ in links) for v in rank}
    for _ in range(200):
        rank = {v: 0.15 + 0.85 * sum(rank[s] / out[s] for s, d in links if d == v) for v in rank}
    assert got == {v: pytest.approx(r, abs=1e-6) for v, r in rank.items()}
    assert rows == [8 + 8]  # a link of each vertex with in-links to the next one, and one to itself


def test_triangles_send_the_rest_of_a_list_as_numbers(spark, monkeypatch):
    """an edge took the whole list of its lower end along, as 64-bit ids."""
    written, write = [], graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, *a, **k: written.append((df.schema, df._jdf.queryExecution().optimizedPlan().toString())) or write(df, *a, **k))
    far = 1 << 40
    pairs = [(far + a, far + b) for a, b in [(1, 2), (2, 3), (3, 1), (3, 4), (4, 1), (2, 2), (5, 1), (1, 2)]] + [(None, far)]
    got = {r.id - far: r.n for r in graph.triangles(edges(spark, pairs)).collect()}
    assert got == {1: 2, 2: 1, 3: 2, 4: 1}
    lists = [s for s, _ in written if "next" in s.names]
    assert [s["next"].dataType.simpleString() for s in lists] == ["array<int>"]
    assert any("slice(next" in plan for _, plan in written)


def test_triangles_broadcast_no_lists(spark, monkeypatch):
    """the slices of all edges passed for as small as the written lists, and were broadcast through the driver."""
    plans, write = [], graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, *a, **k: plans.append((df.columns, df._jdf.queryExecution().sparkPlan().toString())) or write(df, *a, **k))
    assert [tuple(r) for r in graph.triangles(edges(spark, [(1, 2), (2, 3), (3, 1), (3, 4)])).orderBy("id").collect()] == [(1, 1), (2, 1), (3, 1)]
    (joined,) = [plan for columns, plan in plans if "third" in columns]
    assert "SortMergeJoin" in joined and "Broadcast" not in joined

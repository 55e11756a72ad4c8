"""Graph jobs on edge tables ``(src, dst)``. Iterations write their state to the shared folder."""

from __future__ import annotations

import math
import sys

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from kindred.operators.statistics import positions
from kindred.session import bounded, materialise, work_dir


CHAINED = 5
#: Links of one vertex that lie in one place; those of a vertex with more lie in several.
HUB = 100_000


def placed_links(links: DataFrame, key: str, hub: int = HUB) -> tuple[DataFrame, DataFrame | None]:
    """``links`` written where joins on ``key`` need them, and ``(key, parts)`` of the hubs, None without any.

    The links of a hub are dealt to blocks by their other columns, and each block is a place of its own: a grid of
    sources and targets, of which only hubs have more than one column.
    """
    counted = links.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > hub)
    hubs = materialise(counted.select(key, F.ceil(F.col("n") / hub).cast("int").alias("parts")))
    if hubs.isEmpty():
        return materialise(links, bucket_by=key), None
    part = F.pmod(F.xxhash64(*links.columns), F.coalesce("parts", F.lit(1))).cast("int")
    return materialise(links.join(hubs, key, "left").withColumn("part", part).drop("parts"), bucket_by=[key, "part"]), hubs


def meet(links: DataFrame, hubs: DataFrame | None, state: DataFrame, key: str) -> DataFrame:
    """Placed links with the row of ``state`` for their ``key``; a hub's row is copied to each of its blocks."""
    if hubs is None:
        return links.join(state, key)
    blocks = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    return links.join(state.join(hubs, key, "left").select(*state.columns, blocks), [key, "part"]).drop("part")


def _shares(edges: DataFrame) -> DataFrame:
    """Distinct links with the share of the rank of ``src`` that each one passes on."""
    links = materialise(edges.select("src", "dst").distinct())
    degrees = links.groupBy("src").agg((1.0 / F.count("*")).alias("share"))
    return links.join(degrees, "src")


def pagerank(edges: DataFrame, iterations: int, hub: int = HUB) -> DataFrame:
    """``(id, rank)`` after a fixed number of iterations; vertices without in-links drop out.

    The links lie bucketed by ``src`` and new ranks come out of the grouping where the next join needs
    them, so an iteration shuffles once: the sums of passed ranks. With hubs the ranks are shuffled once more, to
    the blocks of links. Every few iterations are written.
    """
    links, hubs = placed_links(_shares(edges), "src", hub)
    ranks = links.select("src").distinct().withColumn("rank", F.lit(1.0))
    for i in range(iterations):
        passed = meet(links, hubs, ranks, "src").groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("c"))
        ranks = passed.select(F.col("dst").alias("src"), (0.15 + 0.85 * F.col("c")).alias("rank"))
        if i % CHAINED == CHAINED - 1 and i + 1 < iterations:
            ranks = materialise(ranks)
    return ranks.withColumnRenamed("src", "id")


def pagerank_until(edges: DataFrame, tolerance: float, limit: int = 400, hub: int = HUB) -> DataFrame:
    """``(id, rank)`` of all vertices, iterated until no rank moves by ``tolerance`` or more.

    A vertex without in-links keeps its first rank, so what it passes on is summed once, as the ``base`` of its
    targets, and its links take no part in the iterations. Every other vertex has a link to itself that passes
    nothing but this base on and keeps it, with its last rank, in the grouping. ``CHAINED`` iterations are one
    job; its last step is written and tested. Ranks that still move after ``limit`` jobs raise an error.
    """
    shares = materialise(_shares(edges))
    moving = materialise(shares.select(F.col("dst").alias("src")).distinct())
    still = shares.join(moving, "src", "left_anti")
    base = still.groupBy("dst").agg((0.15 * F.sum("share")).alias("base"))
    own = moving.select("src", F.col("src").alias("dst")).join(base, "dst", "left")
    kept = own.select("src", "dst", F.lit(0.0).alias("share"), F.lit(1.0).alias("own"), F.coalesce("base", F.lit(0.0)).alias("base"))
    passing = shares.join(moving, "src", "left_semi").withColumns({"own": F.lit(0.0), "base": F.lit(0.0)})
    links, hubs = placed_links(passing.unionByName(kept), "src", hub)
    moved = links.where("own = 1").select("src", F.lit(0.15).alias("rank"), F.lit(0.15).alias("old"))
    for _ in range(limit):
        for _step in range(CHAINED):
            passed = meet(links, hubs, moved.select("src", "rank"), "src").groupBy("dst").agg(
                F.sum(F.col("rank") * F.col("share") + F.col("base")).alias("c"), F.sum(F.col("rank") * F.col("own")).alias("old")
            )
            moved = passed.select(F.col("dst").alias("src"), (0.15 + 0.85 * F.col("c")).alias("rank"), "old")
        moved = materialise(moved)
        if moved.select(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0] < tolerance:
            first = still.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(0.15))
            return moved.select(F.col("src").alias("id"), "rank").unionByName(first)
    raise RuntimeError(f"ranks still move by {tolerance} or more after {limit * CHAINED} iterations")


def transitive_closure(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` for every path. Each round extends only the paths found by the last one.

    A round's paths are written once, next to those of the earlier rounds.
    """
    spark = edges.sparkSession
    parts = [work_dir(spark)]
    edges.select("src", "dst").distinct().write.parquet(parts[0])
    fresh = known = spark.read.parquet(parts[0])
    step = known.select(F.col("src").alias("dst"), F.col("dst").alias("end"))
    while not fresh.isEmpty():
        longer = fresh.join(step, "dst").select("src", F.col("end").alias("dst")).distinct()
        parts.append(work_dir(spark))
        longer.join(known, ["src", "dst"], "left_anti").write.parquet(parts[-1])
        fresh, known = spark.read.parquet(parts[-1]), spark.read.parquet(*parts)
    return known


def components(edges: DataFrame, hub: int = HUB) -> DataFrame:
    """``(id, component)``: lowest vertex id that can be reached.

    A round takes the lowest label among the neighbours and then the label of that label, so the
    number of rounds grows with the logarithm of the longest path.
    """
    both, hubs = placed_links(edges.select("src", "dst").union(edges.select("dst", "src")).distinct(), "dst", hub)
    labels = materialise(both.select(F.col("src").alias("id")).distinct().withColumn("component", F.col("id")))
    while True:
        near = meet(both, hubs, labels.withColumnRenamed("id", "dst"), "dst").groupBy("src").agg(F.min("component").alias("low"))
        lowered = labels.join(near, labels.id == near.src).select(
            "id", F.col("component").alias("old"), F.least("component", "low").alias("component")
        )
        lowered = materialise(lowered)
        target = lowered.select(F.col("id").alias("component"), F.col("component").alias("jump"))
        moved = materialise(
            lowered.join(target, "component", "left").select("id", "old", F.least("component", "jump").alias("component"))
        )
        labels = moved.select("id", "component")
        if moved.where("component <> old").isEmpty():
            return labels


def triangles(edges: DataFrame) -> DataFrame:
    """``(id, n)``: triangles through each vertex.

    Vertices are numbered by degree and edges point from the lower to the higher number, so no list of successors is
    longer than the square root of twice the number of edges, however common a vertex is. Along an edge go only the
    successors of its lower end that lie behind its higher one, as numbers: a triangle is found once, on the edge of its two lowest vertices.
    """
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    pairs = materialise(pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("deg"))
    order = materialise(positions(degree, "deg", "id").select("id", "position"))
    kind = "int" if order.count() < 2**31 else "long"
    order = order.select("id", F.col("position").cast(kind).alias("place"))
    placed = pairs.join(order.toDF("a", "pa"), "a").select("b", "pa").join(order.toDF("b", "pb"), "b")
    directed = placed.select(F.least("pa", "pb").alias("u"), F.greatest("pa", "pb").alias("v"))
    ahead = materialise(directed.groupBy("u").agg(F.sort_array(F.collect_list("v")).alias("next")))
    behind = ahead.where(F.size("next") > 1).select("u", "next", F.posexplode("next").alias("i", "v"))
    behind = behind.where(F.col("i") < F.size("next") - 1).select("u", "v", F.expr("slice(next, i + 2, size(next))").alias("rest"))
    # the size of the slices is not known beforehand: without the hint they can pass for small and be broadcast
    common = (
        behind.hint("merge").join(ahead.select(F.col("u").alias("v"), F.col("next").alias("next_v")), "v")
        .select("u", "v", F.array_intersect("rest", "next_v").alias("third"))
        .where(F.size("third") > 0)
    )
    common = materialise(common)
    corners = common.select(F.explode(F.array("u", "v")).alias("place"), F.size("third").alias("n")).union(
        common.select(F.explode("third").alias("place"), F.lit(1).alias("n"))
    )
    return corners.groupBy("place").agg(F.sum("n").alias("n")).join(order, "place").select("id", "n")


def shortest_paths(edges: DataFrame, source: int, hub: int = HUB) -> DataFrame:
    """``(id, distance)`` from one vertex over ``(src, dst, weight)``; a round relaxes from improved vertices."""
    links, hubs = placed_links(edges.select("src", "dst", "weight"), "src", hub)
    known = materialise(
        links.select(F.col("src").alias("id")).where(F.col("id") == source).distinct().withColumn("distance", F.lit(0.0))
    )
    improved = known
    while not improved.isEmpty():
        reached = (
            meet(links, hubs, improved.withColumnRenamed("id", "src"), "src").groupBy("dst")
            .agg(F.min(F.col("distance") + F.col("weight")).alias("d"))
        )
        merged = known.join(reached, known.id == reached.dst, "full").select(
            F.coalesce("id", "dst").alias("id"), F.least("distance", "d").alias("distance"),
            (F.col("distance").isNull() | (F.col("d") < F.col("distance"))).alias("better"),
        )
        merged = materialise(merged)
        known = merged.select("id", "distance")
        improved = merged.where("better").select("id", "distance")
    return known


def neighbour_average(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """``(id, n, mean)`` over in-neighbours with a larger value; ``vertices`` is ``(id, value)``."""
    own = vertices.select(F.col("id").alias("dst"), F.col("value").alias("own"))
    other = vertices.select(F.col("id").alias("src"), F.col("value").alias("other"))
    joined = edges.select("src", "dst").distinct().join(other, "src").join(own, "dst")
    return joined.where("other > own").groupBy(F.col("dst").alias("id")).agg(
        F.count("*").alias("n"), F.avg("other").alias("mean")
    )


def gaussian(key: Column) -> Column:
    """A normally distributed number that depends on the key alone."""
    uniform = [(F.shiftrightunsigned(F.xxhash64(F.lit(i), key), 11) + F.lit(0.5)) / F.lit(2.0**53) for i in (1, 2)]
    return F.sqrt(-2 * F.log(uniform[0])) * F.cos(2 * math.pi * uniform[1])


def power_iteration(links: DataFrame, iterations: int, start: DataFrame | None = None, hub: int = HUB) -> DataFrame:
    """``(id, x)``: the vector of power iteration clustering for links ``(src, dst, weight)``, which hold both ways.

    The steps and the test for an early end are those of Spark's ``PowerIterationClustering``, which keeps the whole graph of each round
    in the executors. Here the links are written where a round reads them, and a round shuffles the sums of vertices, which
    are written with the total weight of each vertex. ``start`` is ``(id, x)``, random numbers by the id without it.
    """
    spark = links.sparkSession
    wrong = "src IS NULL OR dst IS NULL OR weight IS NULL OR weight < 0 OR isnan(weight)"
    bad = links.where(wrong).limit(1).collect()
    if bad:
        raise ValueError(f"links need both ends and a weight of zero or more: {bad[0]}")
    ways = links.where("src <> dst").select(F.explode(F.array(F.struct("src", "dst", "weight"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))).alias("l")).select("l.*")
    placed, hubs = placed_links(ways, "dst", hub)
    # of both ways, so the weights of the links to a vertex are those of the links from it
    degrees = materialise(placed.groupBy(F.col("dst").alias("id")).agg(F.sum("weight").alias("degree")))
    first = degrees.withColumn("x", gaussian(F.col("id"))) if start is None else degrees.join(start, "id")
    total = first.agg(F.sum(F.abs("x"))).first()[0]
    state = first.select("id", "degree", (F.col("x") / F.lit(total)).alias("x"))
    tolerance = max(1e-5 / max(degrees.count(), 1), 1e-8)
    before = moved = math.inf
    for _ in range(iterations):
        if moved <= tolerance:
            break
        passed = meet(placed, hubs, state.select(F.col("id").alias("dst"), "x"), "dst").groupBy(F.col("src").alias("id")).agg(F.sum(F.col("weight") * F.col("x")).alias("y"))
        share = F.col("y") / F.greatest("degree", F.lit(sys.float_info.epsilon))
        written = materialise(passed.join(state, "id").select("id", "degree", "x", share.alias("y")))
        norm = written.agg(F.sum(F.abs("y"))).first()[0]
        scaled = F.col("y") / F.lit(norm)
        delta = written.agg(F.sum(F.abs(F.col("x") - scaled))).first()[0] or 0.0
        before, moved = delta, abs(delta - before)
        state = written.select("id", "degree", scaled.alias("x"))
        spark._jvm.System.gc()  # shuffle files of a round go when the driver collects what refers to them
    return state.select("id", "x")


def power_iteration_clusters(links: DataFrame, k: int, iterations: int) -> DataFrame:
    """``(id, cluster)`` by k-means over :func:`power_iteration`."""
    points = materialise(power_iteration(links, iterations)).select("id", array_to_vector(F.array("x")).alias("features"))
    found = KMeans(k=k, seed=0, predictionCol="cluster").fit(bounded(points)).transform(points)
    return found.select("id", "cluster")

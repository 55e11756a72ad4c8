"""Largest products of two tables of factors against all pairs, and how they are planned."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS

from kindred.contract import ml_queries
from kindred.operators import nearest_products as n


def table(spark, ids, rows):
    return spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, rows, strict=True)], "id int, features array<float>")


def by_force(users, items, k):
    found = {}
    for u, row in enumerate(users):
        product = n.single(np.broadcast_to(row, items.shape), items)
        found[u] = [(int(i), float(product[i])) for i in np.lexsort((np.arange(len(items)), -product))[:k]]
    return found


@pytest.mark.parametrize(("user_slice", "item_slice"), [(10_000, 10_000), (100, 150)])
def test_equals_all_pairs(spark, user_slice, item_slice):
    random = np.random.default_rng(5)
    users, items = random.normal(1, 1, (600, 4)).astype(np.float32), random.normal(1, 1, (900, 4)).astype(np.float32)
    items[300:340] = items[7] * 4  # equal vectors, and among the best of many users
    users[5] = 0
    found = n.largest_products(table(spark, range(600), users), table(spark, range(900), items), 3, user_slice, item_slice)
    got = {}
    for r in found.collect():
        got.setdefault(r["user"], []).append((r["item"], r["product"]))
    expected = by_force(users, items, 3)
    assert [p for _, p in got.pop(5)] == [0.0] * 3 and expected.pop(5)
    assert {u: sorted(x, key=lambda y: (-y[1], y[0])) for u, x in got.items()} == expected


def test_few_rows(spark):
    one = table(spark, [4], np.array([[1.0, 2.0]]))
    few = table(spark, [9, 3], np.array([[1.0, 1.0], [0.0, -1.0]]))
    assert [tuple(r) for r in n.largest_products(one, few, 3).orderBy("item").collect()] == [(4, 3, -2.0), (4, 9, 3.0)]
    assert n.largest_products(one, few.where("false"), 3).collect() == [] and n.largest_products(one.where("false"), few, 3).collect() == []


def test_same_as_the_model_gives(spark):
    random = np.random.default_rng(2)
    rows = [(u, i, float(random.integers(1, 50))) for u in range(60) for i in random.choice(40, 12, replace=False).tolist()]
    ratings = spark.createDataFrame(rows, "u int, i int, r double")
    model = ALS(rank=4, maxIter=2, userCol="u", itemCol="i", ratingCol="r", seed=1).fit(ratings)
    new, old = n.recommend_for_all_users(model, 3), model.recommendForAllUsers(3)
    assert new.schema.simpleString() == old.schema.simpleString()
    assert {r["u"]: r["recommendations"] for r in new.collect()} == {r["u"]: r["recommendations"] for r in old.collect()}


def test_boxes_hold_every_row_once():
    rows = np.vstack([np.zeros((500, 2)), np.arange(600).reshape(300, 2)])
    parts = n.boxes(rows, 64)
    assert sorted(np.concatenate(parts)) == list(range(800)) and max(map(len, parts)) <= 64


def test_recommendations_do_not_pair_all_rows(spark):
    plan = ml_queries.ml_als(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan

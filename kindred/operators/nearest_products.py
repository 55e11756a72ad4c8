"""The largest products of two tables of factors, for every row of the first: exact, without forming all pairs.

Both tables are cut into slices by a hash of the id, and every pair of slices is a group, so a task holds two slices however
large the tables are. Within a group both sides are cut into boxes of near vectors. A box of items is looked at only for users
for whom its corners allow a product above the last one they have.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Window, functions as F

# the functions below travel to the executors with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Rows of a slice of users and of items, rows of a box.
USERS, ITEMS, BOX = 32_768, 65_536, 256
#: Products listed beyond those asked for; they are compared in single precision, as they are returned.
_SPARE = 4


def boxes(rows: np.ndarray, size: int = BOX) -> list[np.ndarray]:
    """Numbers of the rows, cut at the middle of the widest column until at most ``size`` are together."""
    done, todo = [], [np.arange(len(rows))]
    while todo:
        part = todo.pop()
        if len(part) <= size:
            done.append(part)
            continue
        own = rows[part]
        column = own[:, np.ptp(own, axis=0).argmax()]
        order = np.argpartition(column, len(part) // 2)
        todo += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return done


def single(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Products of the rows in single precision, summed from the first column on."""
    total = np.zeros(left.shape[:-1], np.float32)
    for column in range(left.shape[-1]):
        total = total + left[..., column] * right[..., column]
    return total


def best(user_ids: np.ndarray, users: np.ndarray, item_ids: np.ndarray, items: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of users, ids of items and products of the ``k`` largest products of every user; equal ones by smaller id."""
    order = np.argsort(item_ids, kind="stable")
    item_ids, items = item_ids[order], items[order]
    # of equal vectors the first k are enough
    _, same = np.unique(items, axis=0, return_inverse=True)
    by_vector = np.argsort(same.ravel(), kind="stable")
    sorted_same = same.ravel()[by_vector]
    place = np.arange(len(items)) - np.searchsorted(sorted_same, sorted_same)
    kept = np.sort(by_vector[place < k])
    item_ids, items = item_ids[kept], items[kept]
    wide, parts = items.astype(np.float64), boxes(items)
    low, high = np.array([wide[p].min(axis=0) for p in parts]), np.array([wide[p].max(axis=0) for p in parts])
    listed = min(k + _SPARE, len(items))
    numbers, found = [], []
    for group in boxes(users):
        own = users[group].astype(np.float64)
        bound = np.maximum(own, 0) @ high.T + np.minimum(own, 0) @ low.T
        bound += 1e-12 * (np.abs(own) @ np.maximum(np.abs(low), np.abs(high)).T)  # more than rounding may take
        value, where = np.full((len(group), listed), -np.inf), np.full((len(group), listed), -1)
        for at in bound.max(axis=0).argsort()[::-1]:
            open_ = np.flatnonzero(bound[:, at] >= value[:, -1])
            if not len(open_):
                continue
            product = own[open_] @ wide[parts[at]].T
            gain = product.max(axis=1) > value[open_, -1]
            open_, product = open_[gain], product[gain]
            if not len(open_):
                continue
            product = np.hstack([value[open_], product])
            place = np.hstack([where[open_], np.broadcast_to(parts[at], (len(open_), len(parts[at])))])
            top = np.argpartition(-product, listed - 1, axis=1)[:, :listed]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(product, top, 1), axis=1, kind="stable"), 1)
            value[open_], where[open_] = np.take_along_axis(product, top, 1), np.take_along_axis(place, top, 1)
        numbers.append(group)
        found.append(where)
    number, where = np.concatenate(numbers), np.concatenate(found)
    product = single(users[number][:, None, :], items[where])
    top = np.lexsort((item_ids[where], -product), axis=1)[:, :k]
    return np.repeat(number, top.shape[1]), np.take_along_axis(item_ids[where], top, 1).ravel(), np.take_along_axis(product, top, 1).ravel()


def largest_products(users: DataFrame, items: DataFrame, k: int, user_slice: int = USERS, item_slice: int = ITEMS) -> DataFrame:
    """``user``, ``item`` and ``product`` (float) of the ``k`` largest products of every row of ``users`` with the rows of ``items``.

    Both have an int ``id`` and ``features``, an array of finite floats of one length. Of equal products those of smaller items are
    taken, as far as no more than ``k`` + 4 different vectors of items give them.
    """
    across, down = (-(-df.count() // size) or 1 for df, size in ((users, user_slice), (items, item_slice)))

    def dealt(df: DataFrame, own: str, own_slices: int, other: str, other_slices: int) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0), F.lit(other_slices - 1)))
        return df.select("id", "features", F.pmod(F.xxhash64("id"), F.lit(own_slices)).cast("int").alias(own), copies.alias(other))

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.float32())], names=["user", "item", "product"])
        ids = [t.column("id").to_numpy() for t in (left, right)]
        rows = [t.column("features").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1) for t in (left, right)]
        number, item, product = best(ids[0], rows[0], ids[1], rows[1], k)
        return pa.Table.from_arrays([pa.array(ids[0][number]), pa.array(item), pa.array(product)], names=["user", "item", "product"])

    by = ["user_slice", "item_slice"]
    left, right = dealt(users, by[0], across, by[1], down), dealt(items, by[1], down, by[0], across)
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(met, "user int, item int, product float")
    place = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("product"), "item"))
    return found.withColumn("place", place).where(F.col("place") <= k).drop("place")


def recommend_for_all_users(model: ALSModel, k: int) -> DataFrame:
    """What the model's ``recommendForAllUsers`` gives, which forms every pair of a user and an item; here most pairs are ruled out unseen."""
    user, item = model.getUserCol(), model.getItemCol()
    found = largest_products(model.userFactors, model.itemFactors, k)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("product")).alias("last"), "item", "product")))
    return found.groupBy(F.col("user").alias(user)).agg(
        F.transform(listed, lambda r: F.struct(r["item"].alias(item), r["product"].alias("rating"))).alias("recommendations")
    )

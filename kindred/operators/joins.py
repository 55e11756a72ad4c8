"""Joins Spark has no single operator for."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from kindred.session import materialise


def asof_last(events: DataFrame, key: str, time: str, bucket: Column, is_source: Column, value: str) -> DataFrame:
    """Every row with ``last_value`` and ``last_time`` of the nearest source row of its key at a strictly earlier time.

    Of several source rows at that time the one with the largest value counts. ``time`` is a timestamp or a whole number.

    A key is cut into time buckets. Inside a bucket a window looks back; what earlier buckets hand over is
    one row per bucket, so a very frequent key is spread over as many tasks as it has buckets.
    """
    seen = F.when(is_source, F.struct(F.col(time).alias("t"), F.col(value).alias("v")))
    rows = events.withColumn("bucket", bucket).withColumn("seen", seen)
    per_bucket = rows.groupBy(key, "bucket").agg(F.max("seen").alias("newest"))
    earlier = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(key, "bucket", F.last("newest", ignorenulls=True).over(earlier).alias("carried"))
    whole = F.unix_micros(F.col(time).cast("timestamp")) if dict(events.dtypes)[time].startswith("timestamp") else F.col(time).cast("long")
    # a frame by time, not by rows: rows of the same time do not see each other
    before = Window.partitionBy(key, "bucket").orderBy(whole).rangeBetween(Window.unboundedPreceding, -1)
    found = F.coalesce(F.max("seen").over(before), F.col("carried"))
    return (
        rows.join(carried, [key, "bucket"])
        .withColumn("found", found)
        .withColumn("last_value", F.col("found.v"))
        .withColumn("last_time", F.col("found.t"))
        .drop("bucket", "seen", "carried", "found")
    )


def salted_sum(df: DataFrame, key: str, value: str, salts: int = 32) -> DataFrame:
    """``(key, n, total)`` in two steps: per key and salt first, so one hot key is many groups."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts))  # equal rows are spread as well
    partial = df.groupBy(key, salt.alias("salt")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return partial.groupBy(key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """Inner join with the big side spread by salt and the other side repeated once per salt."""
    left = big.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    right = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "salt"]).drop("salt")


def alone_and_shared(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` whose keys no other row has, and the others, None without any; a null equals a null.

    Work by key needs no shuffle for the first ones. Only keys are shuffled to find them out; ``rows`` is read again for each result.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    repeated = materialise(counted.select(*[F.col(k).alias(f"repeated_{k}") for k in keys]))
    if repeated.isEmpty():
        return rows, None
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"repeated_{k}")) for k in keys])
    return rows.join(repeated, same, "left_anti"), rows.join(repeated, same, "left_semi")

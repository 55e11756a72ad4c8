"""Splitting a corpus into parts, written as one folder per part in a single pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.operators.keywords import chunk_of


def random_split(df: DataFrame, parts: int, seed: int) -> DataFrame:
    """Random part number per row, equal weights; every row gets exactly one part."""
    return df.withColumn("part", F.floor(F.rand(seed) * parts).cast("int"))


def hash_split(df: DataFrame, parts: int, base: str = "part", id_col: str = "id") -> DataFrame:
    """Part name ``base`` plus a five-digit number taken from the hash of the id."""
    number = chunk_of(F.col(id_col), F.lit(parts).cast("long"))
    return df.withColumn("part", F.concat(F.lit(base), F.lpad(number.cast("string"), 5, "0")))


def write_parts(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("part").parquet(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

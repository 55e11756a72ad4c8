"""Helpers that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Sequence
from types import ModuleType
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import materialise

Made = TypeVar("Made")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bodies(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``row`` (unique in this reading only), ``doc_id``, ``text`` with null as empty, and the columns in ``carry``.

    All other columns are dropped, so their names cannot clash with those an operator adds. Write the
    result, or something made of it, before using ``row`` twice.
    """
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
        *[docs[c] for c in carry],
    )


def keyed(docs: DataFrame) -> DataFrame:
    """``key`` and ``doc``: a stable key of each row, and the whole row as a struct, so that no name clashes.

    The key is the row's file and place in it, which stays the same however later reads split the files.
    Rows that do not come straight from files are written first.
    """
    try:
        place = docs.metadataColumn("_metadata")
        return docs.select(F.struct(place["file_path"], place["row_index"]).alias("key"), F.struct("*").alias("doc"))
    except AnalysisException:
        return keyed(materialise(docs))


def held_out(column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == fold


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def spans_text(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def kept_in_worker(name: str, make: Callable[[], Made]) -> Made:
    """What ``make`` gives, made once in a Python worker and kept for its later tasks.

    The code of this package travels with every task, so its own variables start anew each time.
    """
    store = sys.modules.setdefault("_kindred_worker", ModuleType("_kindred_worker")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]

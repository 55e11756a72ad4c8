"""Storage of the keyword index: partitioned Parquet, and the CSV form with posting strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from kindred.sources.articles import CSV_OPTIONS

INDEX_CSV_SCHEMA = StructType(
    [StructField("Keyword", StringType()), StructField("RowId & Score", StringType())]
)


def write_index_csv(encoded: DataFrame, path: str, single_file: bool = False) -> None:
    out = encoded.coalesce(1) if single_file else encoded
    out.write.mode("overwrite").csv(path, **CSV_OPTIONS)


def read_index_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_CSV_SCHEMA).csv(path, **CSV_OPTIONS)


def write_index_table(index: DataFrame, name: str, buckets: int = 256) -> None:
    """Table bucketed and sorted by keyword: searches join on it without shuffling the index."""
    index.write.mode("overwrite").bucketBy(buckets, "keyword").sortBy("keyword").saveAsTable(name)


def write_index(index: DataFrame, path: str) -> None:
    """Parquet sorted by keyword within files, so that row group statistics prune look-ups."""
    index.sortWithinPartitions("keyword").write.mode("overwrite").parquet(path)

"""Running a streaming query over files to its end, with the result as a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from kindred.session import work_dir
from kindred.sources.articles import table


def stream(spark: SparkSession, path: str) -> DataFrame:
    """File stream of a Parquet path."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # as a pattern the path may be one file or a folder of files
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def stream_files(rows: DataFrame, fmt: str, **options) -> DataFrame:
    """File stream of ``rows`` written in the format ``fmt``."""
    spark = rows.sparkSession
    path = work_dir(spark)
    rows.write.format(fmt).options(**options).save(path)
    return spark.readStream.format(fmt).schema(rows.schema).options(**options).load(path)


def run_append(df: DataFrame, out: str | None = None, checkpoint: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Append-mode run over the files present now; final rows go to a Parquet sink, in a folder per value of ``partition_by``."""
    spark = df.sparkSession
    out = out or work_dir(spark)
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("checkpointLocation", checkpoint or work_dir(spark)).start(out).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def run_batches(
    df: DataFrame, mode: str, on_batch: Callable[[DataFrame, int], None], checkpoint: str | None = None
) -> None:
    """Run over the files present now and hand every batch to ``on_batch``."""
    writer = df.writeStream.outputMode(mode).trigger(availableNow=True).foreachBatch(on_batch)
    writer.option("checkpointLocation", checkpoint or work_dir(df.sparkSession)).start().awaitTermination()


def run_complete(df: DataFrame) -> DataFrame:
    """Complete-mode run: the sink table is replaced by every batch, the last one is the result."""
    spark = df.sparkSession
    out = work_dir(spark)
    run_batches(df, "complete", lambda batch, _: batch.write.mode("overwrite").parquet(out))
    return spark.read.schema(df.schema).parquet(out)

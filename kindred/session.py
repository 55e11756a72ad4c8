"""Session helpers: a session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
#: Folders and tables made inside the innermost open scope of ``scratch`` of this thread.
_scope: ContextVar[tuple[list[str], list[str]] | None] = ContextVar("scope", default=None)


def build_session(app: str = "kindred", cpus: int | str = "*", memory: str = "12g") -> SparkSession:
    """Local session for tests and bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """A new folder name below the shared folder set in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of its own.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="kindred-")
        root = _local_root
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope[0].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the folders and tables that jobs made inside it for themselves.

    Results are lazy and read these tables: write or collect what is to stay before the scope ends. Other threads have
    scopes of their own, and what they make meanwhile stays.
    """
    paths: list[str] = []
    names: list[str] = []
    before = _scope.set((paths, names))
    try:
        yield
    finally:
        _scope.reset(before)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, bucket_by: str | Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage, survives lost executors, and its file size is a measured
    statistic: Spark broadcasts the result in later joins only while it is below
    ``spark.sql.autoBroadcastJoinThreshold``. With ``bucket_by`` later joins and groupings on that
    column, or those columns, do not shuffle the table again.
    """
    spark = df.sparkSession
    path = work_dir(spark)
    if bucket_by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"kindred_{path.rsplit('/', 1)[1]}"
    if (scope := _scope.get()) is not None:
        scope[1].append(name)
    columns = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
    placed = df.repartition(buckets, *columns)
    placed.write.bucketBy(buckets, *columns).sortBy(*columns).option("path", path).saveAsTable(name)
    return spark.table(name)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy work on a small input; an input with enough partitions is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


#: Rows of a partition that a job keeps in memory over many passes.
ROWS_PER_TASK = 1_000_000


def bounded(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """At most about ``rows`` rows in a partition; an input with enough partitions for that is not shuffled."""
    parts = -(-df.count() // rows)
    return df if parts <= 1 or df.rdd.getNumPartitions() >= parts else df.repartition(parts)

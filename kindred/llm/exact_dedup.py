"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of fixed size. The distinct blocks of the corpus are sorted and numbered,
so a text becomes a sequence of integers. Then neighbouring integers are paired, the distinct pairs
are sorted and numbered, and so on until every text is one integer: texts have the same integer
exactly if they are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import bodies, partitions
from kindred.session import materialise

#: Bytes in a block.
BLOCK = 4096
#: Names of a text are told apart from those of other levels by ``name * LEVELS + level``.
LEVELS = 64


def cut(text: str, size: int) -> list[bytes]:
    """Blocks of the text with A-Z lower-cased, as UTF-8; the empty text is one empty block."""
    data = text.encode("utf-8", "surrogatepass").lower()
    return [data[i : i + size] for i in range(0, len(data), size)] or [b""]


def block_key(block: bytes, seed: int, key_bytes: int = 16) -> bytes:
    return xxhash.xxh3_128_digest(block, seed)[:key_bytes]


def numbered(values: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """Distinct rows of ``columns`` with a ``name``: the place in the sorted bucket, made unique by the bucket."""
    order = Window.partitionBy("bucket").orderBy(*columns)
    name = F.row_number().over(order).cast("long") * buckets + F.col("bucket")
    return values.withColumn("bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets))).withColumn("name", name).drop("bucket")


def _name_blocks(docs: DataFrame, size: int, seed: int, key_bytes: int) -> DataFrame:
    """``key`` and ``name`` of every distinct block, and ``n``: how many distinct blocks share the key."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sorted({b for text in batch.column(0).to_pylist() for b in cut(text, size)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([block_key(b, seed, key_bytes) for b in found], pa.binary()), pa.array(found, pa.binary())], names=["key", "block"]
            )

    spark = docs.sparkSession
    buckets = partitions(spark)
    found = docs.select("text").mapInArrow(blocks, "key binary, block binary")
    # one shuffle of the blocks; both groupings and the numbering stay on its partitions
    placed = found.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).repartition(buckets, "bucket")
    keys = placed.groupBy("bucket", "key", "block").agg(F.lit(1).alias("one")).groupBy("bucket", "key").agg(F.count("*").alias("n"))
    name = F.row_number().over(Window.partitionBy("bucket").orderBy("key")).cast("long") * buckets + F.col("bucket")
    return keys.select("key", "n", name.alias("name"))


def identities(docs: DataFrame, carry: Sequence[str] = (), block: int = BLOCK, key_bytes: int = 16) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``row``, ``doc_id``, ``text_sha256``, ``identity``, ``carry``.

    ``identity`` is equal exactly for rows whose texts are equal after lower-casing A-Z; a null text is
    empty. Blocks are looked up by a 128-bit key, and the naming pass counts the blocks of every key: if two
    distinct blocks share one, the keys are taken again with another seed, so names never collide. Repeated
    rows are rows of their own, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = bodies(docs, carry)
    seed = 0
    while True:
        names = materialise(_name_blocks(docs, block, seed, key_bytes))
        if names.where("n > 1").isEmpty():
            break
        seed += 1
        if seed > 8:
            key_bytes, seed = 16, 0

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lists = [[block_key(b, seed, key_bytes) for b in cut(text, block)] for text in texts]
            digests = [hashlib.sha256(text.encode("utf-8", "surrogatepass").lower()).hexdigest() for text in texts]
            kept = [batch.column(c) for c in ("row", "doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(digests), pa.array(lists, pa.list_(pa.binary()))], names=["row", "doc_id", *carry, "text_sha256", "keys"])

    out = T.StructType([f for f in docs.schema.fields if f.name != "text"]).add("text_sha256", "string").add("keys", T.ArrayType(T.BinaryType()))
    rows = materialise(docs.mapInArrow(keys, out))
    named = rows.select("row", F.posexplode("keys").alias("place", "key")).join(names, "key")
    levels = max((rows.agg(F.max(F.size("keys"))).first()[0] or 1) - 1, 0).bit_length()
    work = materialise(_sequences(named))
    done = []
    for level in range(levels):
        done.append(_finished(work, level))
        work = materialise(_halved(work, partitions(spark)))
    done.append(_finished(work, levels))
    identity = done[0]
    for part in done[1:]:
        identity = identity.unionByName(part)
    return rows.drop("keys").join(identity, "row")


def _sequences(named: DataFrame) -> DataFrame:
    """The names of every row in the order of their places; as long as the row's own text at most."""
    return named.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "name"))).alias("found")).select("row", F.col("found.name").alias("names"))


def _finished(work: DataFrame, level: int) -> DataFrame:
    return work.where(F.size("names") == 1).select("row", (F.element_at("names", 1) * LEVELS + level).alias("identity"))


def _halved(work: DataFrame, buckets: int) -> DataFrame:
    """Every row of several names with each neighbouring pair replaced by the pair's name; a last odd one pairs with -1."""
    pair = lambda i: F.struct(F.get("names", i * 2).alias("a"), F.coalesce(F.get("names", i * 2 + 1), F.lit(-1)).alias("b"))
    pairs = work.where(F.size("names") > 1).select("row", F.posexplode(F.transform(F.expr("sequence(0, (size(names) - 1) div 2)"), pair)).alias("place", "pair"))
    pairs = pairs.select("row", "place", "pair.a", "pair.b")
    names = numbered(pairs.select("a", "b").distinct(), ["a", "b"], buckets)
    return _sequences(pairs.join(names, ["a", "b"]))


def exact_groups(docs: DataFrame, carry: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """``identities`` with ``keep_id``, ``group_size`` and ``kept``.

    Of equal texts the row with the largest ``doc_id`` stays (null is smallest); among repeated rows of that
    id exactly one stays. Groups are counted before they are joined, so a group of any size is never one task's.
    """
    rows = materialise(identities(docs, carry, block))
    # written, so that both sides of the join are plain shuffles and Spark can split those of a large group
    groups = materialise(rows.groupBy("identity").agg(F.max(F.struct("doc_id", "row")).alias("top"), F.count("*").alias("group_size")))
    return rows.join(groups, "identity").select(
        "row", "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", (F.col("top.row") == F.col("row")).alias("kept"), "text_sha256", *carry
    )

"""CSV files with line breaks inside quotes, read by byte ranges in parallel.

Spark reads the lines of a file in byte ranges, but a range does not know whether it starts inside a quoted field. A first
pass counts the quotes of every range, and a running parity over the ranges of a file tells each one its start. Then every
range puts its own records together. A record that crosses a border belongs to the range where it starts; only the parts
of such records, two in a range at most, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.session import materialise

#: Ranges whose starts are sent to all tasks, at about a hundred bytes each. Lines of more ranges meet them by a shuffle.
SENT_RANGES = 100_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``start`` (of the byte range) and ``line`` as bytes, in the order of the file within a range."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batches cut so that each lies in one range."""
    for batch in batches:
        if batch.num_rows:
            starts, names = batch.column("start").to_numpy(), batch.column("file").dictionary_encode().indices.to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(starts) != 0) | (np.diff(names) != 0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                yield (batch.column("file")[lo].as_py(), int(starts[lo])), batch.slice(lo, hi - lo)


def _inside(lines: pa.Array, quote: bytes, inside: int) -> np.ndarray:
    """For the start of every line and for the end: 1 inside quotes, 0 outside."""
    quotes = pc.count_substring(lines, pattern=quote).to_numpy(zero_copy_only=False)
    return (inside + np.concatenate([[0], np.cumsum(quotes)])) % 2


def _parities(quote: bytes):
    """``parity`` of the quotes of every range, and ``turns``: whether a line after its first odd one starts in it."""

    def parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parity, turns = None, 0, False
        row = lambda: pa.RecordBatch.from_pydict({"file": [key[0]], "start": [key[1]], "parity": [parity], "turns": [turns]})
        for name, part in _slices(batches):
            if name != key:
                if key is not None:
                    yield row()
                key, parity, turns = name, 0, False
            inside = _inside(part.column("line"), quote, parity)
            parity, turns = int(inside[-1]), turns or bool(inside[:-1].any())
        if key is not None:
            yield row()

    return parities


def _ranges(lines: DataFrame, quote: bytes) -> DataFrame:
    """``file``, ``start``, ``inside`` (1 if the range starts inside quotes) and ``before``: the last earlier range in which a record starts."""
    # one row per range: what the driver plans as tasks anyway
    found = materialise(lines.mapInArrow(_parities(quote), "file string, start long, parity long, turns boolean"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    started = found.withColumn("inside", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    owner = F.when((F.col("inside") == 0) | F.col("turns"), F.col("start"))
    return materialise(started.withColumn("owner", owner).select("file", "start", "inside", F.last("owner", ignorenulls=True).over(earlier).alias("before")))


def _cut(quote: bytes, crossing: bool):
    """The records of sorted lines that lie wholly in their range, or the parts of those that do not.

    ``number`` counts the records that start in the range, ``own`` is false for lines of a record that starts in an earlier range.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, begun, number, rest = None, 0, False, 0, []

        def out(found: list[bytes], own: bool) -> pa.RecordBatch:
            texts = [x.decode("utf-8", "replace") for x in found]
            columns = {"file": [key[0]] * len(found), "start": [key[1]] * len(found), "number": list(range(number, number + len(found))), "own": [own] * len(found), "record": texts}
            return pa.RecordBatch.from_pydict(columns)

        def close() -> Iterator[pa.RecordBatch]:
            whole = begun and inside == 0
            if rest and whole != crossing:
                yield out([b"\n".join(rest)], begun)

        for name, part in _slices(batches):
            if name != key:
                if key is not None:
                    yield from close()
                key, number, rest = name, 0, []
                inside = part.column("inside")[0].as_py()
                if inside is None:
                    raise ValueError(f"{key[0]} has no range at {key[1]}: spark.sql.files.maxPartitionBytes changed after the first pass")
                begun = inside == 0
            lines = part.column("line").to_pylist()
            at = _inside(part.column("line"), quote, inside)
            inside = int(at[-1])
            begins = np.flatnonzero(at[:-1] == 0).tolist()
            if not begins:
                rest += lines
                continue
            rest += lines[: begins[0]]
            found = [b"\n".join(rest)] if rest and begun else []
            if rest and not begun and crossing:
                yield out([b"\n".join(rest)], False)
            found += [lines[lo] if hi == lo + 1 else b"\n".join(lines[lo:hi]) for lo, hi in zip(begins, begins[1:], strict=False)]
            # an empty line is no record
            found = [x for x in found if x not in (b"", b"\r")]
            begun, rest = True, lines[begins[-1] :]
            if found and not crossing:
                yield out(found, True)
            number += len(found)
        if key is not None:
            yield from close()

    return cut


_PARTS = "file string, start long, number long, own boolean, record string"


def csv_records(spark: SparkSession, path: str, quote: str = '"', sent: int = SENT_RANGES) -> DataFrame:
    """``file``, ``start``, ``number``, ``record``: every record of CSV files as one text, with its range and its number there.

    Files are cut by ``spark.sql.files.maxPartitionBytes``, so one large file is read by many tasks. Quotes must be
    doubled inside quoted fields and stand in these only, as common CSV writers do. Lines may end with CR and LF.
    """
    mark, lines = quote.encode(), _lines(spark, path)
    ranges = _ranges(lines, mark)
    if ranges.count() <= sent:
        known = lines.join(F.broadcast(ranges.select("file", "start", "inside")), ["file", "start"], "left")
    else:
        numbered = lines.mapInArrow(_numbered, "file string, start long, at long, line binary")
        known = numbered.join(ranges.select("file", "start", "inside").hint("merge"), ["file", "start"], "left").sortWithinPartitions("file", "start", "at")
    known = known.select("file", "start", "inside", "line")
    parts = materialise(known.mapInArrow(_cut(mark, True), _PARTS)).join(ranges, ["file", "start"])
    owner = F.when(F.col("own"), F.col("start")).otherwise(F.col("before"))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("start").alias("at"), "own", "number", "record")))
    joined = parts.groupBy("file", owner.alias("start")).agg(pieces.alias("pieces"))
    # a range's own part is the first one of the record that starts in it
    joined = joined.select("file", "start", F.col("pieces")[0]["number"].alias("number"), F.array_join("pieces.record", "\n").alias("record"))
    whole = known.mapInArrow(_cut(mark, False), _PARTS).select("file", "start", "number", "record")
    record = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return whole.unionByName(joined).withColumn("record", record).where("record != ''")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number among those of the partition, which keeps the order of every range."""
    at = 0
    for batch in batches:
        numbers = pa.array(np.arange(at, at + batch.num_rows))
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("start"), numbers, batch.column("line")], names=["file", "start", "at", "line"])


def read_csv_ranges(spark: SparkSession, path: str, schema: StructType, header: bool = True, sent: int = SENT_RANGES, **options) -> DataFrame:
    """The rows that ``spark.read.csv`` with ``multiLine`` gives, with as many tasks as the files have byte ranges.

    ``options`` are those of the CSV source; separator and quote count, the escape is the quote. With ``header`` the first
    record of every file is left out.
    """
    records = csv_records(spark, path, options.get("quote", '"'), sent)
    if header:
        records = records.where("start != 0 OR number != 0")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", columns, {**{k: str(v) for k, v in options.items()}, "multiLine": "true", "lineSep": "\n"})
    return records.select(parsed.alias("r")).select("r.*")

"""Lines that many documents share, kept in one document only.

Every line long enough becomes a 128-bit hash with the documents and positions that hold it. The hashes are dealt to
partitions by range and sorted by hash, document and position, so one pass over a partition meets all holders of a line
one after another, the one that keeps it first. What comes out is one compressed bitmap of kept lines per document that
loses any; the text itself is not part of the sort.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import keyed, partitions
from kindred.session import materialise

#: Blanks that are stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: Texts that a task holds as Python strings at a time.
_TEXTS = 512
#: Code points of the shortest line, and documents of the rarest one, that count as repeated.
LEAST, HOLDERS = 40, 5
_PLACE = ["file", "row"]


def line_hash(key: str) -> bytes:
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


def _texts(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``file`` and ``row`` (the same in every reading), ``doc_id``, ``text`` with null as empty, ``carried`` with the columns ``carry``."""
    docs = keyed(docs)
    place = [F.xxhash64("key.file_path").alias("file"), F.col("key.row_index").alias("row")]
    return docs.select(*place, F.col("doc.doc_id").cast("long").alias("doc_id"), F.coalesce("doc.text", F.lit("")).alias("text"), F.struct(F.lit(0).alias("_"), *[F.col("doc")[c].alias(c) for c in carry]).alias("carried"))


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS):
            yield batch.slice(at, _TEXTS)


def _holders(texts: DataFrame, least: int) -> DataFrame:
    """One row for each long line that a document holds: its hash as two numbers and all its places there."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            owner, digests, places, lines = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found: dict[bytes, list[int]] = {}
                cut = text.split("\n")
                for at, line in enumerate(cut):
                    key = line.strip(BLANKS)
                    if len(key) >= least:
                        found.setdefault(line_hash(key), []).append(at)
                owner += [i] * len(found)
                digests += found.keys()
                places += found.values()
                lines += [len(cut)] * len(found)
            kept = [batch.column(c).take(pa.array(owner, pa.int64())) for c in ("file", "row", "doc_id")]
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), *kept, pa.array(lines, pa.int32()), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "file", "row", "doc_id", "n_lines", "places"])

    return texts.mapInArrow(each, "h1 long, h2 long, file long, row long, doc_id long, n_lines int, places array<int>")


_DECIDED = "h1 long, h2 long, file long, row long, doc_id long, n_lines int, places array<int>, held long"


def _stream(holders: int):
    """Decides the rows of a sorted partition in one pass.

    Rows out are those to drop (``held`` null, hash null), those whose hash may go on in a neighbouring partition
    (``held`` null, hash given), and for the first and the last hash of the partition their number of rows ``held``
    with their largest document. A hash that starts inside the partition has its keeper here, so its rows are dropped
    as soon as there are enough of them; fewer than ``holders`` rows wait at any time.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: pa.Table | None = None
        key, seen, top, first = None, 0, None, True  # of the run that the last batch ended in; first: it is the partition's first

        def border() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"h1": key[0], "h2": key[1], "doc_id": top, "held": seen}], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if wait is None else pa.concat_tables([wait, pa.Table.from_batches([batch])])
            schema = rows.schema.append(pa.field("held", pa.int64()))
            waited = 0 if wait is None else wait.num_rows
            wait = None
            h1, h2 = rows.column("h1").to_numpy(), rows.column("h2").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            sizes = np.diff(np.append(starts, len(h1)))
            tops = rows.column("doc_id").take(pa.array(starts)).to_pylist()
            goes_on = key == (int(h1[0]), int(h2[0]))
            if key is not None and not goes_on and first:
                yield border()
            began_first = first if goes_on or key is None else False
            total = sizes.copy()
            if goes_on:
                total[0] += seen - waited
                tops[0] = top
            docs = rows.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
            best = np.array([np.iinfo(np.int64).min if t is None else t for t in tops], np.int64)
            run = np.repeat(np.arange(len(starts)), sizes)
            drop = (total[run] >= holders) & (docs != best[run])
            undecided = (run == 0) & began_first
            last = len(starts) - 1
            if not (last == 0 and began_first) and total[last] < holders:
                wait = rows.slice(int(starts[last]))
            yield from _out(rows, drop & ~undecided, False)
            yield from _out(rows, undecided, True)
            if last and began_first:
                key, seen, top = (int(h1[0]), int(h2[0])), int(total[0]), tops[0]
                yield border()
            key, seen, top, first = (int(h1[-1]), int(h2[-1])), int(total[last]), tops[last], last == 0 and began_first
        if key is not None:
            yield border()
            if wait is not None:
                yield from _out(wait, np.ones(wait.num_rows, bool), True)

    return stream


def _out(rows: pa.Table, chosen: np.ndarray, named: bool) -> Iterator[pa.RecordBatch]:
    at = np.flatnonzero(chosen)
    if len(at):
        found = rows.take(pa.array(at))
        if not named:
            found = found.set_column(0, "h1", pa.nulls(len(at), pa.int64())).set_column(1, "h2", pa.nulls(len(at), pa.int64()))
        yield from found.append_column("held", pa.nulls(len(at), pa.int64())).combine_chunks().to_batches()


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, counts = [], []
        for n, lists in zip(batch.column("n_lines").to_pylist(), batch.column("places").to_pylist(), strict=True):
            keep = np.ones(n, np.uint8)
            keep[np.concatenate([np.asarray(x, np.int64) for x in lists])] = 0
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            counts.append(n - int(keep.sum()))
        columns = [batch.column("file"), batch.column("row"), pa.array(counts, pa.int64()), pa.array(maps, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "row", "n_dropped", "bitmap"])


def _keep_bitmaps(texts: DataFrame, least: int, holders: int) -> DataFrame:
    order = ["h1", "h2", F.col("doc_id").desc_nulls_last(), "file", "row"]
    # written, since dealing by range reads its input twice
    found = materialise(_holders(texts, least))
    ranged = found.repartitionByRange(partitions(texts.sparkSession), *order).sortWithinPartitions(*order)
    decided = materialise(ranged.mapInArrow(_stream(holders), _DECIDED))
    # two hashes per partition at most
    borders = materialise(decided.where("held IS NOT NULL").groupBy("h1", "h2").agg(F.sum("held").alias("total"), F.max("doc_id").alias("top")))
    rest = decided.where("held IS NULL")
    crossing = rest.where("h1 IS NOT NULL").join(borders, ["h1", "h2"]).where((F.col("total") >= holders) & ~F.col("doc_id").eqNullSafe(F.col("top")))
    lost = rest.where("h1 IS NULL").select(*_PLACE, "n_lines", "places").unionByName(crossing.select(*_PLACE, "n_lines", "places"))
    per_document = lost.groupBy(*_PLACE).agg(F.first("n_lines").alias("n_lines"), F.collect_list("places").alias("places"))
    return per_document.mapInArrow(_bitmaps, "file long, row long, n_dropped long, bitmap binary")


def kept_lines(text: str, bitmap: bytes | None) -> str:
    """The lines of ``text`` whose bit is set, joined again; without a bitmap all of them."""
    if bitmap is None:
        return text
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines), bitorder="little")
    return "\n".join([lines[i] for i in np.flatnonzero(keep).tolist()])


def deduplicated(docs: DataFrame, carry: Sequence[str] = (), least: int = LEAST, holders: int = HOLDERS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_lines``, ``n_dropped``, ``bitmap``, ``text``, ``carry``.

    Lines are cut at line feeds; their key has the blanks at both ends stripped and A-Z lower-cased. A key of at least
    ``least`` code points in at least ``holders`` documents stays only in the documents with its largest ``doc_id``, on
    all its lines there. ``text`` holds the lines that stay, ``bitmap`` their compressed bits (lowest bit first); it is
    null where all lines stay. ``n_lines`` counts the lines before.

    Null and empty texts are one empty line. Every row is a document of its own, so repeated rows count each; rows that
    share the largest id all keep the line; a null id is smaller than any other. An empty table gives an empty result.
    Equal lines are told by 128-bit hashes, rows by a 64-bit hash of their file's name and their number in it.
    """
    texts = _texts(docs, carry)
    bitmaps = _keep_bitmaps(texts.select(*_PLACE, "doc_id", "text"), least, holders)
    joined = texts.join(bitmaps.hint("shuffle_hash"), _PLACE, "left")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            texts, maps = batch.column("text").to_pylist(), batch.column("bitmap")
            counts = pa.array([t.count("\n") + 1 for t in texts], pa.int64())
            kept = pa.array([kept_lines(t, m) for t, m in zip(texts, maps.to_pylist(), strict=True)], pa.string())
            columns = [batch.column("doc_id"), counts, batch.column("n_dropped").fill_null(0), maps, kept, *[batch.column("carried").field(i + 1) for i in range(len(carry))]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "bitmap", "text", *carry])

    out = T.StructType().add("doc_id", "long").add("n_lines", "long").add("n_dropped", "long").add("bitmap", "binary").add("text", "string")
    for name in carry:
        out = out.add(texts.schema["carried"].dataType[name])
    return joined.mapInArrow(each, out)

"""Near duplicates by SimHash and multi-index hashing.

A fingerprint has two segments of 32 bits. Fingerprints that differ in at most three bits differ in at most one
bit of one segment, so each one looks up the ball of radius one around both of its segments in the table of all
segments, and the full distance is checked on every match.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import bodies, partitions
from kindred.session import materialise

WORDS, SEED, DISTANCE = 3, 42, 3
#: Table rows of one segment value that one group compares; more rows are dealt to several groups.
CHUNK = 2048
_SEGMENT = 32


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of the word shingles of ``text``, as a signed 64-bit number.

    Words are cut at blanks and at tab to carriage return, with A-Z lower-cased. Fewer words than a shingle has
    count as one shingle; no word gives zero.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined, width = b" ".join(found), min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, carry: Sequence[str] = (), words: int = WORDS) -> DataFrame:
    """``row``, ``doc_id``, ``fp`` and ``carry`` of every row of ``docs``; a null text is empty."""
    docs = bodies(docs, carry)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(text, words) for text in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "doc_id", *carry)], found], names=["row", "doc_id", *carry, "fp"])

    return docs.mapInArrow(each, T.StructType([f for f in docs.schema.fields if f.name != "text"]).add("fp", "long"))


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    """Both segment values of every fingerprint; the bit above the value tells the segments apart."""
    return [fps & np.uint64(0xFFFFFFFF), (fps >> np.uint64(_SEGMENT)) | np.uint64(1 << _SEGMENT)]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        keys = np.concatenate(_segments(fps))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.tile(fps, 2).view(np.int64))], names=["key", "fp"])


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ball of radius one, but the centre: each segment with one of its set bits cleared.

    Of two segments that differ in one bit, one has the bit set, so every such pair is met once.
    """
    masks = np.uint64(1) << np.arange(_SEGMENT, dtype=np.uint64)
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for values in _segments(fps):
            row, bit = np.nonzero(values[:, None] & masks[None, :])
            yield pa.RecordBatch.from_arrays([pa.array((values[row] ^ masks[bit]).view(np.int64)), pa.array(fps[row].view(np.int64))], names=["key", "fp"])


def _linked(group: np.ndarray, probes: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges that connect what the table rows ``group`` and the ``probes`` connect: no more than a few per row."""
    left, right = [], []
    near = np.bitwise_count(group[:, None] ^ group[None, :]) <= distance
    label = np.full(len(group), -1)
    for i in range(len(group)):
        if label[i] >= 0:
            continue
        member = np.zeros(len(group), bool)
        member[i] = True
        frontier = member
        while frontier.any():
            reached = near[frontier].any(axis=0) & ~member
            member |= reached
            frontier = reached
        label[member] = i
        others = np.flatnonzero(member)[1:]
        left.append(group[others])
        right.append(np.full(len(others), group[i]))
    for at in range(0, len(probes), 1024):
        part = probes[at : at + 1024]
        near = np.bitwise_count(part[:, None] ^ group[None, :]) <= distance
        hit = np.flatnonzero(near.any(axis=1))
        first = near[hit].argmax(axis=1)
        left.append(part[hit])
        right.append(group[first])
        lowest = np.where(near[hit], label[None, :], len(label)).min(axis=1)
        highest = np.where(near[hit], label[None, :], -1).max(axis=1)
        for i in hit[lowest != highest]:
            met = np.unique(label[near[i]])
            if len(met) > 1:  # the probe joins groups that were apart
                left.append(np.full(len(met), part[i]))
                right.append(group[met])
                label[np.isin(label, met)] = met[0]
    return left, right


def _link(distance: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Reads rows sorted by (key, part, probe); a group that a batch cuts is finished with the next batch."""
        rest = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
            same = (rest[0] == rest[0][-1]) & (rest[1] == rest[1][-1])
            cut = len(same) if not same.any() else int(np.argmax(same))
            yield from groups([x[:cut] for x in rest])
            rest = [x[cut:] for x in rest]
        if rest is not None:
            yield from groups(rest)

    def groups(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, part, probe, fp = columns
        if not len(key):
            return
        fps = fp.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
        ends = np.append(starts[1:], len(key))
        probed = np.concatenate([[0], np.cumsum(probe)])
        tabled = (ends - starts) - (probed[ends] - probed[starts])
        left, right = [], []
        for i in np.flatnonzero((tabled > 0) & (ends - starts > 1)):
            middle = starts[i] + tabled[i]
            a, b = _linked(fps[starts[i] : middle], fps[middle : ends[i]], distance)
            left += a
            right += b
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["a", "b"])

    return link


def links(prints: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints ``fp`` that connect all fingerprints linked by at most ``distance`` bits.

    Edges of a group form a spanning tree of it, not all its pairs. A segment value that more than ``chunk``
    fingerprints share is dealt to several groups: table rows to one of them, look-ups to each.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two segments with balls of radius one find distances up to three")
    entries, probes = prints.mapInArrow(_entries, "key long, fp long"), prints.mapInArrow(_probes, "key long, fp long")
    large = materialise(entries.groupBy("key").count().where(F.col("count") > chunk).select("key", F.ceil(F.col("count") / chunk).alias("parts")))
    parts = F.coalesce("parts", F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    tabled = entries.join(large, "key", "left").select("key", "fp", parts.alias("parts"), own.alias("part"))
    asked = probes.join(large, "key", "left").select("key", "fp", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    # table rows of a divided value also look into the later groups
    across = tabled.where("part + 1 < parts").select("key", "fp", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("part"))
    rows = tabled.select("key", "part", F.lit(0).alias("probe"), "fp").unionByName(asked.unionByName(across).select("key", "part", F.lit(1).alias("probe"), "fp"))
    placed = rows.repartition(partitions(prints.sparkSession), "key", "part").sortWithinPartitions("key", "part", "probe", "fp")
    return placed.mapInArrow(_link(distance), "a long, b long")


def _larger_to_smallest(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _smaller_to_smallest(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``a`` and the smallest vertex ``b`` of its component, for all vertices but the smallest ones.

    Alternates two steps that hang neighbours on smaller vertices until nothing changes; each round is a written
    table, so a lost executor repeats one round at most.
    """
    state = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        total = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if total == seen or total[0] == 0:
            return state
        seen = total
        state = materialise(_smaller_to_smallest(_larger_to_smallest(state)))


def near_groups(docs: DataFrame, carry: Sequence[str] = (), words: int = WORDS, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """``row``, ``doc_id``, ``fp``, ``component_id`` (smallest ``doc_id`` reachable), ``first_row`` and ``carry`` of every row.

    Equal fingerprints are one vertex, whatever their number. Null texts are empty texts; all empty texts share the
    fingerprint zero. Null ids count as largest: ``component_id`` is null only where no member has an id.
    ``first_row`` is the row of the member with that id, one of them if rows are repeated.
    """
    rows = materialise(fingerprints(docs, carry, words))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")))
    prints = materialise(rows.groupBy("fp").agg(first.alias("first")))
    found = components(materialise(links(prints.select("fp"), distance, chunk)))
    rooted = prints.join(found, prints["fp"] == found["a"], "left").select("fp", F.coalesce("b", "fp").alias("root"), "first")
    tops = rooted.groupBy("root").agg(F.min("first").alias("top"))
    member = rooted.select("fp", "root").join(tops, "root").select("fp", F.col("top.doc_id").alias("component_id"), F.col("top.row").alias("first_row"))
    return rows.join(materialise(member), "fp")

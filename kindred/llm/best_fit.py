"""Packing of tokenised documents into sequences of fixed length by best-fit decreasing, certified by lower bounds.

Pieces are dealt to partitions by hash and packed there. Dual feasible functions bound the bins a partition needs
from below. Partitions that need more than their bound give the documents of their unfilled bins to a common
pool, which is dealt and packed anew, until the bounds are met or a round saves nothing.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import bodies, ceil_div, kept_in_worker
from kindred.session import materialise

#: Tokens in a sequence, pieces packed by one task, rounds of exchange, words whose ids a worker keeps.
CAPACITY, PIECES_PER_PART, ROUNDS, CACHE = 1024, 50_000, 4, 800_000


#: Letters of the texts that are looked up together.
_LETTERS = 2_000_000


class WordTokenizer:
    """Ids of whole texts, with the ids of words kept.

    The tokenizer's splitting rule starts a new token at a space or line break between two other characters, whatever
    stands around it. So a text in which white space never touches white space has the ids of its
    words, each with the space or line break before it. Other texts are tokenised in one go.
    """

    def __init__(self, path: str, cache: int = CACHE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # texts that hold one of these are tokenised in one go
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._cache = cache
        self._forget()
        # the id of a line break, which no word without one has among its ids
        self._break = self._tokenizer.encode("\n", add_special_tokens=False).ids[0]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        """No word is kept: the words, their ids one after another, where those of each begin, and which have none."""
        self._words = pa.array([], pa.large_string())
        self._ids, self._begins, self._odd = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, bool)

    def _learn(self, words: list[str]) -> None:
        """Keeps the ids of new words; none for a word in which white space touches the space or break around it."""
        odd = {w for w in words if not w or w[-1].isspace() or w[:2].lstrip("\n")[:1].isspace()}
        found = dict.fromkeys(odd, b"")
        # words with white space inside or before them on their own; the others in long texts, one to a line
        broken = [w for w in words if w not in odd and w.split() != [w]]
        found.update(zip(broken, self._plain([w if w[0] == "\n" else " " + w for w in broken]), strict=True))
        plain = [w for w in words if w not in found]
        for at in range(0, len(plain), 64_000):
            groups = [plain[i : i + 1000] for i in range(at, min(at + 64_000, len(plain)), 1000)]
            for group, ids in zip(groups, self._plain(["\n ".join(["", *group])[1:] for group in groups]), strict=True):
                found.update(zip(group, _split(ids, self._break), strict=True))
        data = [found[w] for w in words]
        self._words = pa.concat_arrays([self._words, pa.array(words, pa.large_string())])
        self._ids = np.concatenate([self._ids, np.frombuffer(b"".join(data), "<u4")])
        self._begins = np.concatenate([self._begins, self._begins[-1] + np.cumsum([len(d) // 4 for d in data], dtype=np.int64)])
        self._odd = np.concatenate([self._odd, np.array([w in odd for w in words], bool)])

    def _places(self, words: pa.Array) -> np.ndarray:
        """The places of distinct words among the kept ones; those that are not kept yet are learned."""
        if len(self._words) > self._cache:
            self._forget()
        # the kept words are looked up among the given ones, of which there are fewer, so the table made for each call is small
        found = pc.index_in(self._words, value_set=words)
        met = found.is_valid().to_numpy(zero_copy_only=False)
        kept = len(self._words)
        places = np.full(len(words), -1, np.int64)
        places[found.drop_null().to_numpy()] = np.flatnonzero(met)
        new = places < 0
        if new.any():
            self._learn(words.filter(pa.array(new)).to_pylist())
            places[new] = np.arange(kept, len(self._words))
        return places

    def encode(self, texts: Sequence[str]) -> Iterator[bytes]:
        """32-bit ids of every text, as bytes."""
        part: list[str] = []
        letters = 0
        for text in texts:
            part.append(text)
            letters += len(text)
            if letters > _LETTERS:
                yield from self._encode(part)
                part, letters = [], 0
        if part:
            yield from self._encode(part)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        # texts with an added token are left whole, like empty ones
        parts = pa.array(["" if any(t in text for t in self._added) else text.replace("\n", " \n") for text in texts], pa.large_string())
        lists = pc.split_pattern(parts, " ")
        offsets = lists.offsets.to_numpy()
        first = offsets[:-1]
        coded = lists.flatten().dictionary_encode()
        of_word, words = coded.indices.to_numpy(), coded.dictionary
        # the first word of a text has no space before it
        body = np.ones(len(of_word), bool)
        body[first] = False
        used = np.zeros(len(words), bool)
        used[of_word[body]] = True
        places = np.zeros(len(words), np.int64)
        places[used] = self._places(words.filter(pa.array(used)))
        place = places[of_word[body]]
        begins, sizes, odd = np.zeros(len(of_word), np.int64), np.zeros(len(of_word), np.int64), np.zeros(len(of_word), bool)
        begins[body], sizes[body], odd[body] = self._begins[place], self._begins[place + 1] - self._begins[place], self._odd[place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = self._ids[np.repeat(begins - ends[:-1], sizes) + np.arange(ends[-1])]
        heads = words.take(pa.array(of_word[first])).to_pylist()
        broken = np.logical_or.reduceat(odd, first).tolist()
        # a text that starts with white space is left whole
        whole = [b or not head or head[0].isspace() or head[-1].isspace() for b, head in zip(broken, heads, strict=True)]
        begun = self._plain([text if all_of_it else head for text, head, all_of_it in zip(texts, heads, whole, strict=True)])
        for head, all_of_it, a, b in zip(begun, whole, ends[offsets[:-1]].tolist(), ends[offsets[1:]].tolist(), strict=True):
            yield head if all_of_it else head + flat[a:b].tobytes()


def _split(data: bytes, separator: int) -> list[bytes]:
    ids = np.frombuffer(data, "<u4")
    at = 4 * np.flatnonzero(ids == separator)
    return [data[a:b] for a, b in zip([0, *(at + 4).tolist()], [*at.tolist(), len(data)], strict=True)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int | None = 2, carry: Sequence[str] = (), keep_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``row``, ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``carry`` and, unless left out, ``ids``.

    A document is the ids of its text (null: empty) and then ``end``. Longer documents are cut so that all pieces but the
    first are full. ``tokenizer`` is the file of a public vocabulary.
    """
    docs = bodies(docs, carry)
    names = ["row", "doc_id", *carry]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_worker(f"words of {tokenizer}", lambda: WordTokenizer(tokenizer))
        tail = b"" if end is None else np.array([end], "<u4").tobytes()
        for batch in batches:
            place, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, data in enumerate(words.encode(batch.column("text").to_pylist())):
                data += tail
                total = len(data) // 4
                first = total - capacity * max(ceil_div(total, capacity) - 1, 0)
                for k, (a, b) in enumerate(zip([0, *range(first, total, capacity)], [*range(first, total, capacity), total], strict=True)):
                    place.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a : 4 * b]))
                    if keep_ids:
                        ids.append(np.frombuffer(data[4 * a : 4 * b], "<i4"))
            at = pa.array(place, pa.int64())
            columns = [batch.column(c).take(at) for c in names]
            columns += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            columns += [pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    out = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    out = out.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    if keep_ids:
        out = out.add("ids", T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(cut, out)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, ``counts[l]`` items having length ``l``: the best of two families of dual feasible functions."""
    sizes = np.arange(capacity + 1)
    best = 0
    for cut in range(capacity // 2 + 1):
        value = np.where(sizes > capacity - cut, capacity, np.where(sizes >= cut, sizes, 0))
        best = max(best, ceil_div(int(value @ counts), capacity))
    for k in range(1, 33):
        # in k-ths of a bin, scaled by the capacity so that all numbers are whole
        scaled = sizes * (k + 1)
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, ceil_div(int(value @ counts), capacity * k))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, items taken longest first; and how full each bin is."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has room r
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        left -= size
        room[b] = left
        if left:
            open_bins[left].append(b)
            mask |= 1 << left
    return bins, offsets, capacity - np.array(room, np.int64)


def _packer(capacity: int, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack_part(part: pd.DataFrame) -> pd.DataFrame:
        lengths = part["length"].to_numpy()
        order = np.lexsort((part["piece"].to_numpy(), part["row"].to_numpy()))  # the same packing in every attempt
        part, lengths = part.iloc[order], lengths[order]
        bins, offsets, filled = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        number = (int(part["part"].iloc[0]) * (ROUNDS + 1) + turn << 24) + bins
        return part.assign(sequence_id=number, offset=offsets, filled=filled[bins], gap=len(filled) - bound).drop(columns="part")

    return pack_part


def _deal(items: DataFrame, count: int, capacity: int, per_part: int, turn: int) -> DataFrame:
    parts = max(1, ceil_div(count, per_part << turn))
    dealt = items.withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "row", "piece"), F.lit(parts)).cast("int"))
    out = T.StructType([*items.schema.fields]).add("sequence_id", "long").add("offset", "long").add("filled", "long").add("gap", "long")
    return materialise(dealt.groupBy("part").applyInPandas(_packer(capacity, turn), out))


def _bins(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def pack(items: DataFrame, capacity: int = CAPACITY, per_part: int = PIECES_PER_PART, rounds: int = ROUNDS) -> DataFrame:
    """``items`` (``row``, ``piece``, ``length`` up to ``capacity``, and others) with ``sequence_id`` and ``offset``.

    Every item gets one place; places in a sequence follow each other without gaps from 0. An empty table stays empty.
    ``items`` should be a written table. Each round's partitions hold twice the pieces of the last round's. A partition's bins are certified where they equal its bound; the
    others' unfilled bins are pooled. Once all are certified, unfilled bins of all partitions are pooled as long as the
    bound of the whole corpus, from the counts of its at most ``capacity`` lengths, is not met.
    """
    rounds = min(rounds, ROUNDS)
    sizes = np.zeros(capacity + 1, np.int64)
    for length, n in items.groupBy("length").count().collect():
        sizes[length] = n
    bound = lower_bound(sizes, capacity)
    packed = _deal(items, int(sizes.sum()), capacity, per_part, 0)
    total = _bins(packed)
    for turn in range(1, rounds + 1):
        if total <= bound:
            break
        unfilled = F.col("filled") < capacity
        uncertified = unfilled & (F.col("gap") > 0)
        pooled = uncertified if turn == 1 and not packed.where(uncertified).isEmpty() else unfilled
        pool = packed.where(pooled).select(*items.columns)
        old = packed.where(pooled & (F.col("offset") == 0)).count()
        pieces_left = pool.count()
        new = _deal(pool, pieces_left, capacity, per_part, turn)
        now = _bins(new)
        if now < old:
            packed = materialise(packed.where(~pooled).unionByName(new))
            total += now - old
        elif pieces_left <= per_part << turn:
            break  # all of them in one task, and nothing saved
    return packed.select(*items.columns, "sequence_id", "offset")

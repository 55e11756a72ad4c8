"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the model's compiled character map: at every place the longest prefix that the map knows is
replaced, and each character made remembers the bytes it came from. The normalised text is cut before its white space, each
part is merged by the scores of the pieces, and every piece gets the span of original bytes that its characters came from.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kindred.llm.common import bodies, kept_in_worker

SPACE = "▁"
#: Parts whose pieces a worker keeps.
CACHE = 1_000_000
_NEVER = float("-inf")
# fixed values: kinds of pieces in the model format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """The compiled map: a double-array trie over bytes, and the replacements its leaves point to."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self._units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self._texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``data`` from ``at``."""
        if not self._units:
            return None
        found = None
        node = self._step(0, self._units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self._units) or self._units[node] & 0x800000FF != data[i]:
                break
            unit = self._units[node]
            node = self._step(node, unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self._units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, place = found
        return length, self._texts[place : self._texts.index(0, place)]

    @staticmethod
    def _step(node: int, unit: int) -> int:
        return node ^ (unit >> 10) << ((unit & 1 << 9) >> 6)


class PieceModel:
    """A model file with byte-pair merges: encodes, decodes, and projects pieces to bytes."""

    def __init__(self, path: str, cache: int = CACHE) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as file:
            model = proto.ModelProto.FromString(file.read())
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError("only models with plain byte-pair merges are supported")
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self._prefix, self._strip, self._escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self._identity = not spec.precompiled_charsmap and self._prefix and not self._strip and self._escape
        #: Whether every byte of a text lies in the span of a piece.
        self.keeps_bytes = not spec.precompiled_charsmap and not self._strip
        self._ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self._scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self._unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self._byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        if not self._byte:
            raise ValueError("only models with byte pieces are supported")
        self._byte_of = {i: b for b, i in self._byte.items()}
        # a byte below 128 is a character whatever stands around it
        of_byte = {i: chr(b) for i, b in self._byte_of.items() if b < 0x80}
        self._pieces = [" ⁇ " if p.type == UNKNOWN else "" if p.type == CONTROL else of_byte.get(i, p.piece.replace(SPACE, " ")) for i, p in enumerate(model.pieces)]
        self._plain = np.array([p.type != BYTE or i in of_byte for i, p in enumerate(model.pieces)])
        #: Bytes of a text that each piece stands for; a space counts as one.
        self._sizes = np.array([1 if p.type == BYTE else len(p.piece.replace(SPACE, " ").encode()) for p in model.pieces], "<i4")
        self._library = SentencePieceProcessor(model_file=path)
        self._cache: dict[str, tuple[bytes, bytes, str]] = {}
        self._limit = cache

    def normalise(self, text: str) -> tuple[str, list[int], list[int]]:
        """The normalised text, and for each of its characters the first byte and the byte after the last it came from."""
        data = text.encode("utf-8", "surrogatepass")
        out: list[str] = []
        begins: list[int] = []
        ends: list[int] = []
        at = 0
        while at < len(data):
            known = self.map.longest(data, at)
            if known:
                length, made = known[0], known[1].decode()
            else:
                length = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                made = data[at : at + length].decode("utf-8", "replace")
            for c in made:
                if self._strip and c == " " and (not out or out[-1] == " "):
                    continue
                out.append(c)
                begins.append(at)
                ends.append(at + length)
            at += length
        while self._strip and out and out[-1] == " ":
            out.pop()
        del begins[len(out) :], ends[len(out) :]
        if self._prefix and out:
            out, begins, ends = [" ", *out], [begins[0], *begins], [begins[0], *ends]
        joined = "".join(out)
        return joined.replace(" ", SPACE) if self._escape else joined, begins, ends

    def _merge(self, part: str) -> list[str]:
        """Pieces of a part: the adjacent pair whose joint piece scores best is merged, the leftmost of equals, until none is left."""
        symbols = list(part)
        scores = self._scores
        if len(symbols) <= 24:
            near = [scores.get(x + y, _NEVER) for x, y in pairwise(symbols)]
            while near and (best := max(near)) != _NEVER:
                at = near.index(best)
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                del near[at]
                if at:
                    near[at - 1] = scores.get(symbols[at - 1] + symbols[at], _NEVER)
                if at < len(near):
                    near[at] = scores.get(symbols[at] + symbols[at + 1], _NEVER)
            return symbols
        # long parts: a heap of candidate merges over a linked list
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (s := scores.get(symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-s, i, j, len(symbols[i]) + len(symbols[j])))

        for i in range(len(symbols)):
            offer(i)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not symbols[i] or not symbols[j] or after[i] != j or len(symbols[i]) + len(symbols[j]) != size:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s]

    def _part(self, part: str) -> tuple[list[int], list[str]]:
        """Ids of a part, and the characters each stands for; the bytes of an unknown character share it, the last one holds it."""
        ids, stands = [], []
        for piece in self._merge(part):
            known = self._ids.get(piece)
            if known is not None:
                ids.append(known)
                stands.append(piece)
                continue
            for c in piece:
                data = c.encode("utf-8", "surrogatepass")
                ids += [self._byte[b] for b in data]
                stands += [""] * (len(data) - 1) + [c]
        return ids, stands

    def _kept(self, part: str) -> tuple[bytes, bytes, str]:
        """Ids as 32-bit numbers, bytes of the text that each stands for, and ids as text, of a part that starts with one space each."""
        ids, stands = self._part(part)
        sizes = []
        for i, piece in zip(ids, stands, strict=True):
            sizes.append(1 if i in self._byte_of else len(piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")))
        return np.array(ids, "<i4").tobytes(), np.array(sizes, "<i4").tobytes(), ",".join(map(str, ids))

    def _parts(self, text: str) -> list[tuple[bytes, bytes, str]]:
        """The kept parts of a text that the model leaves as it is, but for spaces; merges never cross from a word to the next space."""
        units = text.split(" ")
        if "" in units:
            units = re.findall(r" *[^ ]+| +$", " " + text)
            units = [u[1:] for u in units]
        if len(self._cache) > self._limit:
            self._cache.clear()
        cache = self._cache
        if new := set(units).difference(cache):
            self._learn(new)
        return [cache[unit] for unit in units]

    def _learn(self, units: set[str]) -> None:
        """Keeps new parts. The library merges those without spaces, many in one call, exactly as inside a text: the space it puts before each is their own."""
        plain = [u for u in units if u and " " not in u]
        for unit in units.difference(plain):
            self._cache[unit] = self._kept(SPACE + unit.replace(" ", SPACE))
        lists = self._library.encode(plain, num_threads=1) if plain else []
        ids = np.array([i for found in lists for i in found], "<i4")
        data, sizes = ids.tobytes(), self._sizes[ids].tobytes()
        at = 0
        for unit, found in zip(plain, lists, strict=True):
            end = at + 4 * len(found)
            self._cache[unit] = (data[at:end], sizes[at:end], ",".join(map(str, found)))
            at = end

    def _simple(self, text: str) -> bool:
        return self._identity and bool(text) and SPACE not in text

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first byte and the byte after the last of each piece's span in the UTF-8 text.

        Spans follow each other. The space that the model puts before a text is no byte of it. Characters that the map makes
        of the same bytes share those bytes.
        """
        if self._simple(text):
            parts = self._parts(text)
            ids = np.frombuffer(b"".join([p[0] for p in parts]), "<i4")
            ends = np.frombuffer(b"".join([p[1] for p in parts]), "<i4").cumsum() - 1
            begins = np.concatenate([[0], ends[:-1]])
            return ids, begins, ends
        normal, first, last = self.normalise(text)
        ids, begins, ends = [], [], []
        at = 0
        for part in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+$", normal):
            found, stands = self._part(part)
            width = 0  # bytes of a character that are already given
            for i, piece in zip(found, stands, strict=True):
                ids.append(i)
                if i in self._byte_of:
                    whole = last[at] - first[at]
                    begins.append(first[at] + min(width, whole))
                    width += 1
                    ends.append(last[at] if piece else first[at] + min(width, whole))
                else:
                    begins.append(first[at])
                    ends.append(last[at + len(piece) - 1])
                if piece:
                    width = 0
                    at += len(piece)
        return np.array(ids, "<i4"), np.array(begins, np.int64), np.array(ends, np.int64)

    def traced(self, text: str) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        """Ids, the same as decimals joined by commas, and the spans of the pieces as ``encode`` gives them."""
        if self._simple(text):
            parts = self._parts(text)
            ends = np.frombuffer(b"".join([p[1] for p in parts]), "<i4").cumsum() - 1
            return np.frombuffer(b"".join([p[0] for p in parts]), "<i4"), ",".join([p[2] for p in parts]), np.concatenate([[0], ends[:-1]]), ends
        ids, begins, ends = self.encode(text)
        return ids, ",".join(map(str, ids.tolist())), begins, ends

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD each. The space put before a text is taken off again."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        if self._plain[ids].all():
            text = "".join(map(self._pieces.__getitem__, ids.tolist()))
        else:
            parts, run = [], bytearray()
            for i in ids.tolist():
                if not self._plain[i]:
                    run.append(self._byte_of[i])
                    continue
                if run:
                    parts.append(_utf8(bytes(run)))
                    run.clear()
                parts.append(self._pieces[i])
            parts.append(_utf8(bytes(run)))
            text = "".join(parts)
        if self._pieces[int(ids[0])][:1] == " " and int(ids[0]) not in self._byte_of and ids[0] != self._unknown and (self._prefix or self._strip):
            return text.lstrip(" ") if self._strip else text[1:]
        return text


def _utf8(data: bytes) -> str:
    """The text of bytes with U+FFFD for each byte that starts no whole character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode(docs: DataFrame, model: str, carry: Sequence[str] = ()) -> DataFrame:
    """``row``, ``doc_id``, ``carry``, ``ids``, ``begins``, ``ends`` of every row of ``docs``: pieces and their byte spans; a null text is empty."""
    docs = bodies(docs, carry)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceModel(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [codec.encode(text) for text in part.column("text").to_pylist()]
                columns = [part.column(c) for c in ("row", "doc_id", *carry)]
                columns += [pa.array([f[k] for f in found], pa.list_(kind)) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    out = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    out = out.add("ids", T.ArrayType(T.IntegerType())).add("begins", T.ArrayType(T.LongType())).add("ends", T.ArrayType(T.LongType()))
    return docs.mapInArrow(each, out)


def _covered(text: str, begins: np.ndarray, ends: np.ndarray, share: bool) -> int:
    """Bytes that the spans cover. Spans follow each other without gaps; with a character map (``share``) they may share bytes, and stripped blanks have none."""
    size = len(text.encode("utf-8", "surrogatepass"))
    if not len(ends):
        return 0
    if not share and (begins[0] != 0 or ends[-1] != size or (begins[1:] != ends[:-1]).any()):
        raise ValueError("the spans of the pieces leave bytes of the text out")
    return int(ends[-1] - begins[0])


def digests(docs: DataFrame, model: str, carry: Sequence[str] = ()) -> DataFrame:
    """``row``, ``doc_id``, ``carry``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``n_bytes``, ``spans_sha256`` of every row.

    They are made of what ``encode`` and ``decode`` give, without moving it. ``n_bytes`` are the bytes of the text that the
    spans cover, ``spans_sha256`` is taken of the first bytes and then of the ends, as little-endian 64-bit numbers. Where the
    model has no character map and strips nothing, spans that leave a byte of the text out are an error.
    """
    docs = bodies(docs, carry)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_in_worker(f"pieces of {model}", lambda: PieceModel(model))
        for batch in batches:
            counts, ids_digests, text_digests, covered, spans = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                ids, listed, begins, ends = codec.traced(text)
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(listed.encode()).hexdigest())
                text_digests.append(hashlib.sha256(codec.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
                covered.append(_covered(text, begins, ends, not codec.keeps_bytes))
                spans.append(hashlib.sha256(begins.astype("<i8").tobytes() + ends.astype("<i8").tobytes()).hexdigest())
            columns = [batch.column(c) for c in ("row", "doc_id", *carry)]
            columns += [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(covered, pa.int64()), pa.array(spans, pa.string())], names=out.names)

    out = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    out = out.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string").add("n_bytes", "long").add("spans_sha256", "string")
    return docs.mapInArrow(each, out)


def decode(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``ids`` replaced by ``decoded``; null ids decode to the empty text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceModel(model)
        for batch in batches:
            texts = pa.array([codec.decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], texts], names=out.names)

    kept = [c for c in rows.columns if c != ids]
    out = T.StructType([f for f in rows.schema.fields if f.name != ids]).add("decoded", "string")
    return rows.mapInArrow(each, out)

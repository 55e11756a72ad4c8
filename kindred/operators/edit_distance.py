"""Edit distances of many pairs at once: a column of the distance table is a few numbers of 64 bits, and a step takes the next letter of all pairs."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bits of a number, and pairs that are compared together.
BITS, PAIRS = 64, 16_384
ONE, TOP = np.uint64(1), np.uint64(BITS - 1)


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letters one after the other as numbers, where each text begins, and how many it has."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    signs = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    if signs.max(initial=0) < 128:
        return signs, ends[:-1], np.diff(ends)
    first = np.append((signs & 0xC0) != 0x80, True)
    place = np.cumsum(first) - first  # letters before each byte
    return np.frombuffer(signs.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32), place[ends[:-1]], np.diff(place[ends])


def _distances(bits: np.ndarray, size: np.ndarray, kind: np.ndarray, letters: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Distances of patterns to texts; ``bits[word, kind, letter]`` marks the places of a letter in a pattern of ``size`` letters."""
    order = np.argsort(-length, kind="stable")
    kind, start, length = kind[order], start[order], length[order]
    words, n = len(bits), len(order)
    flat, row = bits.reshape(words, -1), kind * bits.shape[2]
    more, less = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    score, last = size[order].astype(np.int64), ((size[order] - 1) % BITS).astype(np.uint64)
    left = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), side="right")  # texts with as many letters
    for at, k in enumerate(left.tolist()):
        place, up, down = row[:k] + letters[start[:k] + at], ONE, np.uint64(0)
        for w in range(words):
            same, plus, minus = flat[w].take(place), more[w, :k], less[w, :k]
            either = same | minus
            same = same | down
            across = (((same & plus) + plus) ^ plus) | same
            rises, falls = minus | ~(across | plus), plus & across
            end = last[:k] if w == words - 1 else TOP
            out = (rises >> end) & ONE, (falls >> end) & ONE
            rises, falls = (rises << ONE) | up, (falls << ONE) | down
            more[w, :k], less[w, :k] = falls | ~(either | rises), rises & either
            up, down = out
        score[:k] += up.astype(np.int64) - down.astype(np.int64)
    found = np.empty(n, np.int64)
    found[order] = score
    return found


class Prepared(NamedTuple):
    bits: np.ndarray  # bits[word, pattern, letter] marks the places of a letter in a pattern
    size: np.ndarray  # letters of each pattern
    letters: np.ndarray  # of all texts, one after the other, numbered
    start: np.ndarray  # where each text begins
    length: np.ndarray  # letters of each text


def prepared(patterns: pa.Array, texts: pa.Array) -> Prepared:
    signs, begin, size = _letters(patterns)
    letters, start, length = _letters(texts)
    known = np.unique(signs)
    # a number for every letter of the patterns, and one for all others
    number = np.full(max(int(signs.max(initial=0)), int(letters.max(initial=0))) + 1, len(known), np.int32)
    number[known] = np.arange(len(known))
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(row)) - begin[row]
    bits = np.zeros((-(-int(size.max(initial=1)) // BITS), len(size), len(known) + 1), np.uint64)
    np.bitwise_or.at(bits, (place // BITS, row, number[signs]), ONE << (place % BITS).astype(np.uint64))
    return Prepared(bits, size, number[letters], start, length)


def distances(known: Prepared, kind: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The edit distance, in letters, of each pattern, by its number, to the text in its place."""
    found = known.length[text].astype(np.int64)  # of an empty pattern
    words = -(-known.size[kind] // BITS)
    for w in np.unique(words[words > 0]).tolist():
        mine = np.flatnonzero(words == w)
        found[mine] = _distances(known.bits[:w], known.size[kind[mine]], kind[mine], known.letters, known.start[text[mine]], known.length[text[mine]])
    return found


def close_pairs(keywords: pa.Table, phrases: pa.Table, threshold: float) -> pa.Table:
    """``(phrase, keyword)`` of all pairs within the edits that ``threshold`` allows.

    Keywords are ``(keyword, size, a0 to a3)``, phrases ``(phrase, m, least, most, b0 to b3)``: letters, sizes of keywords that a phrase can
    be close to, and bags of letters, which rule most pairs out before the distance.
    """
    keywords = keywords.sort_by("size").combine_chunks()
    phrases = phrases.combine_chunks()
    text_of, phrase_of = (t.column(0).chunk(0) if t.num_rows else pa.array([], pa.string()) for t in (keywords, phrases))
    known = prepared(phrase_of, text_of)
    size = keywords.column("size").to_numpy()
    bags = [[t.column(f"{name}{i}").to_numpy() for i in range(4)] for t, name in ((keywords, "a"), (phrases, "b"))]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def compare() -> None:
        kind, text, edits = (np.concatenate(x) for x in zip(*held, strict=True))
        for at in range(0, len(kind), PAIRS):
            part = slice(at, at + PAIRS)
            close = distances(known, kind[part], text[part]) <= edits[part]
            found.append((kind[part][close], text[part][close]))
        held.clear()

    ranges = [np.searchsorted(size, phrases.column(c).to_numpy(), side) for c, side in (("least", "left"), ("most", "right"))]
    for p in np.argsort(known.size, kind="stable").tolist():  # those of as many numbers together
        first, last = int(ranges[0][p]), int(ranges[1][p])
        edits = np.floor(np.maximum(known.size[p], size[first:last]) * (1 - threshold) + 1e-9).astype(np.int64)
        lacking = [sum(np.bitwise_count(x(a[first:last], b[p])).astype(np.int64) for a, b in zip(*bags, strict=True)) for x in (lambda a, b: a & ~b, lambda a, b: b & ~a)]
        near = np.flatnonzero((lacking[0] <= edits) & (lacking[1] <= edits))
        held.append((np.full(len(near), p), near + first, edits[near]))
        if sum(len(x[0]) for x in held) >= PAIRS:
            compare()
    if held:
        compare()
    kind, text = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.array([], np.int64),) * 2
    return pa.table({"phrase": phrase_of.take(pa.array(kind)), "keyword": text_of.take(pa.array(text))})

"""Key phrase extraction (RAKE) per text, without a shuffle.

A text becomes phrases (word runs between stop words and punctuation). A word scores
degree / frequency, a phrase the sum over its words. Cutting the phrases is a Spark expression. Scoring
them needs a small group-by inside every text: higher-order functions take ten times the CPU for it and
an explode would shuffle the whole corpus, so it is one Arrow function over batches of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from kindred.functions.stopwords import ENGLISH
from kindred.functions.text import (
    PUNCTUATION,
    SENTENCE_END,
    WORD_OR_MARK,
    WORD_OR_MARKS,
    ascii_fold,
    let,
)

LIBRARY = "library"
CLASS = "class"
#: Phrases that are scored at a time: what Python holds does not grow with a batch of texts.
AT_ONCE = 50_000
_BREAK = "\x01"
_END = "\x02"


def candidate_phrases(text: Column, variant: str = LIBRARY, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Phrases of a text as strings, words separated by one blank.

    ``library``: distinct phrases, a run at the end of a sentence counts. ``class``: repeated phrases
    stay, a run without a terminator before the sentence end is lost.
    """
    pattern = {LIBRARY: WORD_OR_MARKS, CLASS: WORD_OR_MARK}[variant]
    breaks = list(stopwords) + list(PUNCTUATION)
    folded = F.lower(F.regexp_replace(ascii_fold(text), "[\x01\x02]", ""))
    marked = F.regexp_replace(folded, SENTENCE_END, f"$1 {_END} ")
    tokens = F.regexp_extract_all(marked, F.lit(pattern), F.lit(0))
    runs = F.array_join(F.transform(tokens, lambda t: F.when(t.isin(breaks), F.lit(_BREAK)).otherwise(t)), " ")
    if variant == LIBRARY:
        pieces = F.split(runs, f"[{_BREAK}{_END}]")
    else:
        pieces = F.flatten(
            F.transform(
                F.split(runs, _END),
                lambda s: let(F.split(s, _BREAK), lambda p: F.slice(p, F.lit(1), F.size(p) - 1)),
            )
        )
    phrases = F.filter(F.transform(pieces, lambda p: F.trim(p)), lambda p: p != "")
    return F.array_distinct(phrases) if variant == LIBRARY else phrases


# A number for the degree of a word: integers and decimals with a point.
NUMBER = r"^[+-]?([0-9]+|[0-9]+\.[0-9]*|\.[0-9]+)$"


def _weighed_words(phrases: pa.Array, variant: str) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Of phrase lists: all phrases, the text of each, and of all their words the phrase, the word and the weight."""
    flat = phrases.flatten()
    text_of = pc.list_parent_indices(phrases).to_numpy()
    words = pc.split_pattern(flat, " ")
    phrase_of = pc.list_parent_indices(words).to_numpy()
    word = words.flatten().dictionary_encode()
    if variant == LIBRARY:
        weight = pc.list_value_length(words).to_numpy()[phrase_of]
    else:
        counted = ~pc.match_substring_regex(words.flatten(), NUMBER).to_numpy(zero_copy_only=False)
        weight = np.bincount(phrase_of, counted, len(flat))[phrase_of]
    return flat, text_of, phrase_of, word, weight


def _word_batch(phrases: pa.Array, variant: str) -> pa.Array:
    """Phrase lists of a batch of texts to ``list<struct<word, freq, degree>>`` of their distinct words."""
    _, text_of, phrase_of, word, weight = _weighed_words(phrases, variant)
    slots = max(len(word.dictionary), 1)
    key, group = np.unique(text_of[phrase_of].astype(np.int64) * slots + word.indices.to_numpy(), return_inverse=True)
    found = np.bincount(key // slots, minlength=len(phrases))
    freq, degree = np.bincount(group, minlength=len(key)), np.bincount(group, weight, len(key))
    words = pa.StructArray.from_arrays([word.dictionary.take(pa.array(key % slots)), pa.array(freq, pa.int64()), pa.array(degree, pa.float64())], ["word", "freq", "degree"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(found)), pa.int32()), words)


def _score_batch(phrases: pa.Array, fraction: float, variant: str) -> pa.Array:
    """Phrase lists of a batch of texts to ranked ``list<struct<score, phrase>>``."""
    flat, text_of, phrase_of, word, weight = _weighed_words(phrases, variant)
    key = text_of[phrase_of].astype(np.int64) * max(len(word.dictionary), 1) + word.indices.to_numpy()
    _, group = np.unique(key, return_inverse=True)
    word_score = np.bincount(group, weight) / np.bincount(group)
    # rounded so that equal sums rank as equal
    score = np.floor(np.bincount(phrase_of, word_score[group], len(flat)) * 1e9 + 0.5) / 1e9
    table = pa.table({"text": text_of, "score": score, "phrase": flat})
    if variant == CLASS:
        table = table.group_by(["text", "phrase"]).aggregate([("score", "min")]).rename_columns(
            {"score_min": "score"}
        )
    by_phrase = "descending" if variant == LIBRARY else "ascending"
    table = table.sort_by([("text", "ascending"), ("score", "descending"), ("phrase", by_phrase)])
    text_of = table["text"].to_numpy()
    found = np.bincount(text_of, minlength=len(phrases))
    kept = np.floor(found * fraction).astype(np.int64)
    rank = np.arange(len(text_of)) - (np.cumsum(found) - found)[text_of]
    table = table.filter(pa.array(rank < kept[text_of]))
    ranked = pa.StructArray.from_arrays(
        [table["score"].combine_chunks(), table["phrase"].combine_chunks()], ["score", "phrase"]
    )
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept)), pa.int32()), ranked)


def in_parts(lists: pa.Array, work: Callable[..., pa.Array], at_once: int = AT_ONCE, *more: pa.Array) -> pa.Array:
    """``work`` on lists of a batch, as many rows at a time as hold ``at_once`` elements together, and one at least; ``more`` are cut alike."""
    every = [lists, *more]
    ends = np.cumsum(sum(pc.fill_null(pc.list_value_length(x), 0).to_numpy().astype(np.int64) for x in every))
    parts, start = [], 0
    while start < len(lists) or not parts:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + at_once, "right")), start + 1)
        parts.append(work(*[x.slice(start, stop - start) for x in every]))
        start = stop
    return pa.concat_arrays(parts)


def ranked_phrases(
    text: Column,
    fraction: float = 1.0,
    variant: str = LIBRARY,
    stopwords: Sequence[str] = ENGLISH,
) -> Column:
    """Best ``floor(n * fraction)`` phrases of a text as ``array<struct<score, phrase>>``.

    Equal scores: ``library`` ranks phrases descending, ``class`` ascending.
    """

    @F.arrow_udf("array<struct<score:double,phrase:string>>")
    def rank(phrases: pa.Array) -> pa.Array:
        return in_parts(phrases, lambda part: _score_batch(part, fraction, variant))

    return rank(candidate_phrases(text, variant, stopwords))


def word_statistics(text: Column, variant: str = LIBRARY) -> Column:
    """``array<struct<word, freq, degree>>``: the distinct words of the phrases of a text."""

    @F.arrow_udf("array<struct<word:string,freq:long,degree:double>>")
    def count(phrases: pa.Array) -> pa.Array:
        return in_parts(phrases, lambda part: _word_batch(part, variant))

    return count(candidate_phrases(text, variant))

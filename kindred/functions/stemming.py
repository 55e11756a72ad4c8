"""Porter stemming (the algorithm published in 1980), meant for a distinct vocabulary."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, functions as F

# Suffix tables of the published algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
    "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)


def _shape(stem: str) -> str:
    """``v`` for vowels and ``c`` for consonants; ``y`` is a vowel after a consonant."""
    out = ""
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _swap(word: str, table: dict[str, str]) -> str:
    suffix = _longest(word, table)
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + table[suffix]
    return word


def _plural_and_past(word: str) -> str:
    suffix = _longest(word, ("sses", "ies", "ss", "s"))
    if suffix in ("sses", "ies"):
        word = word[:-2]
    elif suffix == "s":
        word = word[:-1]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    word = word[: -len(suffix)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _double_end(word) and word[-1] not in "lsz":
        return word[:-1]
    return word + "e" if _measure(word) == 1 and _short_end(word) else word


def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    word = _plural_and_past(word)
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(_swap(word, STEP_2), STEP_3)
    suffix = _longest(word, STEP_4)
    if suffix and _measure(word[: -len(suffix)]) > 1 and (suffix != "ion" or word[-4] in "st"):
        word = word[: -len(suffix)]
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stemmed(word: Column) -> Column:
    """Stem of a word column; apply it to distinct words and join the result back."""

    @F.arrow_udf("string")
    def stem_batch(words: pa.Array) -> pa.Array:
        return pa.array([None if w is None else stem(w) for w in words.to_pylist()], pa.string())

    return stem_batch(word)

"""Text expressions on string columns; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import ascii_letters, digits

from pyspark.sql import Column, functions as F

from kindred.functions.stopwords import ENGLISH

# Regular expressions below use only what the Java and RE2 dialects share. Character classes list
# single characters: Java tests such a class with one table look-up, while ranges chain predicates.


def _char_class(chars: str) -> str:
    return "[" + "".join(f"\\x{ord(c):02x}" for c in chars) + "]"


_ALNUM = ascii_letters + digits
_BLANKS = " \t\n\r\f\x0b"
_SENTENCE_MARK = "\x02"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

BLANK = _char_class(_BLANKS)
ALNUM = _char_class(_ALNUM)
WORD_OR_MARK = (
    f"{ALNUM}+(?:[-']{ALNUM}+)*|"
    + _char_class("".join(chr(c) for c in range(128) if chr(c) not in _ALNUM + _BLANKS))
)
WORD_OR_MARKS = (
    _char_class(_ALNUM + "_") + "+|"
    + _char_class("".join(chr(c) for c in range(128) if chr(c) not in _ALNUM + "_" + _BLANKS + _SENTENCE_MARK))
    + r"+|\x02"
)
SENTENCE_END = f"([.!?]){BLANK}+"
NOT_ALNUM_OR_SPACE = "[^" + _char_class(" " + _ALNUM)[1:] + "+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def round_half_up(value: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ascii_fold(text: Column) -> Column:
    """Drop every non-ASCII character, without transliteration."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def word_tokens(text: Column) -> Column:
    """Words (inner hyphens and apostrophes kept) and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_MARK), F.lit(0))


def field_words(text: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Words of a short field: stop words go before lower-casing, so a capitalised one stays."""
    kept = F.filter(
        word_tokens(ascii_fold(text)),
        lambda t: (F.length(t) > 1) & ~t.isin(list(stopwords)),
    )
    return F.transform(kept, F.lower)


def letter_words(text: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Distinct lower-case letter-only words without stop words."""
    words = F.split(F.lower(F.regexp_replace(text, "[^a-zA-Z]", " ")), " ")
    return F.array_distinct(F.filter(words, lambda w: (w != "") & ~w.isin(list(stopwords))))


def plain_words(text: Column) -> Column:
    """Lower-case words after dropping all punctuation, as used for similarity of long texts."""
    bare = F.regexp_replace(F.lower(text), "[!-/:-@\\[-`{-~]", "")
    return F.filter(F.split(bare, f"{BLANK}+"), lambda w: w != "")


def alnum_words(text: Column) -> Column:
    """Blank-separated words with everything but letters and digits removed from them."""
    bare = F.regexp_replace(F.regexp_replace(text, f"{BLANK}+", " "), "[^A-Za-z0-9 ]+", "")
    return F.split(bare, " ")


def glued_words(text: Column) -> Column:
    """Like :func:`alnum_words`, but line breaks vanish too, so words around them stick together."""
    return F.split(F.regexp_replace(text, "[^A-Za-z0-9 ]+", ""), " ")


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by blanks."""
    marked = F.regexp_replace(F.regexp_replace(text, "\x02", ""), SENTENCE_END, "$1\x02")
    return F.filter(F.split(marked, "\x02"), lambda s: F.trim(s) != "")

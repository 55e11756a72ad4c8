"""License notices by a positional index of rare words, in Spark functions only.

The words of the templates are weighed by their rarity in the corpus. The index posts every template under the two rarest words of its key
phrase, each with its position. One pass over a file finds its words that the index has; their postings, moved by the places
of the words, name where templates may start, and only starts that both words name remain. There the template's key
phrase must stand, word by word, and the weighed share of all its words that stand where they should is the score.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Template(NamedTuple):
    label: str
    words: tuple[str, ...]
    key: tuple[int, int]  # first word of the key phrase and the one after its last
    base: bool


def _template(label: str, text: str, key: str, base: bool = False) -> Template:
    words, phrase = text.split(), key.split()
    start = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return Template(label, tuple(words), (start, start + len(phrase)), base)


# fixed values: the three base phrases, and notices in common use with the phrase that each must hold
BASE = (
    _template("cc-by", "cc by", "cc by", True),
    _template("gpl", "general public license", "general public license", True),
    _template("reserved", "all rights reserved", "all rights reserved", True),
)
TEMPLATES = (
    *BASE,
    _template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    _template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    _template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    _template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    _template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    _template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    _template("mit", "released under the mit license", "mit license"),
    _template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    _template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)
#: Least weighed share of a template's words that makes its label.
SHARE = 0.5
#: What stands between words, in a text with A-Z lower-cased.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The only character but A-Z whose lower case is an ASCII letter alone, and one that stays as it is.
_KELVIN, _OTHER = "K", "ĸ"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; a null text has none.

    ``lower`` also changes letters beyond ASCII. They stay letters beyond ASCII (but for the one replaced before), so the number
    of words and all words made of ASCII alone are the same, and only such words are compared.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_OTHER))
    return F.array_remove(F.split(F.lower(plain), BETWEEN), "")


def weights(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of every template word, over all rows of ``docs``."""
    known = sorted({w for t in templates for w in t.words})
    found = docs.select(F.explode(F.array_intersect(words_of(docs["text"]), F.array(*map(F.lit, known)))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = docs.count()
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 1 for w in known}


def rarest(template: Template, idf: dict[str, float]) -> list[int]:
    """Positions of the key phrase's two words with the largest weight, the earlier one of equals."""
    return sorted(range(*template.key), key=lambda i: (-idf[template.words[i]], i))[:2]


#: A start of a template as one number: the template's number, and above it the start, which may lie before the text.
_BEFORE = 1 << 20


def _index(templates: Sequence[Template], idf: dict[str, float], rank: int) -> tuple[list[str], Column]:
    """The words that templates are posted under (the rarest of each at rank 0, the next at 1), and a map of them to (template, position)."""
    posted: dict[str, list[tuple[int, int]]] = {}
    for k, t in enumerate(templates):
        places = rarest(t, idf)
        place = places[min(rank, len(places) - 1)]
        posted.setdefault(t.words[place], []).append((k, place))
    pairs = [(F.lit(w), F.array(*[F.struct(F.lit(k).cast("long").alias("t"), F.lit(p).alias("place")) for k, p in found])) for w, found in posted.items()]
    return list(posted), F.create_map(*[x for pair in pairs for x in pair])


def _named(words: Column, templates: Sequence[Template], idf: dict[str, float], rank: int) -> Column:
    """The starts that a file's words name through the index, as numbers."""
    known, index = _index(templates, idf, rank)
    hits = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(known))
    postings = lambda i: F.transform(F.element_at(index, F.get(words, i)), lambda p: (i - p["place"] + _BEFORE) * len(templates) + p["t"])
    return F.flatten(F.transform(hits, postings))


def starts(words: Column, templates: Sequence[Template], idf: dict[str, float]) -> Column:
    """``array<struct<t, start>>``: where a template's two rarest words and its key phrase stand as they should."""
    both = F.array_intersect(_named(words, templates, idf, 0), _named(words, templates, idf, 1))
    n = len(templates)
    read = F.transform(both, lambda x: F.struct((x % n).cast("int").alias("t"), (F.floor(x / n) - _BEFORE).cast("int").alias("start")))
    keys = F.array(*[F.array(*map(F.lit, t.words[slice(*t.key)])) for t in templates])
    begins = F.array(*[F.lit(t.key[0]) for t in templates])

    def stands(c: Column) -> Column:
        key, at = F.get(keys, c["t"]), c["start"] + F.get(begins, c["t"])
        return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(key)) == key)

    return F.filter(read, stands)


def shares(words: Column, found: Column, templates: Sequence[Template], idf: dict[str, float]) -> Column:
    """``found`` with ``share``: the weighed share of the template's words that stand where they should from the start on (which may lie before the text)."""
    texts = F.array(*[F.array(*map(F.lit, t.words)) for t in templates])
    weighed = F.array(*[F.array(*[F.lit(idf[w]) for w in t.words]) for t in templates])
    whole = F.array(*[F.lit(sum(idf[w] for w in t.words)) for t in templates])

    def share(c: Column) -> Column:
        here = lambda i: F.when(c["start"] + i >= 0, F.get(words, c["start"] + i))
        parts = F.transform(F.get(texts, c["t"]), lambda w, i: F.when(here(i) == w, F.get(F.get(weighed, c["t"]), i)).otherwise(0.0))
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.get(whole, c["t"])

    return F.transform(found, lambda c: F.struct(c["t"].alias("t"), c["start"].alias("start"), share(c).alias("share")))


def scan(docs: DataFrame, idf: dict[str, float], carry: Sequence[str] = (), templates: Sequence[Template] = TEMPLATES, least: float = SHARE) -> DataFrame:
    """One row per row: ``doc_id``, ``carry``, ``n_words``, ``places`` of base phrases, ``base_labels``, ``labels``, ``score``.

    ``places`` is an array of word numbers, unordered. Labels are distinct and sorted. A base phrase is a template that is all
    key phrase, so it always makes its label, with score 1. Null and empty texts have no words, places or labels and score 0.
    """
    rows = docs.select("doc_id", *carry, words_of(docs["text"]).alias("found_words"))
    words = F.col("found_words")
    rows = rows.select("doc_id", *carry, "found_words", starts(words, templates, idf).alias("found_starts"))
    # most files have no start, and nothing is weighed in them
    weighed = F.when(F.size("found_starts") > 0, F.filter(shares(words, F.col("found_starts"), templates, idf), lambda c: c["share"] >= least))
    rows = rows.select("doc_id", *carry, F.size("found_words").cast("long").alias("n_words"), F.coalesce(weighed, F.array().cast("array<struct<t:int,start:int,share:double>>")).alias("found_starts"))
    labels = F.array(*[F.lit(t.label) for t in templates])
    base = F.filter("found_starts", lambda c: c["t"].isin([k for k, t in enumerate(templates) if t.base]))
    named = lambda found: F.array_sort(F.array_distinct(F.transform(found, lambda c: F.get(labels, c["t"]))))
    score = F.least(F.coalesce(F.array_max(F.transform("found_starts", lambda c: c["share"])), F.lit(0.0)), F.lit(1.0))
    return rows.select("doc_id", *carry, "n_words", F.transform(base, lambda c: c["start"]).alias("places"), named(base).alias("base_labels"), named(F.col("found_starts")).alias("labels"), score.alias("score"))


def scan_sql(templates: Sequence[Template] = TEMPLATES, least: float = SHARE) -> str:
    """The same rows in SQL, by aligning every template word with every word."""
    values = ", ".join(f"({k}, '{t.label}', {t.base}, {i}, '{w}', {t.key[0] <= i < t.key[1]})" for k, t in enumerate(templates) for i, w in enumerate(t.words))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BETWEEN}'), lambda x: x <> '') AS words FROM documents),
  templates(t, label, base, place, word, in_key) AS (VALUES {values}),
  tokens AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM docs),
  used AS (SELECT tokens.* FROM tokens WHERE word IN (SELECT word FROM templates)),
  idf AS (SELECT v.word, ln(((SELECT count(*) FROM docs) + 1) / (count(DISTINCT u.row) + 1)) + 1 AS w
    FROM (SELECT DISTINCT word FROM templates) v LEFT JOIN used u USING (word) GROUP BY v.word),
  weighed AS (SELECT *, in_key AND row_number() OVER (PARTITION BY t, in_key ORDER BY w DESC, place) <= 2 AS rare, sum(w) OVER (PARTITION BY t) AS whole,
    count(*) FILTER (in_key) OVER (PARTITION BY t) AS in_phrase FROM templates JOIN idf USING (word)),
  aligned AS (SELECT row, t, any_value(label) AS label, any_value(base) AS base, i - place AS start, sum(w) / any_value(whole) AS share
    FROM used JOIN weighed USING (word) GROUP BY row, t, i - place
    HAVING count(*) FILTER (rare) = 2 AND count(*) FILTER (in_key) = any_value(in_phrase) AND sum(w) / any_value(whole) >= {least}),
  found AS (SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM aligned GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, round(least(coalesce(score, 0), 1), 6) AS score
FROM docs LEFT JOIN found USING (row)
"""

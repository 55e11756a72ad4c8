"""Edit matches by segments against a nested loop; the vocabulary as a table."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kindred.operators import search, vocabulary
from kindred.session import materialise


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def misspelt(draw, word):
    for _ in range(draw.randrange(1, 6)):
        i = draw.randrange(len(word) + 1)
        word = draw.choice([word[:i] + draw.choice("abc ") + word[i:], word[:i] + word[i + 1 :], word[:i] + draw.choice("abc") + word[i + 1 :]])
    return word


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.5])
def test_segments_lose_no_pair(spark, threshold):
    draw = random.Random(int(threshold * 10))
    words = sorted({"".join(draw.choices("abcd ", k=draw.randrange(1, 22))) for _ in range(60)} | {"a", "ab", "abababababab"})
    keywords = sorted({misspelt(draw, w) for w in words for _ in range(4)} | set(words[:5]) | {""})
    table = spark.createDataFrame([(w,) for w in keywords], "keyword string")
    phrases = materialise(spark.createDataFrame([(i % 2, w, float(i)) for i, w in enumerate(words)], "query_id int, phrase string, score double"))
    got = sorted((r.query_id, r.keyword, r.phrase, round(r.ratio, 9)) for r in search.edit_matches(table, phrases, threshold).collect())
    own = {q: {w for i, w in enumerate(words) if i % 2 == q} for q in (0, 1)}
    want = []
    for i, p in enumerate(words):
        for k in keywords:
            ratio = 1 - distance(k, p) / max(len(k), len(p))
            if k and ratio >= threshold and k not in own[i % 2]:
                want.append((i % 2, k, p, round(ratio, 9)))
    assert got == sorted(want)


def test_keywords_meet_phrases_on_segments_only(spark):
    keywords = spark.createDataFrame([("abcdefghij",), ("klmnopqrst",)], "keyword string")
    phrases = spark.createDataFrame([(1, "abcdefghij", 1.0)], "query_id int, phrase string, score double")
    parts = search.edit_segments(phrases, 0.6)
    met = search.keyword_segments(keywords, parts.select("size", "edits").distinct()).join(parts, ["size", "edits", "segment", "part"])
    assert {r.keyword for r in met.collect()} == {"abcdefghij"}


def test_letters_that_differ_are_no_more_than_edits(spark):
    draw = random.Random(8)
    texts = ["", "é", "aaaaaaaaaaaa", *["".join(draw.choices("abc é'9", k=draw.randrange(1, 25))) for _ in range(40)]]
    bags = {r.t: r.bag for r in spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", search.letter_bag(F.col("t")).alias("bag")).collect()}
    assert bags[None] == bags[""] == [0, 0, 0, 0]
    lacking = lambda x, y: sum((a & ~b & (2**64 - 1)).bit_count() for a, b in zip(bags[x], bags[y], strict=True))
    assert all(max(lacking(x, y), lacking(y, x)) <= distance(x, y) for x in texts for y in texts)
    assert lacking("aaaaaaaaaaaa", "") == 8


def test_short_segments_are_not_shuffled(spark):
    keywords = materialise(spark.createDataFrame([("abcdefghijklmnopqrstuvwxyz",)], "keyword string"))
    phrases = materialise(spark.createDataFrame([(1, "abcdefghijklmnopqrstuvwxy", 1.0)], "query_id int, phrase string, score double"))
    assert "segment" not in search.edit_matches(keywords, phrases, 0.6)._jdf.queryExecution().optimizedPlan().toString()  # 11 rows of this keyword
    assert "segment" in search.edit_matches(keywords, phrases, 0.8)._jdf.queryExecution().optimizedPlan().toString()


def test_dictionary_holds_every_word_once(spark):
    draw = random.Random(5)
    texts = [(i, draw.choices([f"w{j}" for j in range(300)], weights=[1 / (j + 1) for j in range(300)], k=draw.randrange(30))) for i in range(200)]
    df = spark.createDataFrame(texts, "id int, words array<string>")
    rows = vocabulary.word_rows(df, "id", F.col("words"))
    words = vocabulary.dictionary(rows)
    df_of = Counter(w for _, t in texts for w in set(t))
    order = sorted(df_of, key=lambda w: (-df_of[w], w))
    assert sorted((r.slot, r.word, r.df) for r in words.collect()) == [(i, w, df_of[w]) for i, w in enumerate(order)]
    got = sorted((r.id, r.word, r.slot, round(r.value, 9)) for r in vocabulary.idf_weights(rows, words, "id", len(texts)).collect())
    assert got == sorted((i, w, order.index(w), round(n * math.log(201 / (df_of[w] + 1)), 9)) for i, t in texts for w, n in Counter(t).items())
    vectors = {r.id: r.v for r in vocabulary.sparse_vectors(rows, words, "id", "v").collect()}
    assert {i: dict(zip(v.indices.tolist(), v.values.tolist(), strict=True)) for i, v in vectors.items()} == {i: {order.index(w): n for w, n in Counter(t).items()} for i, t in texts if t}
    assert {v.size for v in vectors.values()} == {len(order)}

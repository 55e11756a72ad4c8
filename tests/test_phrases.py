"""Key phrases against a plain reimplementation on small texts."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from math import floor

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kindred.functions.phrases import CLASS, LIBRARY, _score_batch, in_parts, ranked_phrases
from kindred.functions.stopwords import ENGLISH, all_languages
from kindred.functions.text import PUNCTUATION
from kindred.operators.phrase_tables import _occurrences, _shared_phrases, _word_scores, phrase_score_table, word_score_table
from kindred.session import materialise


def plain(text: str, variant: str) -> list[tuple[float, str]]:
    text = "".join(c for c in text if ord(c) < 128).lower()
    phrases = []
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        pattern = r"\w+|[^\w\s]+" if variant == LIBRARY else r"[a-z0-9]+(?:[-'][a-z0-9]+)*|[^a-z0-9\s]"
        run: list[str] = []
        for token in re.findall(pattern, sentence):
            if token in ENGLISH or token in list(PUNCTUATION):
                if run:
                    phrases.append(tuple(run))
                run = []
            else:
                run.append(token)
        if run and variant == LIBRARY:
            phrases.append(tuple(run))
    if variant == LIBRARY:
        phrases = list(dict.fromkeys(phrases))
    freq, degree = Counter(), defaultdict(int)
    for p in phrases:
        numeric = [w for w in p if re.fullmatch(r"\d+", w)]
        for w in p:
            freq[w] += 1
            degree[w] += len(p) if variant == LIBRARY else len(p) - len(numeric) - 1
    if variant == CLASS:
        for w in freq:
            degree[w] += freq[w]
    scores = {" ".join(p): sum(degree[w] / freq[w] for w in p) for p in phrases}
    scores = {p: floor(s * 1e9 + 0.5) / 1e9 for p, s in scores.items()}
    if variant == LIBRARY:
        return sorted(((s, p) for p, s in scores.items()), reverse=True)
    return sorted(((s, p) for p, s in scores.items()), key=lambda x: (-x[0], x[1]))


def texts(n: int) -> list[str]:
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "alpha", "beta", "gamma", "delta", "café", "12", "3", "well-known", ",", ".", "!", ";", "--", '."', "\n"]
    return ["", "the of and", "..."] + [
        " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 120))) for _ in range(n)
    ]


@pytest.mark.parametrize("variant", [LIBRARY, CLASS])
def test_matches_plain_version(spark, variant):
    rows = list(enumerate(texts(60)))
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    got = {r.id: [(p.score, p.phrase) for p in r.r] for r in df.select("id", ranked_phrases(F.col("text"), variant=variant).alias("r")).collect()}
    for i, text in rows:
        assert got[i] == plain(text, variant), text


@pytest.mark.parametrize("variant", [LIBRARY, CLASS])
def test_tables_agree_with_batches(spark, variant):
    df = spark.createDataFrame(list(enumerate(texts(30))), "id int, text string")
    batch = df.select("id", F.inline(ranked_phrases(F.col("text"), variant=variant))).select("id", "phrase", "score")
    tables = phrase_score_table(df, "id", "text", variant)
    assert sorted(batch.collect()) == sorted(tables.collect())


def test_hand_computed(spark):
    df = spark.createDataFrame([("linear constraints and linear systems.",)], "text string")
    ranked = df.select(F.inline(ranked_phrases(F.col("text")))).collect()
    # linear: degree 4, frequency 2; constraints and systems: degree 2, frequency 1
    assert [(r.score, r.phrase) for r in ranked] == [(4.0, "linear systems"), (4.0, "linear constraints")]


def test_fraction_floors_and_null_gives_nothing(spark):
    df = spark.createDataFrame([(1, "one, two, three"), (2, None)], "id int, text string")
    half = df.select("id", F.explode(ranked_phrases(F.col("text"), 0.5)).alias("p")).collect()
    assert [r.id for r in half] == [1]


def test_all_languages_extend_english(spark):
    words = all_languages()
    assert set(ENGLISH) < set(words) and "oder" in words


@pytest.mark.parametrize("variant", [LIBRARY, CLASS])
def test_a_batch_is_worked_on_in_parts(variant):
    draw = random.Random(2)
    lists = [[" ".join(draw.choices(["a", "b", "12", "cd"], k=draw.randrange(1, 4))) for _ in range(draw.randrange(9))] for _ in range(40)] + [None, []]
    batch, sizes = pa.array(lists, pa.list_(pa.string())), []

    def work(part):
        sizes.append(len(part.flatten()))
        return _score_batch(part, 0.5, variant)

    assert in_parts(batch, work, 10).equals(_score_batch(batch, 0.5, variant))
    assert max(sizes) <= 10 and len(sizes) > 4 and len(in_parts(batch.slice(0, 0), work)) == 0


@pytest.mark.parametrize("variant", [LIBRARY, CLASS])
def test_tables_count_in_the_row_and_texts_of_one_key_together(spark, variant):
    own = list(enumerate(texts(20))) + [(99, None)]
    twice = [(7, "red dog, big 12 dog. A cat."), (7, "big red dog; old cat."), (None, "blue cat nose, ocean."), (None, "blue cat.")]
    df = materialise(spark.createDataFrame(own + twice, "id int, text string"))
    words, phrases = word_score_table(df, "id", "text", variant), phrase_score_table(df, "id", "text", variant)
    plain = _word_scores(_occurrences(df, "id", "text", variant), "id")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(words.collect()) == order(plain.collect())
    assert order(phrases.collect()) == order(_shared_phrases(df, "id", "text", variant).collect())
    alone = df.where("id > 7")
    for found in (word_score_table(alone, "id", "text", variant), phrase_score_table(alone, "id", "text", variant)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Aggregate" not in plan

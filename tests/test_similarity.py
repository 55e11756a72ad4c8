from __future__ import annotations

import random
from collections import Counter
from math import log, sqrt

import pytest
from pyspark.sql import functions as F

from kindred.functions.stemming import stem
from kindred.operators import similarity as sim
from kindred.session import materialise


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_similar_texts_loses_no_pair(spark, threshold):
    rng = random.Random(8)
    vocabulary = ["a" * n + c for n in range(1, 6) for c in "xyz"]
    sets = [sorted(set(rng.choices(vocabulary, k=rng.randint(1, 9)))) for _ in range(80)]
    left = spark.createDataFrame(list(enumerate(sets[:30])), "query_id int, words array<string>")
    right = spark.createDataFrame(list(enumerate(sets[30:])), "id int, words array<string>")
    want = {}
    for i, x in enumerate(sets[:30]):
        for j, y in enumerate(sets[30:]):
            s = len(set(x) & set(y)) / sqrt(len(x) * len(y))
            if s >= threshold:
                want[(i, j)] = round(s, 9)
    got = {(r.query_id, r.id): round(r.similarity, 9) for r in sim.similar_texts(left, right, threshold).collect()}
    assert got == want


def test_pair_tfidf_follows_the_formula(spark):
    a, b = "red red dog house", "red dog dog cat"
    pairs = spark.createDataFrame([(1, a, b), (2, a, a), (3, a, "")], "k int, a string, b string")
    got = {r.k: r.similarity for r in sim.rerank(pairs, ["k"], "a", "b", stopwords=()).collect()}
    ca, cb = Counter(a.split()), Counter(b.split())
    idf = {w: 1.0 if w in ca and w in cb else 1 + log(3 / 2) for w in ca | cb}
    dot = sum(ca[w] * cb[w] * idf[w] ** 2 for w in idf)
    norm = sqrt(sum((ca[w] * idf[w]) ** 2 for w in idf)) * sqrt(sum((cb[w] * idf[w]) ** 2 for w in idf))
    assert got[1] == pytest.approx(dot / norm) and got[2] == pytest.approx(1.0) and got[3] == 0.0


def test_stop_words_go_after_stemming(spark):
    pairs = spark.createDataFrame([(1, "running dogs", "run dog")], "k int, a string, b string")
    assert sim.rerank(pairs, ["k"], "a", "b", stemming=True).first().similarity == pytest.approx(1.0)


@pytest.mark.parametrize(
    ("word", "want"),
    [
        ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"),
        ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"),
        ("falling", "fall"), ("hissing", "hiss"), ("failing", "fail"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
        ("conditional", "condit"), ("rational", "ration"), ("valenci", "valenc"), ("digitizer", "digit"), ("operator", "oper"), ("feudalism", "feudal"),
        ("decisiveness", "decis"), ("hopefulness", "hope"), ("formaliti", "formal"), ("triplicate", "triplic"), ("formative", "form"), ("formalize", "formal"),
        ("electrical", "electr"), ("goodness", "good"), ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"), ("airliner", "airlin"),
        ("adjustable", "adjust"), ("replacement", "replac"), ("adoption", "adopt"), ("activate", "activ"), ("effective", "effect"), ("probate", "probat"),
        ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("generalizations", "gener"), ("oscillators", "oscil"),
    ],
)
def test_stems_of_the_published_examples(word, want):
    assert stem(word) == want


def test_text_vectors_ignore_unknown_words(spark):
    texts = spark.createDataFrame([(1, "alpha beta gamma"), (2, "gamma")], "id int, text string")
    vectors = spark.createDataFrame([("alpha", [1.0, 0.0]), ("beta", [0.0, 3.0])], "word string, vec array<double>")
    got = {r.id: r.vec for r in sim.text_vectors(sim.text_words(texts, "id", "text"), "id", vectors, 2).collect()}
    assert got == {1: [0.5, 1.5]}


def test_corpus_weights_have_unit_length(spark):
    texts = spark.createDataFrame([(1, "red dog"), (2, "red cat"), (3, "red red")], "id int, text string")
    weights, idf = sim.corpus_weights(texts, "id", F.split("text", " "))
    assert {r.word: round(r.idf, 9) for r in idf.collect()} == {"red": 0.0, "dog": round(log(3), 9), "cat": round(log(3), 9)}
    assert {(r.id, r.word): r.weight for r in weights.where("weight > 0").collect()} == {(1, "dog"): 1.0, (2, "cat"): 1.0}


def test_pairs_of_their_own_key_are_counted_in_their_row(spark):
    rows = [(1, "a b b", "b c"), (2, "a", ""), (3, "", ""), (4, None, "a"), (5, "x", "x"), (5, "x y", "y"), (None, "a", "a"), (None, "b", "a"), (6, "z", "z z")]
    pairs = materialise(spark.createDataFrame(rows, "k int, a string, b string"))
    words = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    plain = sim.count_cosine(sim.pair_counts(pairs, ["k"], words("a"), words("b")), ["k"])
    got = {r.k: r.similarity for r in sim.pair_count_cosine(pairs, ["k"], words("a"), words("b")).collect()}
    assert got == {r.k: r.similarity for r in plain.collect()} and set(got) == {1, 2, 5, 6, None} and got[2] is None
    alone = sim.pair_count_cosine(pairs.where("k < 5"), ["k"], words("a"), words("b"))
    assert "Aggregate" not in alone._jdf.queryExecution().executedPlan().toString()

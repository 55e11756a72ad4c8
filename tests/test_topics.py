from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.sql import functions as F

from kindred.contract import ml_queries
from kindred.operators import topics, vocabulary


@pytest.fixture(scope="module")
def counted(spark):
    rng = random.Random(7)
    texts = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 300 + 100 * (i % 3)}" for _ in range(rng.randrange(1, 80)))) for i in range(400)]
    rows = vocabulary.word_rows(spark.createDataFrame([*texts, (900, "")], "doc_id long, text string").repartition(5), "doc_id", F.split("text", " "))
    return rows, vocabulary.dictionary(rows)


def test_random_numbers_of_java(spark):
    seeds, first, sizes = np.array([1, 5, 5, 2**31]), np.array([0, 3, 1_000_003, 12]), np.array([4, 0, 3, 2])
    got = topics.java_doubles(seeds, first, sizes).tolist()
    want = []
    for seed, skip, n in zip(seeds.tolist(), first.tolist(), sizes.tolist(), strict=True):
        state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)
        drawn = []
        for _ in range(2 * (skip + n)):
            state = (state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
            drawn.append(state)
        want += [((a >> 22 << 27) + (b >> 21)) * 2.0**-53 for a, b in zip(drawn[2 * skip :: 2], drawn[2 * skip + 1 :: 2], strict=True)]
    assert got == want
    java = spark._jvm.java.util.Random(1)
    assert got[:4] == [java.nextDouble() for _ in range(4)]


@pytest.mark.parametrize("held", [topics.WORDS, 300])
def test_topics_are_those_of_spark(spark, counted, monkeypatch, held):
    monkeypatch.setattr(topics, "WORDS", held)
    rows, words = counted
    model = LDA(k=4, maxIter=3, seed=1, optimizer="em").fit(vocabulary.sparse_vectors(rows, words, "doc_id", "features"))
    found, totals = topics.word_topics(rows, words, "doc_id", 4, 3, 1)
    want = model.topicsMatrix().toArray()
    got = np.array([r.counts for r in found.orderBy("slot").collect()])
    assert got.shape == want.shape and np.allclose(got, want, rtol=1e-9, atol=1e-12) and np.allclose(totals, want.sum(axis=0))
    assert "WindowGroupLimit" in topics.best_words(found, totals, 5)._jdf.queryExecution().optimizedPlan().toString()
    best = {t: [r.slot for r in sorted((r for r in topics.best_words(found, totals, 5).collect() if r.topic == t), key=lambda r: r.place)] for t in range(4)}
    assert best == {r.topic: list(r.termIndices) for r in model.describeTopics(5).collect()}


def test_a_key_that_repeats_raises(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "a", 2)], "doc_id long, word string, n long")
    with pytest.raises(Exception, match="its key repeats"):
        topics.word_topics(rows, vocabulary.dictionary(rows), "doc_id", 2, 1, 1)


def test_query_makes_no_graph(spark, tmp_path, monkeypatch):
    """every iteration built a graph of all words of all texts."""
    spark.createDataFrame([(i, f"one two {i % 7} three") for i in range(40)] + [(50, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(ml_queries.K, "LDA", None)
    found = {r.topic: r.terms.split(",") for r in ml_queries.ml_lda(spark, str(tmp_path)).collect()}
    assert set(found) == {0, 1, 2, 3} and all(len(t) == 5 for t in found.values())

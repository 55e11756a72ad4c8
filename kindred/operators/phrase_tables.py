"""Key phrase statistics as tables: one row per word or phrase of a text.

A text whose key no other has is counted inside its row, so none of its words are shuffled or sorted. Texts of one key are one text
in several rows, and only these are exploded and grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.functions.phrases import LIBRARY, NUMBER, candidate_phrases, ranked_phrases, word_statistics
from kindred.functions.text import round_half_up
from kindred.operators.joins import alone_and_shared


def _occurrences(texts: DataFrame, key: str, text: str, variant: str) -> DataFrame:
    """``(key, phrase_no, phrase, weight, position, word)``, placed by text so that later groupings stay local."""
    words = F.split("phrase", " ")
    if variant == LIBRARY:
        weight = F.size(words)
    else:
        weight = F.size(F.filter(words, lambda w: ~w.rlike(NUMBER)))
    phrases = (
        texts.repartition(key)
        .select(key, F.posexplode(candidate_phrases(F.col(text), variant)).alias("phrase_no", "phrase"))
        .withColumn("weight", weight)
    )
    return phrases.select("*", F.posexplode(words).alias("position", "word"))


def _word_scores(occurrences: DataFrame, key: str) -> DataFrame:
    return (
        occurrences.groupBy(key, "word")
        .agg(F.count("*").alias("freq"), F.sum("weight").cast("double").alias("degree"))
        .withColumn("score", F.col("degree") / F.col("freq"))
    )


def word_score_table(texts: DataFrame, key: str, text: str, variant: str = LIBRARY) -> DataFrame:
    """``(key, word, freq, degree, score)``."""
    alone, shared = alone_and_shared(texts, [key])
    words = alone.select(key, F.inline(word_statistics(F.col(text), variant)))
    scores = words.withColumn("score", F.col("degree") / F.col("freq"))
    return scores if shared is None else scores.unionByName(_word_scores(_occurrences(shared, key, text, variant), key))


def phrase_score_table(texts: DataFrame, key: str, text: str, variant: str = LIBRARY) -> DataFrame:
    """``(key, phrase, score)``, each phrase of a text once; texts without a key have none."""
    alone, shared = alone_and_shared(texts.where(F.col(key).isNotNull()), [key])
    phrases = alone.select(key, F.inline(ranked_phrases(F.col(text), variant=variant))).select(key, "phrase", "score")
    return phrases if shared is None else phrases.unionByName(_shared_phrases(shared, key, text, variant))


def _shared_phrases(texts: DataFrame, key: str, text: str, variant: str) -> DataFrame:
    occurrences = _occurrences(texts, key, text, variant)
    scores = _word_scores(occurrences, key).select(key, "word", F.col("score").alias("word_score"))
    return (
        occurrences.join(scores, [key, "word"])
        .groupBy(key, "phrase_no", "phrase")
        .agg(F.sum("word_score").alias("score"))
        .select(key, "phrase", round_half_up(F.col("score"), 9).alias("score"))
        .distinct()
    )

"""Similarity of texts: set, count, TF-IDF and word-vector cosines."""

from __future__ import annotations

from collections.abc import Sequence
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from kindred.functions.phrases import in_parts
from kindred.functions.stemming import stemmed
from kindred.functions.stopwords import ENGLISH
from kindred.functions.text import ascii_fold, letter_words, plain_words
from kindred.operators.joins import alone_and_shared
from kindred.operators.statistics import positions
from kindred.session import materialise

# A two-text TF-IDF with smoothed idf weighs a shared word 1 and an unshared word 1 + ln(3/2).
UNSHARED = 1.0 + log(1.5)
#: Words that Python counts at a time.
WORDS_AT_ONCE = 200_000


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def pair_counts(pairs: DataFrame, keys: Sequence[str], words_a: Column, words_b: Column) -> DataFrame:
    """``(keys, word, a, b)``: how often each word occurs in both texts of a pair.

    The pair rows are placed by key first; all later groupings by key stay on their partitions.
    """
    both = F.concat(
        F.transform(words_a, lambda w: F.struct(w.alias("word"), F.lit(1).alias("a"), F.lit(0).alias("b"))),
        F.transform(words_b, lambda w: F.struct(w.alias("word"), F.lit(0).alias("a"), F.lit(1).alias("b"))),
    )
    return (
        pairs.repartition(*keys)
        .select(*keys, F.explode(both).alias("t"))
        .groupBy(*keys, F.col("t.word").alias("word"))
        .agg(F.sum("t.a").alias("a"), F.sum("t.b").alias("b"))
    )


def count_cosine(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cosine of raw word counts per pair; null when a text has no words."""
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    sums = counts.groupBy(*keys).agg(F.sum(a * b).alias("ab"), F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb"))
    norm = F.sqrt("aa") * F.sqrt("bb")
    return sums.select(*keys, F.when(norm > 0, F.col("ab") / norm).alias("similarity"))


def pair_count_cosine(pairs: DataFrame, keys: Sequence[str], words_a: Column, words_b: Column) -> DataFrame:
    """``(keys, similarity)``: cosine of raw word counts per pair that has words, as :func:`count_cosine` of :func:`pair_counts`.

    A pair whose keys no other has is counted inside its row; only pairs of the same keys are exploded and grouped.
    """

    def cosines(a: pa.Array, b: pa.Array) -> pa.Array:
        rows, words = len(a), pa.concat_arrays([a.flatten(), b.flatten()]).dictionary_encode()
        pair_of = np.concatenate([pc.list_parent_indices(x).to_numpy() for x in (a, b)]).astype(np.int64)
        slots, first = max(len(words.dictionary), 1), len(a.flatten())
        key, group = np.unique(pair_of * slots + words.indices.to_numpy(), return_inverse=True)
        x, y = np.bincount(group[:first], minlength=len(key)), np.bincount(group[first:], minlength=len(key))
        total = lambda n: np.bincount(key // slots, n, rows)
        norm = np.sqrt(total(x * x)) * np.sqrt(total(y * y))
        # a pair without any word has no row; one with an empty side has a null
        kept = (np.bincount(pair_of, minlength=rows) > 0) & pc.and_(a.is_valid(), b.is_valid()).to_numpy(zero_copy_only=False)
        found = np.divide(total(x * y), norm, out=np.zeros(rows), where=norm > 0)[kept]
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept)), pa.int32()), pa.array(found, pa.float64(), mask=~(norm > 0)[kept]))

    @F.arrow_udf("array<double>")
    def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
        return in_parts(a, cosines, WORDS_AT_ONCE, b)

    alone, shared = alone_and_shared(pairs, keys)
    found = alone.select(*keys, F.explode(similarity(words_a, words_b)).alias("similarity"))
    return found if shared is None else found.unionByName(count_cosine(pair_counts(shared, keys, words_a, words_b), keys))


def pair_tfidf_cosine(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """TF-IDF cosine with the idf fitted on just the two texts of a pair; 0 when a text has no words."""
    weight = F.when((F.col("a") > 0) & (F.col("b") > 0), F.lit(1.0)).otherwise(F.lit(UNSHARED))
    a, b = F.col("a") * weight, F.col("b") * weight
    sums = counts.groupBy(*keys).agg(F.sum(a * b).alias("ab"), F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb"))
    norm = F.sqrt("aa") * F.sqrt("bb")
    return sums.select(*keys, F.when(norm > 0, F.col("ab") / norm).otherwise(F.lit(0.0)).alias("similarity"))


def rerank(
    pairs: DataFrame,
    keys: Sequence[str],
    query_text: str,
    text: str,
    stopwords: Sequence[str] = ENGLISH,
    stemming: bool = False,
) -> DataFrame:
    """``(keys, similarity)`` of query and candidate texts; stop words go after stemming."""
    counts = pair_counts(pairs, keys, plain_words(F.col(query_text)), plain_words(ascii_fold(F.col(text))))
    if stemming:
        counts = materialise(counts)  # read for the vocabulary and for the sums
        vocabulary = counts.select("word").distinct().withColumn("stem", stemmed(F.col("word")))
        counts = (
            counts.join(vocabulary, "word")
            .groupBy(*keys, F.col("stem").alias("word"))
            .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        )
    return pair_tfidf_cosine(counts.where(~F.col("word").isin(list(stopwords))), keys)


def word_counts(words: Column) -> Column:
    """``array<struct<word, tf>>``: the distinct words of a list and how often each occurs, counted inside the row."""

    def count(lists: pa.Array) -> pa.Array:
        text_of = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        word = lists.flatten().dictionary_encode()
        slots = max(len(word.dictionary), 1)
        key, tf = np.unique(text_of * slots + word.indices.to_numpy(), return_counts=True)
        found = np.bincount(key // slots, minlength=len(lists))
        pairs = pa.StructArray.from_arrays([word.dictionary.take(pa.array(key % slots)), pa.array(tf, pa.int64())], ["word", "tf"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(found)), pa.int32()), pairs)

    @F.arrow_udf("array<struct<word:string,tf:long>>")
    def counts(lists: pa.Array) -> pa.Array:
        return in_parts(lists, count, WORDS_AT_ONCE)

    return counts(words)


def _word_counts(texts: DataFrame, key: str, words: Column) -> DataFrame:
    return texts.select(key, F.explode(word_counts(words)).alias("found")).select(key, "found.word", "found.tf")


def _weighed(counts: DataFrame, key: str, idf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(key, word, w)`` with w = tf * idf, and ``(key, norm)`` of the texts whose norm is not zero."""
    weighed = counts.join(idf, "word").select(key, "word", (F.col("tf") * F.col("idf")).alias("w"))
    return weighed, weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")).where("norm > 0")


def _unit_length(weighed: DataFrame, norms: DataFrame, key: str) -> DataFrame:
    return weighed.join(norms, key).select(key, "word", (F.col("w") / F.col("norm")).alias("weight"))


def corpus_counts(texts: DataFrame, key: str, words: Column) -> tuple[DataFrame, DataFrame]:
    """``(key, word, tf)`` of texts with distinct keys, and ``(word, idf)`` with idf = ln(n / df). No word of a text is shuffled."""
    counts = materialise(_word_counts(texts, key, words))
    total = texts.agg(F.count("*").alias("n"))
    idf = materialise(
        counts.groupBy("word").agg(F.count("*").alias("df"))
        .crossJoin(F.broadcast(total))  # one row
        .select("word", F.log(F.col("n") / F.col("df")).alias("idf"))
    )
    return counts, idf


def corpus_weights(texts: DataFrame, key: str, words: Column) -> tuple[DataFrame, DataFrame]:
    """Unit-length TF-IDF vectors ``(key, word, weight)`` and ``(word, idf)``."""
    counts, idf = corpus_counts(texts, key, words)
    return _unit_length(*_weighed(counts, key, idf), key), idf


def query_weights(texts: DataFrame, key: str, words: Column, idf: DataFrame) -> DataFrame:
    """Vectors of other texts under the idf of a corpus; words the corpus lacks are dropped."""
    return _unit_length(*_weighed(_word_counts(texts, key, words), key, idf), key)


def tfidf_scores(queries: DataFrame, query_key: str, query_words: Column, texts: DataFrame, key: str, words: Column) -> DataFrame:
    """``(query_key, key, similarity)`` of all queries and texts that share a word, by TF-IDF fitted on the texts.

    Only products of words that a query has are formed. Where the query vectors and the idf are below Spark's
    broadcast threshold, the words of the corpus stay in their partitions: partial sums per pair and one norm
    per text are shuffled. Beyond it the joins shuffle by word.
    """
    counts, idf = corpus_counts(texts, key, words)
    asked = materialise(query_weights(queries, query_key, query_words, idf).join(idf, "word").select(query_key, "word", (F.col("weight") * F.col("idf")).alias("qw")))
    _, norms = _weighed(counts, key, idf)
    products = counts.join(asked, "word").groupBy(query_key, key).agg(F.sum(F.col("tf") * F.col("qw")).alias("product"))
    return products.join(norms, key).select(query_key, key, (F.col("product") / F.col("norm")).alias("similarity"))


def text_words(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, word)``: the distinct words of every text, written, since the vectors are looked up for them before they are averaged."""
    return materialise(texts.select(key, F.explode(letter_words(F.col(text))).alias("word")))


def text_vectors(words: DataFrame, key: str, vectors: DataFrame, dim: int, unit: bool = False) -> DataFrame:
    """``(key, vec)``: mean vector of the known ``words`` of a text; ``vectors`` is ``(word, vec)``.

    One average per dimension in a single aggregation, so a word stays one row. A word has one vector, so Spark can split
    the texts of a very common one. ``unit`` averages the vectors after scaling them to length 1.
    """
    known = words.join(vectors, "word")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v)) if unit else F.lit(1.0)
    known = known.withColumn("norm", norm)
    means = [F.avg(F.get("vec", F.lit(i)).cast("double") / F.col("norm")) for i in range(dim)]
    return known.groupBy(key).agg(F.array(*means).alias("vec"))


def asked_words(asked: DataFrame, texts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(key, size, word)``: the words of texts that any query has, and ``(word, place)``: the order of these words, rarest first.

    Both are written. ``asked`` is ``(word)``, ``texts`` is ``(key, words)`` with distinct words. Only words of the queries are
    counted, so the order is as small as the queries are, whatever the corpus.
    """
    wanted = materialise(asked.select("word").distinct())
    # sizes are taken first, or each word would carry all words of its text along
    own = texts.select(key, F.size("words").alias("size"), "words").select(key, "size", F.explode("words").alias("word"))
    met = materialise(own.join(wanted, "word").select(key, "size", "word"))
    counted = wanted.join(met.groupBy("word").agg(F.count("*").alias("texts")), "word", "left").withColumn("texts", F.coalesce("texts", F.lit(0)))
    return met, materialise(positions(counted, "texts", "word").select("word", F.col("position").alias("place")))


def _prefixes(rows: DataFrame, key: str, size: str, least: Column) -> DataFrame:
    """``(key, size, at, word)``: of the ``(place, word)`` in ``known``, those among the first ``size - least + 1`` words of a text.

    Words that no query has come first in the order and cannot be met, so a text with many of them has few words left, or none.
    """
    unknown = F.col(size) - F.size("known")
    kept = F.slice("known", F.lit(1), F.greatest(F.col(size) - least + 1 - unknown, F.lit(0)).cast("int"))
    return rows.select(key, size, unknown.alias("unknown"), F.posexplode(kept).alias("at", "w")).select(key, size, (F.col("at") + F.col("unknown")).alias("at"), "w.word")


def similar_texts(queries: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``(query_id, id, similarity)`` with set cosine of the distinct words at or above ``threshold``.

    ``queries`` is ``(query_id, words)``, ``texts`` is ``(id, words)``. A pair this close shares a word among the first
    ``n - ceil(t * t * n) + 1`` words of both sides in any common order; its sizes differ by at most a factor ``t * t``; and
    enough words must follow the shared one on both sides. The order is that of the number of texts with a word, rarest
    first, so common words are hardly ever joined. Pairs that are left are checked in full.
    """
    # all filters are a little wider than they need be, so that rounding loses no pair at the threshold
    square = threshold * threshold * (1 - 1e-9)
    queries, texts = queries.where(F.size("words") > 0), texts.where(F.size("words") > 0)
    met, order = asked_words(queries.select(F.explode("words").alias("word")), texts, "id")
    ordered = lambda df, *keys: df.join(order, "word").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("known"))
    left = ordered(queries.select("query_id", F.size("words").alias("x"), F.explode("words").alias("word")), "query_id", "x")
    right = ordered(met.withColumnRenamed("size", "y"), "id", "y")
    left = _prefixes(left, "query_id", "x", F.ceil(F.col("x") * square)).withColumnRenamed("at", "i")
    right = _prefixes(right, "id", "y", F.ceil(F.col("y") * square)).withColumnRenamed("at", "j")
    near = (F.col("x") >= F.col("y") * square) & (F.col("y") >= F.col("x") * square)
    # the first shared word of a pair: it and all that follow must be enough
    enough = F.least(F.col("x") - F.col("i"), F.col("y") - F.col("j")) >= F.sqrt(square * F.col("x") * F.col("y")) - 1e-6
    pairs = left.join(right, "word").where(near).groupBy("query_id", "id").agg(F.min_by(enough, "i").alias("enough"))
    candidates = materialise(pairs.where("enough").select("query_id", "id"))
    q, t = queries.withColumnRenamed("words", "qw"), texts.withColumnRenamed("words", "tw")
    shared = F.size(F.array_intersect("qw", "tw"))
    similarity = shared / F.sqrt((F.size("qw") * F.size("tw")).cast("double"))
    return (
        candidates.join(q, "query_id").join(t, "id")
        .select("query_id", "id", similarity.alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )


def word_matrix(words_a: DataFrame, words_b: DataFrame, block: int = 512) -> DataFrame:
    """``(a, b, cosine)`` of all words of two texts, each ``(word, vec)`` with distinct words: the matrix in blocks, one block per task."""
    spark = words_a.sparkSession

    def blocked(df: DataFrame) -> tuple[DataFrame, int]:
        rows = materialise(df.select("word", F.col("vec").cast("array<double>").alias("vec")))
        blocks = max(1, -(-rows.count() // block))
        return rows.withColumn("own", F.pmod(F.xxhash64("word"), F.lit(blocks)).cast("int")), blocks

    (left, rows), (right, columns) = blocked(words_a), blocked(words_b)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sides = left.select(F.lit(True).alias("first"), "word", "vec", F.col("own").alias("r"), every(columns).alias("c")).unionByName(
        right.select(F.lit(False).alias("first"), "word", "vec", F.col("own").alias("c"), every(rows).alias("r"))
    )

    def multiply(table: pa.Table) -> pa.Table:
        first = table.column("first").to_numpy()
        words = np.array(table.column("word").to_pylist(), dtype=object)
        unit = np.array(table.column("vec").to_pylist(), dtype=np.float64).reshape(len(words), -1)
        length = np.linalg.norm(unit, axis=1, keepdims=True)
        unit = np.divide(unit, length, out=np.full_like(unit, np.nan), where=length > 0)
        a, b = words[first], words[~first]
        cells = unit[first] @ unit[~first].T
        columns = [pa.array(np.repeat(a, len(b)), pa.string()), pa.array(np.tile(b, len(a)), pa.string()), pa.array(cells.ravel())]
        return pa.Table.from_arrays(columns, names=["a", "b", "cosine"])

    tasks = max(1, min(rows * columns, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return sides.repartition(tasks, "r", "c").groupBy("r", "c").applyInArrow(multiply, "a string, b string, cosine double").where("NOT isnan(cosine)")

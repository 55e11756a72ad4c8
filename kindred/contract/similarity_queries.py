"""Similarity of texts and of word vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kindred.contract import sqltext as q
from kindred.contract.registry import query
from kindred.functions.stopwords import ENGLISH
from kindred.functions.text import letter_words, plain_words, round_half_up
from kindred.operators import similarity as sim
from kindred.session import materialise, work_dir
from kindred.sources.articles import passages, read_word_vectors, table, texts

VECTOR_SIZE = 64
COUNTED = r"[\p{L}\p{N}_]{2,}"


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that follows it: ``(doc_id, a, b)``."""
    docs = texts(spark, sf_dir)
    following = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("b"))
    return docs.select("doc_id", F.col("text").alias("a")).join(following, "doc_id")


NEIGHBOURS = "\nnb AS (SELECT x.doc_id, x.text AS a, y.text AS b FROM documents x JOIN documents y ON y.doc_id = x.doc_id + 1)"


@query(
    q.with_(
        NEIGHBOURS,
        f"""
wc AS (SELECT doc_id, word, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(b) AS DOUBLE) AS b FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(a), '{COUNTED}', 0)) AS word, 1 AS a, 0 AS b FROM nb UNION ALL
  SELECT doc_id, unnest(regexp_extract_all(lower(b), '{COUNTED}', 0)), 0, 1 FROM nb) GROUP BY ALL),
cs AS (SELECT doc_id, CASE WHEN sum(a) > 0 AND sum(b) > 0 THEN sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))) END AS s FROM wc GROUP BY doc_id)""",
    )
    + "SELECT doc_id, " + q.half_up("1 - s", 6) + " AS distance, " + q.half_up("s * 100", 2) + " AS percent FROM cs"
)
def sim_count_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    def counted(c: str):
        return F.regexp_extract_all(F.lower(c), F.lit(COUNTED), F.lit(0))

    found = sim.pair_count_cosine(neighbours(spark, sf_dir), ["doc_id"], counted("a"), counted("b"))
    return found.select(
        "doc_id",
        round_half_up(1 - F.col("similarity"), 6).alias("distance"),
        round_half_up(F.col("similarity") * 100, 2).alias("percent"),
    )


_CORPUS = f"""
dt AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest({q.plain_words('text')}) AS word FROM documents)
       WHERE word NOT IN {q.STOP} GROUP BY ALL),
df AS (SELECT word, ln(CAST((SELECT count(*) FROM documents) AS DOUBLE) / count(*)) AS idf FROM dt GROUP BY word),
dw AS (SELECT doc_id, word, tf * idf AS w FROM dt JOIN df USING (word)),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM dw GROUP BY doc_id),
qt AS (SELECT item_id, word, count(*) * any_value(idf) AS w FROM
       (SELECT item_id, unnest({q.plain_words('text')}) AS word FROM benchmark) JOIN df USING (word) GROUP BY ALL),
qn AS (SELECT item_id, sqrt(sum(w * w)) AS norm FROM qt GROUP BY item_id),
sc AS (SELECT item_id, doc_id, {q.half_up('sum(qt.w * dw.w) / any_value(qn.norm * dn.norm)', 6)} AS similarity
       FROM qt JOIN dw USING (word) JOIN dn USING (doc_id) JOIN qn USING (item_id) WHERE dn.norm > 0 AND qn.norm > 0 GROUP BY ALL)"""


@query(
    q.with_(_CORPUS)
    + "SELECT item_id AS query_id, doc_id, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id) AS rank FROM sc) WHERE rank <= 5"
)
def sim_corpus_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest documents of each query article by TF-IDF fitted on the whole corpus."""

    def words(c: str):
        return F.filter(plain_words(F.col(c)), lambda w: ~w.isin(ENGLISH))

    scores = sim.tfidf_scores(passages(spark, sf_dir), "query_id", words("text"), texts(spark, sf_dir), "doc_id", words("text"))
    scores = scores.withColumn("similarity", round_half_up(F.col("similarity"), 6))
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(best)).where("rank <= 5")


@query(
    "SELECT 'w' || vec_id AS word, len(embedding) AS n, " + q.half_up("list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE)))", 6)
    + " AS total FROM embeddings"
)
def vector_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word vectors written as text lines and read back."""
    path = work_dir(spark)
    values = F.array_join(F.transform("embedding", lambda v: v.cast("double").cast("string")), " ")
    table(spark, sf_dir, "embeddings").select(
        F.concat_ws(" ", F.concat(F.lit("w"), "vec_id"), values).alias("value")
    ).write.text(path)
    found = read_word_vectors(spark, path)
    return found.select(
        "word",
        F.size("vec").cast("long").alias("n"),
        round_half_up(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v), 6).alias("total"),
    )


LETTERS = (
    "list_distinct(list_filter(string_split(lower(regexp_replace({}, '[^a-zA-Z]', ' ', 'g')), ' '), lambda w: w <> '' AND w NOT IN "
    + q.STOP + "))"
)


@query("SELECT doc_id, unnest(" + LETTERS.format("text") + ") AS word FROM documents")
def text_letter_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.explode(letter_words(F.col("text"))).alias("word"))


@query(
    "SELECT x.vec_id, " + q.half_up("list_cosine_similarity(list_transform(x.embedding, lambda v: CAST(v AS DOUBLE)), list_transform(y.embedding, lambda v: CAST(v AS DOUBLE)))", 6)
    + " AS similarity FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1"
)
def sim_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return vectors.join(following, "vec_id").select(
        "vec_id", round_half_up(sim.cosine(F.col("embedding"), F.col("b")), 6).alias("similarity")
    )


def word_vectors(spark: SparkSession, sf_dir: str, words: DataFrame) -> DataFrame:
    """``(word, vec)``: a word takes the vector its hash points to; about half of the words have none."""
    vectors = table(spark, sf_dir, "embeddings")
    total = vectors.agg((F.count("*") * 2).alias("slots"))
    slot = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long")
    return (
        words.select("word").distinct().crossJoin(F.broadcast(total))  # one row
        .select("word", F.pmod(slot, F.col("slots")).alias("vec_id"))
        .join(vectors, "vec_id")
        .select("word", F.col("embedding").alias("vec"))
    )


def _vector_sql(source: str, key: str, unit: bool) -> str:
    norm = "sqrt(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * v)))" if unit else "1.0"
    return f"""
lw AS (SELECT {key} AS id, unnest({LETTERS.format('text')}) AS word FROM {source}),
wv AS MATERIALIZED (SELECT word, embedding, {norm} AS norm FROM (SELECT DISTINCT word FROM lw) JOIN embeddings
       ON vec_id = CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % (SELECT count(*) * 2 FROM embeddings)),
ex AS (SELECT id, unnest(embedding) / norm AS v, generate_subscripts(embedding, 1) AS pos FROM lw JOIN wv USING (word)),
mv AS MATERIALIZED (SELECT id, list(v ORDER BY pos) AS vec FROM (SELECT id, pos, avg(CAST(v AS DOUBLE)) AS v FROM ex GROUP BY ALL) GROUP BY id)"""


def _vectors(spark: SparkSession, sf_dir: str, docs: DataFrame, unit: bool) -> DataFrame:
    words = sim.text_words(docs, "id", "text")
    return sim.text_vectors(words, "id", materialise(word_vectors(spark, sf_dir, words)), VECTOR_SIZE, unit)


@query(
    q.with_(_vector_sql("documents", "doc_id", False))
    + "SELECT x.id AS doc_id, " + q.half_up("list_cosine_similarity(x.vec, y.vec)", 5) + " AS similarity FROM mv x JOIN mv y ON y.id = x.id + 1"
)
def sim_embedding_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of the mean word vectors of every document and the one that follows it."""
    docs = texts(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    vectors = materialise(_vectors(spark, sf_dir, docs, unit=False))
    following = vectors.select((F.col("id") - 1).alias("id"), F.col("vec").alias("b"))
    return vectors.join(following, "id").select(
        F.col("id").alias("doc_id"), round_half_up(sim.cosine(F.col("vec"), F.col("b")), 5).alias("similarity")
    )


@query(
    q.with_(_vector_sql("benchmark", "item_id", True))
    + ", uv AS MATERIALIZED (SELECT word, list_transform(embedding, lambda v: CAST(v AS DOUBLE) / norm) AS unit FROM wv) "
    + "SELECT l.id AS query_id, l.word, " + q.half_up("list_dot_product(u.unit, m.vec)", 5)
    + " AS mean_similarity FROM lw l JOIN uv u USING (word) JOIN mv m ON m.id = l.id + 1"
)
def sim_word_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of each matrix row: a word of one query article against all words of the next one.

    The mean cosine of a word with a set of words is its product with the mean unit vector of the set,
    so no word pairs are formed.
    """
    sides = passages(spark, sf_dir).select(F.col("query_id").alias("id"), "text")
    words = sim.text_words(sides, "id", "text")
    vectors = materialise(word_vectors(spark, sf_dir, words))
    means = sim.text_vectors(words, "id", vectors, VECTOR_SIZE, unit=True)
    following = means.select((F.col("id") - 1).alias("id"), F.col("vec").alias("mean"))
    dot = F.aggregate(F.zip_with("vec", "mean", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v))
    return words.join(vectors, "word").join(following, "id").select(
        F.col("id").alias("query_id"), "word", round_half_up(dot / norm, 5).alias("mean_similarity")
    )


def _longest(n: str) -> str:
    return f"(SELECT item_id FROM (SELECT item_id, row_number() OVER (ORDER BY length(text) DESC, item_id) AS place FROM benchmark) WHERE place = {n})"


@query(
    q.with_(_vector_sql("benchmark", "item_id", True))
    + "SELECT a.word AS a, b.word AS b, " + q.half_up("list_cosine_similarity(list_transform(x.embedding, lambda v: CAST(v AS DOUBLE)), list_transform(y.embedding, lambda v: CAST(v AS DOUBLE)))", 5)
    + f" AS cosine FROM lw a JOIN wv x ON x.word = a.word, lw b JOIN wv y ON y.word = b.word WHERE a.id = {_longest('1')} AND b.id = {_longest('2')}"
)
def sim_word_pair_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the longest passage against every word of the second longest: all cells of the matrix of one pair of texts."""
    longest = passages(spark, sf_dir).orderBy(F.length("text").desc(), "query_id").limit(2).collect()
    sides = []
    for row in longest:
        words = passages(spark, sf_dir).where(F.col("query_id") == row.query_id).select(F.explode(letter_words(F.col("text"))).alias("word"))
        sides.append(word_vectors(spark, sf_dir, words))
    return sim.word_matrix(*sides).withColumn("cosine", round_half_up(F.col("cosine"), 5))


@query(
    "WITH d AS (SELECT doc_id, " + LETTERS.format("text") + " AS w FROM documents), b AS (SELECT item_id, " + LETTERS.format("text")
    + " AS w FROM benchmark), p AS (SELECT item_id AS query_id, doc_id AS id, len(list_intersect(b.w, d.w)) / sqrt(CAST(len(b.w) * len(d.w) AS DOUBLE)) AS s "
    "FROM b, d WHERE len(b.w) > 0 AND len(d.w) > 0) SELECT query_id, id, " + q.half_up("s", 6) + " AS similarity FROM p WHERE s >= 0.3"
)
def sim_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a query article and a document whose word sets are close."""
    queries = passages(spark, sf_dir).select("query_id", letter_words(F.col("text")).alias("words"))
    docs = texts(spark, sf_dir).select(F.col("doc_id").alias("id"), letter_words(F.col("text")).alias("words"))
    found = sim.similar_texts(queries, docs, 0.3)
    return found.withColumn("similarity", round_half_up(F.col("similarity"), 6))

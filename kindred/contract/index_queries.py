"""Keyword extraction and index build."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.contract import sqltext as q
from kindred.contract.registry import query
from kindred.functions.phrases import CLASS, candidate_phrases, ranked_phrases
from kindred.functions.stopwords import all_languages
from kindred.functions.text import round_half_up
from kindred.operators import keywords as kw
from kindred.operators.phrase_tables import phrase_score_table, word_score_table
from kindred.session import materialise, work_dir
from kindred.sources.articles import articles, read_article_csv, read_article_xml, table, texts, write_article_csv
from kindred.sources.index_store import read_index_csv, write_index_csv
from kindred.sources.splits import hash_split, random_split, read_parts, write_parts


def _register_fields() -> None:
    names = {
        "content": "kw_rake_content",
        "title": "kw_title_tokens",
        "keywords": "kw_keywords_col",
        "meta_keywords": "kw_meta_keywords",
        "meta_description": "kw_meta_description",
        "tags": "kw_tags",
        "summary": "kw_rake_summary",
    }
    for field, name in names.items():
        sql = q.with_(q.ARTICLES, q.index(fields=[field], min_length=1)) + "SELECT keyword, doc_id, score FROM idx"

        def build(spark: SparkSession, sf_dir: str, field: str = field) -> DataFrame:
            found = kw.postings(articles(spark, sf_dir), fields=[field], min_length=1)
            return found.select("keyword", "doc_id", "score")

        build.__name__ = name
        query(sql)(build)


_register_fields()


@query(q.with_(q.ARTICLES, q.index()) + "SELECT keyword, doc_id, score, field FROM idx")
def kw_all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.postings(articles(spark, sf_dir))


@query(q.with_(q.ARTICLES, q.index(fraction=1.0, fields=["content"])) + "SELECT keyword, doc_id, score FROM idx")
def kw_rake_all_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.postings(articles(spark, sf_dir), fields=["content"], fraction=1.0).select("keyword", "doc_id", "score")


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        "(" + q.with_(q.ARTICLES, q.index(profile=p)) + f"SELECT '{p}' AS profile, field, count(*) AS n, " + q.half_up("sum(score)", 3) + " AS total FROM idx GROUP BY field)"
        for p in kw.FIELD_WEIGHTS
    )
    + ")"
)
def kw_weight_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and total score of the postings of every field under every profile."""
    corpus = articles(spark, sf_dir)
    found = [kw.postings(corpus, profile=p).groupBy("field").agg(F.count("*").alias("n"), round_half_up(F.sum("score"), 3).alias("total")).select(F.lit(p).alias("profile"), "*") for p in kw.FIELD_WEIGHTS]
    return functools.reduce(DataFrame.unionByName, found)


@query(
    q.with_(q.ARTICLES, q.index(fields=["content"]))
    + "SELECT doc_id, count(*) AS n, string_agg(keyword, '|' ORDER BY keyword) AS keywords, "
    + q.half_up("sum(score)", 4) + " AS total FROM idx GROUP BY doc_id"
)
def kw_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_doc = kw.document_keywords(kw.postings(articles(spark, sf_dir), fields=["content"]))
    return per_doc.select(
        "doc_id",
        F.size("keywords").cast("long").alias("n"),
        F.array_join("keywords.keyword", "|").alias("keywords"),
        round_half_up(F.aggregate("keywords.score", F.lit(0.0), lambda a, s: a + s), 4).alias("total"),
    )


@query(
    q.with_(q.ARTICLES, q.index())
    + "SELECT keyword, '(' || doc_id || ',' || CAST(CAST(score AS DECIMAL(20,1)) AS VARCHAR) || ')' AS posting FROM idx"
)
def index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kw.postings(articles(spark, sf_dir))
    return found.select("keyword", kw.posting_text(F.col("doc_id"), F.col("score")).alias("posting"))


_CHUNKED = """,
counts AS (SELECT keyword, greatest(1, CAST(ceil(count(*) / 100.0) AS BIGINT)) AS chunks FROM idx GROUP BY keyword),
chunked AS (
  SELECT idx.*, CASE WHEN c.chunks = 1 THEN 0
                ELSE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % c.chunks END AS chunk
  FROM idx JOIN counts c USING (keyword))
"""


@query(
    q.with_(q.ARTICLES, q.index()) + _CHUNKED
    + "SELECT keyword, CAST(chunk AS BIGINT) AS chunk, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id, score) AS docs, "
    + "min(score) AS low, max(score) AS high FROM chunked GROUP BY keyword, chunk"
)
def index_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = kw.group_postings(materialise(kw.postings(articles(spark, sf_dir))), per_row=100)
    return grouped.select(
        "keyword",
        "chunk",
        F.size("postings").cast("long").alias("n"),
        F.array_join(F.transform("postings", lambda p: p["doc_id"].cast("string")), ",").alias("docs"),
        F.array_min("postings.score").alias("low"),
        F.array_max("postings.score").alias("high"),
    )


@query(q.with_(q.ARTICLES, q.index()) + "SELECT keyword, CAST(doc_id AS VARCHAR) AS doc_id, score FROM idx")
def index_string_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped posting strings written as CSV, read back and decoded."""
    path = work_dir(spark)
    write_index_csv(kw.encode_postings(kw.group_postings(materialise(kw.postings(articles(spark, sf_dir))))), path)
    return kw.decode_postings(read_index_csv(spark, path))


@query(q.with_(q.ARTICLES, q.index()) + "SELECT keyword, doc_id, score, field FROM idx")
def index_multi_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of a corpus that lies in several split folders, built by one job."""
    path = work_dir(spark)
    write_parts(hash_split(articles(spark, sf_dir), 8), path)
    return kw.postings(read_parts(spark, path))


@query(
    "SELECT * FROM (" + " UNION ALL ".join("(" + q.with_(q.ARTICLES, q.index(profile=p)) + f"SELECT '{p}' AS profile, keyword, doc_id, score, field FROM idx)" for p in ("first", "light")) + ")"
)
def kw_other_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings under the weights other than the default ones."""
    first, light = (kw.postings(articles(spark, sf_dir), profile=p).withColumn("profile", F.lit(p)) for p in ("first", "light"))
    return first.unionByName(light)


# phrase extraction, step by step


@query(
    q.with_(q.rake("r", "documents", "doc_id", "text", variant=CLASS))
    + "SELECT id AS doc_id, phrase, count(*) AS n FROM r_cand GROUP BY id, phrase"
)
def rake_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    phrases = docs.select("doc_id", F.explode(candidate_phrases(F.col("text"), CLASS)).alias("phrase"))
    return phrases.groupBy("doc_id", "phrase").agg(F.count("*").alias("n"))


@query(
    q.with_(q.rake("r", "documents", "doc_id", "text", variant=CLASS))
    + "SELECT id AS doc_id, w AS word, freq, degree, " + q.half_up("degree / freq", 6) + " AS score FROM r_words"
)
def rake_word_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_score_table(texts(spark, sf_dir), "doc_id", "text", CLASS)
    return found.withColumn("score", round_half_up(F.col("score"), 6))


@query(
    q.with_(q.rake("r", "documents", "doc_id", "text", variant=CLASS))
    + "SELECT id AS doc_id, phrase, " + q.half_up("score", 6) + " AS score FROM r_all"
)
def rake_phrase_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_score_table(texts(spark, sf_dir), "doc_id", "text", CLASS)
    return found.withColumn("score", round_half_up(F.col("score"), 6))


@query(
    q.with_(q.rake("r", "documents", "doc_id", "text", 1 / 3, CLASS))
    + "SELECT id AS doc_id, phrase, " + q.half_up("score", 6) + " AS score, rn AS rank FROM r"
)
def rake_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    ranked = ranked_phrases(F.col("text"), 1 / 3, CLASS)
    return docs.select("doc_id", F.posexplode(ranked).alias("pos", "p")).select(
        "doc_id",
        "p.phrase",
        round_half_up(F.col("p.score"), 6).alias("score"),
        (F.col("pos") + 1).cast("long").alias("rank"),
    )


@query(
    q.with_(q.rake("r", "pages", "page_id", "html"))
    + "SELECT phrase AS keyword, split_part(url, '/', -1) || ',' || CAST(" + q.half_up("score", 1)
    + " AS VARCHAR) AS posting FROM r JOIN pages ON page_id = id"
)
def rake_with_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting as base name of the location and score."""
    pages = texts(spark, sf_dir, "pages").select(F.substring_index("url", "/", -1).alias("name"), "html")
    found = kw.file_keywords(pages, "name", "html", digits=1)
    return found.select("keyword", F.concat_ws(",", "doc_id", F.col("score").cast("string")).alias("posting"))


@query()
def rake_all_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases between the stop words of all languages, which Spark ships."""
    ranked = ranked_phrases(F.col("text"), 1 / 3, CLASS, all_languages())
    found = texts(spark, sf_dir).select("doc_id", F.posexplode(ranked).alias("pos", "p"))
    return found.select("doc_id", "p.phrase", round_half_up(F.col("p.score"), 6).alias("score"), (F.col("pos") + 1).cast("long").alias("rank"))


# sources and splits


@query("SELECT doc_id AS id, text AS content, source AS tags FROM documents")
def csv_roundtrip_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark)
    docs = texts(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), F.col("source").alias("tags")
    )
    write_article_csv(docs, path)
    back = read_article_csv(spark, path, docs.schema)
    return back.withColumn("id", F.col("id").cast("long"))


def _write_xml(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark)
    docs = texts(spark, sf_dir).select(F.col("text").alias("mainText"))
    docs.write.xml(path, rowTag="article", rootTag="articles")
    return path


@query("SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY 1")
def xml_article_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_article_xml(spark, _write_xml(spark, sf_dir))
    return found.where(F.col("filename").startswith("part-")).groupBy(F.md5("mainText").alias("digest")).agg(
        F.count("*").alias("n")
    )


_XML = q.with_(q.rake("r", "documents", "doc_id", "text"))


@query(_XML + "SELECT phrase AS keyword, " + q.half_up("score", 2) + " AS score, count(*) AS n FROM r GROUP BY ALL")
def xml_extract_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kw.file_keywords(read_article_xml(spark, _write_xml(spark, sf_dir)))
    return found.groupBy("keyword", "score").agg(F.count("*").alias("n"))


@query(_XML + "SELECT phrase AS keyword, count(*) AS n_postings, min(" + q.half_up("score", 2) + ") AS low FROM r GROUP BY phrase")
def xml_keyword_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = kw.group_postings(materialise(kw.file_keywords(read_article_xml(spark, _write_xml(spark, sf_dir)))))
    return grouped.groupBy("keyword").agg(
        F.sum(F.size("postings")).alias("n_postings"), F.min(F.array_min("postings.score")).alias("low")
    )


@query(_XML + "SELECT phrase AS keyword, count(*) AS n_postings, min(" + q.half_up("score", 2) + ") AS low FROM r GROUP BY phrase")
def xml_keywords_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction written as Parquet first, grouped by a second job."""
    path = work_dir(spark)
    kw.file_keywords(read_article_xml(spark, _write_xml(spark, sf_dir))).write.parquet(path)
    return spark.read.parquet(path).groupBy("keyword").agg(
        F.count("*").alias("n_postings"), F.min("score").alias("low")
    )


@query("SELECT CAST(item_id AS VARCHAR) AS query_id, md5(text) AS digest, length(text) AS n FROM benchmark")
def query_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query article as a file of its own, read back as whole texts."""
    path = work_dir(spark)
    # one folder per article: a query batch is a small set of files
    table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("q"), "text").repartition("q").write.partitionBy(
        "q"
    ).option("lineSep", "\x1e").text(path)
    found = spark.read.text(path, wholetext=True)
    text = F.regexp_replace("value", "\x1e$", "")
    return found.select(F.col("q").cast("string").alias("query_id"), F.md5(text).alias("digest"), F.length(text).cast("long").alias("n"))


@query()
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint random parts that together are the corpus: size of each."""
    parts = random_split(texts(spark, sf_dir), 6, seed=42)
    return parts.groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(*) AS different, 6 AS parts FROM documents")
def split_by_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of equal weight by ``randomSplit``: together they hold every document once."""
    parts = table(spark, sf_dir, "documents").select("doc_id").randomSplit([1.0] * 6, seed=42)
    named = functools.reduce(DataFrame.unionByName, [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)])
    return named.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("different"), F.countDistinct("part").cast("int").alias("parts"))


@query(
    "SELECT doc_id AS id, 'documents' || lpad(CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 6 AS VARCHAR), 5, '0') AS part, "
    "n_chars FROM documents"
)
def split_hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark)
    docs = texts(spark, sf_dir).withColumnRenamed("doc_id", "id")
    write_parts(hash_split(docs, 6, "documents"), path)
    return read_parts(spark, path).select("id", "part", "n_chars")


@query(
    "SELECT d.doc_id AS id, d.lang, length(d.text) AS n FROM documents d "
    "WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"
)
def lookup_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    docs = texts(spark, sf_dir).join(wanted, "doc_id", "left_semi")
    return docs.select(F.col("doc_id").alias("id"), "lang", F.length("text").cast("long").alias("n"))

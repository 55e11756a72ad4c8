"""Search: phrases, matches, scores, recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.contract import sqltext as q
from kindred.contract.registry import query
from kindred.functions.stopwords import ENGLISH
from kindred.functions.text import round_half_up
from kindred.operators import blocked_index, search
from kindred.operators.keywords import postings
from kindred.operators.similarity import UNSHARED, rerank
from kindred.plans import recommend as plan
from kindred.session import materialise, work_dir
from kindred.sources.articles import WHOLE, article_types, articles, query_articles, whole_articles


def _index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return plan.build_index(articles(spark, sf_dir))


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(search.dictionary(postings(articles(spark, sf_dir))))


def _phrases(queries: DataFrame) -> DataFrame:
    return materialise(search.query_phrases(queries))


# query articles: passages of ten benchmark items, or the longest documents of each language with their two halves
PASSAGES = "\nqa AS (SELECT item_id // 10 AS item_id, string_agg(text, chr(10) ORDER BY item_id) AS text FROM benchmark GROUP BY 1)"
HALVES = f"""
longest AS (SELECT doc_id, string_split(text, chr(10)) AS rows FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY length(text) DESC, doc_id) AS place FROM documents) WHERE place <= {WHOLE}),
qa AS (SELECT doc_id * 3 + part AS item_id, array_to_string(CASE part WHEN 0 THEN rows WHEN 1 THEN rows[1:(len(rows) + 1) // 2] ELSE rows[(len(rows) + 1) // 2 + 1:] END, chr(10)) AS text
       FROM longest, (SELECT unnest([0, 1, 2]) AS part))"""


def phrases_sql(queries: str) -> str:
    """``qp(query_id, phrase, score, rank, n)`` of the query articles ``qa``."""
    ranked = q.rake("qr", "qa", "item_id", "text", 0.5)
    return queries + "," + ranked + ",\nqp AS (SELECT id AS query_id, phrase, score, rn AS rank, count(*) OVER (PARTITION BY id) AS n FROM qr)"


FOLDED = "\nfx AS (SELECT " + q.fold("keyword") + " AS keyword, doc_id, score FROM idx),\ndict AS (SELECT DISTINCT keyword FROM fx)"
TEXT_WORDS = (
    "\ntw AS (SELECT item_id AS query_id, list_distinct(list_filter(string_split("
    r"regexp_replace(regexp_replace(lower(text), '[ \t\n\r\f\x0b]+', ' ', 'g'), '[^A-Za-z0-9 ]+', '', 'g'), ' '), lambda w: w <> '')) AS words, text FROM qa)"
)


def pair_sql(source: str, stop: bool = False) -> str:
    keep = f"WHERE tok NOT IN {q.STOP}" if stop else ""
    side = lambda t, cols, txt: (
        f"SELECT *, count(*) OVER (PARTITION BY {cols}) AS m FROM (SELECT DISTINCT {cols}{', score' if t != 'dict' else ''}, tok FROM "
        f"(SELECT *, unnest({q.tokens(txt)}) AS tok FROM {t}) {keep})"
    )
    return f"""
kt AS ({side('dict', 'keyword', 'keyword')}),
pt AS ({side(source, 'query_id, phrase', 'phrase')}),
pp AS (SELECT p.query_id, p.phrase, p.score, k.keyword, count(*) AS shared, k.m AS x, p.m AS y
       FROM kt k JOIN pt p USING (tok) GROUP BY p.query_id, p.phrase, p.score, k.keyword, k.m, p.m),
pn AS (SELECT pp.*, shared / sqrt(CAST(x * y AS DOUBLE)) AS ratio FROM pp
       WHERE NOT EXISTS (SELECT 1 FROM qp WHERE qp.query_id = pp.query_id AND qp.phrase = pp.keyword))"""


OVERLAP = (
    "len(list_distinct(list_intersect(string_split(regexp_replace(keyword, '[^ A-Za-z0-9]+', '', 'g'), ' '), words))) "
    "> len(string_split(regexp_replace(keyword, '[^ A-Za-z0-9]+', '', 'g'), ' ')) // 2"
)
TOP = "\ntop AS (SELECT * FROM qp WHERE rank <= n // 20)"
FUZZY = (
    f"\nfz AS (SELECT pn.query_id, keyword, phrase, ratio, score * ratio AS kw_score FROM pn JOIN tw USING (query_id) "
    f"WHERE ratio > 0.5 AND {OVERLAP})"
)
MATCH = "\nmt AS (SELECT query_id, phrase AS keyword, score AS kw_score FROM qp UNION ALL SELECT query_id, keyword, kw_score FROM fz)"
SCORED = (
    "\nsp AS (SELECT query_id, doc_id, fx.keyword, kw_score, fx.score AS posting_score, kw_score + fx.score AS score FROM fx JOIN mt USING (keyword))"
    ",\nsd AS (SELECT query_id, doc_id, " + q.half_up("sum(score)", 6) + " AS score FROM sp GROUP BY query_id, doc_id)"
    ",\ntd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sd) WHERE rank <= 15)"
)


def search_ctes(fields=None) -> list[str]:
    return [q.ARTICLES, q.index(fields=fields), phrases_sql(HALVES), FOLDED, TEXT_WORDS, TOP, pair_sql("top"), FUZZY, MATCH, SCORED]


def similarity_sql(pairs: str) -> str:
    """``rr(query_id, doc_id, similarity)`` from ``pairs(query_id, doc_id, query_text, text)``."""
    return f"""
pc AS (
  SELECT query_id, doc_id, word, sum(a) AS a, sum(b) AS b FROM (
    SELECT query_id, doc_id, unnest({q.plain_words('query_text')}) AS word, 1 AS a, 0 AS b FROM {pairs}
    UNION ALL
    SELECT query_id, doc_id, unnest({q.plain_words(q.fold('text'))}), 0, 1 FROM {pairs})
  WHERE word NOT IN {q.STOP} GROUP BY ALL),
pw AS (SELECT *, CASE WHEN a > 0 AND b > 0 THEN CAST(1 AS DOUBLE) ELSE CAST({UNSHARED!r} AS DOUBLE) END AS w FROM pc),
rr AS (SELECT query_id, doc_id, CASE WHEN sum(a) > 0 AND sum(b) > 0
         THEN sum(a * w * b * w) / (sqrt(sum(a * w * a * w)) * sqrt(sum(b * w * b * w))) ELSE 0 END AS similarity
       FROM pw GROUP BY query_id, doc_id)"""


PAIRS = "\nprs AS (SELECT td.*, b.text AS query_text, d.text FROM td JOIN qa b ON b.item_id = td.query_id JOIN documents d USING (doc_id))"


@query(q.with_(phrases_sql(HALVES)) + "SELECT query_id, phrase, " + q.half_up("score", 6) + " AS score, rank, n FROM qp")
def query_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.query_phrases(whole_articles(spark, sf_dir))
    return found.withColumn("score", round_half_up(F.col("score"), 6))


@query(
    q.with_(q.ARTICLES, q.index(), phrases_sql(PASSAGES), FOLDED)
    + "SELECT query_id, keyword, doc_id, fx.score AS posting_score, " + q.half_up("qp.score", 6)
    + " AS kw_score FROM fx JOIN qp ON qp.phrase = fx.keyword"
)
def match_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = search.score_pairs(postings(articles(spark, sf_dir)), search.exact_matches(_phrases(query_articles(spark, sf_dir))))
    return pairs.select("query_id", "keyword", "doc_id", "posting_score", round_half_up(F.col("kw_score"), 6).alias("kw_score"))


@query(
    q.with_(q.ARTICLES, q.index(), FOLDED, PASSAGES, TEXT_WORDS)
    + f"SELECT query_id, keyword FROM dict, tw WHERE {OVERLAP}"
)
def match_overlap_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.overlapping_keywords(_keywords(spark, sf_dir), query_articles(spark, sf_dir))


@query(
    q.with_(q.ARTICLES, q.index(), phrases_sql(HALVES), FOLDED, TEXT_WORDS, TOP, pair_sql("top"), FUZZY)
    + "SELECT query_id, keyword, phrase, " + q.half_up("ratio", 6) + " AS ratio, " + q.half_up("kw_score", 6) + " AS kw_score FROM fz"
)
def match_fuzzy_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = whole_articles(spark, sf_dir)
    keywords = _keywords(spark, sf_dir)
    found = search.fuzzy_matches(keywords, _phrases(queries), queries)
    return _rounded(found)


def _rounded(found: DataFrame) -> DataFrame:
    return found.select(
        "query_id",
        "keyword",
        "phrase",
        round_half_up(F.col("ratio"), 6).alias("ratio"),
        round_half_up(F.col("kw_score"), 6).alias("kw_score"),
    )


_NOSTOP = [q.ARTICLES, q.index(), phrases_sql(PASSAGES), FOLDED, TEXT_WORDS, pair_sql("qp", stop=True)]


@query(q.with_(*_NOSTOP) + "SELECT DISTINCT pn.query_id, keyword FROM pn JOIN tw USING (query_id) WHERE contains(text, keyword)")
def match_substring_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nostop(spark, sf_dir).select("query_id", "keyword").distinct()


@query(
    q.with_(*_NOSTOP)
    + "SELECT pn.query_id, keyword, phrase, " + q.half_up("ratio", 6) + " AS ratio, " + q.half_up("score * ratio", 6)
    + " AS kw_score FROM pn JOIN tw USING (query_id) WHERE contains(text, keyword)"
)
def match_cosine_nostop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_nostop(spark, sf_dir))


def _nostop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.fuzzy_matches(
        _keywords(spark, sf_dir),
        _phrases(query_articles(spark, sf_dir)),
        query_articles(spark, sf_dir),
        threshold=0.0,
        share=1,
        without=ENGLISH,
        prefilter="substring",
    )


@query(
    q.with_(q.ARTICLES, q.index(), phrases_sql(PASSAGES), FOLDED)
    + "SELECT query_id, keyword, phrase, " + q.half_up("r", 6) + " AS ratio, " + q.half_up("score / 2", 6) + " AS kw_score FROM ("
    "SELECT *, 1 - levenshtein(keyword, phrase) / greatest(length(keyword), length(phrase)) AS r FROM dict, qp "
    "WHERE abs(length(keyword) - length(phrase)) <= 0.41 * greatest(length(keyword), length(phrase)) "
    "AND NOT EXISTS (SELECT 1 FROM qp own WHERE own.query_id = qp.query_id AND own.phrase = dict.keyword)) WHERE r >= 0.6"
)
def match_edit_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(search.edit_matches(_keywords(spark, sf_dir), _phrases(query_articles(spark, sf_dir))))


@query(
    q.with_(*search_ctes())
    + "SELECT query_id, doc_id, keyword, posting_score, " + q.half_up("score", 6) + " AS score FROM sp"
)
def score_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, keywords = _index(spark, sf_dir)
    pairs = search.score_pairs(index, plan.matches(keywords, whole_articles(spark, sf_dir)))
    return pairs.select("query_id", "doc_id", "keyword", "posting_score", round_half_up(F.col("score"), 6).alias("score"))


@query(q.with_(*search_ctes()) + "SELECT query_id, doc_id, score FROM sd")
def score_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, keywords = _index(spark, sf_dir)
    return search.score_documents(search.score_pairs(index, plan.matches(keywords, whole_articles(spark, sf_dir))))


@query(q.with_(*search_ctes()) + "SELECT query_id, doc_id, score, rank FROM td")
def score_docs_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.candidates(*_index(spark, sf_dir), whole_articles(spark, sf_dir))


@query(q.with_(*search_ctes()) + "SELECT query_id, doc_id, score, rank FROM td")
def search_block_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents from an index in blocks, without reading the blocks that cannot hold one."""
    index, keywords = _index(spark, sf_dir)
    return blocked_index.best_documents(blocked_index.build(index), plan.matches(keywords, whole_articles(spark, sf_dir)))


@query(
    q.with_(*search_ctes())
    + "SELECT td.query_id, td.rank, a.id AS doc_id, a.type, a.title, length(a.content) AS n FROM td JOIN articles a ON a.id = td.doc_id"
)
def fetch_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = materialise(plan.candidates(*_index(spark, sf_dir), whole_articles(spark, sf_dir)))
    found = plan.fetch(articles(spark, sf_dir), article_types(spark, sf_dir), best)
    return found.join(best, "doc_id").select(
        "query_id", "rank", "doc_id", "type", "title", F.length("content").cast("long").alias("n")
    )


@query(
    q.with_(*search_ctes(["content"]), PAIRS, similarity_sql("prs"))
    + "SELECT query_id, doc_id, " + q.half_up("similarity", 6) + " AS similarity FROM rr"
)
def rerank_tfidf_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rerank(spark, sf_dir, stemming=False)


@query()
def rerank_tfidf_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rerank(spark, sf_dir, stemming=True)


def _rerank(spark: SparkSession, sf_dir: str, stemming: bool) -> DataFrame:
    queries = whole_articles(spark, sf_dir)
    corpus = articles(spark, sf_dir)
    best = materialise(plan.candidates(*plan.build_index(corpus, ["content"]), queries))
    found = materialise(plan.fetch(corpus, article_types(spark, sf_dir), best))
    pairs = found.join(best, "doc_id").join(queries, "query_id")
    similar = rerank(pairs, ["query_id", "doc_id"], "text", "content", stemming=stemming)
    return similar.withColumn("similarity", round_half_up(F.col("similarity"), 6))


_RECOMMEND = (
    "SELECT query_id, rank, doc_id, type, title, td.score, " + q.half_up("similarity", 6) + " AS similarity "
    "FROM td JOIN rr USING (query_id, doc_id) JOIN articles a ON a.id = td.doc_id"
)


@query(q.with_(*search_ctes(), PAIRS, similarity_sql("prs")) + _RECOMMEND)
def recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the best documents for every query article, with their similarity."""
    found = plan.recommend(articles(spark, sf_dir), article_types(spark, sf_dir), *_index(spark, sf_dir), whole_articles(spark, sf_dir))
    return found.drop("content")


@query(q.with_(*search_ctes(["title", "tags", "content"]), PAIRS, similarity_sql("prs")) + _RECOMMEND)
def recommend_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index build and search in one run, on three of the fields."""
    found = plan.build_and_recommend(articles(spark, sf_dir), article_types(spark, sf_dir), whole_articles(spark, sf_dir), ["title", "tags", "content"])
    return found.drop("content")


@query(
    q.with_(*search_ctes(), PAIRS, similarity_sql("prs"))
    + "SELECT query_id, CAST(rank - 1 AS VARCHAR) || '_' || doc_id AS name, md5('File id in dataset: ' || doc_id || chr(10) || 'Labels from dataset: ' "
    "|| coalesce(type, '') || chr(10) || 'Similarity Score: ' || printf('%.6f', " + q.half_up("similarity", 6) + ") || chr(10) || 'Title: ' || "
    + q.fold("title") + " || chr(10) || " + q.fold("content")
    + ") AS digest FROM td JOIN rr USING (query_id, doc_id) JOIN articles a ON a.id = td.doc_id"
)
def recommend_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files written and read back as whole texts."""
    path = work_dir(spark)
    plan.write_reports(
        plan.recommend(articles(spark, sf_dir), article_types(spark, sf_dir), *_index(spark, sf_dir), whole_articles(spark, sf_dir)), path
    )
    back = spark.read.option("basePath", path).text(path, wholetext=True)
    return back.select(
        F.col("query_id").cast("long").alias("query_id"), "name", F.md5(F.regexp_replace("value", "\n$", "")).alias("digest")
    )

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import keywords as kw
from kindred.session import materialise, work_dir
from kindred.sources.articles import ARTICLE_COLUMNS, read_article_csv, read_article_xml, read_query_texts, write_article_csv
from kindred.sources.index_store import read_index_csv, write_index, write_index_csv, write_index_table
from kindred.sources.splits import hash_split, random_split

FIELDS = "id long, content string, title string, keywords string, meta_keywords string, meta_description string, tags string, summary string"


def build(spark, **fields):
    row = {"id": 7, "content": None, "title": None, "keywords": None, "meta_keywords": None, "meta_description": None, "tags": None, "summary": None}
    row.update(fields)
    return sorted((r.keyword, r.doc_id, r.score, r.field) for r in kw.postings(spark.createDataFrame([row], FIELDS)).collect())


def test_null_markers_give_nothing(spark):
    assert build(spark, content="null", title="null", keywords="null", meta_keywords="null", tags="null", summary="null") == []
    assert build(spark) == []


def test_title_keeps_capitalised_stop_words(spark):
    assert build(spark, title="The café of a King a-b x") == [
        ("a-b", 7, 10.0, "title"), ("caf", 7, 10.0, "title"), ("king", 7, 10.0, "title"), ("the", 7, 10.0, "title"),
    ]


def test_word_lists(spark):
    assert build(spark, meta_keywords="['Alpha beta', u'gamma', 'x']") == [("alpha beta", 7, 13.0, "meta_keywords"), ("gamma", 7, 13.0, "meta_keywords")]
    assert build(spark, meta_keywords="not a list") == []
    assert build(spark, tags="One, Two") == [(" two", 7, 13.0, "tags"), ("one", 7, 13.0, "tags")]
    assert build(spark, keywords="One two of") == [("one", 7, 13.0, "keywords"), ("two", 7, 13.0, "keywords")]


def test_content_keeps_the_better_half(spark):
    assert build(spark, content="big red dog, cat, mouse") == [("big red dog", 7, 9.0, "content")]


def hot_index(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("keyword"), F.col("id").alias("doc_id"), (F.col("id") % 7).cast("double").alias("score"))
    cold = spark.range(50).select(F.concat(F.lit("k"), "id").alias("keyword"), F.col("id").alias("doc_id"), F.lit(1.0).alias("score"))
    return materialise(hot.union(cold))


def test_hot_keyword_is_spread_and_whole(spark):
    index = hot_index(spark)
    grouped = kw.group_postings(index, per_row=100)
    sizes = [r.n for r in grouped.where("keyword = 'hot'").select(F.size("postings").alias("n")).collect()]
    assert len(sizes) == 30 and sum(sizes) == 3000 and max(sizes) < 200
    assert grouped.where("keyword <> 'hot'").count() == 50


def test_codec_round_trip(spark):
    index = hot_index(spark)
    path = work_dir(spark)
    write_index_csv(kw.encode_postings(kw.group_postings(index, per_row=100)), path, single_file=True)
    back = kw.decode_postings(read_index_csv(spark, path)).select("keyword", F.col("doc_id").cast("long").alias("doc_id"), "score")
    assert back.exceptAll(index).isEmpty() and index.exceptAll(back).isEmpty()


def test_index_tables(spark):
    index = hot_index(spark)
    path = work_dir(spark)
    write_index(index, path)
    assert spark.read.parquet(path).count() == 3050
    name = "index_" + path.rsplit("/", 1)[1]
    write_index_table(index, name, buckets=4)
    plan = spark.table(name).groupBy("keyword").count()._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    spark.sql(f"DROP TABLE {name}")


def test_csv_keeps_line_breaks_quotes_and_nulls(spark):
    row = {c: None for c in ARTICLE_COLUMNS}
    row.update(id="1", content='a "quoted"\nsecond, line ', title=" lead")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in ARTICLE_COLUMNS)).select(*ARTICLE_COLUMNS)
    path = work_dir(spark)
    write_article_csv(df, path)
    assert read_article_csv(spark, path).collect() == df.collect()


def test_xml_and_text_sources(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<article><title>t</title><mainText>big dog</mainText></article>")
    (tmp_path / "b.xml").write_text("<article><title>no text</title></article>")
    rows = sorted(read_article_xml(spark, str(tmp_path)).collect())
    assert [(r.filename, r.mainText) for r in rows] == [("a.xml", "big dog"), ("b.xml", None)]
    found = kw.file_keywords(read_article_xml(spark, str(tmp_path))).collect()
    assert [tuple(r) for r in found] == [("big dog", "a.xml", 4.0)]
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "query.txt").write_text("line one\nline two")
    assert [tuple(r) for r in read_query_texts(spark, str(tmp_path / "q")).collect()] == [("query.txt", "line one\nline two")]


def test_splits_cover_and_are_disjoint(spark):
    df = spark.range(2000)
    for parts in (hash_split(df, 5), random_split(df, 5, seed=1)):
        assert parts.count() == 2000 and parts.select("id").distinct().count() == 2000
        sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
        assert len(sizes) == 5 and min(sizes) > 300

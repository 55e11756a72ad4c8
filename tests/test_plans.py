"""Shapes of plans that have to hold at scale."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kindred.operators import search, similarity as sim
from kindred.operators.keywords import postings
from kindred.operators.phrase_tables import phrase_score_table
from kindred.session import materialise, spread, work_dir
from kindred.sources.articles import articles, query_articles, table

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written_articles(spark):
    return materialise(articles(spark, SF_DIR).repartition(16))


def test_index_build_is_one_scan_without_shuffle(written_articles):
    plan = plan_of(postings(written_articles))
    assert "Exchange" not in plan and plan.count("FileScan") == 1 and "BatchEvalPython" not in plan


def test_phrase_tables_shuffle_once_per_side(spark, written_articles):
    plan = plan_of(phrase_score_table(written_articles, "id", "content"))
    assert plan.count("Exchange hashpartitioning") <= 3


def test_small_matches_are_broadcast_and_the_index_is_not_shuffled(spark, written_articles):
    index = materialise(postings(written_articles))
    matches = materialise(search.exact_matches(search.query_phrases(query_articles(spark, SF_DIR))))
    plan = plan_of(search.score_pairs(index, matches))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_matches_are_not_broadcast(spark, written_articles):
    index = materialise(postings(written_articles))
    matches = materialise(search.exact_matches(search.query_phrases(query_articles(spark, SF_DIR))))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "BroadcastHashJoin" not in plan_of(search.score_pairs(index, matches))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_top_documents_cut_before_the_shuffle(spark):
    scores = spark.range(100).select((F.col("id") % 3).alias("query_id"), F.col("id").alias("doc_id"), F.rand(1).alias("score"))
    assert "WindowGroupLimit" in plan_of(search.top_documents(scores, 5))


def test_pair_counts_shuffle_texts_only(spark):
    pairs = materialise(spark.createDataFrame([(1, "a b", "b c")], "k int, a string, b string"))
    counts = sim.pair_counts(pairs, ["k"], F.split("a", " "), F.split("b", " "))
    assert plan_of(sim.pair_tfidf_cosine(counts, ["k"])).count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(spark):
    li = table(spark, SF_DIR, "lineitem").where("l_quantity < 10").select("l_orderkey")
    plan = plan_of(li)
    assert "LessThan(l_quantity,10.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_bucketed_state_is_not_shuffled_again(spark):
    links = materialise(spark.range(1000).select((F.col("id") % 50).alias("src"), F.col("id").alias("dst")), bucket_by="src")
    assert "Exchange" not in plan_of(links.groupBy("src").count())


def test_spread_leaves_large_inputs_alone(spark):
    assert "Exchange" not in plan_of(spread(spark.range(0, 1000, 1, 64)))
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() >= 8


def test_work_dir_follows_the_setting():
    session = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert work_dir(session).startswith("hdfs://shared/folder/") and work_dir(session) != work_dir(session)


def test_a_cluster_without_the_setting_is_refused():
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(session)

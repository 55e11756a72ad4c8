"""What jobs write for themselves, and the state of models trained on streams."""

from __future__ import annotations

import threading
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.contract import ml_queries
from kindred.operators import graph
from kindred.operators import similarity as sim
from kindred.session import bounded, materialise, scratch, work_dir
from kindred.streaming.models import BatchState, stream_kmeans, stream_logistic


def test_scope_removes_folders_and_tables(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src int, dst int")
    root = Path(work_dir(spark)).parent
    root.mkdir(exist_ok=True)
    folders, tables = set(root.iterdir()), {t.name for t in spark.catalog.listTables()}
    with scratch(spark):
        assert graph.pagerank(edges, 7).count() == 3
        assert set(root.iterdir()) > folders
    assert set(root.iterdir()) == folders and {t.name for t in spark.catalog.listTables()} == tables


def test_scopes_nest_and_end_on_errors(spark):
    one = spark.range(3)
    with scratch(spark):
        kept = materialise(one)
        with pytest.raises(ValueError), scratch(spark):
            lost = materialise(one)
            raise ValueError
        assert kept.count() == 3
        with pytest.raises(Exception):
            lost.collect()
    assert materialise(one).count() == 3  # no scope is open


def test_another_thread_keeps_its_tables(spark):
    made = []
    with scratch(spark):
        other = threading.Thread(target=lambda: made.append(materialise(spark.range(4))))
        other.start()
        other.join()
    assert made[0].count() == 4


def test_closure_finds_all_paths(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (3, 4), (5, 5)], "src int, dst int")
    found = sorted(tuple(r) for r in graph.transitive_closure(edges).collect())
    assert found == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (5, 5)]
    assert graph.transitive_closure(edges.where("src > 9")).count() == 0


def test_state_of_a_stream_outlives_its_run(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(rng.normal(m, 0.1, 2).tolist(), float(m > 0)) for m in (-2, 2) for _ in range(20)]
    source = str(tmp_path / "source")
    folders = [str(tmp_path / n) for n in ("state", "checkpoint")]

    def run(part, learn):
        spark.createDataFrame(part, "vec array<double>, label double").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("vec array<double>, label double").parquet(source)
        return learn(stream, *folders)

    kmeans = lambda stream, state, checkpoint: stream_kmeans(stream, 2, state=state, checkpoint=checkpoint)
    first = run(rows[::2], kmeans)
    state = BatchState(spark, folders[0])
    before = state.last()
    assert np.array_equal(before["centres"], first)
    second = run(rows[1::2], kmeans)
    after = state.last()
    # the second run starts from the weights of the first one
    assert after["weight"].sum() == pytest.approx(before["weight"].sum() * 0.8 + 20)
    assert not np.array_equal(first, second)


def test_logistic_weights_separate_two_vectors(spark, tmp_path):
    source = str(tmp_path / "two")
    spark.createDataFrame([([1.0, -1.0], 1.0), ([-1.0, 1.0], 0.0)], "vec array<double>, label double").write.parquet(source)
    weights = stream_logistic(spark.readStream.schema("vec array<double>, label double").parquet(source))
    assert weights[0] > 0 > weights[1]


def test_word_counts_of_empty_and_missing_lists(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["ß", "b"])], "id int, words array<string>")
    got = {r.id: {c.word: c.tf for c in r.found} for r in rows.select("id", sim.word_counts(F.col("words")).alias("found")).collect()}
    assert got == {1: {"a": 1, "b": 2}, 2: {}, 3: {}, 4: {"ß": 1, "b": 1}}


def test_tfidf_scores_shuffle_no_words_of_the_corpus(spark):
    texts = spark.createDataFrame([(1, "red dog"), (2, "red cat"), (3, "red red"), (4, None)], "id int, text string")
    queries = spark.createDataFrame([(9, "dog dog red"), (8, "unknown")], "query_id int, q string")
    found = sim.tfidf_scores(queries, "query_id", F.split("q", " "), texts, "id", F.split("text", " "))
    got = {(r.query_id, r.id): r.similarity for r in found.collect()}
    assert set(got) == {(9, 1), (9, 2), (9, 3)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 0  # words are counted once and read from a written table
    assert got[9, 1] == max(got.values()) and got[9, 1] < 1


def test_models_on_lines_keep_a_bounded_number_of_rows_in_a_task(spark, tmp_path, monkeypatch):
    """a task kept, over all passes, the rows of as many files as one scan reads."""
    made = spark.range(0, 4000, 1, 1).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 50 + 1.0).alias("l_quantity"), (F.col("id") % 10 / 100.0).alias("l_discount"), (F.col("id") % 8 / 100.0).alias("l_tax"), (F.col("id") % 50 * 10.0).alias("l_extendedprice")
    )
    made.write.parquet(str(tmp_path / "lineitem.parquet"))
    whole = bounded(spark.read.parquet(str(tmp_path / "lineitem.parquet")), 4000)
    assert whole.rdd.getNumPartitions() == 1
    monkeypatch.setattr(ml_queries, "bounded", lambda df: bounded(df, 500))
    sizes = ml_queries._priced(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) <= 600

"""Own state and own sinks of streams; joins by the rarest words."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import Row, functions as F

from kindred.operators import search, similarity
from kindred.session import materialise, work_dir
from kindred.streaming import jobs, state
from kindred.streaming.runs import run_append, run_batches, stream
from kindred.streaming.sinks import JsonRows, run_rows


def test_a_repeated_epoch_leaves_each_row_once(tmp_path):
    folder = (tmp_path / "out").as_uri()

    def attempt(epoch, rows, error=None):
        sink = JsonRows(folder)
        if sink.open(0, epoch):
            for r in rows:
                sink.process(Row(a=r))
            sink.close(error)

    attempt(1, [1, 2], ValueError("lost"))
    attempt(1, [1, 2])
    attempt(1, [1, 2])
    attempt(2, [3])
    attempt(3, [])
    files = sorted((tmp_path / "out").iterdir())
    assert [f.name for f in files] == ["epoch=1-part=0.json", "epoch=2-part=0.json"]
    assert [json.loads(x)["a"] for f in files for x in f.read_text().splitlines()] == [1, 2, 3]


def test_rows_go_on_from_the_checkpoint(spark):
    source, out, checkpoint = work_dir(spark), work_dir(spark), work_dir(spark)
    for lo in (0, 10):
        spark.range(lo, lo + 10).write.mode("append").parquet(source)
        run_rows(stream(spark, source), out, checkpoint)
    assert sorted(r.id for r in spark.read.schema("id long").json(f"{out}/*.json").collect()) == list(range(20))


def test_sessions_close_and_leave_the_state(spark):
    """Two runs on one checkpoint: an event between two open sessions joins them, closed ones are gone."""
    source, out, checkpoint = work_dir(spark), work_dir(spark), work_dir(spark)
    hour = lambda h: f"2024-01-01 {h:02}:00:00"
    runs = [[(1, hour(0)), (1, hour(5)), (2, hour(1))], [(1, hour(3)), (2, hour(20))], [(9, hour(23))]]
    for rows in runs:
        spark.createDataFrame(rows, "user_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(source)
        with state.own_state(spark):
            events = jobs.timed(stream(spark, source), "6 hours")
            found = run_append(state.closed_sessions(events, 3 * 3_600_000), out, checkpoint)
    got = sorted((r.user_id, (r["last"] - r.start) // 3_600_000, r.n) for r in found.collect())
    assert got == [(1, 5, 3), (2, 0, 1)]


def test_days_go_on_from_the_state_in_few_groups(spark):
    source, checkpoint = work_dir(spark), work_dir(spark)
    found = []
    for run in range(2):
        rows = spark.range(4000).select(F.when(F.col("id") > 0, F.col("id") + 2**60).alias("user_id"), F.lit(f"2024-01-01 0{run}:00:00").cast("timestamp_ntz").alias("ts"), F.when(F.col("id") != 7, F.lit(1.5)).alias("value"))
        rows.where(F.col("id") % (run + 1) == 0).coalesce(1).write.mode("append").parquet(source)
        events = jobs.timed(stream(spark, source), "1 hour").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", "ts")
        totals = state.daily_totals(events)
        run_batches(totals, "update", lambda batch, _: found.append({r.user_id: (r.day, r.n, r.total) for r in batch.collect()}), checkpoint)
    first, second = [f for f in found if f]
    key = lambda i: i + 2**60 if i else None
    assert first == {key(i): ("2024-01-01", 1, 0.0 if i == 7 else 1.5) for i in range(4000)}
    assert second == {key(i): ("2024-01-01", 2, 3.0) for i in range(0, 4000, 2)}
    assert "part" in str(totals._jdf.logicalPlan())  # a call of Python for a group of users, not for each


def test_totals_start_from_a_table(spark):
    source, checkpoint, seen = work_dir(spark), work_dir(spark), []
    seed = materialise(spark.createDataFrame([("a", 5), ("z", 1)], "word string, n long"))
    for words in (["a", "b", "a"], ["b", "a"]):
        spark.createDataFrame([(w,) for w in words], "word string").coalesce(1).write.mode("append").parquet(source)
        with state.own_state(spark):
            run_batches(state.running_totals(stream(spark, source), seed), "update", lambda batch, _: seen.append({r.word: r.n for r in batch.collect()}), checkpoint)
    assert [b for b in seen if b] == [{"a": 7, "b": 1}, {"a": 8, "b": 2}]


def word_sets(draw, n, vocabulary):
    return [sorted(set(draw.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=draw.randrange(1, 14)))) for _ in range(n)]


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9, 1.0])
def test_close_texts_equal_force(spark, threshold):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    queries, texts = word_sets(draw, 40, vocabulary[:40]) + [[]], word_sets(draw, 150, vocabulary) + [[], vocabulary]
    texts += [q[:] for q in queries[:5]]
    q = spark.createDataFrame(list(enumerate(queries)), "query_id int, words array<string>")
    t = spark.createDataFrame(list(enumerate(texts)), "id int, words array<string>")
    got = {(r.query_id, r.id): round(r.similarity, 9) for r in similarity.similar_texts(q, t, threshold).collect()}
    want = {}
    for i, a in enumerate(queries):
        for j, b in enumerate(texts):
            if a and b and (s := len(set(a) & set(b)) / (len(a) * len(b)) ** 0.5) >= threshold:
                want[i, j] = round(s, 9)
    assert got == want


def test_rare_words_first_joins_fewer_pairs(spark):
    """A word that all texts have is met only where nothing rarer is left."""
    q = spark.createDataFrame([(0, ["common", "rare", "seldom"])], "query_id int, words array<string>")
    t = materialise(spark.createDataFrame([(i, ["common", f"own{i}", f"other{i}"]) for i in range(300)] + [(300, ["common", "rare", "x"])], "id int, words array<string>"))
    met, order = similarity.asked_words(q.select(F.explode("words").alias("word")), t, "id")
    assert {r.word: r.place for r in order.collect()} == {"seldom": 0, "rare": 1, "common": 2}
    known = met.join(order, "word").groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("known"))
    assert [r.id for r in similarity._prefixes(known, "id", "size", F.ceil(F.col("size") * 0.36)).select("id").distinct().collect()] == [300]


@pytest.mark.parametrize("strict", [False, True])
def test_overlapping_keywords_equal_force(spark, strict):
    draw = random.Random(9)
    vocabulary = ["the", "a", "cat", "Dog", "tv", "x-ray", "red"]
    keywords = sorted({" ".join(draw.choices(vocabulary, k=draw.randrange(1, 6))) for _ in range(150)} | {"!!", "the the cat"})
    queries = spark.createDataFrame([(i, " ".join(draw.choices(vocabulary, k=3)) + "\nend") for i in range(8)], "query_id int, text string")
    table = spark.createDataFrame([(k,) for k in keywords], "keyword string")
    own = search.query_words(queries, strict)
    want = table.crossJoin(own).where(search.overlaps(F.col("keyword"), F.col("words"))).select("query_id", "keyword")
    assert sorted(map(tuple, search.overlapping_keywords(table, queries, strict).collect())) == sorted(map(tuple, want.collect()))


def test_word_matrix_in_blocks(spark):
    a = spark.createDataFrame([(f"a{i}", [float(i), 1.0]) for i in range(7)] + [("zero", [0.0, 0.0])], "word string, vec array<double>")
    b = spark.createDataFrame([(f"b{i}", [1.0, float(i)]) for i in range(5)], "word string, vec array<double>")
    got = {(r.a, r.b): round(r.cosine, 9) for r in similarity.word_matrix(a, b, block=2).collect()}
    assert got == {(f"a{i}", f"b{j}"): round((i + j) / ((i * i + 1) * (j * j + 1)) ** 0.5, 9) for i in range(7) for j in range(5)}


def test_users_and_words_of_a_group_share_a_call(spark, monkeypatch):
    """More users than groups in two runs: each session is closed as by itself; more words than groups."""
    monkeypatch.setattr(state, "USER_GROUPS", 2)
    monkeypatch.setattr(state, "WORD_GROUPS", 2)
    source, out, checkpoint, seen = work_dir(spark), work_dir(spark), work_dir(spark), []
    for hours in ([0, 1, 9], [3, 10, 30]):
        rows = spark.range(40).select(F.when(F.col("id") > 0, F.col("id") + 2**60).alias("user_id"), F.explode(F.array(*map(F.lit, hours))).alias("h"))
        timed = rows.select("user_id", F.timestamp_seconds(1_700_000_000 + F.col("h") * 3600).cast("timestamp_ntz").alias("ts"))
        timed.coalesce(1).write.mode("append").parquet(source)
        with state.own_state(spark):
            found = run_append(state.closed_sessions(jobs.timed(stream(spark, source), "12 hours"), 3 * 3_600_000), out, checkpoint)
    users = [None] + [i + 2**60 for i in range(1, 40)]
    got = sorted(((r.user_id or 0, (r.start // 1000 - 1_700_000_000) // 3600, (r["last"] - r.start) // 3_600_000, r.n) for r in found.collect()))
    assert got == sorted((u or 0, *s) for u in users for s in ((0, 3, 3), (9, 1, 2)))
    assert "part" in str(state.closed_sessions(jobs.timed(stream(spark, source), "1 hour"), 1)._jdf.logicalPlan())
    words, seed = work_dir(spark), materialise(spark.createDataFrame([(f"w{i}", i) for i in range(5)] + [(None, 3)], "word string, n long"))
    spark.createDataFrame([(f"w{i % 9}",) for i in range(90)] + [(None,)], "word string").coalesce(1).write.parquet(words)
    with state.own_state(spark):
        run_batches(state.running_totals(stream(spark, words), seed), "update", lambda batch, _: seen.extend(map(tuple, batch.collect())))
    assert dict(seen) == {f"w{i}": 10 + (i if i < 5 else 0) for i in range(9)} | {None: 4} and len(seen) == 10

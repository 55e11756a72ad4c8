"""Cases that once gave wrong rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import graph, joins, keywords as kw, search, similarity as sim


def test_asof_does_not_see_rows_of_the_same_time(spark):
    rows = [(1, "u", 3, True, 7.0), (2, "u", 5, True, 10.0), (3, "u", 5, False, 0.0), (4, "u", 6, False, 0.0), (5, "u", 5, True, 4.0)]
    df = spark.createDataFrame(rows, "id int, k string, t int, src boolean, v double")
    for width in (2, 100):
        got = {r.id: r.last_value for r in joins.asof_last(df, "k", "t", F.floor(F.col("t") / width), F.col("src"), "v").collect()}
        assert got == {1: None, 2: 7.0, 3: 7.0, 4: 10.0, 5: 7.0}


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ("['vitamin u', 'b']", ["vitamin u", "b"]), ("[u\"don't\", u'x y']", ["don't", "x y"]), ("['a', u'b c']", ["a", "b c"]), ("[u'it\\'s', 'u']", ["it's", "u"]),
        ("[]", []), ("['open", None),
    ],
)
def test_word_lists(spark, cell, want):
    assert spark.createDataFrame([(cell,)], "c string").select(kw.parse_word_list(F.col("c")).alias("w")).first().w == want


def test_postings_keep_ids_and_digits(spark):
    rows = [("k", "report(1).xml", 1.55), ("k", "a,b.xml", 4.0), ("k", "50%28.xml", 0.05), ("k", "7", 13.0)]
    index = spark.createDataFrame(rows, "keyword string, doc_id string, score double")
    encoded = kw.encode_postings(kw.group_postings(index))
    assert sorted(tuple(r) for r in kw.decode_postings(encoded).collect()) == sorted(rows)
    assert "(7,13.0)" in encoded.first()["RowId & Score"]


def test_similar_texts_at_the_threshold(spark):
    left = spark.createDataFrame([(1, [f"w{i}" for i in range(100)])], "query_id int, words array<string>")
    right = spark.createDataFrame([(2, ["w5"])], "id int, words array<string>")
    assert [(r.query_id, r.id) for r in sim.similar_texts(left, right, 0.1).collect()] == [(1, 2)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_matches_equal_the_nested_loop(spark):
    rng = random.Random(4)
    words = ["color", "goverment", "color tv", ""] + ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 9))) for _ in range(120)]
    wanted = ["colour", "government", "colour tv"] + ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 9))) for _ in range(30)]
    keywords = spark.createDataFrame([(w,) for w in set(words)], "keyword string")
    phrases = spark.createDataFrame([(i % 3, w, 1.0) for i, w in enumerate(wanted)], "query_id int, phrase string, score double").distinct()
    found = search.edit_matches(keywords, phrases, 0.6)
    own = {(i % 3, w) for i, w in enumerate(wanted)}
    want = {(q, k, p) for q, p in own for k in set(words) if (q, k) not in own and 1 - distance(k, p) / max(len(k), len(p)) >= 0.6}
    assert {(r.query_id, r.keyword, r.phrase) for r in found.collect()} == want
    assert {"color", "goverment"} <= {k for _, k, _ in want}
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_ranks_that_do_not_settle_are_an_error(spark):
    ring = [(i, (i + 1) % 40) for i in range(40)] + [(0, 20)]
    with pytest.raises(RuntimeError):
        graph.pagerank_until(spark.createDataFrame(ring, "src long, dst long"), 1e-6, limit=1).collect()


def test_salt_spreads_equal_rows(spark):
    big = spark.range(1000).select(F.lit(1).alias("k"))
    assert joins.salted_sum(big.withColumn("v", F.lit(2)), "k", "v").first().asDict() == {"k": 1, "n": 1000, "total": 2000}

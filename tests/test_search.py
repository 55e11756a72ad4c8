"""Search against brute force on small fixtures, and the whole recommendation."""

from __future__ import annotations

import re
from math import sqrt

from pyspark.sql import functions as F

from kindred.operators import search
from kindred.plans import recommend as plan
from kindred.session import materialise

TOKEN = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)*|[^A-Za-z0-9\s]"
KEYWORDS = ["red dog", "big red dog", "dog", "blue cat", "red big fish", "ocean", "big dog house red", "dog dog", "a1 red-dog"]
PHRASES = [("big red dog house", 16.0), ("blue cat nose", 9.0), ("red dog", 4.0), ("ocean", 1.0)]
TEXT = "Big red dog house.\nBlue cat nose, the ocean; red dog"


def fixture(spark):
    keywords = spark.createDataFrame([(k,) for k in KEYWORDS], "keyword string")
    phrases = spark.createDataFrame([(1, p, s, i + 1, len(PHRASES)) for i, (p, s) in enumerate(PHRASES)], "query_id int, phrase string, score double, rank int, n int")
    queries = spark.createDataFrame([(1, TEXT)], "query_id int, text string")
    return keywords, phrases, queries


def brute(share: int, threshold: float, lower: bool = True):
    words = set(re.sub("[^A-Za-z0-9 ]+", "", re.sub(r"\s+", " ", TEXT.lower())).split(" ")) if lower else set(re.sub("[^A-Za-z0-9 ]+", "", TEXT).split(" "))
    own = {p for p, _ in PHRASES}
    found = {}
    for k in KEYWORDS:
        bare = re.sub("[^A-Za-z0-9 ]+", "", k).split(" ")
        if k in own or not len(set(bare) & words) > len(bare) // 2:
            continue
        for p, s in PHRASES[: len(PHRASES) // share]:
            x, y = set(re.findall(TOKEN, k)), set(re.findall(TOKEN, p))
            ratio = len(x & y) / sqrt(len(x) * len(y))
            if ratio > threshold:
                found[(k, p)] = (round(ratio, 9), round(s * ratio, 9))
    return found


def rows(df):
    return {(r.keyword, r.phrase): (round(r.ratio, 9), round(r.kw_score, 9)) for r in df.collect()}


def test_fuzzy_is_the_nested_loop(spark):
    for share, threshold in ((1, 0.0), (1, 0.5), (2, 0.5), (4, 0.3)):
        assert rows(search.fuzzy_matches(*fixture(spark), threshold=threshold, share=share)) == brute(share, threshold)
    assert rows(search.fuzzy_matches(*fixture(spark))) == {}  # four phrases: floor(4 / 20) take part


def test_strict_prefilter_keeps_case_and_glued_words(spark):
    strict = rows(search.fuzzy_matches(*fixture(spark), threshold=0.0, share=1, prefilter="strict"))
    assert strict == brute(1, 0.0, lower=False)
    assert ("blue cat", "blue cat nose") not in strict and ("blue cat", "blue cat nose") in brute(1, 0.0)


def test_overlapping_keywords_is_the_nested_loop(spark):
    keywords, _, queries = fixture(spark)
    words = set(re.sub("[^a-z0-9 ]+", "", re.sub(r"\s+", " ", TEXT.lower())).split(" "))
    want = []
    for k in KEYWORDS:
        bare = re.sub("[^A-Za-z0-9 ]+", "", k).split(" ")
        if len(set(bare) & words) > len(bare) // 2:
            want.append(k)
    assert sorted(r.keyword for r in search.overlapping_keywords(keywords, queries).collect()) == sorted(want)


def test_substring_and_edit(spark):
    keywords, phrases, queries = fixture(spark)
    sub = search.fuzzy_matches(keywords, phrases, queries, threshold=0.0, share=1, prefilter="substring")
    assert {r.keyword for r in sub.collect()} == {"dog"}
    edit = search.edit_matches(keywords, phrases, 0.6).collect()
    assert {(r.keyword, r.phrase, r.kw_score) for r in edit} == {("big red dog", "big red dog house", 8.0), ("blue cat", "blue cat nose", 4.5), ("big red dog", "red dog", 2.0), ("a1 red-dog", "red dog", 2.0)}


def common_words(spark):
    keywords = spark.range(3000).select(F.format_string("the name%d of%d", "id", "id").alias("keyword"))
    phrases = [(q, f"the x{q}a{i} y{i} z{i}", 1.0, i + 1, 60) for q in (1, 2) for i in range(60)]
    text = " ".join(p for _, p, *_ in phrases)
    queries = spark.createDataFrame([(1, text), (2, text + " the name77 of77")], "query_id int, text string")
    return materialise(keywords), materialise(spark.createDataFrame([*phrases, (2, "the name77 of77 q", 3.0, 1, 60)], "query_id int, phrase string, score double, rank int, n int")), queries


def test_pairs_with_a_common_word_are_not_shuffled(spark):
    keywords, phrases, queries = common_words(spark)
    for threshold, prefilter in ((0.5, "overlap"), (0.0, "substring")):
        found = search.fuzzy_matches(keywords, phrases, queries, threshold, 1, prefilter=prefilter)
        assert {(r.query_id, r.keyword) for r in found.collect()} == {(2, "the name77 of77")}
    plan = search.phrase_pairs(keywords, phrases, 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[.*keyword", plan)  # no counting of the words that pairs share


def test_repeated_phrases_count_as_often_as_they_stand(spark):
    keywords, phrases, queries = fixture(spark)
    once = rows(search.fuzzy_matches(keywords, phrases, queries, threshold=0.0, share=1))
    twice = rows(search.fuzzy_matches(keywords, phrases.union(phrases), queries, threshold=0.0, share=1))
    assert {k: round(2 * r, 6) for k, (r, _) in once.items()} == {k: round(r, 6) for k, (r, _) in twice.items()}
    long = spark.createDataFrame([(1, "red a b c d", 1.0)] * 2, "query_id int, phrase string, score double")
    near = spark.createDataFrame([("red",), ("red x",)], "keyword string")
    # one word and five do not fit the threshold of 0.5, whatever the rows
    assert {(r.keyword, round(r.ratio, 6)) for r in search.phrase_pairs(near, long, 0.5).collect()} == {("red x", round(2 / sqrt(10), 6))}


def test_contained_keywords_of_every_length(spark):
    text = "ab the quick brown fox jumps over"
    held = ["a", "b t", "the", "he q", "quick br", "the quick brown", "the quick brown fox jumps", text]
    keywords = spark.createDataFrame([(k,) for k in [*held, "", "fox  jumps", "the quick brown fox jumped", text + "!"]], "keyword string")
    queries = spark.createDataFrame([(1, text), (2, "ab"), (3, None)], "query_id int, text string")
    found = {(r.query_id, r.keyword) for r in search.contained_keywords(keywords, queries).collect()}
    assert found == {(1, k) for k in held} | {(2, "a")}


def test_duplicate_postings_count_every_time_and_ties_go_by_id(spark):
    index = spark.createDataFrame([("dog", 5, 1.0), ("dog", 5, 1.0), ("dog", 3, 5.0), ("cat", 9, 1.0)], "keyword string, doc_id int, score double")
    matches = spark.createDataFrame([(1, "dog", 3.0)], "query_id int, keyword string, kw_score double")
    best = search.top_documents(search.score_documents(search.score_pairs(index, matches)), 1).collect()
    assert [(r.doc_id, r.score, r.rank) for r in best] == [(3, 8.0, 1)]
    both = search.score_documents(search.score_pairs(index, matches)).collect()
    assert sorted((r.doc_id, r.score) for r in both) == [(3, 8.0), (5, 8.0)]


def test_a_text_and_its_halves_find_each_other(spark):
    half_a = "Zebra stripes confuse hungry lions. Tall giraffes browse thorny acacia trees."
    half_b = "Deep submarines chart volcanic ridges, while patient whales sing haunting songs."
    other = "Municipal budgets rarely balance. Tax revenue declines slowly."
    docs = [(1, f"{half_a} {half_b}"), (2, half_a), (3, half_b), (4, other)]
    articles = spark.createDataFrame([(i, t, "null", None, None, "null", None, None) for i, t in docs], "id int, content string, title string, keywords string, meta_keywords string, meta_description string, tags string, summary string")
    types = spark.createDataFrame([(1, "reliable")], "doc_id int, type string")
    queries = spark.createDataFrame([(10, half_a), (20, f"{half_a} {half_b}")], "query_id int, text string")
    index, keywords = plan.build_index(articles)
    found = materialise(plan.recommend(articles, types, index, keywords, queries, stemming=True))
    by_query = {q: [r.doc_id for r in found.where(F.col("query_id") == q).orderBy("rank").collect()] for q in (10, 20)}
    assert set(by_query[10]) == {1, 2} and by_query[20][0] == 1 and 4 not in by_query[20]
    exact = {(r.query_id, r.doc_id): r.similarity for r in found.collect()}
    assert exact[(10, 2)] == 1.0 and exact[(20, 1)] == 1.0 and 0 < exact[(10, 1)] < 1
    assert {r.doc_id: r.type for r in found.collect()} == {1: "reliable", 2: None}


def test_only_postings_of_matches_are_shuffled(spark):
    """The filter keeps every key that is asked for, zero and negative hashes included, and few others."""
    keys = materialise(spark.range(3000).select(F.col("id").cast("string").alias("keyword")))
    rows = spark.range(60_000).select(F.when(F.col("id") < 50_000, F.col("id").cast("string")).alias("keyword"))
    kept = [r.keyword for r in rows.where(search.held_by(keys, "keyword")(F.col("keyword"))).collect()]
    assert {str(i) for i in range(3000)} <= set(kept) and len(kept) < 3200
    index = materialise(rows.where("keyword IS NOT NULL").select("keyword", F.lit(1).alias("doc_id"), F.lit(2.0).alias("score")))
    pairs = search.score_pairs(index, keys.select(F.lit(1).alias("query_id"), "keyword", F.lit(1.0).alias("kw_score")))
    assert "ArrowEvalPython" in pairs._jdf.queryExecution().executedPlan().toString() and pairs.count() == 3000


def test_overlapping_words_do_not_carry_their_keyword(spark, monkeypatch):
    """every word of a keyword took the keyword and all its words along, and every pair was compared with all words of the query."""
    met = []
    asked = search.asked_words
    monkeypatch.setattr(search, "asked_words", lambda *a: met.append(asked(*a)[0]) or asked(*a))
    keywords = [" ".join(f"w{i}" for i in range(1000)), "w1 w2 none", "w1 none other", "w1 w1 none", "", "w1  w2", "w3!", None]
    table = spark.createDataFrame([(k,) for k in keywords], "keyword string")
    queries = spark.createDataFrame([(0, " ".join(f"W{i}" for i in range(501))), (1, "w1 w3"), (2, ""), (3, None)], "query_id int, text string")
    own = search.query_words(queries)
    want = table.crossJoin(own).where(search.overlaps(F.col("keyword"), F.col("words"))).select("query_id", "keyword")
    got = search.overlapping_keywords(table, queries)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and (0, keywords[0]) in map(tuple, got.collect())
    assert [str(f.dataType) for f in met[0].schema["id"].dataType] == ["LongType()", "LongType()"]
    assert "array_intersect" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_signs_of_keywords_are_one_class_of_single_characters():
    every = "".join(map(chr, range(0x250)))
    assert re.sub(search.NOT_ALNUM_OR_SPACE, "", every) == re.sub("[^ A-Za-z0-9]+", "", every) and "A-Z" not in search.NOT_ALNUM_OR_SPACE

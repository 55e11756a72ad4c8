"""Search: phrases of query articles against the keyword index, scores per document, best documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from kindred.functions.phrases import ranked_phrases
from kindred.functions.text import NOT_ALNUM_OR_SPACE, alnum_words, ascii_fold, glued_words, round_half_up, word_tokens
from kindred.operators import edit_distance
from kindred.operators.similarity import asked_words
from kindred.session import materialise

TOP_DOCUMENTS = 15
FUZZY_SHARE = 20
#: Hash slots by which tokens are counted for their order.
SLOTS = 1 << 16
#: Bits of a filter on join keys; ``BUCKET`` of them are a row of Spark's bitmaps.
BITS, BUCKET = 1 << 22, 1 << 15
#: Edit ratio from which segments have about four letters.
SEGMENTS_FROM = 0.75
#: Keywords that a task compares at a time, about.
KEYWORDS = 200_000
#: Lengths of the parts of texts by which keywords are looked up, from the longest.
GRAMS = (16, 8, 4, 2, 1)


def query_phrases(queries: DataFrame, fraction: float = 0.5) -> DataFrame:
    """``(query_id, phrase, score, rank, n)``: best phrases of each query article; ``n`` of them."""
    return (
        queries.select("query_id", ranked_phrases(F.col("text"), fraction).alias("ranked"))
        .select("query_id", F.size("ranked").alias("n"), F.posexplode("ranked").alias("pos", "p"))
        .select("query_id", "p.phrase", "p.score", (F.col("pos") + 1).alias("rank"), "n")
    )


def dictionary(index: DataFrame) -> DataFrame:
    """Distinct folded keywords of the index."""
    return index.select(ascii_fold(F.col("keyword")).alias("keyword")).distinct()


def exact_matches(phrases: DataFrame) -> DataFrame:
    """``(query_id, keyword, kw_score)``: a phrase matches the keyword it equals."""
    return phrases.select("query_id", F.col("phrase").alias("keyword"), F.col("score").alias("kw_score"))


def _token_set(text: Column, without: Sequence[str]) -> Column:
    tokens = F.array_distinct(word_tokens(text))
    return F.filter(tokens, lambda t: ~t.isin(list(without))) if without else tokens


def _slots(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(SLOTS)).cast("int"))


def held_by(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A filter on a join key that leaves all values ``keys`` has and drops nearly all others, before they are shuffled.

    It is ``BITS`` bits of hashes whatever the input. A key that is let through wrongly finds no partner in the join.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(BITS))
    held = keys.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bits = np.zeros((BITS // BUCKET + 1, BUCKET // 8), np.uint8)
    for row in held.collect():  # at most BITS // BUCKET + 1
        bits[row.bucket] = np.frombuffer(row.bits, np.uint8)
    bits = bits.ravel()

    @F.arrow_udf("boolean")
    def has(places: pa.Array) -> pa.Array:
        place = places.to_numpy()
        return pa.array((bits[place >> 3] >> (place & 7)) & 1 == 1)

    # Spark's place of a number: buckets count from 1, and number 0 belongs to the first one
    numbered = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    return lambda c: has(F.bitmap_bucket_number(numbered(c)) * F.lit(BUCKET) + F.bitmap_bit_position(numbered(c)))


def rarest_first(keywords: DataFrame, phrases: DataFrame) -> Callable[[Column], Column]:
    """Of a list of slots to the indexes of those that a phrase has, the rarest among the keywords first.

    Both sides are ``(tokens)``. Tokens are counted by ``SLOTS`` hash slots, so the order is a list of that length whatever the
    input, and no keyword is shuffled for it. Equal slots keep the order of the list.
    """
    counted = keywords.select(F.explode(_slots(F.col("tokens"))).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    asked = phrases.select(F.explode(_slots(F.col("tokens"))).alias("slot")).distinct()
    rows = asked.join(counted, "slot", "left").select("slot", F.coalesce("n", F.lit(0)).alias("n")).collect()  # at most SLOTS
    place = np.full(SLOTS, -1, np.int32)
    place[[r.slot for r in sorted(rows, key=lambda r: (r.n, r.slot))]] = np.arange(len(rows))

    @F.arrow_udf("array<int>")
    def order(slots: pa.Array) -> pa.Array:
        text_of = pc.list_parent_indices(slots).to_numpy().astype(np.int64)
        held = np.bincount(text_of, minlength=len(slots))
        index = np.arange(len(text_of)) - (np.cumsum(held) - held)[text_of]
        rank = place[slots.flatten().to_numpy()]
        known = np.flatnonzero(rank >= 0)
        known = known[np.lexsort((index[known], rank[known], text_of[known]))]
        found = np.bincount(text_of[known], minlength=len(slots))
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(found)), pa.int32()), pa.array(index[known], pa.int32()))

    return order


def _ordered(rows: DataFrame, order: Callable[[Column], Column], size: str, known: str) -> DataFrame:
    """``rows`` of ``tokens`` with their number and, as ``known``, those that a phrase has in the common order."""
    placed = rows.select("*", F.size("tokens").alias(size), order(_slots(F.col("tokens"))).alias("at"))
    return placed.select("*", F.transform("at", lambda i: F.get("tokens", i)).alias(known)).drop("tokens", "at")


def _leading(size: str, known: str, share: Column) -> Column:
    """The tokens of ``known`` one of which a close pair shares, with the number of tokens from each one on.

    A pair shares more than ``share`` of the tokens of either side, so its first shared token has as many from it on.
    """
    counted = F.transform(known, lambda t, i: F.struct(t.alias("token"), (F.size(known) - i).alias("rest")))
    return F.filter(counted, lambda c: c["rest"] > F.col(size) * share)


def phrase_pairs(
    keywords: DataFrame, phrases: DataFrame, threshold: float, without: Sequence[str] = ()
) -> DataFrame:
    """``(query_id, phrase, score, keyword, ratio)`` for all pairs with a set cosine above ``threshold``.

    Both sides are joined on the tokens that the first shared one of a close pair can be, in an order that puts rare tokens
    first; a pair is kept where that token is the first shared one and then compared, so pairs are not shuffled to be counted.
    ``keywords`` is read twice and should be a written table, as should ``phrases``. The ratio of a phrase that a query has
    in several equal rows is that many times the cosine, while the sizes must fit the threshold by themselves.
    """
    sorted_tokens = lambda text: F.array_sort(_token_set(F.col(text), without)).alias("tokens")
    asked = phrases.groupBy("query_id", "phrase", "score").agg(F.count("*").alias("rows"))
    # equal phrases of several queries are compared once; all bounds are a little wider, so that rounding loses no pair
    least = (F.pow(F.lit(threshold) / F.max("rows"), F.lit(2)) * (1 - 1e-9)).alias("least")
    own = materialise(asked.groupBy("phrase").agg(least).select("phrase", F.xxhash64("phrase").alias("number"), "least", sorted_tokens("phrase")))
    lowest = own.agg(F.coalesce(F.min("least"), F.lit(0.0))).first()[0]
    left = keywords.select("keyword", sorted_tokens("keyword"))
    order = rarest_first(left, own)
    own = materialise(_ordered(own, order, "y", "others"))
    right = materialise(own.select("number", "y", "least", F.inline(_leading("y", "others", F.col("least")))).withColumnRenamed("rest", "after"))
    left = _ordered(left, order, "x", "known").select("keyword", "x", "known", F.inline(_leading("x", "known", F.lit(lowest))))
    square = threshold * threshold * (1 - 1e-9)
    near = (F.col("x") > F.col("y") * square) & (F.col("y") > F.col("x") * square)  # also where a phrase has several rows
    met = left.join(right, "token").where(near).where(F.least("rest", "after") >= F.sqrt(F.col("least") * F.col("x") * F.col("y")))
    both = F.array_intersect("known", "others")
    found = met.join(own.select("number", "phrase", "others"), "number").select("keyword", "x", "y", "phrase", "token", both.alias("both"))
    close = found.where(F.get("both", F.lit(0)) == F.col("token")).select("keyword", "phrase", "x", "y", F.size("both").cast("long").alias("shared"))
    return (
        close.join(asked, "phrase")
        .withColumn("ratio", set_cosine(F.col("shared") * F.col("rows"), F.col("x"), F.col("y")))
        .where(F.col("ratio") > threshold)
        .select("query_id", "phrase", "score", "keyword", "ratio")
    )


def contained_keywords(keywords: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query_id, keyword)``, distinct, of the keywords that the text of a query holds.

    A keyword is looked up once, by its first letters: as many as the largest of ``GRAMS`` that it has.
    """
    length = lambda text: F.coalesce(*[F.when(F.length(text) >= n, F.lit(n)) for n in GRAMS])
    parts = [F.expr(f"transform(sequence(1, greatest(length(text) - {n - 1}, 1)), i -> substring(text, i, {n}))") for n in GRAMS]
    grams = queries.select("query_id", F.explode(F.array_distinct(F.flatten(F.array(*parts)))).alias("gram")).distinct()
    left = keywords.select("keyword", F.substring(F.col("keyword"), F.lit(1), length("keyword")).alias("gram"))
    found = left.join(grams, "gram").join(queries.select("query_id", "text"), "query_id").where(F.contains("text", "keyword"))
    return found.select("query_id", "keyword").distinct()


def query_pairs(found: DataFrame, phrases: DataFrame, threshold: float, without: Sequence[str] = ()) -> DataFrame:
    """``(query_id, phrase, score, keyword, ratio)`` as :func:`phrase_pairs`, of ``(query_id, keyword)`` and phrases of the same query."""
    tokens = lambda rows, text, size: rows.withColumn("tokens", _token_set(F.col(text), without)).select(*rows.columns, F.size("tokens").alias(size), F.explode("tokens").alias("token"))
    met = tokens(found, "keyword", "x").join(tokens(phrases.select("query_id", "phrase", "score"), "phrase", "y"), ["query_id", "token"])
    counted = met.groupBy("query_id", "phrase", "score", "keyword", "x", "y").agg(F.count("*").alias("shared"))
    close = counted.withColumn("ratio", set_cosine(F.col("shared"), F.col("x"), F.col("y"))).where(F.col("ratio") > threshold)
    return close.select("query_id", "phrase", "score", "keyword", "ratio")


def set_cosine(shared: Column, x: Column, y: Column) -> Column:
    return shared / F.sqrt((x * y).cast("double"))


def overlaps(keyword: Column, text_words: Column) -> Column:
    """More than half of the words of a keyword occur among the words of the query text."""
    words = F.split(F.regexp_replace(keyword, NOT_ALNUM_OR_SPACE, ""), " ")
    return F.size(F.array_intersect(words, text_words)) > F.floor(F.size(words) / F.lit(2))


def query_words(queries: DataFrame, strict: bool = False) -> DataFrame:
    """``(query_id, words)``; ``strict`` keeps case and glues words around line breaks."""
    text = F.col("text")
    words = glued_words(text) if strict else F.filter(alnum_words(F.lower(text)), lambda w: w != "")
    return queries.select("query_id", F.array_distinct(words).alias("words"))


def not_exact(pairs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Drop pairs whose keyword is itself a phrase of the query."""
    own = phrases.select("query_id", F.col("phrase").alias("keyword"))
    return pairs.join(own, ["query_id", "keyword"], "left_anti")


def fuzzy_matches(
    keywords: DataFrame,
    phrases: DataFrame,
    queries: DataFrame,
    threshold: float = 0.5,
    share: int = FUZZY_SHARE,
    without: Sequence[str] = (),
    prefilter: str = "overlap",
) -> DataFrame:
    """``(query_id, keyword, phrase, ratio, kw_score)`` for keywords that are no phrase of the query.

    The best ``floor(n / share)`` phrases of a query take part. ``prefilter``: ``overlap``, ``strict``
    (overlap with the case-sensitive words of the text) or ``substring`` (keyword occurs in the text).
    """
    top = phrases.where(F.col("rank") <= F.floor(F.col("n") / F.lit(share)))
    if prefilter == "substring":
        found = query_pairs(contained_keywords(keywords, queries), top, threshold, without)
        kept = not_exact(found, phrases).join(queries, "query_id").where(F.contains(F.col("text"), F.col("keyword")))
    else:
        close = not_exact(phrase_pairs(keywords, top, threshold, without), phrases)
        kept = close.join(query_words(queries, prefilter == "strict"), "query_id").where(
            overlaps(F.col("keyword"), F.col("words"))
        )
    return kept.select(
        "query_id", "keyword", "phrase", "ratio", (F.col("score") * F.col("ratio")).alias("kw_score")
    )


def overlapping_keywords(keywords: DataFrame, queries: DataFrame, strict: bool = False) -> DataFrame:
    """``(query_id, keyword)`` for all keywords that pass :func:`overlaps`, as a join on words.

    A keyword of ``d`` distinct among ``n`` words must share more than ``n / 2``, so one of any ``d - floor(n / 2)`` of its words
    is in the query. The words that no query has and then those that the fewest keywords have are taken, so a keyword without
    enough words of any query is never joined and common words seldom are. Of the pairs found all shared words are counted.
    Keywords and words are numbers on the way: a keyword can be a thousand words long.
    """
    own = materialise(query_words(queries, strict))
    asked = own.select("query_id", F.explode("words").alias("word"))
    numbered = materialise(keywords.select(F.monotonically_increasing_id().alias("k"), "keyword"))
    words = F.split(F.regexp_replace("keyword", NOT_ALNUM_OR_SPACE, ""), " ")
    cut = numbered.select(F.struct("k", F.floor(F.size(words) / F.lit(2)).alias("half")).alias("id"), F.array_distinct(words).alias("words"))
    met, order = asked_words(asked, cut, "id")
    known = met.join(order, "word").groupBy("id").agg(F.sort_array(F.collect_list("place")).alias("known"))
    known = known.where(F.size("known") > F.col("id.half"))
    left = known.select("id", "known", F.explode(F.slice("known", F.lit(1), (F.size("known") - F.col("id.half")).cast("int"))).alias("place"))
    places = asked.join(order, "word").select("query_id", "place")
    found = left.join(places, "place").select("query_id", "id", "known").distinct()
    shared = found.select("query_id", "id", F.explode("known").alias("place")).join(places, ["query_id", "place"])
    enough = shared.groupBy("query_id", "id").agg(F.count("*").alias("n")).where(F.col("n") > F.col("id.half"))
    return enough.select("query_id", F.col("id.k").alias("k")).join(numbered, "k").select("query_id", "keyword")


def _edits(longer: str, threshold: float) -> str:
    """SQL: edits that two texts may differ by, from the length of the longer one."""
    return f"CAST(floor({longer} * (1 - {threshold}D) + 1e-9) AS INT)"


def _letters(text: str) -> Column:
    """The letters of a text as bits of a number."""
    return F.expr(f"aggregate(filter(split({text}, ''), c -> c <> ''), 0L, (m, c) -> m | shiftleft(1L, ascii(c) % 64))")


def edit_segments(phrases: DataFrame, threshold: float) -> DataFrame:
    """``(phrase, b, size, edits, segment, part)``, ``b`` its letters: the parts of phrases that keywords of ``size`` letters are looked up by.

    A keyword that may differ by ``edits`` is cut into one more segment than that, so one segment stands in the phrase
    unchanged. Edits before it can shift segment i by i places at most, edits after it by the other edits at most, which
    leaves few places to look at.
    """
    own = phrases.select("phrase").distinct().withColumns({"m": F.length("phrase"), "b": _letters("phrase")}).where("m > 0")
    sizes = own.select("phrase", "b", "m", F.explode(F.expr(f"sequence(greatest(1, CAST(ceil(m * {threshold}D - 1e-9) AS INT)), CAST(floor(m / {threshold}D + 1e-9) AS INT))")).alias("size"))
    sizes = sizes.withColumn("edits", F.expr(_edits("greatest(m, size)", threshold)))
    cut = sizes.select("*", F.explode(F.expr("sequence(0, edits)")).alias("segment"))
    cut = cut.select("*", F.expr("size div (edits + 1)").cast("int").alias("short"), F.expr("edits + 1 - size % (edits + 1)").alias("shorts"))
    cut = cut.select("*", F.expr("segment * short + greatest(segment - shorts, 0)").alias("at"), F.expr("short + IF(segment >= shorts, 1, 0)").alias("letters"))
    first = "greatest(0, at - segment, at + m - size - (edits - segment))"
    last = "least(m - letters, at + segment, at + m - size + (edits - segment))"
    places = cut.withColumns({"first": F.expr(first), "last": F.expr(last)}).where("first <= last")
    return places.select("phrase", "b", "size", "edits", "segment", F.explode(F.expr("array_distinct(transform(sequence(first, last), p -> substring(phrase, p + 1, letters)))")).alias("part"))


def keyword_segments(keywords: DataFrame, edits: DataFrame) -> DataFrame:
    """``(keyword, a, size, edits, segment, part)``, ``a`` its letters, of keywords for all their ``(size, edits)``."""
    sized = keywords.select("keyword", F.length("keyword").alias("size"), _letters("keyword").alias("a")).join(edits, "size")
    cut = sized.select("*", F.expr("size div (edits + 1)").cast("int").alias("short"), F.expr("edits + 1 - size % (edits + 1)").alias("shorts"), F.explode(F.expr("sequence(0, edits)")).alias("segment"))
    part = "substring(keyword, segment * short + greatest(segment - shorts, 0) + 1, short + IF(segment >= shorts, 1, 0))"
    return cut.select("keyword", "a", "size", "edits", "segment", F.expr(part).alias("part"))


def _met_on_segments(keywords: DataFrame, phrases: DataFrame, threshold: float, tasks: int) -> DataFrame:
    """``(keyword, phrase)`` within the edits: a keyword meets a phrase on a segment of its own that the phrase holds where the allowed edits can have moved it."""
    parts = materialise(edit_segments(phrases, threshold))
    segments = keyword_segments(keywords, parts.select("size", "edits").distinct())
    key = ["size", "edits", "segment", "part"]
    left, right = segments.repartition(tasks, *key), parts.repartition(tasks, *key)
    unshared = F.greatest(*[F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(y))) for x, y in (("a", "b"), ("b", "a"))])
    close = left.join(right, key).where(unshared <= F.col("edits")).where("levenshtein(keyword, phrase, edits) >= 0")
    return close.select("keyword", "phrase").distinct()


def letter_bag(text: Column) -> Column:
    """The letters of a text as 256 bits in four numbers: of each of 32 kinds of letters, as many bits as it occurs, up to eight.

    Bits that one text has and another lacks are letters to be replaced or dropped, so there are no more of them than edits.
    """

    @F.arrow_udf("array<long>")
    def bag(texts: pa.Array) -> pa.Array:
        texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_binary())])
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        signs = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
        first = (signs & 0xC0) != 0x80  # one byte of every letter
        counts = np.bincount(text_of[first] * 32 + signs[first] % 32, minlength=len(texts) * 32)
        bits = ((1 << np.minimum(counts, 8)) - 1).astype(np.uint8).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * 4, pa.int32()), pa.array(bits))

    return bag(text)


def _met_on_letters(keywords: DataFrame, phrases: DataFrame, threshold: float, tasks: int) -> DataFrame:
    """``(keyword, phrase)`` within the edits: every task has a share of the keywords and all phrases, compared where lengths and letters allow it."""
    deals = max(4 * tasks, -(-keywords.count() // KEYWORDS))
    bags = lambda name: [F.get("bag", F.lit(i)).alias(f"{name}{i}") for i in range(4)]
    own = phrases.select("phrase").distinct().where(F.length("phrase") > 0).select("phrase", F.length("phrase").alias("m"), letter_bag(F.col("phrase")).alias("bag"))
    own = materialise(own.select("phrase", F.expr(f"greatest(1, CAST(ceil(m * {threshold}D - 1e-9) AS INT))").alias("least"), F.expr(f"CAST(floor(m / {threshold}D + 1e-9) AS INT)").alias("most"), *bags("b")))
    right = own.select("*", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"))
    left = keywords.where("keyword IS NOT NULL").select("keyword", F.length("keyword").alias("size"), letter_bag(F.col("keyword")).alias("bag"), F.pmod(F.xxhash64("keyword"), F.lit(deals)).cast("int").alias("deal"))
    left = left.select("keyword", "size", "deal", *bags("a"))
    compare = lambda mine, others: edit_distance.close_pairs(mine, others, threshold)
    # about a deal in a partition: with several, some tasks get many and others none
    met = left.repartition(deals, "deal").groupBy("deal").cogroup(right.repartition(deals, "deal").groupBy("deal")).applyInArrow(compare, "phrase string, keyword string")
    return met.select("keyword", "phrase").distinct()


def edit_matches(keywords: DataFrame, phrases: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``(query_id, keyword, phrase, ratio, kw_score)`` by edit distance, with half of the phrase score.

    ``ratio`` is 1 - distance / longer length. Exact: pairs that may be close are compared. From a ratio of ``SEGMENTS_FROM`` on,
    these meet on segments; below it segments are so short that nearly all pairs meet, on several each, and keywords are
    compared with all phrases of about their length and letters instead. ``phrases`` should be a written table.
    """
    spark = keywords.sparkSession
    # many comparisons for little data: a stated number of partitions, which is not coalesced
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = (_met_on_segments if threshold >= SEGMENTS_FROM else _met_on_letters)(keywords, phrases, threshold, tasks)
    longest = F.greatest(F.length("keyword"), F.length("phrase"))
    return (
        not_exact(met.join(phrases.select("query_id", "phrase", "score"), "phrase"), phrases)
        .withColumn("ratio", 1 - F.levenshtein("keyword", "phrase") / longest)
        .where(F.col("ratio") >= threshold)
        .select("query_id", "keyword", "phrase", "ratio", (F.col("score") / 2).alias("kw_score"))
    )


def score_pairs(index: DataFrame, matches: DataFrame) -> DataFrame:
    """``(query_id, doc_id, keyword, kw_score, posting_score, score)`` per match and posting.

    ``matches`` should be a written table: it is broadcast when its size allows, the index is not. Beyond that size only
    postings of keywords that a match may have are shuffled.
    """
    folded = index.select(ascii_fold(F.col("keyword")).alias("keyword"), "doc_id", F.col("score").alias("posting_score"))
    folded = folded.where(held_by(matches, "keyword")(F.col("keyword")))
    return folded.join(matches.select("query_id", "keyword", "kw_score"), "keyword").select(
        "query_id",
        "doc_id",
        "keyword",
        "kw_score",
        "posting_score",
        (F.col("kw_score") + F.col("posting_score")).alias("score"),
    )


def score_documents(pairs: DataFrame) -> DataFrame:
    """``(query_id, doc_id, score)``; rounded so that equal sums rank as equal."""
    return pairs.groupBy("query_id", "doc_id").agg(round_half_up(F.sum("score"), 6).alias("score"))


def top_documents(scores: DataFrame, k: int = TOP_DOCUMENTS) -> DataFrame:
    """Best ``k`` documents of every query, ties by document id."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

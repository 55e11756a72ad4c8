"""Spellings of one edit apart, by asymmetric q-chunks.

Of two words of about the same length, one contributes two disjoint chunks of half its length, the other all its
positional grams of that length. One edit leaves one of the chunks whole and moves it by one place at most, so words
are joined on chunk and gram within a shift of one, and every pair that meets is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import bodies
from kindred.session import materialise

#: Runs of letters, and of which runs (their crc32 with the id divisible by this) a letter is deleted.
RUN, TYPO = re.compile("[A-Za-zÀ-ÿ]+"), 199
#: Code points and occurrences of a word, at least.
LENGTH, OCCURRENCES = 6, 5
#: How many times as frequent a word's form must be.
FACTOR = 5
#: Chunks of one text that are joined as they are; those that more words share are divided by the rest of the words.
CROWD = 1024
#: Words that a task counts before it hands the counts on.
_FLUSH = 200_000


def typed(doc_id: int | None, run: str) -> str:
    """The run, without one letter if its checksum with the id is divisible by ``TYPO``."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % TYPO else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, length: int = LENGTH, least: int = OCCURRENCES) -> DataFrame:
    """``word`` and ``n`` of all words with at least ``length`` code points and ``least`` occurrences in all texts."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # bytes are lower-cased in A-Z only
                for run, n in Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
                    if len(run) >= length:
                        counts[typed(doc_id, run)] += n
                if len(counts) > _FLUSH:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    found = bodies(docs).select("doc_id", "text").mapInArrow(each, "word string, n long").where(F.char_length("word") >= length)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _chunk(word: Column, q: Column, which: int, at: Column) -> Column:
    return F.struct(q.alias("q"), F.lit(which).alias("which"), F.substring(word, at + 1, q).alias("gram"))


def _chunks(words: DataFrame) -> DataFrame:
    """``x`` with its two disjoint chunks of half its length."""
    q = F.expr("char_length(word) div 2").cast("int")
    both = F.array(_chunk(F.col("word"), q, 0, F.lit(0)), _chunk(F.col("word"), q, 1, q))
    return words.select(F.col("word").alias("x"), F.explode(both).alias("c")).select("x", "c.*")


def _grams(words: DataFrame) -> DataFrame:
    """``y`` with its positional grams that lie within a shift of one of a chunk of a word at most one letter shorter or longer."""
    size = F.char_length("word")
    halves = F.array_distinct(F.transform(F.array(size - 1, size, size + 1), lambda m: F.floor(m / 2).cast("int")))
    near = lambda q, which, at: F.transform(F.filter(at, lambda p: (p >= 0) & (p + q <= size)), lambda p: _chunk(F.col("word"), q, which, p))
    of_half = lambda q: F.concat(near(q, 0, F.array(F.lit(0), F.lit(1))), near(q, 1, F.array(q - 1, q, q + 1)))
    grams = F.array_distinct(F.flatten(F.transform(halves, of_half)))
    return words.select(F.col("word").alias("y"), "n", F.explode(grams).alias("c")).select("y", "n", "c.*")


def _verified(x: str, y: str) -> Column:
    return (F.abs(F.char_length(x) - F.char_length(y)) <= 1) & (F.levenshtein(F.col(x), F.col(y), 1) == 1)


def _divided(words: DataFrame, crowded: DataFrame) -> DataFrame:
    """Pairs that share a crowded chunk, found by what is left of the words.

    Next to a whole chunk the rests of two near words are one edit apart: both without the letter at the same place
    (replaced), or one without a letter is the other. Every text so made is a key of its own, and all words that share
    one are near each other, so no group holds pairs that are not.
    """
    size = F.char_length("word")
    q = F.col("q")
    # the chunk lies at the front, or ends as many letters before the end in both words
    spots = F.explode(F.array_distinct(F.flatten(F.transform(F.array(size - 1, size, size + 1), lambda m: F.array(F.struct(F.floor(m / 2).cast("int").alias("q"), F.lit(0).alias("which"), F.lit(0).alias("tail")), F.struct(F.floor(m / 2).cast("int").alias("q"), F.lit(1).alias("which"), F.pmod(m, F.lit(2)).cast("int").alias("tail")))))))
    placed = words.select("word", "n", spots.alias("s")).select("word", "n", "s.*")
    start = F.when(F.col("which") == 0, F.lit(0)).otherwise(size - F.col("tail") - q)
    cut = placed.withColumn("start", start).where((F.col("start") >= 0) & (F.col("start") + q <= size)).withColumn("gram", F.substring(F.col("word"), F.col("start") + 1, q))
    kept = cut.join(crowded, ["q", "which", "gram"], "left_semi")
    rest = F.when(F.col("which") == 0, F.substring(F.col("word"), q + 1, size)).otherwise(F.substring(F.col("word"), F.lit(1), F.col("start")))
    end = F.when(F.col("which") == 0, F.lit("")).otherwise(F.substring(F.col("word"), F.col("start") + q + 1, size))
    kept = kept.select("word", "n", "q", "which", "gram", "tail", rest.alias("rest"), end.alias("end")).where("rest != ''")
    holes = F.transform(F.sequence(F.lit(0), F.char_length("rest") - 1), lambda i: F.struct(i.cast("int").alias("hole"), F.concat(F.substring(F.col("rest"), F.lit(1), i), F.substring(F.col("rest"), i + 2, F.char_length("rest"))).alias("left")))
    key = ["q", "which", "gram", "tail", "end", "left"]
    holed = kept.select("word", "n", *key[:-1], F.explode(holes).alias("h")).select("word", "n", *key[:-1], "h.*")
    whole = kept.select("word", "n", *key[:-1], F.col("rest").alias("left"))
    named = lambda df, word, n: df.withColumnsRenamed({"word": word, "n": n})
    replaced = named(holed, "x", "n_x").join(named(holed, "y", "n"), [*key, "hole"])
    shorter = named(holed, "x", "n_x").join(named(whole, "y", "n"), key)
    longer = named(whole, "x", "n_x").join(named(holed, "y", "n"), key)
    parts = [df.where(_verified("x", "y")).select("x", "y", "n") for df in (replaced, shorter, longer)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """All ordered pairs ``x``, ``y`` of ``words`` (``word``, ``n``, written) that differ by one edit, each once, with the ``n`` of ``y``."""
    key = ["q", "which", "gram"]
    chunks, grams = _chunks(words), _grams(words)
    crowded = materialise(grams.groupBy(*key).count().where(F.col("count") > crowd).select(*key))
    divided = None
    if not crowded.isEmpty():
        divided = _divided(words, crowded)
        chunks, grams = chunks.join(crowded, key, "left_anti"), grams.join(crowded, key, "left_anti")
    met = chunks.join(grams, key).where(_verified("x", "y")).select("x", "y", "n")
    return (met if divided is None else met.unionByName(divided)).distinct()


def variants(docs: DataFrame, length: int = LENGTH, least: int = OCCURRENCES, factor: int = FACTOR, crowd: int = CROWD) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of ``docs`` (``doc_id``, ``text``).

    A word's form is its near word of largest ``n`` (ties: smallest in code-point order) if that is at least ``factor``
    times as frequent; ``root`` follows the forms to the last one. A null text has no words, a null id counts as empty
    text in the checksum, repeated rows count each, an empty table gives an empty result.
    """
    words = materialise(word_counts(docs, length, least))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("y").alias("y"))).alias("best")
    near = near_pairs(words, crowd).groupBy(F.col("x").alias("word")).agg(F.count("*").alias("n_near"), best)
    frequent = -F.col("best.less") >= factor * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best.y")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")
    )
    found = materialise(found)
    roots = _roots(materialise(found.where("form IS NOT NULL").select("word", "form")))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """The last form of every word. A form is several times as frequent as its word, so there are no circles and few rounds."""
    onward = forms.select(F.col("word").alias("at"), F.col("form").alias("onward"))
    state, done = forms.select("word", F.col("form").alias("at")), None
    while True:
        step = materialise(state.join(onward, "at", "left"))
        ended = step.where("onward IS NULL").select("word", F.col("at").alias("root"))
        done = ended if done is None else done.unionByName(ended)
        state = step.where("onward IS NOT NULL").select("word", F.col("onward").alias("at"))
        if state.isEmpty():
            return done

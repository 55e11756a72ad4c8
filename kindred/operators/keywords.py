"""Keyword extraction: articles to scored postings, and postings to an inverted index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kindred.functions.phrases import LIBRARY, ranked_phrases
from kindred.functions.stopwords import ENGLISH
from kindred.functions.text import ascii_fold, field_words, round_half_up
from kindred.session import materialise

# Weight of a keyword by the field it comes from, one row per profile.
FIELD_WEIGHTS = {
    "default": {"title": 10, "keywords": 13, "meta_keywords": 13, "meta_description": 13, "tags": 13, "summary": 10},
    "first": {"title": 10, "keywords": 15, "meta_keywords": 15, "meta_description": 8, "tags": 12, "summary": 10},
    "light": {"title": 5, "keywords": 7, "meta_keywords": 7, "meta_description": 7, "tags": 7, "summary": 5},
}
FIELDS = ("content", "title", "keywords", "meta_keywords", "meta_description", "tags", "summary")
POSTINGS_PER_ROW = 10_000


def _present(field: str) -> Column:
    return F.nullif(F.col(field), F.lit("null"))


def _weighted(words: Column, weight: float, field: str) -> Column:
    return F.transform(
        words,
        lambda w: F.struct(w.alias("keyword"), F.lit(float(weight)).alias("score"), F.lit(field).alias("field")),
    )


def _phrases(field: str, fraction: float, variant: str, stopwords: Sequence[str], digits: int = 1) -> Column:
    return F.transform(
        ranked_phrases(_present(field), fraction, variant, stopwords),
        lambda p: F.struct(
            p["phrase"].alias("keyword"), round_half_up(p["score"], digits).alias("score"), F.lit(field).alias("field")
        ),
    )


def parse_word_list(cell: Column) -> Column:
    """A Python list literal of strings; a cell that does not parse gives null.

    The prefix ``u`` goes before a quote that opens a string; strings are passed over whole.
    """
    string = r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
    plain = F.regexp_replace(cell, string + r"""|u(?=['"])""", "$1")
    return F.from_json(plain, "array<string>", {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})


def field_keywords(
    field: str,
    profile: str = "default",
    fraction: float = 0.5,
    variant: str = LIBRARY,
    stopwords: Sequence[str] = ENGLISH,
) -> Column:
    """``array<struct<keyword, score, field>>`` of one article field."""
    if field in ("content", "summary"):
        return _phrases(field, fraction, variant, stopwords)
    text = _present(field)
    words = {
        "title": lambda: field_words(text, stopwords),
        "meta_description": lambda: field_words(text, stopwords),
        "keywords": lambda: F.split(F.lower(ascii_fold(text)), " "),
        "tags": lambda: F.split(F.lower(ascii_fold(text)), ","),
        "meta_keywords": lambda: F.transform(
            F.filter(parse_word_list(text), lambda w: F.length(w) > 1), F.lower
        ),
    }[field]()
    return _weighted(words, FIELD_WEIGHTS[profile][field], field)


def postings(
    articles: DataFrame,
    fields: Sequence[str] = FIELDS,
    profile: str = "default",
    fraction: float = 0.5,
    variant: str = LIBRARY,
    min_length: int = 3,
    id_col: str = "id",
) -> DataFrame:
    """``(keyword, doc_id, score, field)``: the long inverted index.

    One scan and no shuffle: every field becomes an array, the concatenation is exploded once.
    """
    empty = F.array().cast("array<struct<keyword:string,score:double,field:string>>")
    per_field = [F.coalesce(field_keywords(f, profile, fraction, variant), empty) for f in fields]
    return (
        articles.select(F.col(id_col).alias("doc_id"), F.explode(F.concat(*per_field)).alias("k"))
        .select("k.keyword", "doc_id", "k.score", "k.field")
        .where(F.length("keyword") >= min_length)
    )


def chunk_of(doc_id: Column, chunks: Column) -> Column:
    """Stable chunk number of a document among ``chunks``."""
    bucket = F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 8), 16, 10).cast("long")
    return F.when(chunks == 1, F.lit(0).cast("long")).otherwise(F.pmod(bucket, chunks))


def group_postings(index: DataFrame, per_row: int = POSTINGS_PER_ROW, extra: Sequence[str] = ()) -> DataFrame:
    """``(keyword, chunk, postings)`` with sorted ``postings``.

    A keyword with more than ``per_row`` postings is spread over several rows by document, so that no
    row or task has to hold all of a very common keyword. ``index`` is read twice: pass a written table.
    """
    counts = index.groupBy("keyword").agg(F.count("*").alias("n"))
    common = materialise(
        counts.where(F.col("n") > per_row).select(
            "keyword", F.ceil(F.col("n") / F.lit(per_row)).cast("long").alias("chunks")
        )
    )
    chunks = F.coalesce(F.col("chunks"), F.lit(1).cast("long"))
    # placed by chunk explicitly: a placement by keyword alone would satisfy the grouping as well,
    # but put all chunks of a common keyword into one task
    return (
        index.join(common, "keyword", "left")
        .withColumn("chunk", chunk_of(F.col("doc_id"), chunks))
        .repartition("keyword", "chunk")
        .groupBy("keyword", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "score", *extra))).alias("postings"))
    )


# characters of an id that the posting format uses itself, and what stands for them; the percent sign comes first
ESCAPES = (("%", "%25"), ("(", "%28"), (")", "%29"), (",", "%2C"))


def posting_text(doc_id: Column, score: Column) -> Column:
    """``(id,score)`` with the score as a plain decimal of at least one digit; brackets and commas of the id are escaped."""
    name = doc_id.cast("string")
    for sign, code in ESCAPES:
        name = F.replace(name, F.lit(sign), F.lit(code))
    number = F.regexp_replace(score.cast("decimal(20,6)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.concat(F.lit("("), name, F.lit(","), number, F.lit(")"))


def encode_postings(grouped: DataFrame) -> DataFrame:
    """``(Keyword, RowId & Score)`` with postings as ``(id,score)(id,score)``."""
    text = F.array_join(F.transform("postings", lambda p: posting_text(p["doc_id"], p["score"])), "")
    return grouped.select(F.col("keyword").alias("Keyword"), text.alias("RowId & Score"))


def decode_postings(encoded: DataFrame) -> DataFrame:
    """Back to ``(keyword, doc_id, score)``; a row without postings gives nothing."""
    cell = F.col("`RowId & Score`")
    pattern = F.lit(r"\(([^,()]*),([^()]*)\)")
    pairs = F.arrays_zip(
        F.regexp_extract_all(cell, pattern, F.lit(1)).alias("doc_id"),
        F.regexp_extract_all(cell, pattern, F.lit(2)).alias("score"),
    )
    doc_id = F.col("p.doc_id")
    for sign, code in reversed(ESCAPES):
        doc_id = F.replace(doc_id, F.lit(code), F.lit(sign))
    return (
        encoded.where(cell.isNotNull())
        .select(F.col("Keyword").alias("keyword"), F.explode(pairs).alias("p"))
        .select("keyword", doc_id.alias("doc_id"), F.col("p.score").try_cast("double").alias("score"))
    )


def file_keywords(texts: DataFrame, name: str = "filename", text: str = "mainText", digits: int = 2) -> DataFrame:
    """``(keyword, doc_id, score)`` from named texts: all phrases, scores to two decimals."""
    return (
        texts.select(F.col(name).alias("doc_id"), F.explode(ranked_phrases(F.col(text))).alias("p"))
        .select(F.col("p.phrase").alias("keyword"), "doc_id", round_half_up(F.col("p.score"), digits).alias("score"))
    )


def document_keywords(index: DataFrame) -> DataFrame:
    """``(doc_id, keywords)``: all postings of a document in one sorted array."""
    return index.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("keyword", "score", "field"))).alias("keywords")
    )

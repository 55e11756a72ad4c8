"""Article corpora: CSV, XML and plain text files, and the corpus view of the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kindred.session import spread
from kindred.sources.csv_ranges import read_csv_ranges

# The column order of the article CSV files.
ARTICLE_COLUMNS = (
    "_index", "id", "domain", "type", "url", "content", "scraped_at", "inserted_at", "updated_at",
    "title", "authors", "keywords", "meta_keywords", "meta_description", "tags", "summary",
)
ARTICLE_SCHEMA = StructType([StructField(c, StringType()) for c in ARTICLE_COLUMNS])
XML_SCHEMA = StructType([StructField("mainText", StringType())])
CSV_OPTIONS = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_article_csv(spark: SparkSession, path: str, schema: StructType = ARTICLE_SCHEMA) -> DataFrame:
    """Articles with embedded line breaks and doubled quotes; the text ``null`` is a null. Every byte range of a file is a task."""
    return read_csv_ranges(spark, path, schema, nullValue="null", **CSV_OPTIONS)


def write_article_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, nullValue="null", **CSV_OPTIONS)


def read_article_xml(spark: SparkSession, path: str) -> DataFrame:
    """``(filename, mainText)`` per ``article`` element; only the base name of the file is kept."""
    return (
        spark.read.schema(XML_SCHEMA)
        .xml(path, rowTag="article")
        .select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("filename"), "mainText")
    )


def read_query_texts(spark: SparkSession, path: str) -> DataFrame:
    """``(filename, text)``: every file is one query article."""
    return spark.read.text(path, wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("filename"),
        F.col("value").alias("text"),
    )


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(word, vec)`` from lines of a word and its numbers, separated by blanks."""
    parts = F.split("value", " ")
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("word"),
        F.slice(parts, F.lit(2), F.size(parts) - 1).cast("array<double>").alias("vec"),
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of texts, spread over all cores when its files are fewer than these."""
    return spread(table(spark, sf_dir, name))


def label_type() -> Column:
    return (
        F.when(F.col("toxic") == 1, "hate").when(F.col("quality") == 1, "reliable").otherwise("unreliable")
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table in the shape of the article corpus; short fields come from the text.

    The ``type`` of an article is a table of its own, see :func:`article_types`: only the few articles of
    a result need it, and joining it here would shuffle the texts of the whole corpus.
    """
    text = F.col("text")
    return texts(spark, sf_dir).select(
        F.col("doc_id").alias("id"),
        text.alias("content"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.concat_ws(" ", "lang", "source").alias("keywords"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("['"), "source"))
        .otherwise(F.concat(F.lit("['"), "lang", F.lit(" news', u'"), "source", F.lit("']")))
        .alias("meta_keywords"),
        F.coalesce(F.get(F.split(text, "\n"), F.lit(1)), F.lit("null")).alias("meta_description"),
        F.concat_ws(", ", "source", "lang").alias("tags"),
        F.substring_index(text, ". ", 2).alias("summary"),
    )


def article_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, type)``."""
    return table(spark, sf_dir, "labels").select("doc_id", label_type().alias("type"))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, text)``: every benchmark passage by itself."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


#: Passages in a query article.
PARAGRAPHS = 10


def query_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, text)``: ten benchmark passages in a row are the paragraphs of one query article.

    A single passage has too few phrases for the fuzzy stage, which takes a twentieth of an article's phrases.
    """
    number = F.floor(F.col("item_id") / PARAGRAPHS).alias("query_id")
    grouped = table(spark, sf_dir, "benchmark").groupBy(number).agg(F.array_sort(F.collect_list(F.struct("item_id", "text"))).alias("parts"))
    return grouped.select("query_id", F.array_join("parts.text", "\n").alias("text"))


#: Documents of a language that become query articles.
WHOLE = 10


def whole_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, text)``: the longest documents of every language as query articles, whole, and each half of their lines by itself.

    The number is three times that of the document, plus one for the first and two for the second half.
    """
    longest_first = Window.partitionBy("lang").orderBy(F.length("text").desc(), "doc_id")
    longest = table(spark, sf_dir, "documents").withColumn("place", F.row_number().over(longest_first)).where(F.col("place") <= WHOLE)
    rows = longest.select("doc_id", F.split("text", "\n").alias("rows"))
    middle = F.ceil(F.size("rows") / 2).cast("int")
    parts = F.array(F.col("rows"), F.slice("rows", F.lit(1), middle), F.slice("rows", middle + 1, F.size("rows")))
    return rows.select("doc_id", F.posexplode(parts).alias("part", "rows")).select((F.col("doc_id") * 3 + F.col("part")).alias("query_id"), F.array_join("rows", "\n").alias("text"))

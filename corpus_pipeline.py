"""A training corpus from raw documents: quality, exact and near duplicates, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import best_fit, cotraining, exact_dedup, secret_automata, simhash
from kindred.llm.common import keyed, table
from kindred.session import materialise, scratch, work_dir


def _only(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``decided``, with their own columns."""
    return docs.join(decided, "key", "left_semi").select("doc.*")


def _flat(docs: DataFrame) -> DataFrame:
    """The key with the columns that operators read."""
    return docs.select("key", "doc.doc_id", "doc.text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject. All columns and repeated rows are kept as they are.

    Null texts and metadata count as values of their own; without labels of both classes everything stays.
    """
    model = cotraining.learn(docs, table(spark, sf_dir, "labels"))
    # a name that no column has
    whole = "row_" + "_" * max(map(len, docs.columns))
    return cotraining.scores(docs.select("*", F.struct("*").alias(whole)), model, [whole]).where("keep").select(f"{whole}.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts, that with the largest id (null is smallest). A null text equals the empty one."""
    docs = keyed(docs)
    return _only(docs, exact_dedup.exact_groups(_flat(docs), ["key"]).where("kept").select("key"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, that with the smallest id (null is largest). Null and empty texts are one group."""
    docs = keyed(docs)
    return _only(docs, simhash.near_groups(_flat(docs), ["key"]).where(F.col("row") == F.col("first_row")).select("key"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with every secret masked; a length column ``n_chars`` follows the text. Null texts stay null."""
    model = secret_automata.load(secret_automata.learn(docs))
    return secret_automata.masked(docs, model)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens. A null text is its end token alone; no documents, no pieces."""
    items = materialise(best_fit.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False))
    return best_fit.pack(items).drop("row")


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("secrets", secrets), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again, and what it wrote on the way is removed."""
    docs = table(spark, sf_dir, "documents")
    last = work_dir(spark)
    with scratch(spark):
        for i, (_, stage) in enumerate(STAGES):
            path = last if i + 1 == len(STAGES) else work_dir(spark)
            with scratch(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

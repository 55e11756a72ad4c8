from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, name string, fp string, identity string, spans string, hits string"
LONG = "The same words again and again, " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and very long texts, repeated rows and ids, ties, and columns named like those of the operators."""
    rows = [
        (1, "Alpha beta gamma delta", "en"), (2, "ALPHA beta gamma delta", "en"), (2, "ALPHA beta gamma delta", "en"), (3, None, None), (4, "", "fr"),
        (5, LONG, "en"), (6, LONG.upper(), "de"), (7, LONG + "!", "en"), (None, "no id at all", "en"), (None, None, None), (8, "ÀÉ ß K", "fr"), (9, " \t\n ", None),
        (10, "x", "es"), (11, "123 456 --- 789", "en"), (12, "cc by and CC-BY; all rights reserved", "en"), (13, "password: hunter2hunter2 ▁ \x00 end", "en"),
    ]
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), 0, "k", "n", "f", "i", "s", "h") for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def planted(spark, documents):
    """Documents with exact copies, near copies in a chain, and a hot text."""
    base = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    rows = list(base)
    for i, (_, text) in enumerate(base[:30]):
        words = text.split(" ")
        rows += [(1000 + 10 * i, text.swapcase()), (1001 + 10 * i, text + " more"), (1002 + 10 * i, " ".join(words[:-1]))]
    rows += [(5000 + i, base[3][1]) for i in range(150)] + [(6000 + i, base[5][1] + f" tail {i}") for i in range(150)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(7)

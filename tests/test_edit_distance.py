from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kindred.operators import edit_distance, search


def by_table(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def texts(seed: int, letters: str, n: int = 400) -> tuple[list[str], list[str]]:
    rng = random.Random(seed)
    patterns = ["".join(rng.choice(letters) for _ in range(m)) for m in (0, 1, 2, 9, 30, 63, 64, 65, 90, 128, 129, 200)]
    pairs = []
    for _ in range(n):
        a = rng.choice(patterns)
        b = list(a) if rng.random() < 0.6 else [rng.choice(letters) for _ in range(rng.randrange(140))]
        for _ in range(rng.randrange(12)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(letters), "?z"])
        pairs.append((a, "".join(b)))
    return tuple(map(list, zip(*pairs, strict=True)))


def by_numbers(patterns: pa.Array, others: pa.Array) -> list[int]:
    coded = patterns.dictionary_encode()
    return edit_distance.distances(edit_distance.prepared(coded.dictionary, others), coded.indices.to_numpy(), np.arange(len(others))).tolist()


def test_distances_by_table():
    for seed, letters in enumerate(["ab", "abcdefgh ", "aé漢😀 ", "😀"]):
        a, b = texts(seed, letters)
        want = [by_table(x, y) for x, y in zip(a, b, strict=True)]
        assert by_numbers(pa.array(a), pa.array(b)) == want
        assert by_numbers(pa.array(["x", *a])[1:], pa.array(["yé", *b])[1:]) == want
    assert by_numbers(pa.array([], pa.string()), pa.array([], pa.string())) == []


def test_close_pairs_by_table(spark, monkeypatch):
    monkeypatch.setattr(search, "KEYWORDS", 50)
    a, b = texts(8, "abc é", 300)
    b = sorted({*b, *a})
    phrases = spark.createDataFrame([(x,) for x in sorted(set(a))], "phrase string")
    found = search._met_on_letters(spark.createDataFrame([*[(y,) for y in b], (None,)], "keyword string"), phrases, 0.6, 2)
    got = sorted((r.phrase, r.keyword) for r in found.collect())
    assert got == sorted((x, y) for x in set(a) for y in b if x and y and by_table(x, y) <= int(max(len(x), len(y)) * (1 - 0.6) + 1e-9)) and len(got) > 20


def test_letters_are_not_compared_pair_by_pair(spark):
    """nearly all the time went into Spark's levenshtein of each pair."""
    words = [(w,) for w in ("alpha beta", "alpha bets", "gamma", "naïve thought", "naive thougt", "x" * 150 + "y")]
    phrases = spark.createDataFrame([(1, w, 2.0) for (w,) in words[:1] + words[3:4]] + [(1, "x" * 152, 2.0)], "query_id long, phrase string, score double")
    found = search.edit_matches(spark.createDataFrame(words, "keyword string"), phrases, 0.6)
    assert {(r.phrase[:9], r.keyword[:9], round(r.ratio, 3)) for r in found.collect()} == {("alpha bet", "alpha bet", 0.9), ("naïve tho", "naive tho", 0.846), ("x" * 9, "x" * 9, round(150 / 152, 3))}
    pairs = search._met_on_letters(spark.createDataFrame(words, "keyword string"), phrases, 0.6, 4)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "cogroupsinarrow" in plan and "levenshtein" not in plan

"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from kindred.llm import exact_dedup, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_by_force(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize(("block", "name"), [(4096, "odd"), (5, "odd"), (64, "planted"), (4096, "planted"), (100000, "planted")])
def test_exact_equals_force(request, block, name):
    docs = request.getfixturevalue(name)
    got = exact_dedup.exact_groups(docs, block=block).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == exact_by_force(pairs(docs))
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_keys_that_collide_are_taken_again(spark):
    docs = spark.createDataFrame([(i, f"text {i % 40}") for i in range(80)], "doc_id long, text string")
    rows = exact_dedup.identities(docs, block=3, key_bytes=1).collect()
    assert len({r["identity"] for r in rows}) == 40


def test_exact_of_nothing(none):
    assert exact_dedup.exact_groups(none).collect() == []


def print_by_force(text):
    words = (text or "").translate(LOWER).encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_force(prints, ids, distance=3):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    fps = np.array(prints, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= distance).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(fps)):
        groups[find(i)].append(i)
    least = {k: min((ids[i] for i in v if ids[i] is not None), default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(fps))]


@pytest.mark.parametrize(("name", "chunk"), [("odd", 2048), ("planted", 2048), ("planted", 4)])
def test_near_equals_force(request, name, chunk):
    docs = request.getfixturevalue(name)
    rows = pairs(docs)
    prints = [print_by_force(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], prints, components_by_force(prints, [i for i, _ in rows]), strict=True), key=str)
    got = simhash.near_groups(docs, chunk=chunk).collect()
    assert sorted([(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got], key=str) == want
    first = [r for r in got if r["row"] == r["first_row"]]
    assert len(first) == len({r["component_id"] for r in got}) and all(r["doc_id"] == r["component_id"] for r in first)


@pytest.mark.parametrize("chunk", [2048, 16])
def test_links_of_random_and_dense_prints(spark, chunk):
    random = np.random.default_rng(5)
    centres = random.integers(0, 2**63, 30, dtype=np.uint64)
    prints = set(centres.tolist())
    for c in centres:
        for _ in range(12):
            flips = random.choice(64, random.integers(1, 6), replace=False)
            prints.add(int(c) ^ sum(1 << int(b) for b in flips))
    prints |= {(7 << 40) | i for i in range(300)}  # one segment shared by all, dense in the other
    prints |= {(int(i) * 0x9E3779B1 % 2**32) << 32 | 5 for i in range(200)}
    prints = sorted(prints)
    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    edges = simhash.links(table, 3, chunk).collect()
    assert len(edges) < 40 * len(prints)
    found = {r["a"]: r["b"] for r in simhash.components(simhash.links(table, 3, chunk)).collect()}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    assert [found.get(s, s) for s in signed] == components_by_force(prints, signed)


def test_near_of_nothing(none):
    assert simhash.near_groups(none).collect() == []

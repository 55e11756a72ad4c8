"""Line dedup, spelling variants and source divergence against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kindred.llm import line_dedup, source_divergence, spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- lines


def lines_by_force(rows, least=40, holders=5):
    held = defaultdict(set)
    cut = [(t or "").split("\n") for _, t in rows]
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for i, lines in enumerate(cut):
        for line in lines:
            if len(key(line)) >= least:
                held[key(line)].add(i)
    small = lambda i: (rows[i][0] is not None, rows[i][0] or 0)
    top = {k: max(small(i) for i in v) for k, v in held.items() if len(v) >= holders}
    out = []
    for i, lines in enumerate(cut):
        keep = [line for line in lines if key(line) not in top or small(i) == top[key(line)]]
        out.append((rows[i][0], len(lines), len(lines) - len(keep), sha("\n".join(keep))))
    return sorted(out, key=str)


def lines_found(docs, **options):
    rows = line_dedup.deduplicated(docs, **options).collect()
    assert all((r["bitmap"] is None) == (r["n_dropped"] == 0) for r in rows)
    return sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], sha(r["text"])) for r in rows], key=str)


@pytest.fixture(scope="module")
def lined(spark):
    """Documents of lines that few, many or all of them hold, at places of all kinds."""
    draw = random.Random(3)
    common = [f"{'The line number'} {i} that {'many' if i % 2 else 'some'} documents hold in their text" for i in range(60)]
    rows = []
    for i in range(400):
        lines = [f"own line {i} {j} " + "x" * draw.randrange(60) for j in range(draw.randrange(6))]
        lines += draw.choices(common, k=draw.randrange(5))
        lines += ["  A LINE that a third of all documents hold, with blanks around it\t"] * (i % 3 == 0)
        lines += ["short shared line", ""]
        lines += ["É" * 39 + "a", "É" * 39, " " * 50] * (i % 11 == 0)
        draw.shuffle(lines)
        rows.append((i % 380, "\n".join(line.upper() if draw.random() < 0.2 else line for line in lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, common[0]), (None, common[1] + "\n" + common[1])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("parts", [1, 8, 97])
def test_lines_equal_force_however_dealt(spark, lined, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert lines_found(lined.repartition(5)) == lines_by_force(pairs(lined))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", ["odd", "documents", "planted"])
def test_lines_equal_force(request, name):
    docs = request.getfixturevalue(name)
    for options in ({}, {"least": 1, "holders": 2}):
        assert lines_found(docs, **options) == lines_by_force(pairs(docs), **options)


def test_lines_carry_columns_of_any_name(odd):
    got = line_dedup.deduplicated(odd, ["row", "key"]).collect()
    assert len(got) == odd.count() and {(r["row"], r["key"]) for r in got} == {(0, "k")}


def test_lines_of_nothing(none):
    assert line_dedup.deduplicated(none).collect() == []


def test_bits_of_kept_lines():
    bits = zlib.compress(np.packbits([1, 0, 1, 1, 0], bitorder="little").tobytes())
    assert line_dedup.kept_lines("a\nb\nc\nd\ne", bits) == "a\nc\nd"
    assert line_dedup.kept_lines("a\n", None) == "a\n"
    assert line_dedup.kept_lines("a\nb", zlib.compress(b"\0")) == ""


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_stream_meets_borders_anywhere(size):
    """The decisions of cut partitions, put together by the borders, are those of one whole partition."""
    draw = random.Random(size)
    rows = sorted((draw.randrange(6) ** 3, 0, -draw.randrange(9), 0, i) for i in range(120))
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("file", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_lines", pa.int32()), ("places", pa.list_(pa.int32()))])
    table = [{"h1": h, "h2": h2, "file": f, "row": r, "doc_id": -d, "n_lines": 1, "places": [0]} for h, h2, d, f, r in rows]
    groups = defaultdict(list)
    for r in table:
        groups[r["h1"]].append(r)
    want = {r["row"] for g in groups.values() if len(g) >= 5 for r in g if r["doc_id"] != max(x["doc_id"] for x in g)}
    cuts = [0, 1, 2, 30, 31, 64, 65, 100, 120]
    out = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        batches = [pa.RecordBatch.from_pylist(table[i : min(i + size, hi)], schema=schema) for i in range(lo, hi, size)]
        out += [r for b in line_dedup._stream(5)(iter(batches)) for r in b.to_pylist()]
    total, top = Counter(), {}
    for r in out:
        if r["held"] is not None:
            total[r["h1"]] += r["held"]
            top[r["h1"]] = max(top.get(r["h1"], -99), r["doc_id"])
    rest = [r for r in out if r["held"] is None]
    assert len(rest) == len({r["row"] for r in rest})
    got = {r["row"] for r in rest if r["h1"] is None or total[r["h1"]] >= 5 and r["doc_id"] != top[r["h1"]]}
    assert got == want


# ---- words


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_force(counts, factor=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def words_by_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 199 else "".join(c for i, c in enumerate(run) if i != h % len(run))] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def variants_found(docs, **options):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_variants.variants(docs, **options).collect())


@pytest.mark.parametrize(("name", "crowd"), [("odd", 1024), ("documents", 1024), ("documents", 3), ("planted", 0)])
def test_variants_equal_force(request, name, crowd):
    docs = request.getfixturevalue(name)
    assert variants_found(docs, crowd=crowd) == variants_by_force(words_by_force(pairs(docs)))


@pytest.fixture(scope="module")
def misspelt(spark):
    """Words with edits at every place, chains of forms, repeated letters, ties, and a third of all words with one front."""
    draw = random.Random(8)
    letters = "abcdeéÿÀ×"
    words = {"".join(draw.choices(letters, k=draw.randrange(6, 14))) for _ in range(60)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "babababa"}
    words |= {"internat" + a + b for a in letters for b in letters + "x"}
    for w in sorted(words)[:40]:
        for i in range(len(w) + 1):
            words.add(w[:i] + draw.choice(letters) + w[i:])
            words.add(w[:i] + w[i + 1 :])
            words.add(w[:i] + draw.choice(letters) + w[i + 1 :])
    counts = {w: draw.choice([5, 6, 25, 26, 125, 700]) for w in sorted(words)}
    return spark.createDataFrame(list(counts.items()), "word string, n long"), {w: n for w, n in counts.items() if len(w) >= 6}


@pytest.mark.parametrize("crowd", [10**6, 40, 5, 0])
def test_pairs_equal_force(misspelt, crowd):
    table, counts = misspelt
    got = [(r["x"], r["y"], r["n"]) for r in spelling_variants.near_pairs(table.where(F.char_length("word") >= 6), crowd).collect()]
    want = sorted((a, b, counts[b]) for a in counts for b in counts if one_edit(a, b))
    assert sorted(got) == want


def test_roots_follow_chains(spark):
    forms = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "d")]
    got = spelling_variants._roots(spark.createDataFrame(forms, "word string, form string")).collect()
    assert sorted((r["word"], r["root"]) for r in got) == [("a", "d"), ("b", "d"), ("c", "d"), ("x", "d")]


def test_variants_of_nothing(none):
    assert spelling_variants.variants(none).collect() == []


# ---- sources


def audit_by_force(rows, least=10, ranks=10):
    unit, groups, held, count = 10**9, defaultdict(set), Counter(), Counter()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        held.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = []
    price = lambda p, q: (p - q) ** 2 // (p + q)
    order = lambda found: sorted(found, key=lambda x: (-x[1], x[0].encode()))
    for lang, sources in groups.items():
        terms = [t for (g, t), n in held.items() if g == lang and n >= least]
        table = {s: {t: count[lang, s, t] for t in terms} for s in sources}
        whole = {t: sum(table[s][t] for s in sources) for t in terms}
        share = lambda c, t: 1 + unit * (c[t] + 2) // (sum(c.values()) + 2 * len(terms))  # noqa: E731, B023
        p = {s: {t: share(table[s], t) for t in terms} for s in sources}
        q = {t: share(whole, t) for t in terms}
        for s in sources:
            found = order([(o, sum(price(p[s][t], p[o][t]) for t in terms)) for o in sources if o != s])
            out += [(lang, s, "pair", o, v, i + 1) for i, (o, v) in enumerate(found)]
            found = order([(t, price(p[s][t], q[t])) for t in terms if table[s][t] > 0 and p[s][t] > q[t]])
            out += [(lang, s, "term", t, v, i + 1) for i, (t, v) in enumerate(found[:ranks])]
    return sorted(out)


def audit_found(docs, **options):
    rows = source_divergence.audit(docs, **options).collect()
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows)


def triples(docs):
    return [(r["lang"], r["source"], r["text"]) for r in docs.select("lang", "source", "text").collect()]


@pytest.fixture(scope="module")
def sourced(spark):
    """Languages with many sources, without kept terms, with one source, null names; terms of all frequencies and ties."""
    draw = random.Random(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}É" for i in range(150)]
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else f"s{draw.randrange(12)}"
        rows.append((draw.choice(["aa", "aa", "bb", None]), source if i % 17 else None, " ".join(words[int(150 * draw.random() ** 3)] for _ in range(draw.randrange(40)))))
    rows += [("few", "p", "never often"), ("few", "q", "12 34"), ("few", "r", None), ("one", "only", words[0])] + [("one", "only", words[0].upper())] * 12
    return spark.createDataFrame(rows, "lang string, source string, text string")


@pytest.mark.parametrize(("block", "tile"), [(1024, 128), (7, 128), (1024, 5), (16, 3), (1024, 1)])
def test_audit_equals_force(sourced, block, tile):
    assert audit_found(sourced, block=block, tile=tile) == audit_by_force(triples(sourced))


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_audit_of_documents(request, name):
    docs = request.getfixturevalue(name)
    assert audit_found(docs) == audit_by_force(triples(docs))
    assert audit_found(docs, documents=1) == audit_by_force(triples(docs), 1)


def test_audit_of_nothing(none):
    assert audit_found(none) == []


def test_joint_prices_of_wide_blocks():
    """More columns than are multiplied at a time."""
    draw = np.random.default_rng(4)
    counts = draw.integers(0, 400, (90, 6)) * (draw.random((90, 6)) < 0.8)
    term, g = np.nonzero(counts)
    shares = draw.integers(1, 10**9, (6, 401))
    got = source_divergence.joint_prices(g + 10, term * 5, counts[term, g], shares[g, counts[term, g]], np.arange(6) + 10, shares[:, 0], np.zeros(6, int), 95)
    want = []
    for i in range(6):
        for j in range(i + 1, 6):
            cells = [(int(shares[i, a]), int(shares[j, b])) for a, b in zip(counts[:, i], counts[:, j], strict=True)] + [(int(shares[i, 0]), int(shares[j, 0]))] * 5
            want.append((i + 10, j + 10, sum((p - q) ** 2 // (p + q) for p, q in cells)))
    assert got == want

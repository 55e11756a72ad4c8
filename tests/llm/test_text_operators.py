"""Secrets, licenses, languages, pieces, model scores and quality, against brute force or held-out rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from kindred.llm import backoff_lm, cotraining, language_id, license_scan, piece_codec, secret_automata

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- secrets -----------------------------------------------------------------


def spans_by_force(text):
    """The fixed patterns as they are stated, one scan each."""
    kinds = {
        "assign": (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
        "access": (r"AKIA[A-Z0-9]+", 0, 16),
        "hex": (r"[0-9a-f]+", 0, 32),
    }
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(kinds.items()):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "TOKEN", "api_key", "apikey", "ſecret", "toKen", '"', "'", " ", "  ", ":", "=", "abcdef0123456789" * 2, "AKIA", "ABCD1234EFGH5678", "é", "\n", "x", "7f", "."]), max_size=12).map("".join))
def test_base_spans(text):
    assert secret_automata.base_spans(text) == spans_by_force(text)


def test_scan_of_odd_rows(odd, none):
    model = secret_automata.load(secret_automata.learn(odd))
    rows = secret_automata.scan(odd, model, ["name"]).collect()
    assert len(rows) == odd.count()
    for r in rows:
        base = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in secret_automata.KINDS]
        assert base == spans_by_force(r["text"])
    assert secret_automata.load(secret_automata.learn(none)) == {}
    assert secret_automata.scan(none, {}).collect() == []


def test_automata_learn_a_format(spark):
    random = np.random.default_rng(1)
    key = lambda: "tk-" + "".join(random.choice(list("0123456789"), 12)) + "".join(random.choice(list("xyzw"), 6))
    filler = "international-organisation-of-everything plain words"
    docs = spark.createDataFrame([(i, f"{filler} token = {key()} and more") for i in range(300)], "doc_id long, text string")
    model = secret_automata.load(secret_automata.learn(docs))
    fresh = f"see {key()} or abcdefghijklmnop1 or international1organisation and token={key()}"
    spans = secret_automata.learned_spans(fresh, secret_automata.base_spans(fresh), model)
    assert [(k, fresh[a:b][:3]) for k, a, b in spans] == [("like_assign", "tk-")]
    assert key()[:3] not in secret_automata.redact(fresh, [*spans, *secret_automata.base_spans(fresh)])


def test_plain_words_come_from_all_of_every_text(spark):
    texts = [f"token=abcd{i:04}efgh first-ordinary-word1 and then second-ordinary-word" for i in range(3)] + ["no credential, third-ordinary-word", None]
    found = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("text").where("text IS NOT NULL")
    rows = {tuple(r) for r in found.mapInArrow(secret_automata._gather, "kind string, word string").collect()}
    assert {w for k, w in rows if k == "plain"} == {"first-ordinary-word1", "second-ordinary-word", "credential", "third-ordinary-word"}
    assert {w for k, w in rows if k == "assign"} == {f"abcd{i:04}efgh" for i in range(3)}


def test_candidates_cover_dotted_and_short_formats(spark):
    random = np.random.default_rng(2)
    key = lambda: "".join(random.choice(list("0123456789"), 3)) + "." + "".join(random.choice(list("XYZW"), 6))
    docs = spark.createDataFrame([(i, f"token={key()} followed by international organisations, everything considered {i}") for i in range(300)], "doc_id long, text string")
    model = secret_automata.load(secret_automata.learn(docs))
    fresh = f"see {key()} or organisations, considered everything"
    spans = secret_automata.learned_spans(fresh, secret_automata.base_spans(fresh), model)
    assert [(k, a, b) for k, a, b in spans] == [("like_assign", 4, 14)]


def test_automaton_merges_states_and_sums_to_one():
    arcs = secret_automata.infer(["00f" * n for n in range(1, 9) for _ in range(512 >> n)])
    totals = Counter()
    for state, _, _, score in arcs:
        totals[state] += math.exp(score)
    assert all(abs(t - 1) < 1e-9 for t in totals.values())
    assert len(totals) <= 6


def test_redact_and_mask(spark):
    assert secret_automata.redact("abcdef", [("a", 1, 3), ("b", 2, 4)], "*") == "a*ef"
    assert secret_automata.redact("abcdef", [("a", 1, 3), ("b", 3, 4), ("c", 5, 6)], "*") == "a*e*"
    docs = spark.createDataFrame([(1, "password=abcdefgh1 x", 20, None), (1, None, None, "z"), (2, "", 0, "z")], "doc_id long, text string, n_chars long, spans string")
    got = [tuple(r) for r in secret_automata.masked(docs, {}).collect()]
    assert got == [(1, "[secret] x", 10, None), (1, None, None, "z"), (2, "", 0, "z")]


# --- licenses ----------------------------------------------------------------


def words_by_force(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_licenses_of_odd_rows(spark, odd, none):
    extra = [(50, "Licensed under CC BY-NC 4.0.", "en"), (51, "cc by cc by", None), (52, "All rights  reserved ALL RIGHTS\nRESERVED", None), (53, "worK ccK by by", None), (54, "Permission is hereby granted, free of charge, to any person obtaining", "en")]
    docs = odd.unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"), allowMissingColumns=True)
    idf = license_scan.weights(docs)
    rows = license_scan.scan(docs.withColumn("places", docs["doc_id"]), idf).collect()
    texts = [t for _, t in docs.select("doc_id", "text").collect()]
    assert len(rows) == len(texts)
    for r, text in zip(rows, texts, strict=True):
        words = words_by_force(text)
        want = sorted(i for t in license_scan.BASE for i in range(len(words)) if tuple(words[i : i + len(t.words)]) == t.words)
        assert r["n_words"] == len(words) and sorted(r["places"]) == want
        assert set(r["base_labels"]) == {t.label for t in license_scan.BASE if any(tuple(words[i : i + len(t.words)]) == t.words for i in range(len(words)))}
        assert set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[50]["labels"] == ["cc-by", "cc-by-nc"] and by_id[54]["labels"] == ["mit"] and by_id[1]["score"] == 0
    assert license_scan.scan(none, license_scan.weights(none)).collect() == []


def test_license_plan_has_no_python(documents):
    plan = license_scan.scan(documents, license_scan.weights(documents))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan


# --- languages ---------------------------------------------------------------


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.cross_fold(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(odd, none):
    rows = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(odd, language_id.learn(odd)).collect()}
    assert {(3, "und", 0.0), (4, "und", 0.0), (9, "und", 0.0), (11, "und", 0.0)} <= rows
    assert {p for _, p, _ in rows} <= {"und", "en", "fr", "de", "es"}
    assert language_id.cross_fold(none).collect() == []
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.learn(none)).collect()} == {"und"}
    one = language_id.learn(odd.where("lang = 'fr'"))
    assert {r["lang_pred"] for r in language_id.predict(odd, one).collect()} == {"und", "fr"}


def test_svm_separates():
    random = np.random.default_rng(0)
    x = random.normal(size=(300, 5))
    signs = np.where(x @ [1, -2, 0.5, 0, 0] + 0.3 > 0, 1.0, -1.0)
    w = language_id.svm(x, signs, cost=100, passes=500)
    assert (np.sign(x @ w[:-1] + w[-1]) == signs).mean() > 0.98


# --- pieces ------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return piece_codec.PieceModel(MODEL, cache=50)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("ab the \n\t▁é日😀\x00.,<0>K　")), max_size=60) | st.text(max_size=40))
def test_pieces_equal_library(codec, library, text):
    text = text.encode("utf-8", "ignore").decode()
    ids, begins, ends = codec.encode(text)
    assert ids.tolist() == library.encode(text)
    assert codec.decode(ids) == library.decode(ids.tolist())
    data = text.encode()
    assert b"".join(data[b:e] for b, e in zip(begins, ends, strict=True)) == data
    assert piece_codec._covered(text, begins, ends, False) == len(data)
    traced = codec.traced(text)
    assert traced[1] == ",".join(map(str, ids.tolist())) and all((a == b).all() for a, b in zip((traced[0], *traced[2:]), codec.encode(text), strict=True))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31999) | st.integers(3, 258) | st.sampled_from([0, 259, 260]), max_size=12))
def test_decode_any_ids(codec, library, ids):
    assert codec.decode(ids) == library.decode(ids)


def test_long_word(codec, library):
    text = "ab" * 3000 + "thethe" * 500
    assert codec.encode(text)[0].tolist() == library.encode(text)


def trie_blob(entries):
    """A compiled map made by hand: a double array whose nodes each lie in a block of 256 units of their own."""
    units, texts, blocks = {}, b"", 1
    children = {b"": set()}
    for key in entries:
        for i in range(len(key)):
            children.setdefault(key[:i], set()).add(key[i])
            children.setdefault(key[: i + 1], set())
    where = {b"": 0}
    for node in sorted(children, key=len):
        at, base = where[node], blocks * 256
        blocks += 1
        offset = at ^ base  # a block's first unit is the leaf of its node
        label = node[-1] if node else 0
        units[at] = (offset >> 8 << 10) | 1 << 9 | label if offset & 0xFF == 0 and offset >= 1 << 21 else (offset << 10) | label
        if node in entries:
            units[at] |= 1 << 8
            units[base] = 1 << 31 | len(texts)
            texts += entries[node] + b"\x00"
        for b in children[node]:
            where[node + bytes([b])] = base ^ b
    data = np.zeros(blocks * 256, "<u4")
    for k, v in units.items():
        data[k] = v
    return np.uint32(data.nbytes).tobytes() + data.tobytes() + texts


def test_character_map_takes_the_longest_prefix():
    entries = {b"a": b"x", b"abc": b"yz", "é".encode(): b"e", b"ab": b""}
    known = piece_codec.CharacterMap(trie_blob({k: v for k, v in entries.items()}))
    assert known.longest(b"abcd", 0) == (3, b"yz")
    assert known.longest(b"abd", 0) == (2, b"")
    assert known.longest("zé".encode(), 1) == (2, b"e")
    assert known.longest(b"zz", 0) is None


def test_offsets_through_a_character_map():
    codec = piece_codec.PieceModel(MODEL)
    codec.map = piece_codec.CharacterMap(trie_blob({"ﬁ".encode(): b"fi", "é".encode(): b"e"}))
    codec._identity = False
    text = "caﬁé x"
    normal, begins, ends = codec.normalise(text)
    assert normal == "▁cafie▁x"
    assert list(zip(begins, ends, strict=True))[3:5] == [(2, 5), (2, 5)]
    ids, first, last = codec.encode(text)
    assert codec.decode(ids) == "cafie x" and first[0] == 0 and last[-1] == len(text.encode())


def test_pieces_of_odd_rows(odd, none, library):
    got = sorted([(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in piece_codec.digests(odd, MODEL).collect()], key=str)
    want = []
    for doc_id, text in odd.select("doc_id", "text").collect():
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    texts = {i: t or "" for i, t in odd.select("doc_id", "text").collect()}
    codec = piece_codec.PieceModel(MODEL)
    for r in piece_codec.digests(odd.where("doc_id IS NOT NULL"), MODEL).collect():
        _, begins, ends = codec.encode(texts[r["doc_id"]])
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())
        assert r["spans_sha256"] == hashlib.sha256(np.asarray(begins, "<i8").tobytes() + np.asarray(ends, "<i8").tobytes()).hexdigest()
    full = piece_codec.decode(piece_codec.encode(odd, MODEL, ["key"]).drop("begins", "ends"), MODEL).collect()
    assert {(r["doc_id"], r["decoded"]) for r in full} == {(i, library.decode(library.encode(t or ""))) for i, t in odd.select("doc_id", "text").collect()}
    assert piece_codec.encode(none, MODEL).collect() == []


# --- model scores ------------------------------------------------------------


def model_by_force(texts, order, word_least, gram_least, discount=0.75):
    """Interpolated absolute discounting straight from counts of word tuples."""
    lists = [[*w, b""] for w in map(backoff_lm.words_of, texts)]
    words = Counter(w for x in lists for w in x)
    total, distinct = sum(words.values()), len(words)
    head = {w for w, c in words.items() if c >= word_least} | {b""}
    start = None
    grams = [Counter() for _ in range(order + 1)]
    for x in lists:
        x = [start, *x]
        for n in range(2, order + 1):
            for i in range(len(x) - n + 1):
                if all(w is start or w in head for w in x[i : i + n]):
                    grams[n][tuple(x[i : i + n])] += 1
    kept = [{g: c for g, c in grams[n].items() if c >= gram_least} for n in range(order + 1)]
    context = {(w,): c for w, c in words.items()} | {(start,): len(lists)} | {g: c for n in range(2, order + 1) for g, c in kept[n].items()}

    def prob(history, word):
        if not history:
            return (words[word] + 1) / (total + distinct + 1)
        if history not in context or (len(history) == 1 and history[0] is not start and history[0] not in head):
            return prob(history[1:], word)
        followers = {g: c for g, c in kept[len(history) + 1].items() if g[:-1] == history}
        left = max(1 - sum((c - discount) / context[history] for c in followers.values()), 1e-12)
        own = followers.get((*history, word), 0)
        return (own - discount) / context[history] + left * prob(history[1:], word) if own else left * prob(history[1:], word)

    def score(text):
        x, value = [start, *backoff_lm.words_of(text), b""], 0.0
        for i in range(1, len(x)):
            value += math.log10(prob(tuple(x[max(0, i - order + 1) : i]), x[i]))
        return value

    return score, words, total, distinct


@pytest.mark.parametrize(("order", "word_share", "gram_share"), [(2, 0.004, 0.004), (3, 0.002, 0.004), (3, 1e-9, 1e-9)])
def test_scores_equal_force(spark, order, word_share, gram_share):
    random = np.random.default_rng(order)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [" ".join(random.choice(vocabulary, random.integers(0, 25), p=np.arange(30, 0, -1) / 465)) for _ in range(40)]
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    probe = texts[:10] + ["", "w1 w2 W1 w2 unseen w3", "unseen", "w0 w0 w0", None]
    docs = spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string")
    automaton, counts = backoff_lm.learn(train, word_share, gram_share, order)
    score, words, total, distinct = model_by_force(texts, order, word_share * automaton.tokens, gram_share * automaton.tokens)
    assert (automaton.tokens, automaton.distinct) == (total, distinct)
    for r in backoff_lm.score(docs, automaton, counts).collect():
        text = probe[r["doc_id"]] or ""
        tokens = [*backoff_lm.words_of(text), b""]
        assert r["n_tokens"] == len(tokens) and r["n_known"] == sum(words[w] > 0 for w in tokens) and r["train_tokens"] == total
        assert r["base_score"] == pytest.approx(sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in tokens))
        assert r["score"] == pytest.approx(score(text))


def test_scores_of_odd_rows(odd, none):
    automaton, counts = backoff_lm.learn(odd)
    rows = backoff_lm.score(odd, automaton, counts, ["name"]).collect()
    assert len(rows) == odd.count() and all(r["n_known"] == r["n_tokens"] for r in rows)
    automaton, counts = backoff_lm.learn(none)
    rows = backoff_lm.score(odd, automaton, counts).collect()
    assert all(r["n_known"] == 0 and r["base_score"] == 0 and r["score"] == 0 for r in rows)


def test_every_gram_counts_whatever_the_size(spark):
    # over 250,000 tokens, beyond which the shares 1e-6 and 4e-6 used to drop n-grams that occur once
    random = np.random.default_rng(7)
    texts = [" ".join(f"w{n}" for n in random.integers(0, 3000, 1000)) for _ in range(300)]
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    probe = [*[" ".join(t.split()[:8]) for t in texts[:3]], texts[5][400:440] + " unseen " + texts[6][:40], "w1"]
    docs = spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string")
    score, *_ = model_by_force(texts, 3, 1, 1)
    got = {r["doc_id"]: r["score"] for r in backoff_lm.score(docs, *backoff_lm.learn(train)).collect()}
    assert [got[i] for i in range(5)] == pytest.approx([score(t) for t in probe])


# --- quality -----------------------------------------------------------------


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = cotraining.learn(docs, labels.where("doc_id % 3 <> 0"))
    rows = cotraining.scores(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = [r["keep"] == bool(r["quality"]) for r in rows]
    assert len(rows) > 300 and sum(right) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_views_teach_each_other():
    random = np.random.default_rng(0)
    truth = random.integers(0, 2, 1000)
    text = truth[:, None] * 2 + random.normal(size=(1000, 4))
    meta = truth[:, None] * 2 + random.normal(size=(1000, 3))
    labels = np.where(np.arange(1000) < 60, truth, -1)
    model = cotraining.cotrain(text, meta, labels, taught=50)
    joint = cotraining.score(model, text, meta)[2]
    assert ((joint >= 0.5) == truth).mean() > 0.95


def test_every_sure_row_is_taught_once():
    # far more unlabelled rows than a round used to teach; the first label stays and no round repeats it
    truth = np.random.default_rng(0).integers(0, 2, 3000)
    views = (truth[:, None] * 40.0 - 20, truth[:, None] * 40.0 - 20)
    plain = (np.zeros(1), np.ones(1))
    same = (*plain, np.array([1.0, 0.0]))
    now = [(same, same), (same, same)]
    turned = [((*plain, np.array([-1.0, 0.0])), same)] * 2
    for labels in cotraining.taught_rows([now, turned], views, 0.95):
        assert (labels == truth).all()


def test_all_unlabelled_rows_teach_at_any_number(spark):
    # the sums over 9,000 unlabelled rows in tasks are those over all of them in memory
    words = ["fine", "poor"]
    rows = [(i, f"{words[i % 2]} text {i % 7}", "en", f"s{i % 2}", 20) for i in range(9200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    model = cotraining.learn(docs, labels, rounds=1)
    text = np.array([cotraining.text_view(r[1]) for r in rows]).astype("f4").astype(float)
    meta = np.array([cotraining.meta_view(r[3], r[2], r[4]) for r in rows]).astype("f4").astype(float)
    want = cotraining.cotrain(text, meta, np.array([i % 2 if i < 200 else -1 for i in range(9200)]), rounds=1)
    for got, expected in zip(model["models"], want["models"], strict=True):
        assert got[2] == pytest.approx(expected[2], abs=1e-6)


def test_quality_by_words_alone(spark):
    # the same outlines and metadata: only the words tell the classes apart
    random = np.random.default_rng(3)
    names = [["amber", "cedar", "delta"], ["bingo", "loans", "spams"]]
    texts = [" ".join(random.choice(names[i % 2], 30)) for i in range(600)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    rows = cotraining.scores(docs, cotraining.learn(docs, labels)).where("doc_id >= 300").collect()
    assert sum(r["keep"] == bool(r["doc_id"] % 2) for r in rows) / len(rows) > 0.98


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 1, None), (5, None, 1), (7, 1, 0), (10, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = cotraining.scores(odd, cotraining.learn(odd, labels), ["source", "name"]).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert cotraining.learn(none, labels) == {} and cotraining.learn(odd, labels.where("quality = 1")) == {}
    assert all(r["keep"] for r in cotraining.scores(odd.drop("lang", "n_chars"), {}).collect())
    assert cotraining.scores(none, {}).collect() == []


def test_a_repeated_id_is_one_labelled_row(spark, monkeypatch):
    """However many rows a labelled id has, one reaches the driver; sums added in tasks first are the same."""
    docs = spark.createDataFrame([(i if i < 40 else 3, f"Text {i % 7} of some words. And {i}.", "en", f"s{i % 3}", 20) for i in range(3000)], "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    unpacked = cotraining._unpacked
    monkeypatch.setattr(cotraining, "_unpacked", lambda rows: seen.append(len(rows)) or unpacked(rows))
    featured = cotraining.features(docs)
    plain = cotraining.learn(docs, labels, rounds=1, featured=featured)
    assert max(seen) <= 40
    monkeypatch.setattr(cotraining, "SUMS", 2)
    added = cotraining.learn(docs, labels, rounds=1, featured=featured)
    assert np.allclose(plain["models"][0][2], added["models"][0][2]) and np.allclose(plain["combined"][2], added["combined"][2])
    got = {r["row"]: r["score"] for r in cotraining.scores_of(featured, plain).collect()}
    assert len(got) == 3000 and all(0 <= v <= 1 for v in got.values())

"""Secrets in text: fixed patterns, and formats learned as probabilistic automata.

The matches of the patterns are labelled credentials. From a bounded sample of them, and one of ordinary long words, a
prefix tree with counts is built for every kind; states whose futures do not differ by a Hoeffding bound are merged, which
leaves a probabilistic automaton of the format. Ordinary words come from all texts. Every candidate word of every text is then scored by all automata.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import bodies
from kindred.session import materialise

# fixed values: the patterns, their names in the order of listing, and the least lengths
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

PLAIN = "plain"
#: Words that may be credentials: the characters and the least length of all formats that are learned.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: Credentials of a kind, and ordinary words, that an automaton is learned from at most; longest one used; the test's level.
SAMPLE, LONGEST, ALPHA = 1000, 128, 0.05
#: Share of the learned credentials that may score below the least score of their kind.
MISSED = 0.02
SPANS = T.StructField("spans", T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long")))
_FLOOR = math.log(1e-4)
_TURNS = 1 << 30
_HEXRUN = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
_CLASSES = str.maketrans("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0" * 10 + "f" * 6 + "z" * 20 + "F" * 6 + "Z" * 20)
#: Scores of shapes that an automaton remembers at most.
_KNOWN = 100_000
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start and then by kind as listed."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    if b"x" * HEX_LENGTH in text.encode("utf-8", "surrogatepass").translate(_HEXRUN):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def candidates(text: str, taken: Sequence[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Words that may be credentials and touch none of the ``taken`` spans."""
    found, at = [], 0
    taken = sorted((start, end) for _, start, end in taken)
    reach = np.maximum.accumulate([end for _, end in taken]) if taken else []
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            at += 1
        if at == 0 or reach[at - 1] <= m.start():
            found.append(m.span())
    return found


def shape(word: str) -> str:
    """The word with its characters replaced by classes: digit, hex or other letter by case, symbols as they are."""
    return word.translate(_CLASSES)


class _Tree:
    """A prefix tree; ``passed`` counts the words along each arc, ``ended`` those that end in a state."""

    def __init__(self, words: Sequence[str]) -> None:
        self.ended, self.follow, self.passed = [0], [{}], [defaultdict(int)]
        for word in words:
            at = 0
            for c in word:
                nxt = self.follow[at].get(c)
                if nxt is None:
                    nxt = self.follow[at][c] = len(self.ended)
                    self.ended.append(0)
                    self.follow.append({})
                    self.passed.append(defaultdict(int))
                self.passed[at][c] += 1
                at = nxt
            self.ended[at] += 1

    def total(self, state: int) -> int:
        return self.ended[state] + sum(self.passed[state].values())

    def alike(self, a: int, b: int, alpha: float) -> bool:
        """No share of what follows ``a`` and ``b``, now or later, differs by more than the Hoeffding bound."""
        spread = math.sqrt(0.5 * math.log(2 / alpha))
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.total(a), self.total(b)
            if not n or not m:
                continue
            bound = spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if bound >= 1:
                continue  # too few to tell, here and below
            if abs(self.ended[a] / n - self.ended[b] / m) > bound:
                return False
            for c in self.follow[a].keys() | self.follow[b].keys():
                if abs(self.passed[a].get(c, 0) / n - self.passed[b].get(c, 0) / m) > bound:
                    return False
                if c in self.follow[a] and c in self.follow[b]:
                    todo.append((self.follow[a][c], self.follow[b][c]))
        return True

    def fold(self, into: int, gone: int) -> None:
        """Adds the counts of the subtree below ``gone`` along the same words from ``into``."""
        todo = [(into, gone)]
        while todo:
            a, b = todo.pop()
            self.ended[a] += self.ended[b]
            for c, y in self.follow[b].items():
                self.passed[a][c] += self.passed[b][c]
                if c in self.follow[a]:
                    todo.append((self.follow[a][c], y))
                else:
                    self.follow[a][c] = y


Arc = tuple[int, str, int, float]


def infer(words: Sequence[str], alpha: float = ALPHA) -> list[Arc]:
    """Arcs (state, symbol, next state, log-probability) of the automaton; the empty symbol ends a word. State 0 starts."""
    tree = _Tree(sorted(words))
    kept = [0]
    while True:
        inside = set(kept)
        # the states that the kept ones lead to, the most travelled first
        rim = [(-tree.passed[k][c], k, c) for k in kept for c, y in tree.follow[k].items() if y not in inside]
        if not rim:
            break
        _, parent, symbol = min(rim)
        node = tree.follow[parent][symbol]
        same = next((k for k in kept if tree.alike(k, node, alpha)), None)
        if same is None:
            kept.append(node)
        else:
            tree.follow[parent][symbol] = same
            tree.fold(same, node)
    number = {k: i for i, k in enumerate(kept)}
    arcs = []
    for k in kept:
        if n := tree.total(k):
            arcs += [(number[k], c, number[y], math.log(tree.passed[k][c] / n)) for c, y in sorted(tree.follow[k].items())]
            arcs += [(number[k], "", number[k], math.log(tree.ended[k] / n))] if tree.ended[k] else []
    return arcs


class Automaton:
    """Mean log-probability per symbol of a word's shape; an arc that was never seen costs a floor and stays in place."""

    def __init__(self, arcs: Sequence[Arc]) -> None:
        self._arcs = {(state, symbol): (nxt, score) for state, symbol, nxt, score in arcs}
        self._known: dict[str, float] = {}

    def score(self, word: str) -> float:
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= _KNOWN:
                self._known.clear()
            found = self._known[word] = self._score(word)
        return found

    def _score(self, word: str) -> float:
        state, total = 0, 0.0
        for c in [*word, ""]:
            state, score = self._arcs.get((state, c), (state, _FLOOR))
            total += score
        return total / (len(word) + 1)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, word): the labelled credentials of each text, and as ordinary words all its candidates outside them."""
    for batch in batches:
        found = set()
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            for kind, start, end in spans:
                word = ASSIGN.fullmatch(text, start, end).group(2) if kind == "assign" else text[start:end]
                found.add((kind, word))
            found.update((PLAIN, text[start:end]) for start, end in candidates(text, spans))
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([w for _, w in rows], pa.string())], names=["kind", "word"])


def _fit(sample: pd.DataFrame) -> pd.DataFrame:
    words = [shape(w) for w in sorted(sample["word"])]
    arcs = infer(words)
    automaton = Automaton(arcs)
    least = float(np.quantile([automaton.score(w) for w in words], MISSED))
    out = pd.DataFrame(arcs, columns=["state", "symbol", "next_state", "score"])
    return out.assign(kind=sample["kind"].iloc[0], least=least)


def learn(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Arcs of one automaton for each kind: ``kind``, ``state``, ``symbol``, ``next_state``, ``score``, ``least``.

    ``sample`` bounds the distinct words an automaton is learned from (those with the least hash; at most 128 characters long).
    A hash bound taken from the number of words of a kind thins them before they meet, so that a kind's task reads about twice
    the sample, however many words and tasks there are. Each kind is learned in a task of its own. Without credentials there are no arcs.
    """
    found = bodies(docs).select("text").mapInArrow(_gather, "kind string, word string").where(F.length("word") <= LONGEST).distinct()
    found = materialise(found)
    counts = found.groupBy("kind").count().collect()  # a row for each of the four kinds
    turn = F.pmod(F.xxhash64("word"), F.lit(_TURNS))
    bound = F.coalesce(*[F.when(F.col("kind") == r["kind"], F.lit(min(_TURNS, 2 * sample * _TURNS // r["count"]))) for r in counts], F.lit(_TURNS))
    order = Window.partitionBy("kind").orderBy(turn, "word")
    chosen = found.where(turn < bound).withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample).drop("place")
    out = "state long, symbol string, next_state long, score double, kind string, least double"
    return chosen.groupBy("kind").applyInPandas(_fit, out)


Model = dict[str, tuple[Automaton, float]]


def load(arcs: DataFrame) -> Model:
    """The automata and least scores; their size is bounded by the sample."""
    by_kind = defaultdict(list)
    least = {}
    for row in arcs.collect():
        by_kind[row["kind"]].append((row["state"], row["symbol"], row["next_state"], row["score"]))
        least[row["kind"]] = row["least"]
    return {kind: (Automaton(found), least[kind]) for kind, found in by_kind.items()}


def learned_spans(text: str, taken: Sequence[tuple[str, int, int]], model: Model) -> list[tuple[str, int, int]]:
    """Candidates whose format is as likely as a kind's credentials and likelier than an ordinary word's; ``like_`` the best kind."""
    found = []
    for start, end in candidates(text, taken):
        word = shape(text[start:end])
        plain = model[PLAIN][0].score(word) if PLAIN in model else _FLOOR
        scores = {kind: automaton.score(word) for kind, (automaton, least) in sorted(model.items()) if kind != PLAIN}
        good = {kind: score for kind, score in scores.items() if score >= model[kind][1] and score > plain}
        if good:
            found.append((f"like_{max(good, key=good.get)}", start, end))
    return found


def scan(docs: DataFrame, model: Model, carry: Sequence[str] = ()) -> DataFrame:
    """``row``, ``doc_id``, ``text``, ``carry`` and ``spans``: array of (kind, start, end) in code points, by start, of every row.

    A null text is empty and has no spans. Learned spans touch no span of the patterns.
    """
    docs = bodies(docs, carry)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                spans = sorted([*base, *learned_spans(text, base, model)], key=_order)
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "spans"])

    return docs.mapInArrow(each, T.StructType([*docs.schema.fields, SPANS]))


def _order(span: tuple[str, int, int]) -> tuple[int, int, str]:
    return span[1], KINDS.index(span[0]) if span[0] in KINDS else len(KINDS), span[0]


def redact(text: str, spans: Sequence[tuple[str, int, int]], mask: str = "[secret]") -> str:
    """The text with every stretch that spans cover replaced by ``mask``; spans that touch or overlap are one stretch."""
    parts, at, covered = [], 0, -1
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start > covered:
            parts += [text[at:start], mask]
        covered = max(covered, end)
        at = covered
    return "".join([*parts, text[at:]])


def masked(docs: DataFrame, model: Model, mask: str = "[secret]") -> DataFrame:
    """``docs`` with all spans of every text replaced by ``mask``.

    Row and column order stay; a null text stays null. A column ``n_chars`` holds the new length where the text has changed.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = []
            for text in texts:
                base = base_spans(text) if text else []
                spans = [*base, *learned_spans(text, base, model)] if text else []
                new.append(redact(text, spans, mask) if spans else text)
            columns = list(batch.columns)
            columns[at] = pa.array(new, pa.string())
            if size is not None:
                old = columns[size].to_pylist()
                columns[size] = pa.array([n if t == u else len(u) for n, t, u in zip(old, texts, new, strict=True)], columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    names = [c.lower() for c in docs.columns]
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    return docs.mapInArrow(each, docs.schema)

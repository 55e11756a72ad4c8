"""Language of texts, in two steps: the family, then linear one-versus-one machines within it.

A support vector machine for each pair of families votes on the family, one for each pair of languages of a family on the
language. The features are letter n-grams of the whole text. Every machine is learned in a Spark task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import bodies, held_out

# fixed values: families of closely related languages; any other language is a family of its own
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indo-aryan": ("hi", "bn", "mr", "ur", "pa", "gu"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}

#: Hashed features, and documents of a language that are learned from in expectation.
SLOTS, SAMPLE = 2048, 300
UNKNOWN = "und"
#: Training texts of a language are joined and cut to pieces, so that short texts are learned as well: words in a piece.
_LENGTHS = (6, 40)


def family(lang: str) -> str:
    return _FAMILY.get(lang, lang)


class Letters:
    """Code points of a text with all but letters as blanks."""

    def __init__(self) -> None:
        self._letter = np.array([chr(c).isalpha() for c in range(0x110000)])

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        return np.where(self._letter[codes], codes, 32).astype(np.uint32)


def features(codes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Root of the share of every hashed letter n-gram up to three letters, word borders included, with length one."""
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]  # one blank between words
    h = codes * np.uint32(2654435761)
    counts = np.zeros(slots)
    gram = h
    for n in range(3):
        if n:
            gram = (gram[:-1] * np.uint32(31) + np.uint32(n)) ^ h[n:]
            gram = gram * np.uint32(2246822519)
        counts += np.bincount(gram >> np.uint32(32 - slots.bit_length() + 1), minlength=slots)
    counts = np.sqrt(counts)
    return counts / max(np.linalg.norm(counts), 1e-12)


def svm(rows: np.ndarray, signs: np.ndarray, cost: float = 10.0, passes: int = 30) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine with squared loss, by dual coordinate descent."""
    x = np.column_stack([rows, np.ones(len(rows))])
    # classes count alike, however many rows they have
    c = cost * len(rows) / (2 * np.where(signs > 0, (signs > 0).sum(), (signs < 0).sum()))
    diagonal = (x**2).sum(axis=1) + 1 / (2 * c)
    alpha, weights = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.arange(len(x))
    random = np.random.default_rng(0)
    for _ in range(passes):
        random.shuffle(order)
        worst = 0.0
        for i in order.tolist():
            slope = signs[i] * (x[i] @ weights) - 1 + alpha[i] / (2 * c[i])
            if alpha[i] == 0 and slope >= 0:
                continue
            worst = max(worst, abs(slope))
            new = max(alpha[i] - slope / diagonal[i], 0.0)
            weights += (new - alpha[i]) * signs[i] * x[i]
            alpha[i] = new
        if worst < 1e-3:
            break
    return weights


Machines = dict[tuple[str, str, str], np.ndarray]


def learn(docs: DataFrame, sample: int = SAMPLE, slots: int = SLOTS) -> Machines:
    """Machines by (level, one, other): level is ``family`` or a family's name. They map to weights, or to nothing if there is no rival.

    Rows with ``lang`` and ``text`` are learned from. ``sample`` bounds the rows of a language, in expectation: rows are drawn by
    a hash of the id with the share that gives this number. Each machine gets its share of those rows in a task of its own;
    the driver gets the weights only, ``slots`` numbers for each pair of languages.
    """
    rows = bodies(docs.where("lang IS NOT NULL AND text IS NOT NULL"), ["lang"]).withColumn("lang", F.col("lang").cast("string"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    langs = sorted(counts)
    pairs = [("family", a, b) for a, b in combinations(sorted({family(x) for x in langs}), 2)]
    pairs += [(family(a), a, b) for a, b in combinations(langs, 2) if family(a) == family(b)]
    machines: Machines = {(family(x), x, x): np.zeros(0) for x in langs}
    if not pairs:
        return machines
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample / counts[lang]))])
    turn = F.pmod(F.xxhash64(F.coalesce("doc_id", "row")), F.lit(1 << 30)) / (1 << 30)
    drawn = rows.where(turn < share[F.col("lang")]).select(F.coalesce("doc_id", "row").alias("doc_id"), "lang", "text")
    wanted = {lang: [k for k, (level, a, b) in enumerate(pairs) if (level == "family" and family(lang) in (a, b)) or lang in (a, b)] for lang in langs}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each machine that needs the text, for the whole text and for short pieces from all over it."""
        letters = Letters()
        for batch in batches:
            machine, lang, order, vectors = [], [], [], []
            for doc_id, name, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                codes = letters(text)
                blanks = np.flatnonzero(codes == 32)
                views = [codes]
                for k, words in enumerate(_LENGTHS):
                    if len(blanks) > words:
                        at = (doc_id * 7919 + k * 104729) % (len(blanks) - words)
                        views.append(codes[blanks[at] : blanks[at + words]])
                for view in views:
                    if (view != 32).any():
                        vector = features(view, slots).astype(np.float32).tobytes()
                        for k in wanted[name]:
                            machine.append(k)
                            lang.append(name)
                            order.append(doc_id)
                            vectors.append(vector)
            yield pa.RecordBatch.from_arrays(
                [pa.array(machine, pa.int32()), pa.array(lang, pa.string()), pa.array(order, pa.int64()), pa.array(vectors, pa.binary())], names=["machine", "lang", "doc_id", "vector"]
            )

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        k = int(part["machine"].iloc[0])
        level, one, _ = pairs[k]
        part = part.sort_values(["doc_id", "vector"], kind="stable")
        x = np.frombuffer(b"".join(part["vector"]), np.float32).reshape(len(part), -1).astype(np.float64)
        names = part["lang"].map(family) if level == "family" else part["lang"]
        signs = np.where(names == one, 1.0, -1.0)
        weights = svm(x, signs) if len(set(signs.tolist())) == 2 else np.append(np.zeros(x.shape[1]), signs[0])
        return pd.DataFrame({"machine": [k], "weights": [weights.tobytes()]})

    fitted = drawn.mapInArrow(spread, "machine int, lang string, doc_id long, vector binary").groupBy("machine").applyInPandas(fit, "machine int, weights binary")
    for row in fitted.collect():
        machines[pairs[row["machine"]]] = np.frombuffer(row["weights"])
    return machines


class Predictor:
    """The votes of all machines as one matrix."""

    def __init__(self, machines: Machines) -> None:
        self._families = sorted({level for level, _, _ in machines if level != "family"})
        self._langs = {f: sorted({x for level, a, b in machines if level == f for x in (a, b)}) for f in self._families}
        self._pairs = [key for key in sorted(machines) if len(machines[key])]
        self._weights = np.array([machines[key] for key in self._pairs]).T
        self.letters = Letters()

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The language and how sure it is: the least probability among the machines that the winners had to beat."""
        codes = self.letters(text or "")
        if not self._families or not (codes != 32).any():
            return UNKNOWN, 0.0
        margins = {}
        if self._pairs:
            values = features(codes, len(self._weights) - 1) @ self._weights[:-1] + self._weights[-1]
            margins = dict(zip(self._pairs, values.tolist(), strict=True))
        group, sure = self._vote("family", self._families, margins)
        lang, also = self._vote(group, self._langs[group], margins)
        return lang, min(sure, also)

    @staticmethod
    def _vote(level: str, names: Sequence[str], margins: dict[tuple[str, str, str], float]) -> tuple[str, float]:
        wins, least, total = dict.fromkeys(names, 0), dict.fromkeys(names, 1.0), dict.fromkeys(names, 0.0)
        for a, b in combinations(names, 2):
            m = margins.get((level, a, b), 0.0)
            wins[a if m >= 0 else b] += 1
            p = 1 / (1 + np.exp(-4 * np.clip(m, -8, 8)))
            least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
            total[a] += m
            total[b] -= m
        best = max(names, key=lambda x: (wins[x], total[x]))
        return best, float(least[best])


def predict(docs: DataFrame, machines: Machines, carry: Sequence[str] = ()) -> DataFrame:
    """``row``, ``doc_id``, ``carry``, ``lang_pred`` and ``score`` (0 to 1) of every row, from ``text`` alone.

    Null texts, texts without a letter, and all texts if nothing was learned get ``und`` and 0.
    """
    docs = bodies(docs, carry)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Predictor(machines)
        for batch in batches:
            found = [judge(text) for text in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in ("row", "doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], names=out.names)

    out = T.StructType([f for f in docs.schema.fields if f.name != "text"]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(each, out)


def cross_fold(docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Predictions for all rows by machines that learn from the rows outside one fold of the ids; ``held_out`` marks the fold."""
    out = held_out("doc_id", folds, fold)
    machines = learn(docs.where(~out))
    return predict(docs, machines).select("doc_id", out.alias("held_out"), "lang_pred", "score")

"""Quality of documents by co-training: a text classifier and a metadata classifier teach each other.

Both are logistic regressions on their own view of a document. Over several rounds each labels all unlabelled documents it is
sure of and has not labelled before, and the other learns from them as well, by gradients summed in every partition. Their
scores are calibrated and weighed on labelled documents that no round learns from, and calibrated scores say what is sure.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import bodies
from kindred.session import materialise

#: Labelled rows learned from at most, rounds, how sure a view must be of a row that it labels, and the number of labelled rows
#: that all rows a view is taught of one class weigh at most. The unlabelled rows are all of them.
LABELLED, ROUNDS, TAUGHT, SURE = 4000, 4, 200, 0.95
#: Steps of a round's fit, of about one pass over the unlabelled rows each; unlabelled rows that only shape the steps.
STEPS, SHAPING = 5, 2000
#: Rows of sums that reach the driver at most; those of more partitions are added in tasks first.
SUMS = 256
#: Documents below are rejected.
KEEP = 0.5
_CHARS, _SHAPES, _WORDS, _META = 64, 192, 1024, 64
_TEXT = _CHARS + _SHAPES + 8 + _WORDS
_ENTRY = np.dtype([("slot", "<u2"), ("value", "<f4")])


def _slots(items: Sequence[str], size: int) -> np.ndarray:
    return np.bincount([zlib.crc32(x.encode("utf-8", "surrogatepass")) % size for x in items], minlength=size)


def text_view(text: str) -> np.ndarray:
    """Features of the content: shares of characters by code, of word forms, of general shapes, and of hashed words; all of the text counts.

    A word's form keeps its symbols and case, with runs of letters and of digits as one sign each.
    """
    out = np.zeros(_TEXT)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return out
    symbols = np.bincount(data, minlength=256)
    # ASCII signs and digits have slots of their own; letters and other bytes share the last ones
    out[:_CHARS] = symbols[:_CHARS] / len(data)
    words = text.split()
    if words:
        forms = np.bincount(_form_slots(words), minlength=_SHAPES)
        out[_CHARS : _CHARS + _SHAPES] = np.sqrt(forms / len(words))
        out[-_WORDS:] = np.sqrt(_slots(text.lower().split(), _WORDS) / len(words))
    upper, lower = symbols[65:91].sum(), symbols[97:123].sum()
    distinct = len(set(words))
    out[_CHARS + _SHAPES : -_WORDS] = [
        upper / (upper + lower + 1), lower / len(data), symbols[123:128].sum() / len(data), symbols[91:97].sum() / len(data),
        distinct / max(len(words), 1), math.log1p(len(words)) / 10, symbols[10] / max(len(words), 1), len(data) / max(len(words), 1) / 10,
    ]
    return out


_FORM = bytes(
    97 if 97 <= c < 123 or c >= 128 else 65 if 65 <= c < 91 else 48 if 48 <= c < 58 else c for c in range(256)
)


def _form_slots(words: Sequence[str]) -> list[int]:
    """A slot for each word's outline: its first form sign, whether it mixes forms, and its last two signs."""
    found = []
    for word in words:
        form = word.encode("utf-8", "surrogatepass").translate(_FORM)
        found.append((form[0] * 31 + form[-1] * 7 + (form[-2] if len(form) > 1 else 0) * 3) % _SHAPES)
    return found


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Features of what is known about a page: hashed source and language, and its stated size."""
    out = _slots([f"source={source}", f"lang={lang}"], _META).astype(float)
    size = math.log1p(max(n_chars or 0, 0))
    return np.concatenate([out, [size / 10, (size / 10) ** 2, n_chars is None]])


Fitted = tuple[np.ndarray, np.ndarray, np.ndarray]


def logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> Fitted:
    """Logistic regression with an L2 penalty on standardised features, by Newton steps: mean, spread and weights."""
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.column_stack([np.clip((rows - mean) / spread, -8, 8), np.ones(len(rows))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ weights)
        slope = x.T @ (labels - p) - ridge * weights
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return mean, spread, weights


def margin(fitted: Fitted, rows: np.ndarray) -> np.ndarray:
    mean, spread, weights = fitted
    return np.clip((rows - mean) / spread, -8, 8) @ weights[:-1] + weights[-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _standard(fitted: Fitted, rows: np.ndarray) -> np.ndarray:
    mean, spread, _ = fitted
    return np.column_stack([np.clip((rows - mean) / spread, -8, 8), np.ones(len(rows))])


Models = list[Fitted]  # of the text view and of the metadata view
Judges = list[tuple[Fitted, Fitted]]  # the same, each with its calibration on labelled rows that it has not learned from


def taught_rows(judges: Sequence[Judges], views: Sequence[np.ndarray], sure: float) -> list[np.ndarray]:
    """For each view, the label that the other one gave each row in the first of the rounds in which it was sure; -1 for none."""
    least = math.log(sure / (1 - sure))
    found = [np.full(len(views[0]), -1), np.full(len(views[0]), -1)]
    for pair in judges:
        for k, (fitted, calibrated) in enumerate(pair):
            m = margin(calibrated, margin(fitted, views[k])[:, None])
            new = (found[1 - k] < 0) & (np.abs(m) >= least)
            found[1 - k][new] = m[new] > 0
    return found


def _sums(judges: Sequence[Judges], now: Models, views: Sequence[np.ndarray], sure: float) -> np.ndarray:
    """What the unlabelled rows add, in a row: for each view and class the number of taught rows, their log-likelihood and its slope."""
    out = []
    for fitted, rows, labels in zip(now, views, taught_rows(judges, views, sure), strict=True):
        for label in (0, 1):
            x = _standard(fitted, rows[labels == label])
            m = x @ fitted[2]
            out += [[float(len(x)), -np.logaddexp(0, m if label == 0 else -m).sum()], x.T @ (label - _sigmoid(m))]
    return np.concatenate(out)


def _descend(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, apart: Callable[[np.ndarray], np.ndarray], steps: int) -> np.ndarray:
    """Lowers ``value`` (and slope) from ``start`` by steps that halve until it falls; ``apart`` gives the first one's shape, later ones learn from the slopes."""
    at, (best, slope) = start, value(start)
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, weighs = slope.copy(), []
        for s, y in reversed(seen):
            weighs.append((s @ q) / (s @ y))
            q -= weighs[-1] * y
        q = apart(q)
        for (s, y), w in zip(seen, reversed(weighs), strict=True):
            q += s * (w - (y @ q) / (s @ y))
        step = -q * min(1.0, 4 / (np.abs(q).max() + 1e-12))
        for _ in range(6):
            found, new = value(at + step)
            if found <= best + 1e-4 * (slope @ step):
                break
            step = step / 4
        else:
            return at
        if step @ (new - slope) > 1e-10:
            seen.append((step, new - slope))
        at, best, slope = at + step, found, new
        if np.abs(step).max() < 1e-4:
            break
    return at


def _rounds(text: np.ndarray, meta: np.ndarray, labels: np.ndarray, shaping: Sequence[np.ndarray], pool: Callable[[list[Judges], Models], np.ndarray], rounds: int, taught: float) -> dict:
    """Co-trains on labelled rows; ``pool`` gives the sums over all unlabelled rows for the models of past rounds and those of now.

    ``shaping`` are a few unlabelled rows whose curvature stands for that of all, which changes the way to the solution only.
    """
    known = np.arange(len(labels))
    if len(set(labels.tolist())) < 2:
        return {}
    spare = known[::5] if len(set(labels[::5].tolist())) == 2 and len(set(np.delete(labels, np.s_[::5]).tolist())) == 2 else known
    learned = known if spare is known else np.setdiff1d(known, spare)
    views, y = (text, meta), labels[learned]
    now = [logistic(v[learned], y) for v in views]
    rows = [_standard(fitted, view[learned]) for fitted, view in zip(now, views, strict=True)]
    other = [_standard(fitted, view) for fitted, view in zip(now, shaping, strict=True)]
    ridge = [np.append(np.ones(x.shape[1] - 1), 1e-3) for x in rows]
    cut = rows[0].shape[1]
    past: list[Judges] = []
    for _ in range(rounds):
        past.append([(m, logistic(margin(m, v[spare])[:, None], labels[spare])) for m, v in zip(now, views, strict=True)])

        def at(weights: np.ndarray) -> Models:
            return [(*fitted[:2], part) for fitted, part in zip(now, np.split(weights, [cut]), strict=True)]  # noqa: B023

        def value(weights: np.ndarray) -> tuple[float, np.ndarray]:
            trial = at(weights)  # noqa: B023
            sums, place, total, slopes = pool(past, trial), 0, 0.0, []
            for (_, _, w), x, r in zip(trial, rows, ridge, strict=True):
                m = x @ w
                slope = x.T @ (y - _sigmoid(m)) - r * w
                total += np.logaddexp(0, np.where(y == 1, -m, m)).sum() + 0.5 * (r * w) @ w
                for _ in (0, 1):
                    share = min(1.0, taught / max(sums[place], 1))
                    total -= share * sums[place + 1]
                    slope = slope + share * sums[place + 2 : place + 2 + len(w)]
                    place += 2 + len(w)
                slopes.append(-slope)
            return total, np.concatenate(slopes)

        factors = []
        for (_, _, w), x, z, r in zip(now, rows, other, ridge, strict=True):
            bent = lambda x: np.maximum((p := _sigmoid(x @ w)) * (1 - p), 0.05)  # noqa: E731, B023
            curve = (x * bent(x)[:, None]).T @ x + np.diag(r)
            if len(z):
                curve += min(1.0, 2 * taught / len(z)) * (z * bent(z)[:, None]).T @ z
            factors.append(np.linalg.inv(curve))
        now = at(_descend(value, np.concatenate([w for _, _, w in now]), lambda q: np.concatenate([f @ part for f, part in zip(factors, np.split(q, [cut]), strict=True)]), STEPS))  # noqa: B023
    margins = [margin(m, v[spare]) for m, v in zip(now, views, strict=True)]
    calibrated = [logistic(m[:, None], labels[spare]) for m in margins]
    joint = np.column_stack([margin(c, m[:, None]) for c, m in zip(calibrated, margins, strict=True)])
    return {"models": now, "calibrated": calibrated, "combined": logistic(joint, labels[spare])}


def cotrain(text: np.ndarray, meta: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, taught: float = TAUGHT, sure: float = SURE) -> dict:
    """The fitted views and the weights that combine them. ``labels`` are 0, 1 or -1 for unlabelled.

    Every fifth labelled row is kept for calibration. With one class only, or none, there is nothing to learn and the
    result is empty.
    """
    known, other = labels >= 0, (text[labels < 0], meta[labels < 0])
    return _rounds(text[known], meta[known], labels[known], [v[:SHAPING] for v in other], lambda past, now: _sums(past, now, other, sure), rounds, taught)


def score(model: dict, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Calibrated probability of good quality by text, by metadata, and combined; 1 throughout where nothing was learned."""
    if not model:
        return (np.ones(len(text)),) * 3
    margins = [margin(c, margin(m, v)[:, None]) for c, m, v in zip(model["calibrated"], model["models"], (text, meta), strict=True)]
    return _sigmoid(margins[0]), _sigmoid(margins[1]), _sigmoid(margin(model["combined"], np.column_stack(margins)))


def _metadata(docs: DataFrame) -> DataFrame:
    """Adds the metadata columns a table lacks as null."""
    have = {c.lower() for c in docs.columns}
    for name, kind in (("source", "string"), ("lang", "string"), ("n_chars", "long")):
        if name not in have:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.withColumns({"source": F.col("source").cast("string"), "lang": F.col("lang").cast("string"), "n_chars": F.col("n_chars").cast("long")})


_VIEWS = ("source", "lang", "n_chars")


def _matrices(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text, source, lang, size = (batch.column(c).to_pylist() for c in ("text", *_VIEWS))
    return np.array([text_view(x) for x in text]), np.array([meta_view(*x) for x in zip(source, lang, size, strict=True)])


def _packed(both: np.ndarray) -> pa.Array:
    """The entries of each row that are not zero, as slots and values."""
    row, slot = np.nonzero(both)
    data = np.empty(len(row), _ENTRY)
    data["slot"], data["value"] = slot, both[row, slot]
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(both)))]) * _ENTRY.itemsize
    return pa.Array.from_buffers(pa.binary(), len(both), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _unpacked(rows: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(rows), _ENTRY)
    out = np.zeros((len(rows), _TEXT + _META + 3))
    out[np.repeat(np.arange(len(rows)), [len(r) // _ENTRY.itemsize for r in rows]), data["slot"]] = data["value"]
    return out[:, :_TEXT], out[:, _TEXT:]


def features(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``row``, ``doc_id``, ``carry`` and the packed features ``view`` of every row, written, so that learning and scoring share them."""
    docs = bodies(_metadata(docs), [*[c for c in _VIEWS if c not in carry], *carry])
    names = ["row", "doc_id", *carry]

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], _packed(np.column_stack(_matrices(part)))], names=out.names)

    out = T.StructType([f for f in docs.schema.fields if f.name in names]).add("view", "binary")
    return materialise(docs.mapInArrow(views, out))


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, taught: float = TAUGHT, sure: float = SURE, featured: DataFrame | None = None) -> dict:
    """Co-trains on at most about ``labelled`` rows with a label and on all other rows.

    Labelled ids are chosen by a hash, so that their expected number is the bound at any size, and one row of each is
    taken (that of the smallest features, if an id is repeated); ids not chosen count as unlabelled. ``labels`` has
    ``doc_id`` and ``quality`` (0 or 1; null is no label; the lowest of several counts). The features of all rows are
    written once, or given as ``featured``; each step sums over them in tasks, and at most ``SUMS`` rows of sums, the
    chosen labelled rows and the weights reach the driver.
    """
    spark = docs.sparkSession
    marks = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("mark"))
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    drawn = [(r["doc_id"], r["mark"]) for r in marks.where(turn < labelled / max(marks.count(), 1)).collect()]
    if len({mark for _, mark in drawn}) < 2:
        return {}
    chosen = F.broadcast(spark.createDataFrame(drawn, "doc_id long, mark int"))  # about ``labelled`` rows
    rows = (features(docs) if featured is None else featured).select("doc_id", "view")
    sample = rows.join(chosen, "doc_id").groupBy("doc_id", "mark").agg(F.min("view").alias("view")).orderBy("doc_id").toArrow()
    text, meta = _unpacked(sample.column("view").to_pylist())
    others = rows.join(chosen, "doc_id", "left_anti").select("view", F.spark_partition_id().alias("part"))
    few = F.pmod(F.xxhash64("view"), F.lit(1 << 30)) / (1 << 30) < SHAPING / max(rows.count(), 1)
    shaping = _unpacked(others.where(few).orderBy("view").limit(2 * SHAPING).toArrow().column("view").to_pylist())
    many = others.rdd.getNumPartitions() > SUMS

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(r) for r in table.column("sums").to_pylist())
        return pa.table({"part": pa.array([0], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    def pool(past: list[Judges], now: Models) -> np.ndarray:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, part = 0, 0
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    total = total + _sums(past, now, _unpacked(batch.column(0).slice(at, 1024).to_pylist()), sure)
                    part = batch.column(1)[0].as_py()
            if not isinstance(total, int):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

        size = sum(2 * (2 + len(fitted[2])) for fitted in now)
        sums = others.mapInArrow(each, "part int, sums binary")
        if many:  # added in tasks first
            sums = sums.groupBy(F.col("part") % SUMS).applyInArrow(added, "part int, sums binary")
        return sum((np.frombuffer(r) for r in sums.toArrow().column("sums").to_pylist()), np.zeros(size))

    return _rounds(text, meta, np.array(sample.column("mark").to_pylist(), np.int64), shaping, pool, rounds, taught)


def scores_of(featured: DataFrame, model: dict) -> DataFrame:
    """``scores`` of the rows whose ``features`` are given."""
    names = [c for c in featured.columns if c != "view"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = score(model, *_unpacked(part.column("view").to_pylist()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *map(pa.array, found), pa.array(found[2] >= KEEP)], names=out.names)

    out = T.StructType([f for f in featured.schema.fields if f.name in names])
    out = out.add("text_score", "double").add("meta_score", "double").add("score", "double").add("keep", "boolean")
    return featured.mapInArrow(each, out)


def scores(docs: DataFrame, model: dict, carry: Sequence[str] = ()) -> DataFrame:
    """``row``, ``doc_id``, ``carry``, ``text_score``, ``meta_score``, ``score`` (0 to 1) and ``keep`` of every row.

    Null texts count as empty, null metadata as a value of its own. Without a model everything is kept.
    """
    extra = [c for c in _VIEWS if c not in carry]
    docs = bodies(_metadata(docs), [*extra, *carry])
    names = ["row", "doc_id", *carry]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = score(model, *_matrices(part))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *map(pa.array, found), pa.array(found[2] >= KEEP)], names=out.names)

    out = T.StructType([f for f in docs.schema.fields if f.name in names])
    out = out.add("text_score", "double").add("meta_score", "double").add("score", "double").add("keep", "boolean")
    return docs.mapInArrow(each, out)

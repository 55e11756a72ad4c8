"""How far the sources of a language differ in their words, by products of one-hot count levels.

A term's share in a source depends on nothing but the source and the term's count there, its level. A block of terms is
a matrix with one indicator column for every (source, level). Its transpose times itself holds, for every two sources,
how many terms have which two levels: the joint table, exact, since it counts. Each cell is priced once.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import materialise

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
#: Documents of a language that hold a term, at least; ranks of terms; the unit of shares.
DOCUMENTS, RANKS, UNIT = 10, 10, 1_000_000_000
#: Terms of a block, sources of a tile, and columns multiplied at a time.
BLOCK, TILE, _COLUMNS = 1024, 128, 512
#: (language, source, term) that a task counts before it hands the counts on.
_FLUSH = 400_000


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n``, ``documents``; every group also has a row with an empty term and zeros."""
    texts = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def rows(counts: dict[tuple[str, str], Counter], held: dict[tuple[str, str], Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in counts.items():
            found = held[lang, source]
            columns = [pa.array([name] * (len(terms) + 1), pa.string()) for name in (lang, source)]
            columns += [pa.array(["", *terms], pa.string()), pa.array([0, *terms.values()], pa.int64()), pa.array([0, *[found[t] for t in terms]], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "documents"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "text")], strict=True):
                # bytes are lower-cased in A-Z only
                terms = TERM.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                counts[lang, source].update(terms)
                held[lang, source].update(set(terms))
            if sum(map(len, counts.values())) > _FLUSH:
                yield from rows(counts, held)
                counts.clear()
                held.clear()
        yield from rows(counts, held)

    found = texts.mapInArrow(each, "lang string, source string, term string, n long, documents long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(count: str | int, total: str, terms: str) -> Column:
    """One plus the smoothed share in units of ``UNIT``, rounded down, exactly."""
    return F.expr(f"1 + (CAST({count} + 2 AS DECIMAL(27, 0)) * {UNIT}) div (CAST({total} AS DECIMAL(27, 0)) + 2 * {terms})")


def joint_prices(g: np.ndarray, term: np.ndarray, n: np.ndarray, p: np.ndarray, groups: np.ndarray, empty: np.ndarray, tile: np.ndarray, terms: int) -> list[tuple[int, int, int]]:
    """(group, other group, sum of prices over the terms of a block) for all pairs of the groups of two tiles.

    ``g``, ``term``, ``n``, ``p``: the counts over zero. ``groups``, ``empty``, ``tile``: all groups, each with the
    share of a count of zero and its tile. ``terms``: the terms of the block, in these groups or not.
    """
    met, at = np.unique(term, return_inverse=True)
    order = np.argsort(groups)
    groups, empty, tile = groups[order], empty[order], tile[order]
    # a column of every group for level zero, and one for each level that occurs
    levels, column = np.unique(np.stack([np.concatenate([groups, g]), np.concatenate([np.zeros_like(groups), n])]), axis=1, return_inverse=True)
    column = column.ravel()
    prices = np.empty(levels.shape[1], np.int64)
    prices[column] = np.concatenate([empty, p])
    zero, column = column[: len(groups)], column[len(groups) :]
    owner = np.searchsorted(groups, levels[0])
    sums = np.zeros((len(groups), len(groups)), np.int64)
    present = np.zeros((len(met), len(groups)), bool)
    present[at, np.searchsorted(groups, g)] = True

    def indicators(lo: int, hi: int) -> np.ndarray:
        x = np.zeros((len(met), hi - lo), np.float32)
        inside = (column >= lo) & (column < hi)
        x[at[inside], column[inside] - lo] = 1
        for i in np.flatnonzero((zero >= lo) & (zero < hi)).tolist():
            x[:, zero[i] - lo] = ~present[:, i]
        return x

    cuts = list(range(0, levels.shape[1], _COLUMNS))
    for a in cuts:
        left = indicators(a, min(a + _COLUMNS, levels.shape[1]))
        for b in cuts[cuts.index(a) :]:
            hi = min(b + _COLUMNS, levels.shape[1])
            mine, others = owner[a : a + left.shape[1]], owner[b:hi]
            if len(set(tile.tolist())) > 1 and tile[mine].min() == tile[mine].max() == tile[others].min() == tile[others].max():
                continue  # pairs within one tile belong to the task of that tile
            joint = left.T @ (left if a == b else indicators(b, hi))  # counts up to the terms of a block, exact
            p1, p2 = prices[a : a + left.shape[1], None], prices[None, b:hi]
            value = joint.astype(np.int64) * ((p1 - p2) ** 2 // (p1 + p2))
            first, second = np.unique(mine, return_index=True), np.unique(others, return_index=True)
            part = np.add.reduceat(np.add.reduceat(value, first[1], axis=0), second[1], axis=1)
            sums[np.ix_(first[0], second[0])] += part
    rest = terms - len(met)
    i, j = np.triu_indices(len(groups), 1)
    if len(set(tile.tolist())) > 1:
        wanted = tile[i] != tile[j]
        i, j = i[wanted], j[wanted]
    # terms of the block that none of these groups holds
    extra = rest * ((empty[i] - empty[j]) ** 2 // (empty[i] + empty[j]))
    return list(zip(groups[i].tolist(), groups[j].tolist(), (sums[i, j] + extra).tolist(), strict=True))


def _priced(rows: pa.Table) -> pa.Table:
    """All pairs of a (language, block, two tiles); rows without a term are the groups."""
    is_group = rows.column("term").is_null().to_numpy()
    column = lambda name, which: rows.column(name).to_numpy()[which]
    own = ~is_group
    groups = column("g", is_group)
    terms = int(column("n", is_group).max()) if len(groups) else 0
    found = joint_prices(column("g", own), rows.column("term").filter(pa.array(own)).to_numpy(), column("n", own), column("p", own), groups, column("p", is_group), column("tile", is_group), terms)
    values = np.array(found, np.int64).reshape(-1, 3)
    lang = pa.array([rows.column("lang")[0].as_py()] * len(values), pa.string())
    return pa.Table.from_arrays([lang, *[pa.array(values[:, i]) for i in range(3)]], names=["lang", "g", "h", "value"])


def audit(docs: DataFrame, documents: int = DOCUMENTS, ranks: int = RANKS, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every (``lang``, ``source``) of ``docs``.

    Part ``pair`` holds the divergence from every other source of the language, part ``term`` the ``ranks`` terms of
    the source that it uses more than its language and that differ most. Terms count if at least ``documents``
    documents of the language hold them. Null texts, languages and sources are empty strings, so they form groups
    like any other; a group without terms has counts of zero; repeated rows count each; a language with one source has
    no pairs; an empty table gives an empty result. All values are whole numbers, and all steps exact.

    Terms of a block have about the same frequency, which keeps the levels of a block few. A task holds a block of
    terms for the groups of two tiles, whatever the number of groups or terms of the language.
    """
    counts = materialise(term_counts(docs))
    kept = counts.where("term != ''").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("documents").alias("held")).where(F.col("held") >= documents)
    size = F.floor(F.log2("n_lang")).cast("int")
    kept = materialise(kept.select("lang", "term", "n_lang", size.alias("size"), F.monotonically_increasing_id().alias("id")))
    sized = kept.groupBy("lang", "size").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"), F.count("*").alias("terms"), F.sum("n_lang").alias("total"))
    sized = materialise(sized)
    langs = sized.groupBy("lang").agg(F.sum("terms").alias("terms"), F.sum("total").alias("lang_total"))
    part = F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part")
    in_blocks = materialise(kept.join(sized.select("lang", "size", "parts"), ["lang", "size"]).select("lang", "term", "n_lang", "id", "size", part))
    blocks = in_blocks.groupBy("lang", "size", "part").agg(F.count("*").alias("block_terms"))
    entries = materialise(counts.where("n > 0").select("lang", "source", "term", "n").join(in_blocks, ["lang", "term"]))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    own = Window.partitionBy("lang")
    groups = groups.withColumns({"g": F.row_number().over(own.orderBy("source")).cast("long") - 1, "tiles": F.ceil(F.count("*").over(own) / tile).cast("int")})
    groups = materialise(groups.withColumn("tile", F.floor(F.col("g") / tile).cast("int")))

    of_group = entries.join(groups, ["lang", "source"])
    # for every tile that the group's own one meets; the smaller tile first
    pairs_of_tiles = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least("tile", t).alias("t1"), F.greatest("tile", t).alias("t2"))))
    counted = of_group.select("lang", "size", "part", pairs_of_tiles.alias("t"), "tile", "g", F.col("id").alias("term"), "n", share("n", "total", "terms").alias("p"))
    zero = F.when(F.col("terms") > 0, share(0, "total", "greatest(terms, 1)")).otherwise(F.lit(1))
    # a language without terms has one block of none
    empty = groups.join(blocks, "lang", "left").na.fill(0, ["size", "part", "block_terms"])
    empty = empty.select("lang", "size", "part", pairs_of_tiles.alias("t"), "tile", "g", F.lit(None).cast("long").alias("term"), F.col("block_terms").alias("n"), zero.alias("p"))
    rows = counted.unionByName(empty).select("lang", "size", "part", "t.*", "tile", "g", "term", "n", "p")
    priced = rows.groupBy("lang", "size", "part", "t1", "t2").applyInArrow(_priced, "lang string, g long, h long, value long")
    sums = materialise(priced.groupBy("lang", "g", "h").agg(F.sum("value").alias("value")))
    both = sums.unionByName(sums.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    names = groups.select("lang", "g", "source")
    named = both.join(names, ["lang", "g"]).join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
    of_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(of_source))

    shares = of_group.select("lang", "source", F.col("term").alias("item"), share("n", "total", "terms").alias("p"), share("n_lang", "lang_total", "terms").alias("q")).where("p > q")
    worth = shares.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    term = worth.withColumn("rank", F.row_number().over(of_source)).where(F.col("rank") <= ranks)
    return pair.unionByName(term)

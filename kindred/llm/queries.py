"""The registered queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import (
    backoff_lm,
    best_fit,
    cotraining,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    permutation_index,
    piece_codec,
    secret_automata,
    simhash,
    source_divergence,
    spelling_variants,
)
from kindred.llm.common import LOWER, UPPER, held_out, table
from kindred.session import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
""")
def op1_block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents`` with A-Z lower-cased."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op2_family_then_svm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all ``documents``, learned outside one fold of five."""
    return language_id.cross_fold(table(spark, sf_dir, "documents"))


@query()
def op3_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest ``embeddings`` by cosine of every fiftieth one."""
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op4_format_automata_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in ``documents`` by fixed patterns and learned formats."""
    docs = table(spark, sf_dir, "documents")
    model = secret_automata.load(secret_automata.learn(docs))
    spans = secret_automata.scan(docs, model).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_automata.KINDS))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(kind).alias(f"n_{kind}") for kind in secret_automata.KINDS]
    return spans.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query(license_scan.scan_sql())
def op5_rare_word_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in ``documents``."""
    docs = table(spark, sf_dir, "documents")
    found = license_scan.scan(docs, license_scan.weights(docs))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), F.round("score", 6).alias("score"),
    )


@query()
def op6_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the pieces of all ``documents`` and of the texts decoded from them."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.digests(table(spark, sf_dir, "documents"), path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "spans_sha256")


@query()
def op7_backoff_automaton_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents`` by a model of those outside one fold of seven."""
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 7, 2)
    automaton, counts = backoff_lm.learn(docs.where(~out))
    scored = backoff_lm.score(docs, automaton, counts)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op8_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all ``documents``, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    featured = cotraining.features(docs)
    model = cotraining.learn(docs, table(spark, sf_dir, "labels"), featured=featured)
    return cotraining.scores_of(featured, model).select("doc_id", "text_score", "meta_score", "score", "keep")


@query()
def op9_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 1024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    items = materialise(best_fit.pieces(table(spark, sf_dir, "documents"), path, keep_ids=False))
    packed = best_fit.pack(items)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op10_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` whose fingerprints differ in at most three bits."""
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT r, doc_id, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM cut),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS body FROM l),
held AS (SELECT body, max(doc_id) AS top FROM k WHERE length(body) >= 40 GROUP BY body HAVING count(DISTINCT r) >= 5),
marked AS (SELECT k.*, held.body IS NOT NULL AND k.doc_id IS DISTINCT FROM held.top AS lost FROM k LEFT JOIN held USING (body))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r
""")
def op11_range_streamed_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that five ``documents`` or more share, kept in one of them."""
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(f"""
WITH RECURSIVE steps(b, c, i) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT b, xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), i + 1 FROM steps WHERE i < 8
),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE i = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS mark, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT mark, run, n, list_concat([4294967295::BIGINT], list_transform(range(1, (length(hex(encode(mark))) // 2 + 1)::BIGINT), lambda i: ('0x' || substr(hex(encode(mark)), 2 * i - 1, 2))::BIGINT)) AS x
  FROM counted
),
sums AS (SELECT run, n, xor(list_reduce(x, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, n FROM sums
),
w AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (
  SELECT a.word AS x, b.word AS y, b.n AS n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN w b ON a.rest = b.word
),
near AS (SELECT x, count(*) AS n_near, max(n) AS most, min({{'n': -n, 'y': y}}) AS best FROM pairs GROUP BY x),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN best.y END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
  FROM w LEFT JOIN near ON w.word = near.x
),
paths(word, root) AS (
  SELECT word, word FROM f
  UNION ALL SELECT paths.word, f.form FROM paths JOIN f ON paths.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, paths.root, f.n, f.n_near, f.form_n
FROM f JOIN paths USING (word) JOIN f AS e ON e.word = paths.root AND e.form IS NULL
""")
def op12_chunked_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` with the more frequent words one edit away."""
    return spelling_variants.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


_SHARE = "1 + (1000000000::HUGEINT * ({0} + 2)) // ({1} + 2 * v)"


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
),
kept AS (SELECT lang, term, count(*) AS n_lang FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
totals AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(total_lang, 0) AS total_lang, coalesce(total, 0) AS total
  FROM g LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN langs USING (lang)
),
p AS (
  SELECT lang, source, term, n_lang, total_lang, v, coalesce(n, 0) AS n, {_SHARE.format("coalesce(n, 0)", "total")} AS p
  FROM totals JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
q AS (SELECT *, {_SHARE.format("n_lang", "total_lang")} AS q FROM p WHERE n > 0),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM q WHERE p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank FROM ranked WHERE part = 'pair' OR place <= 10
""")
def op13_level_product_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of ``documents`` from each other and from their language."""
    return source_divergence.audit(table(spark, sf_dir, "documents")).select("lang", "source", "part", "item", "value", "rank")

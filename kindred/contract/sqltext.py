"""SQL fragments shared by the checks: corpus view, key phrases, index, search."""

from __future__ import annotations

from kindred.functions.phrases import CLASS, LIBRARY, NUMBER
from kindred.functions.stopwords import ENGLISH
from kindred.functions.text import BLANK, PUNCTUATION, SENTENCE_END, WORD_OR_MARK, WORD_OR_MARKS
from kindred.operators.keywords import FIELD_WEIGHTS


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def value_list(words) -> str:
    return "(" + ", ".join(quote(w) for w in words) + ")"


STOP = value_list(ENGLISH)
BREAKS = value_list([*ENGLISH, *PUNCTUATION])


def fold(x: str) -> str:
    return rf"regexp_replace({x}, '[^\x00-\x7F]', '', 'g')"


def half_up(x: str, digits: int) -> str:
    return f"(floor(({x}) * 1e{digits} + 0.5) / 1e{digits})"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {quote(WORD_OR_MARK)}, 0)"


def field_words(x: str) -> str:
    return (
        f"list_transform(list_filter({tokens(fold(x))}, lambda t: length(t) > 1 and t not in {STOP}), "
        "lambda t: lower(t))"
    )


def plain_words(x: str) -> str:
    bare = rf"regexp_replace(lower({x}), '[!-/:-@\[-`{{-~]', '', 'g')"
    return f"list_filter(regexp_split_to_array({bare}, {quote(BLANK + '+')}), lambda w: w <> '')"


ARTICLES = """
articles AS (
  SELECT d.doc_id AS id, d.text AS content,
         split_part(d.text, chr(10), 1) AS title,
         d.lang || ' ' || d.source AS keywords,
         CASE WHEN d.lang = 'fr' THEN '[''' || d.source
              ELSE '[''' || d.lang || ' news'', u''' || d.source || ''']' END AS meta_keywords,
         CASE WHEN d.text LIKE '%' || chr(10) || '%' THEN split_part(d.text, chr(10), 2) ELSE 'null' END
           AS meta_description,
         d.source || ', ' || d.lang AS tags,
         array_to_string(string_split(d.text, '. ')[1:2], '. ') AS summary,
         CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN 'hate'
              WHEN l.quality = 1 THEN 'reliable' ELSE 'unreliable' END AS type
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def rake(p: str, src: str, key: str, text: str, fraction: float = 1.0, variant: str = LIBRARY) -> str:
    """CTEs ending in ``p(id, phrase, score, rn)``; also ``p_cand``, ``p_words`` and ``p_all``."""
    pattern = {LIBRARY: WORD_OR_MARKS, CLASS: WORD_OR_MARK}[variant]
    clean = rf"regexp_replace(lower(regexp_replace({fold(text)}, '[\x01\x02]', '', 'g')), {quote(SENTENCE_END)}, '\1 ' || chr(2) || ' ', 'g')"
    tie = "DESC" if variant == LIBRARY else "ASC"
    if variant == LIBRARY:
        cand = f"""
{p}_cand AS (
  SELECT DISTINCT id, phrase, 0 AS pid FROM (
    SELECT id, grp, string_agg(tok, ' ' ORDER BY pos) AS phrase FROM {p}_grp WHERE brk = 0 GROUP BY id, grp))"""
        weight = "len(string_split(phrase, ' '))"
    else:
        cand = f"""
{p}_cand AS (
  SELECT r.id, r.phrase, r.grp AS pid FROM (
    SELECT id, grp, string_agg(tok, ' ' ORDER BY pos) AS phrase FROM {p}_grp WHERE brk = 0 GROUP BY id, grp) r
  JOIN {p}_grp e ON e.id = r.id AND e.brk = 1 AND e.grp = r.grp + 1 AND e.tok <> chr(2))"""
        weight = f"len(list_filter(string_split(phrase, ' '), lambda w: NOT regexp_matches(w, {quote(NUMBER)})))"
    return f"""
{p}_tok AS (
  SELECT id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos
  FROM (SELECT {key} AS id, regexp_extract_all({clean}, {quote(pattern)}, 0) AS toks FROM {src} WHERE {text} IS NOT NULL)),
{p}_grp AS (
  SELECT *, sum(brk) OVER (PARTITION BY id ORDER BY pos) AS grp
  FROM (SELECT *, CASE WHEN tok = chr(2) OR tok IN {BREAKS} THEN 1 ELSE 0 END AS brk FROM {p}_tok)),{cand},
{p}_occ AS (
  SELECT id, phrase, pid, {weight} AS n, unnest(string_split(phrase, ' ')) AS w,
         generate_subscripts(string_split(phrase, ' '), 1) AS j
  FROM {p}_cand),
{p}_words AS (
  SELECT id, w, count(*) AS freq, CAST(sum(n) AS DOUBLE) AS degree FROM {p}_occ GROUP BY id, w),
{p}_all AS (
  SELECT DISTINCT id, phrase, score FROM (
    SELECT o.id, o.phrase, o.pid, {half_up('sum(s.degree / s.freq ORDER BY o.j)', 9)} AS score
    FROM {p}_occ o JOIN {p}_words s ON o.id = s.id AND o.w = s.w GROUP BY o.id, o.phrase, o.pid)),
{p} AS (
  SELECT id, phrase, score, rn FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, phrase {tie}) AS rn,
           count(*) OVER (PARTITION BY id) AS cnt FROM {p}_all)
  WHERE rn <= floor(cnt * CAST({fraction} AS DOUBLE)))"""


def index(fraction: float = 0.5, profile: str = "default", fields=None, min_length: int = 3) -> str:
    """CTEs ending in ``idx(keyword, doc_id, score, field)`` over ``articles``."""
    w = FIELD_WEIGHTS[profile]

    def words(field: str, expr: str) -> str:
        return (
            f"SELECT unnest({expr}) AS keyword, id AS doc_id, CAST({w[field]} AS DOUBLE) AS score, '{field}' AS field "
            f"FROM articles WHERE {field} IS NOT NULL AND {field} <> 'null'"
        )

    parts = {
        "content": f"SELECT phrase, id, {half_up('score', 1)}, 'content' FROM rc",
        "title": words("title", field_words("title")),
        "keywords": words("keywords", f"string_split(lower({fold('keywords')}), ' ')"),
        "meta_keywords": words(
            "meta_keywords",
            "list_transform(list_filter(CASE WHEN meta_keywords LIKE '%]' THEN "
            "regexp_extract_all(meta_keywords, '''([^'']*)''', 1) ELSE [] END, lambda x: length(x) > 1), "
            "lambda x: lower(x))",
        ),
        "meta_description": words("meta_description", field_words("meta_description")),
        "tags": words("tags", f"string_split(lower({fold('tags')}), ',')"),
        "summary": f"SELECT phrase, id, {half_up('score', 1)}, 'summary' FROM rs",
    }
    chosen = list(fields or parts)
    ctes = []
    if "content" in chosen:
        ctes.append(rake("rc", "articles", "id", "content", fraction))
    if "summary" in chosen:
        ctes.append(rake("rs", "articles", "id", "summary", fraction))
    union = " UNION ALL ".join(parts[f] for f in chosen)
    ctes.append(f"\nidx(keyword, doc_id, score, field) AS (SELECT * FROM ({union}) u(keyword, doc_id, score, field) "
                f"WHERE length(keyword) >= {min_length})")
    return ",".join(ctes)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"

"""Function families, sources and sinks, user functions, SQL entry points."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.contract.registry import query
from kindred.session import work_dir
from kindred.sources.articles import table


def r(c, n: int = 6):
    return F.round(c, n)


@query(
    "SELECT doc_id, CASE WHEN n_chars > 2000 THEN 'long' WHEN n_chars > 500 THEN 'medium' ELSE 'short' END AS size, coalesce(l.quality, -1) AS q, l.quality IS NULL AS missing, "
    "greatest(n_chars, 1000) AS g, least(n_chars, 1000) AS l, CAST(CASE WHEN n_chars > 5000 THEN -1 ELSE n_chars END AS DOUBLE) AS v, n_chars > 5000 AS isnan FROM documents d LEFT JOIN labels l USING (doc_id)"
)
def fn_conditionals(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    maybe = F.when(F.col("n_chars") > 5000, F.lit(float("nan"))).otherwise(F.col("n_chars").cast("double"))
    return d.select(
        "doc_id", F.when(F.col("n_chars") > 2000, "long").when(F.expr("n_chars > 500"), "medium").otherwise("short").alias("size"),
        F.coalesce("quality", F.lit(-1)).alias("q"), F.isnull("quality").alias("missing"), F.greatest("n_chars", F.lit(1000)).alias("g"),
        F.least("n_chars", F.lit(1000)).alias("l"), F.nanvl(maybe, F.lit(-1.0)).alias("v"), F.isnan(maybe).alias("isnan"),
    )


@query(
    "SELECT event_type, max(value) AS mx, min(value) AS mn, count(value) AS n, round(sum(value), 2) AS s, round(avg(value), 5) AS a, count(DISTINCT user_id) AS users, "
    "CAST(sum(DISTINCT user_id) AS BIGINT) AS su, round(corr(value, user_id), 5) AS c, round(stddev(value), 5) AS sd, round(variance(value), 4) AS var FROM events GROUP BY 1"
)
def fn_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.max("value").alias("mx"), F.min("value").alias("mn"), F.count("value").alias("n"), r(F.sum("value"), 2).alias("s"), r(F.mean("value"), 5).alias("a"),
        F.count_distinct("user_id").alias("users"), F.sum_distinct("user_id").alias("su"), r(F.corr("value", "user_id"), 5).alias("c"),
        r(F.stddev("value"), 5).alias("sd"), r(F.variance("value"), 4).alias("var"),
    )


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) ORDER BY quality ASC NULLS FIRST, toxic DESC NULLS LAST, doc_id DESC")
def fn_sort_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", "quality", "toxic").orderBy(F.asc_nulls_first("quality"), F.desc_nulls_last("toxic"), F.desc("doc_id"))


_MATH = {
    "ab": ("abs(x - 25)", lambda x: F.abs(x - 25)), "sq": ("sqrt(x)", F.sqrt), "cb": ("cbrt(x)", F.cbrt), "ex": ("exp(x / 50)", lambda x: F.exp(x / 50)),
    "em": ("exp(x / 50) - 1", lambda x: F.expm1(x / 50)), "ln": ("ln(x)", F.log), "l10": ("log10(x)", F.log10), "l1p": ("ln(1 + x)", F.log1p), "l2": ("log2(x)", F.log2),
    "ce": ("CAST(ceil(y / 1000) AS BIGINT)", None), "fl": ("CAST(floor(y / 1000) AS BIGINT)", None), "ri": ("round_even(y / 1000, 0)", None), "ro": ("round(y / 1000, 1)", None),
    "sg": ("sign(x - 25)", lambda x: F.signum(x - 25)), "si": ("sin(x)", F.sin), "sh": ("(exp(x / 50) - exp(-x / 50)) / 2", lambda x: F.sinh(x / 50)), "asi": ("asin(x / 51)", lambda x: F.asin(x / 51)),
    "co": ("cos(x)", F.cos), "ch": ("(exp(x / 50) + exp(-x / 50)) / 2", lambda x: F.cosh(x / 50)), "aco": ("acos(x / 51)", lambda x: F.acos(x / 51)), "ta": ("tan(x)", F.tan),
    "th": ("(exp(x / 25) - 1) / (exp(x / 25) + 1)", lambda x: F.tanh(x / 50)), "at": ("atan(x)", F.atan), "at2": ("atan2(x, 7)", lambda x: F.atan2(x, F.lit(7.0))),
    "hy": ("sqrt(x * x + 9)", lambda x: F.hypot(x, F.lit(3.0))), "po": ("power(x, 1.5)", lambda x: F.pow(x, F.lit(1.5))), "de": ("degrees(x)", F.degrees), "ra": ("radians(x)", F.radians),
}


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"round({e}, 6) AS {n}" for n, (e, _) in _MATH.items())
    + ", CAST(factorial(l_linenumber) AS BIGINT) AS fa, to_base(l_partkey, 2) AS bi, hex(l_partkey) AS he, ~l_linenumber AS bn, l_linenumber << 3 AS sl, l_partkey >> 2 AS sr "
    "FROM (SELECT *, l_quantity AS x, l_extendedprice AS y FROM lineitem)"
)
def fn_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    own = {"ce": F.ceil(y / 1000), "fl": F.floor(y / 1000), "ri": F.rint(y / 1000), "ro": F.round(y / 1000, 1)}
    cols = [F.round(own[n] if n in own else f(x), 6).alias(n) for n, (_, f) in _MATH.items()]
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", *cols, F.factorial("l_linenumber").alias("fa"), F.bin("l_partkey").alias("bi"), F.hex("l_partkey").alias("he"),
        F.bitwise_not("l_linenumber").alias("bn"), F.shiftleft("l_linenumber", 3).alias("sl"), F.shiftright("l_partkey", 2).alias("sr"),
    )


@query(
    "SELECT p_partkey, round_even(p_retailprice / 100, 0) AS br, upper(to_base(p_partkey, 36)) AS cv, p_brand AS un, p_partkey >> 1 AS su, "
    "upper(hex(p_name)) AS hx, to_base64(CAST(p_name AS BLOB)) AS b6, xor(p_partkey, p_size) AS bx FROM part"
)
def fn_number_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounding to even, other bases, coded forms and back."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.bround(F.col("p_retailprice") / 100, 0).alias("br"), F.conv(F.col("p_partkey").cast("string"), 10, 36).alias("cv"),
        F.unhex(F.hex("p_brand")).cast("string").alias("un"), F.shiftrightunsigned("p_partkey", 1).alias("su"), F.hex("p_name").alias("hx"),
        F.base64(F.col("p_name").cast("binary")).alias("b6"), F.col("p_partkey").bitwiseXOR(F.col("p_size")).alias("bx"),
    )


@query()
def fn_math_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.bround(F.col("p_retailprice") / 100, 0).alias("br"), F.conv(F.col("p_partkey").cast("string"), 10, 36).alias("cv"),
        F.unhex(F.hex("p_brand")).cast("string").alias("un"), F.shiftrightunsigned("p_partkey", 1).alias("su"), F.soundex("p_name").alias("sx"),
        F.crc32("p_name").alias("crc"), F.hash("p_name", "p_size").alias("ha"), F.rand(1).alias("ra"), F.randn(1).alias("rn"),
        F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("pid"), F.input_file_name().alias("file"), F.shuffle(F.split("p_name", " ")).alias("sh"),
        F.current_date().alias("cd"), F.current_timestamp().alias("ct"),
    )


@query(
    "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS lo, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS ic, "
    "length(p_name) AS le, p_name || '-' || p_brand AS co, concat_ws('/', p_brand, p_type) AS cw, substr(p_name, 2, 3) AS su, split_part(p_name, ' ', 1) AS si, "
    "instr(p_name, 'e') AS ins, lpad(p_brand, 10, '*') AS lp, rpad(p_brand, 10, '*') AS rp, repeat(p_type, 2) AS re, reverse(p_name) AS rv, "
    "array_to_string(string_split(p_name, ' '), '|') AS sp, regexp_extract(p_brand, '#([0-9]+)', 1) AS rx, regexp_replace(p_name, '[aeiou]', '_', 'g') AS rr, translate(p_name, 'abc', 'xyz') AS tr, "
    "levenshtein(p_name, p_type) AS lev, format('{:,.2f}', p_retailprice) AS fnum, printf('%s:%d', p_brand, p_size) AS fs, p_name AS de, md5(p_name) AS md, sha1(p_name) AS s1, sha256(p_name) AS s2 FROM part"
)
def fn_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, b, t = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.upper(n).alias("up"), F.lower(b).alias("lo"), F.initcap(n).alias("ic"), F.length(n).alias("le"), F.concat(n, F.lit("-"), b).alias("co"),
        F.concat_ws("/", b, t).alias("cw"), F.substring(n, 2, 3).alias("su"), F.substring_index(n, " ", 1).alias("si"), F.instr(n, "e").alias("ins"),
        F.lpad(b, 10, "*").alias("lp"), F.rpad(b, 10, "*").alias("rp"), F.repeat(t, 2).alias("re"), F.reverse(n).alias("rv"), F.array_join(F.split(n, " "), "|").alias("sp"),
        F.regexp_extract(b, "#([0-9]+)", 1).alias("rx"), F.regexp_replace(n, "[aeiou]", "_").alias("rr"), F.translate(n, "abc", "xyz").alias("tr"),
        F.levenshtein(n, t).alias("lev"), F.format_number("p_retailprice", 2).alias("fnum"), F.format_string("%s:%d", b, F.col("p_size")).alias("fs"),
        F.decode(F.encode(n, "UTF-8"), "UTF-8").alias("de"), F.md5(n).alias("md"), F.sha1(n).alias("s1"), F.sha2(n, 256).alias("s2"),
    )


@query(
    "SELECT o_orderkey, year(d) AS y, quarter(d) AS q, month(d) AS m, dayofweek(d) + 1 AS dow, day(d) AS dom, dayofyear(d) AS doy, weekofyear(d) AS w, hour(d) AS h, minute(d) AS mi, second(d) AS s, "
    "strftime(d + INTERVAL 10 DAY, '%Y-%m-%d') AS da, strftime(d - INTERVAL 10 DAY, '%Y-%m-%d') AS ds, date_diff('day', DATE '1995-01-01', CAST(d AS DATE)) AS dd, strftime(d + INTERVAL 2 MONTH, '%Y-%m-%d') AS am, "
    "strftime(date_trunc('month', d), '%Y-%m-%d') AS tr, strftime(date_trunc('quarter', d), '%Y-%m-%d') AS dt, strftime(last_day(d), '%Y-%m-%d') AS ld, strftime(d, '%d/%m/%Y') AS fm, "
    "CAST(epoch(d) AS BIGINT) AS ut FROM (SELECT o_orderkey, o_orderdate AS d FROM orders)"
)
def fn_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")

    def iso(c):
        return F.date_format(c, "yyyy-MM-dd")

    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(d).alias("y"), F.quarter(d).alias("q"), F.month(d).alias("m"), F.dayofweek(d).alias("dow"), F.dayofmonth(d).alias("dom"), F.dayofyear(d).alias("doy"),
        F.weekofyear(d).alias("w"), F.hour(d).alias("h"), F.minute(d).alias("mi"), F.second(d).cast("long").alias("s"), iso(F.date_add(d, 10)).alias("da"), iso(F.date_sub(d, 10)).alias("ds"),
        F.datediff(d, F.to_date(F.lit("1995-01-01"))).alias("dd"), iso(F.add_months(d, 2)).alias("am"), iso(F.trunc(d, "month")).alias("tr"), iso(F.date_trunc("quarter", d)).alias("dt"),
        iso(F.last_day(d)).alias("ld"), F.date_format(d, "dd/MM/yyyy").alias("fm"),
        F.unix_timestamp(F.convert_timezone(F.lit("UTC"), F.current_timezone(), d).cast("timestamp")).alias("ut"),
    )


_ISO = "'%Y-%m-%d %H:%M:%S'"


@query(
    "SELECT o_orderkey, round((year(d) - 1995) * 12 + month(d) - 1 + CASE WHEN day(d) = 1 THEN 0 ELSE ((day(d) - 1) * 86400 + epoch(d) % 86400) / (31 * 86400.0) END, 8) AS mb, "
    f"strftime(CAST(d AS DATE) + CAST(8 - isodow(d) AS INTEGER), '%Y-%m-%d') AS nd, strftime(d, {_ISO}) AS fu, strftime(d + INTERVAL 9 HOUR, {_ISO}) AS fz, strftime(d - INTERVAL 9 HOUR, {_ISO}) AS tz, "
    f"strftime(date_trunc('day', d), {_ISO}) AS ts FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS d FROM orders)"
)
def fn_dates_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("timestamp")

    def shown(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")

    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.months_between(d, F.lit("1995-01-01")).alias("mb"), F.date_format(F.next_day(d, "Mon"), "yyyy-MM-dd").alias("nd"), F.from_unixtime(F.unix_timestamp(d)).alias("fu"),
        shown(F.from_utc_timestamp(d, "Asia/Tokyo")).alias("fz"), shown(F.to_utc_timestamp(d, "Asia/Tokyo")).alias("tz"),
        shown(F.to_timestamp(F.date_format(d, "yyyyMMdd"), "yyyyMMdd")).alias("ts"),
    )


@query(
    "SELECT doc_id, len(w) AS n, list_contains(w, 'the') AS has, list_has_any(w, ['the', 'der']) AS ov, array_to_string(w[2:4], ' ') AS sl, coalesce(list_position(w, 'the'), 0) AS pos, w[1] AS fst, "
    "len(list_filter(w, lambda x: x <> 'the')) AS rm, len(list_distinct(w)) AS di, len(list_intersect(w, ['the', 'of', 'der'])) AS ins, list_min(w) AS mn, list_max(w) AS mx, "
    "array_to_string(list_sort(w)[1:3], ' ') AS st, array_to_string(list_reverse(w)[1:2], ' ') AS rv, len(flatten([w, w])) AS fl "
    "FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)"
)
def fn_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("w")
    some = F.array(F.lit("the"), F.lit("of"), F.lit("der"))
    return table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("w")).select(
        "doc_id", F.size(w).alias("n"), F.array_contains(w, "the").alias("has"), F.arrays_overlap(w, F.array(F.lit("the"), F.lit("der"))).alias("ov"),
        F.array_join(F.slice(w, 2, 3), " ").alias("sl"), F.array_position(w, "the").alias("pos"), F.element_at(w, 1).alias("fst"), F.size(F.array_remove(w, "the")).alias("rm"),
        F.size(F.array_distinct(w)).alias("di"), F.size(F.array_intersect(w, some)).alias("ins"), F.array_min(w).alias("mn"), F.array_max(w).alias("mx"),
        F.array_join(F.slice(F.array_sort(w), 1, 3), " ").alias("st"), F.array_join(F.slice(F.reverse(w), 1, 2), " ").alias("rv"), F.size(F.flatten(F.array(w, w))).alias("fl"),
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, unnest(range(1, l_linenumber + 1)) AS step FROM lineitem"
)
def fn_generators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.explode(F.sequence(F.lit(1), "l_linenumber")).alias("step"))


@query(
    "SELECT doc_id, pos - 1 AS pos, word FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, string_split(source || ' ' || lang, ' ') AS w FROM documents)) "
)
def fn_posexplode(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.concat_ws(" ", "source", "lang"), " ")
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode_outer(words).alias("pos", "word"))


@query("SELECT c_custkey, c_mktsegment AS seg, c_nationkey AS nat, 2 AS n, 'nat,seg' AS ks FROM customer")
def fn_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.map_concat(F.create_map(F.lit("seg"), F.col("c_mktsegment")), F.map_from_arrays(F.array(F.lit("nat")), F.array(F.col("c_nationkey").cast("string"))))
    return table(spark, sf_dir, "customer").select("c_custkey", m.alias("m")).select(
        "c_custkey", F.element_at("m", "seg").alias("seg"), F.col("m")["nat"].cast("int").alias("nat"), F.size(F.map_values("m")).alias("n"),
        F.array_join(F.sort_array(F.map_keys("m")), ",").alias("ks"),
    )


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, json_extract_string(props, '$.k') AS ks, '{\"id\":' || event_id || '}' AS js FROM events")
def fn_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int")["k"].alias("k"), F.get_json_object("props", "$.k").alias("ks"), F.to_json(F.struct(F.col("event_id").alias("id"))).alias("js")
    )


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def fn_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time windows as a grouping function."""
    w = F.window("ts", "1 hour")
    return table(spark, sf_dir, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n"
    )


@query(
    "SELECT doc_id, len(list_distinct(list_concat(w, ['the', 'zzz']))) AS un, len(list_filter(list_distinct(w), lambda x: x NOT IN ('the', 'of'))) AS ex, "
    "repeat(w[1], 2) AS re, instr(text, 'the') AS lo FROM (SELECT doc_id, text, string_split(text, ' ') AS w FROM documents)"
)
def fn_array_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("w")
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.split("text", " ").alias("w")).select(
        "doc_id", F.size(F.array_union(w, F.array(F.lit("the"), F.lit("zzz")))).alias("un"), F.size(F.array_except(w, F.array(F.lit("the"), F.lit("of")))).alias("ex"),
        F.array_join(F.array_repeat(w[0], 2), "").alias("re"), F.locate("the", "text").alias("lo"),
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, unnest(CASE WHEN l_linenumber > 3 THEN range(4, l_linenumber + 1) ELSE [NULL::BIGINT] END) AS step FROM lineitem")
def fn_explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty arrays give one row with null."""
    late = F.transform(F.filter(F.sequence(F.lit(1), "l_linenumber"), lambda i: i > 3), lambda i: i.cast("long"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.explode_outer(late).alias("step"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, 'STRUCT<k: BIGINT>' AS shape, value AS own, event_type = 'click' AS click FROM events")
def fn_json_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.map_from_entries(F.array(F.struct("event_type", "value")))
    return table(spark, sf_dir, "events").select("event_id", "event_type", entry.alias("m"), F.json_tuple("props", "k").alias("k")).select(
        "event_id", "k", F.schema_of_json(F.lit('{"k": 1}')).alias("shape"), F.element_at("m", F.col("event_type")).alias("own"), F.map_contains_key("m", "click").alias("click")
    )


@query("SELECT n_regionkey, min(n_name) AS name, count(*) AS n FROM nation GROUP BY 1")
def fn_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First value of a group that is constant in it."""
    lowest = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.min("n_name").alias("low"))
    return table(spark, sf_dir, "nation").join(lowest, "n_regionkey").groupBy("n_regionkey").agg(F.first("low").alias("name"), F.count("*").alias("n"))


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) ORDER BY quality ASC NULLS LAST, toxic DESC NULLS FIRST, doc_id")
def fn_sort_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", "quality", "toxic").orderBy(F.asc_nulls_last("quality"), F.desc_nulls_first("toxic"), "doc_id")


@query("SELECT p_partkey, round_even(p_retailprice / 100, 0) AS br, upper(to_base(p_partkey, 36)) AS cv, p_brand AS un, p_partkey >> 1 AS su FROM part")
def fn_base_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.bround(F.col("p_retailprice") / 100, 0).alias("br"), F.conv(F.col("p_partkey").cast("string"), 10, 36).alias("cv"),
        F.unhex(F.hex("p_brand")).cast("string").alias("un"), F.shiftrightunsigned("p_partkey", 1).alias("su"),
    )


@query(
    "SELECT o_orderkey, strftime(d + INTERVAL 1 DAY * (8 - isodow(d)), '%Y-%m-%d') AS nd, strftime(d + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS fz, "
    "strftime(d - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS tz, strftime(date_trunc('day', d), '%Y-%m-%d %H:%M') AS ts FROM (SELECT o_orderkey, o_orderdate AS d FROM orders)"
)
def fn_dates_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("timestamp")

    def minute(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm")

    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(F.next_day(d, "Mon"), "yyyy-MM-dd").alias("nd"), minute(F.from_utc_timestamp(d, "Asia/Tokyo")).alias("fz"),
        minute(F.to_utc_timestamp(d, "Asia/Tokyo")).alias("tz"), minute(F.to_timestamp(F.date_format(d, "yyyyMMdd"), "yyyyMMdd")).alias("ts"),
    )


# sources and sinks: written to the shared folder and read back


def _roundtrip(spark: SparkSession, df: DataFrame, fmt: str, **options) -> DataFrame:
    path = work_dir(spark)
    df.write.format(fmt).options(**options).save(path)
    return spark.read.format(fmt).schema(df.schema).options(**options).load(path)


_PART = "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


@query(_PART)
def io_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, _part(spark, sf_dir), "parquet", compression="zstd")


@query(_PART)
def io_csv_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, _part(spark, sf_dir), "csv", sep=";", header=True, quote="'")


@query(_PART)
def io_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, _part(spark, sf_dir), "json", compression="gzip")


@query(_PART)
def io_orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, _part(spark, sf_dir), "orc")


@query("SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1")
def io_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark)
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    lines.write.text(path, lineSep="\n")
    return spark.read.text(path, lineSep="\n").groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def io_partitioned_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark)
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(path)
    kept = spark.read.parquet(path).where("o_orderstatus = 'F'")
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_orderstatus, count(*) AS n, sum(l_quantity) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def io_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides bucketed by the join key: the join itself does not shuffle."""
    names = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        stored = f"bucketed_{name}_{work_dir(spark).rsplit('/', 1)[1]}"
        table(spark, sf_dir, name).write.bucketBy(8, key).sortBy(key).option("path", work_dir(spark)).saveAsTable(stored)
        names.append(spark.table(stored))
    orders, li = names
    return orders.join(li, orders.o_orderkey == li.l_orderkey).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer")
def io_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark)
    table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance").write.parquet(f"{path}/kind=s")
    table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment").write.parquet(f"{path}/kind=c")
    return spark.read.option("mergeSchema", True).parquet(path).select("id", "name", "balance", "segment")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def io_insert_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended to a catalogue table."""
    stored = f"accounts_{work_dir(spark).rsplit('/', 1)[1]}"
    table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name").write.option("path", work_dir(spark)).saveAsTable(stored)
    table(spark, sf_dir, "customer").select("c_custkey", "c_name").write.insertInto(stored)
    return spark.table(stored)


# user functions


@query("SELECT p_partkey, len(string_split(p_name, ' ')) AS words FROM part")
def udf_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.udf(lambda s: len(s.split(" ")), "int", useArrow=True)
    return table(spark, sf_dir, "part").select("p_partkey", words("p_name").alias("words"))


@query("SELECT p_brand, sum(p_size * 2) AS doubled FROM part GROUP BY 1")
def udf_sql_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udf.register("twice", F.udf(lambda v: v * 2, "int", useArrow=True))
    return spark.sql("SELECT p_brand, sum(twice(p_size)) AS doubled FROM {part} GROUP BY 1", part=table(spark, sf_dir, "part"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem")
def udf_pandas_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("double")
    def net(price: pd.Series, discount: pd.Series) -> pd.Series:
        return price * (1 - discount)

    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(net("l_extendedprice", "l_discount"), 4).alias("net"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, floor((l_quantity - avg(l_quantity) OVER (PARTITION BY l_partkey)) * 1e4 + 0.50001) / 1e4 AS centred FROM lineitem")
def udf_grouped_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part, which has some thirty lines at every scale."""

    def centre(lines: pa.Table) -> pa.Table:
        quantity = lines["l_quantity"].to_numpy()
        return lines.drop(["l_quantity"]).append_column("centred", pa.array(np.floor((quantity - quantity.mean()) * 1e4 + 0.50001) / 1e4))

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return li.groupBy("l_partkey").applyInArrow(centre, "l_orderkey long, l_linenumber int, l_partkey long, centred double")


@query("SELECT l_partkey, round(avg(l_quantity), 4) AS mean FROM lineitem GROUP BY 1")
def udf_grouped_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("double")
    def mean(v: pd.Series) -> float:
        return float(v.mean())

    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.round(mean("l_quantity"), 4).alias("mean"))


@query("SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def sql_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("customer", "nation", "region"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"v_{name}")
    return spark.sql("SELECT n_name, r_name, count(*) AS n FROM v_customer JOIN v_nation ON c_nationkey = n_nationkey JOIN v_region ON n_regionkey = r_regionkey GROUP BY 1, 2")


@query("SELECT c_name, c_acctbal FROM customer WHERE c_acctbal BETWEEN 1300 AND 1900")
def sql_between_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceGlobalTempView("balances")
    return spark.sql("SELECT c_name, c_acctbal FROM global_temp.balances WHERE c_acctbal BETWEEN 1300 AND 1900")

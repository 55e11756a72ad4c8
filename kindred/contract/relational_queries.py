"""Projections, filters, joins, sorts, set operations, aggregation, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kindred.contract.registry import query
from kindred.operators.joins import asof_last
from kindred.operators.statistics import positions
from kindred.sources.articles import table

r6 = lambda c: F.round(c, 4)


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem WHERE l_shipdate >= DATE '1998-01-01' AND l_quantity < 10")
def rel_project_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_shipdate >= timestamp_ntz'1998-01-01' AND l_quantity < 10")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), day("l_shipdate").alias("shipped"))


@query(
    "SELECT c_custkey, c_name, substr(c_name, 1, 8) AS head, c_mktsegment IN ('BUILDING', 'MACHINERY') AS chosen, "
    "c_name LIKE '%7' AS seven, regexp_matches(c_name, '0[13]$') AS tail, starts_with(c_mktsegment, 'AUTO') AS auto, ends_with(c_name, '5') AS five, "
    "contains(c_name, '12') AS twelve, (c_acctbal IS NOT DISTINCT FROM NULL) AS no_balance, c_nationkey & 3 AS low_bits FROM customer "
    "WHERE c_acctbal BETWEEN 100 AND 5000 AND NOT (c_mktsegment = 'FURNITURE')"
)
def rel_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return c.where(F.col("c_acctbal").between(100, 5000) & ~(segment == "FURNITURE")).select(
        "c_custkey", "c_name", name.substr(1, 8).alias("head"), segment.isin("BUILDING", "MACHINERY").alias("chosen"),
        name.like("%7").alias("seven"), name.rlike("0[13]$").alias("tail"), segment.startswith("AUTO").alias("auto"),
        name.endswith("5").alias("five"), name.contains("12").alias("twelve"),
        F.col("c_acctbal").eqNullSafe(F.lit(None)).alias("no_balance"), F.col("c_nationkey").bitwiseAND(3).alias("low_bits"),
    )


def _balances(spark: SparkSession, sf_dir: str):
    """Orders, and the accounts that sell: customers and suppliers share one id space."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")


_O = "(SELECT o_orderkey, o_custkey, o_totalprice FROM orders) o"
_C = "(SELECT s_suppkey, s_acctbal FROM supplier) c"


def _register_joins() -> None:
    for name, how, sql in (
        ("join_inner", "inner", "JOIN"), ("join_left", "left", "LEFT JOIN"),
        ("join_right", "right", "RIGHT JOIN"), ("join_full", "full", "FULL JOIN"),
    ):
        def joined(spark: SparkSession, sf_dir: str, how: str = how) -> DataFrame:
            orders, sellers = _balances(spark, sf_dir)
            return orders.join(sellers, orders.o_custkey == sellers.s_suppkey, how)

        joined.__name__ = name
        query(f"SELECT * FROM {_O} {sql} {_C} ON o_custkey = s_suppkey")(joined)
    for name, how, sql in (("join_semi", "left_semi", "IN"), ("join_anti", "left_anti", "NOT IN")):
        def joined(spark: SparkSession, sf_dir: str, how: str = how) -> DataFrame:
            orders, sellers = _balances(spark, sf_dir)
            return orders.join(sellers, orders.o_custkey == sellers.s_suppkey, how)

        joined.__name__ = name
        query(f"SELECT * FROM {_O} WHERE o_custkey {sql} (SELECT s_suppkey FROM {_C})")(joined)


_register_joins()


@query("SELECT c_mktsegment, sum(c_acctbal) AS total, round(sum(c_acctbal) / (SELECT sum(c_acctbal) FROM customer), 6) AS share FROM customer GROUP BY 1")
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross join with a one-row total."""
    per = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("total"))
    whole = table(spark, sf_dir, "customer").agg(F.sum("c_acctbal").alias("whole"))
    return per.crossJoin(F.broadcast(whole)).select("c_mktsegment", "total", F.round(F.col("total") / F.col("whole"), 6).alias("share"))


@query("SELECT r_name AS band, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM customer JOIN region ON c_acctbal >= r_regionkey * 2000 AND c_acctbal < (r_regionkey + 1) * 2000 GROUP BY 1")
def join_theta_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance bands, one per region row; the bands are disjoint and the region table has a fixed size."""
    bands = table(spark, sf_dir, "region").select(F.col("r_name").alias("band"), (F.col("r_regionkey") * 2000).alias("lo"), ((F.col("r_regionkey") + 1) * 2000).alias("hi"))
    c = table(spark, sf_dir, "customer")
    return c.join(bands, (F.col("c_acctbal") >= F.col("lo")) & (F.col("c_acctbal") < F.col("hi"))).groupBy("band").agg(F.count("*").alias("n"), r6(F.avg("c_acctbal")).alias("mean"))


@query("SELECT d.doc_id, l.type, t.n FROM (SELECT d.doc_id, l.quality AS type FROM documents d LEFT JOIN labels l USING (doc_id)) l JOIN documents d USING (doc_id) JOIN (SELECT type, count(*) AS n FROM (SELECT l.quality AS type FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY type) t ON t.type IS NOT DISTINCT FROM l.type")
def join_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", F.col("quality").alias("type"))
    counts = typed.groupBy(F.col("type").alias("t")).agg(F.count("*").alias("n"))
    return typed.join(counts, F.col("type").eqNullSafe(F.col("t"))).select("doc_id", "type", "n")


@query("SELECT n_name, count(*) AS n, round(sum(s_acctbal), 2) AS total FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def join_broadcast_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation table has 25 rows at every scale."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n.hint("broadcast"), s.s_nationkey == n.n_nationkey).groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.sum("s_acctbal"), 2).alias("total"))


@query(
    "SELECT p.event_id, p.user_id, c.event_id AS click_id, c.value AS click_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p "
    "ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts > c.ts"
)
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("event_type IN ('purchase', 'click')")
    packed = events.withColumn("pack", F.struct("event_id", "value"))
    found = asof_last(packed, "user_id", "ts", F.to_date("ts"), F.col("event_type") == "click", "pack")
    return found.where("event_type = 'purchase'").select(
        "event_id", "user_id", F.col("last_value.event_id").alias("click_id"), F.col("last_value.value").alias("click_value")
    )


@query("SELECT d.doc_id, l.quality, d.lang FROM documents d LEFT JOIN labels l USING (doc_id) ORDER BY l.quality DESC NULLS LAST, d.lang, d.doc_id")
def sort_multi_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", "quality", "lang").orderBy(F.desc_nulls_last("quality"), F.asc("lang"), "doc_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


_SETS = ("(SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R')", "(SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45)")


def _register_sets() -> None:
    for name, sql, op in (
        ("set_union_all", "UNION ALL", "union"), ("set_intersect", "INTERSECT", "intersect"),
        ("set_intersect_all", "INTERSECT ALL", "intersectAll"), ("set_except", "EXCEPT", "subtract"),
        ("set_except_all", "EXCEPT ALL", "exceptAll"),
    ):
        def combined(spark: SparkSession, sf_dir: str, op: str = op) -> DataFrame:
            li = table(spark, sf_dir, "lineitem")
            a = li.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k"))
            b = li.where("l_quantity > 45").select(F.col("l_partkey").alias("k"))
            return getattr(a, op)(b)

        combined.__name__ = name
        query(f"{_SETS[0]} {sql} {_SETS[1]}")(combined)


_register_sets()


@query("SELECT s_name AS name, s_nationkey AS nation, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_name, c_nationkey, c_mktsegment FROM customer")
def set_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").dropDuplicates(["o_orderstatus", "o_orderpriority"]).select("o_orderstatus", "o_orderpriority")


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, CASE WHEN lang = 'en' THEN 'English' WHEN lang = 'fr' THEN 'French' ELSE lang END AS lang FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.source IS NOT NULL")
def na_fill_drop_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "quality", "lang", "source")
    return d.na.drop(subset=["source"]).na.fill({"quality": -1}).na.replace({"en": "English", "fr": "French"}, subset=["lang"]).drop("source")


@query("SELECT lang AS lang_quality, CAST(count(*) FILTER (quality = 0) AS BIGINT) AS \"0\", CAST(count(*) FILTER (quality = 1) AS BIGINT) AS \"1\" FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def stat_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return d.stat.crosstab("lang", "quality")


@query()
def stat_freq_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").stat.freqItems(["l_returnflag", "l_linestatus"], 0.2)


@query()
def stat_approx_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    probs = [0.1, 0.5, 0.9]
    return table(spark, sf_dir, "lineitem").agg(F.percentile_approx("l_extendedprice", probs, 10000).alias("quantiles"))


@query("SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS p, TRUE AS close")
def stat_quantile_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``approxQuantile`` with a stated error of ranks: the share of rows up to each value is that close."""
    probs, error = [0.1, 0.5, 0.9], 0.001
    lines = table(spark, sf_dir, "lineitem")
    values = lines.approxQuantile("l_extendedprice", probs, error)
    price, n = F.col("l_extendedprice"), F.count("*")
    close = [((F.count_if(price < v) / n <= p + 2 * error) & (F.count_if(price <= v) / n >= p - 2 * error)).alias(str(i)) for i, (p, v) in enumerate(zip(probs, values, strict=True))]
    return lines.agg(F.map_from_arrays(F.array(*map(F.lit, probs)), F.array(*close)).alias("m")).select(F.explode("m").alias("p", "close"))


@query()
def sample_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    fractions = {"en": 0.5, "fr": 0.2, "de": 1.0}
    sample = table(spark, sf_dir, "documents").stat.sampleBy("lang", fractions, seed=7)
    return sample.groupBy("lang").agg(F.count("*").alias("n"))


@query()
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").sample(fraction=0.1, seed=3).groupBy("l_returnflag").agg(F.count("*").alias("n"))


# aggregation


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, min(l_tax) AS min_tax, max(l_tax) AS max_tax, count(*) AS n FROM lineitem GROUP BY 1, 2")
def agg_group_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_tax").alias("min_tax"), F.max("l_tax").alias("max_tax"), F.count("*").alias("n"),
    )


@query("SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean FROM orders")
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), r6(F.avg("o_totalprice")).alias("mean"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS line_sum FROM lineitem GROUP BY 1")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.sum_distinct("l_linenumber").alias("line_sum")
    )


def _register_groupings() -> None:
    for name, sql, op in (("agg_rollup", "ROLLUP", "rollup"), ("agg_cube", "CUBE", "cube")):
        def grouped(spark: SparkSession, sf_dir: str, op: str = op) -> DataFrame:
            return getattr(table(spark, sf_dir, "orders"), op)("o_orderstatus", "o_orderpriority").agg(
                F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.grouping("o_orderstatus").cast("long").alias("g"), F.grouping_id().alias("gid")
            )

        grouped.__name__ = name
        query(f"SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, grouping(o_orderstatus) AS g, grouping(o_orderstatus, o_orderpriority) AS gid FROM orders GROUP BY {sql}(o_orderstatus, o_orderpriority)")(grouped)


_register_groupings()

_GROUPING_SETS = "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"


@query(_GROUPING_SETS)
def agg_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_GROUPING_SETS.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


@query("SELECT l_returnflag, sum(l_quantity) FILTER (l_linestatus = 'F') AS F, sum(l_quantity) FILTER (l_linestatus = 'O') AS O FROM lineitem GROUP BY 1")
def agg_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity"))


@query(
    "SELECT l_returnflag, round(stddev_samp(l_quantity), 5) AS sd, round(stddev_pop(l_quantity), 5) AS sdp, round(var_samp(l_quantity), 5) AS v, round(var_pop(l_quantity), 5) AS vp, "
    "round(corr(l_quantity, l_extendedprice), 5) AS c, round(covar_pop(l_quantity, l_discount), 5) AS cp, round(covar_samp(l_quantity, l_discount), 5) AS cs, "
    "round(avg(power(l_quantity - m, 3)) / power(var_pop(l_quantity), 1.5), 4) AS skew, round(kurtosis_pop(l_quantity), 4) AS kurt "
    "FROM lineitem JOIN (SELECT l_returnflag, avg(l_quantity) AS m FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY 1"
)
def agg_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = "l_quantity"
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        *[F.round(e, 5).alias(n) for n, e in (
            ("sd", F.stddev_samp(x)), ("sdp", F.stddev_pop(x)), ("v", F.var_samp(x)), ("vp", F.var_pop(x)), ("c", F.corr(x, "l_extendedprice")),
            ("cp", F.covar_pop(x, "l_discount")), ("cs", F.covar_samp(x, "l_discount")))],
        F.round(F.skewness(x), 4).alias("skew"), F.round(F.kurtosis(x), 4).alias("kurt"),
    )


@query("SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey, l_linenumber) AS parts, array_to_string(list_sort(list_distinct(list(l_returnflag))), '') AS flags FROM lineitem GROUP BY 1")
def agg_collect_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected per order, which has a handful of lines."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("l_partkey", "l_linenumber"))), lambda p: p["l_partkey"].cast("string"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(parts, ",").alias("parts"), F.array_join(F.sort_array(F.collect_set("l_returnflag")), "").alias("flags")
    )


@query("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1")
def agg_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.struct("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", key).alias("first_order"), F.max_by("o_orderkey", key).alias("last_order"))


@query()
def agg_approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"))


@query("SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1 HAVING count(*) > (SELECT count(*) / (SELECT count(*) FROM supplier) FROM lineitem)")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    mean = li.agg(F.count("*").alias("c")).crossJoin(table(spark, sf_dir, "supplier").agg(F.count("*").alias("s"))).select((F.col("c") / F.col("s")).alias("mean"))
    per = li.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return per.crossJoin(F.broadcast(mean)).where("n > mean").drop("mean")


# windows; the partitions are orders, or groups that were aggregated first


@query(
    "SELECT l_orderkey, l_linenumber, row_number() OVER w AS rn, rank() OVER v AS rk, dense_rank() OVER v AS dr, round(percent_rank() OVER v, 6) AS pr, round(cume_dist() OVER v, 6) AS cd "
    "FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey), v AS (PARTITION BY l_orderkey ORDER BY l_quantity)"
)
def win_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey")
    v = Window.partitionBy("l_orderkey").orderBy("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.row_number().over(w).alias("rn"), F.rank().over(v).alias("rk"), F.dense_rank().over(v).alias("dr"),
        F.round(F.percent_rank().over(v), 6).alias("pr"), F.round(F.cume_dist().over(v), 6).alias("cd"),
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, lag(l_extendedprice, 1, 0.0) OVER w AS before, lead(l_extendedprice) OVER w AS after FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)")
def win_lag_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lag("l_extendedprice", 1, 0.0).over(w).alias("before"), F.lead("l_extendedprice").over(w).alias("after")
    )


@query("SELECT l_suppkey, n, ntile(4) OVER (ORDER BY n, l_suppkey) AS quartile FROM (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1)")
def win_ntile_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of suppliers by lines, from their places in sorted ranges, not from one sorted task."""
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey", "left_semi")
    per = li.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    ordered = positions(per, "n", "l_suppkey").withColumnRenamed("position", "pos")
    placed = ordered.crossJoin(F.broadcast(per.agg(F.count("*").alias("total"))))
    size, rest = F.floor(F.col("total") / 4), F.col("total") % 4
    cut = rest * (size + 1)
    quartile = F.when(F.col("pos") < cut, F.floor(F.col("pos") / (size + 1)) + 1).otherwise(rest + F.floor((F.col("pos") - cut) / F.greatest(size, F.lit(1))) + 1)
    return placed.select("l_suppkey", "n", quartile.cast("long").alias("quartile"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(ntile(2) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT) AS half FROM lineitem")
def win_ntile(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.ntile(2).over(w).alias("half"))


@query("SELECT p_partkey AS id, p_size AS size FROM part")
def rel_frame_verbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by pattern, new names, ranges sorted inside."""
    part = table(spark, sf_dir, "part")
    return part.select(part.colRegex("`p_(partkey|size)`")).toDF("id", "size").repartitionByRange("id").sortWithinPartitions("id")


@query(
    "SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS summary, unnest([count(l_quantity)::DOUBLE, round(avg(l_quantity), 5), round(stddev_samp(l_quantity), 5), min(l_quantity)::DOUBLE, max(l_quantity)::DOUBLE]) AS quantity, "
    "unnest([count(l_tax)::DOUBLE, round(avg(l_tax), 5), round(stddev_samp(l_tax), 5), min(l_tax)::DOUBLE, max(l_tax)::DOUBLE]) AS tax FROM lineitem"
)
def stat_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = table(spark, sf_dir, "lineitem").describe("l_quantity", "l_tax")
    return shown.select("summary", *[F.round(F.col(f"l_{c}").cast("double"), 5).alias(c) for c in ("quantity", "tax")])


@query("SELECT unnest(['count', 'min', 'max']) AS summary, unnest([count(o_totalprice)::DOUBLE, round(min(o_totalprice), 5), round(max(o_totalprice), 5)]) AS price FROM orders")
def stat_summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = table(spark, sf_dir, "orders").select("o_totalprice").summary("count", "min", "max")
    return shown.select("summary", F.round(F.col("o_totalprice").cast("double"), 5).alias("price"))


@query("SELECT round(covar_samp(l_quantity, l_extendedprice), 3) AS covariance FROM lineitem")
def stat_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "lineitem").stat.cov("l_quantity", "l_extendedprice")
    return spark.createDataFrame([(found,)], "covariance double").select(F.round("covariance", 3).alias("covariance"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(avg(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving FROM lineitem")
def win_rows_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey").rowsBetween(-2, Window.currentRow)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", r6(F.avg("l_quantity").over(w)).alias("moving"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS around FROM lineitem")
def win_range_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rangeBetween(-1, 1)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.sum("l_quantity").over(w).alias("around"))


@query("SELECT status, month, n, CAST(sum(n) OVER (PARTITION BY status ORDER BY month) AS BIGINT) AS running FROM (SELECT o_orderstatus AS status, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1, 2)")
def win_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("status").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.withColumn("running", F.sum("n").over(w))

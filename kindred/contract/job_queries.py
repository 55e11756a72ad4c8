"""Graphs, logs, skew, metrics, statistics, matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kindred.contract.registry import query
from kindred.operators import graph, matrix, statistics as st
from kindred.operators.joins import salted_join, salted_sum
from kindred.session import materialise
from kindred.sources.articles import table

ITERATIONS = 5


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1")
def job_wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query("SELECT l_partkey, l_orderkey FROM lineitem ORDER BY l_partkey, l_orderkey")
def job_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey").orderBy("l_partkey", "l_orderkey")


def _line():
    """Access-log lines made from events; cheap events give a broken line."""
    user = F.col("user_id").cast("string")
    good = F.concat(
        F.lit("10.0.0."), user, F.lit(" - u"), user, F.lit(" ["), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit('] "GET /'),
        F.col("event_type"), F.lit(' HTTP/1.1" 200 '), F.floor(F.col("value") * 100).cast("string"),
    )
    return F.when(F.col("value") >= 1, good).otherwise(F.concat(F.lit("broken "), user))


LOG = r'^(\S+) \S+ (\S+) \[([^\]]+)\] "([^"]*)" (\d{3}) (\d+)$'


@query(
    "SELECT CASE WHEN value >= 1 THEN '10.0.0.' || user_id END AS ip, CASE WHEN value >= 1 THEN 'u' || user_id END AS login, CASE WHEN value >= 1 THEN 'GET /' || event_type || ' HTTP/1.1' END AS request, "
    "count(*) AS n, CAST(sum(CASE WHEN value >= 1 THEN CAST(floor(value * 100) AS BIGINT) END) AS BIGINT) AS bytes FROM events GROUP BY 1, 2, 3"
)
def job_log_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").select(_line().alias("line"))

    def part(i: int):
        return F.nullif(F.regexp_extract("line", LOG, i), F.lit(""))

    parsed = lines.select(part(1).alias("ip"), part(2).alias("login"), part(4).alias("request"), part(6).cast("long").alias("size"))
    return parsed.groupBy("ip", "login", "request").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


@query("SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def job_skewed_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_orderkey", "l_linenumber")
    return salted_sum(li, "l_returnflag", "l_quantity")


@query("SELECT n_name, round(sum(c_acctbal), 2) AS total, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def job_skewed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "key")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    return salted_join(c, n, "key").groupBy("n_name").agg(F.round(F.sum("c_acctbal"), 2).alias("total"), F.count("*").alias("n"))


# graphs: accounts (customers and suppliers share one id space) linked by purchases


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey).select(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()


ACCOUNTS = "links AS (SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"


def _pagerank_sql(edges: str) -> str:
    ctes = [edges, "shares AS (SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM links)", "r0 AS (SELECT DISTINCT src AS id, 1.0::DOUBLE AS rank FROM links)"]
    for i in range(ITERATIONS):
        ctes.append(f"r{i + 1} AS (SELECT dst AS id, 0.15 + 0.85 * sum(rank * share) AS rank FROM shares JOIN r{i} ON id = src GROUP BY dst)")
    return "WITH " + ",\n".join(ctes) + "\n"


@query(_pagerank_sql(ACCOUNTS) + f"SELECT id, round(rank, 5) AS rank FROM r{ITERATIONS}")
def graph_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.pagerank(_accounts(spark, sf_dir), ITERATIONS).select("id", F.round("rank", 5).alias("rank"))


def _converged_sql(tolerance: float, rounds: int = 100) -> str:
    """Ranks of the first fifth, tenth, ... round in which no rank moved by ``tolerance``."""
    ctes = [
        ACCOUNTS, "shares AS (SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM links)",
        "kept AS MATERIALIZED (SELECT * FROM shares UNION ALL SELECT DISTINCT id, id, 0.0::DOUBLE FROM (SELECT unnest([src, dst]) AS id FROM links))",
        "r0 AS (SELECT DISTINCT src AS id, 0.15::DOUBLE AS rank FROM kept)",
    ]
    for i in range(rounds):
        ctes.append(f"r{i + 1} AS MATERIALIZED (SELECT dst AS id, 0.15 + 0.85 * sum(rank * share) AS rank FROM kept JOIN r{i} ON id = src GROUP BY dst)")
    tested = range(graph.CHAINED, rounds + 1, graph.CHAINED)
    moved = " UNION ALL ".join(f"SELECT {i} AS i, max(abs(a.rank - b.rank)) AS m FROM r{i} a JOIN r{i - 1} b USING (id)" for i in tested)
    ranks = " UNION ALL ".join(f"SELECT {i} AS i, id, rank FROM r{i}" for i in tested)
    ctes.append(f"stop AS (SELECT min(i) AS i FROM ({moved}) WHERE m < {tolerance})")
    return "WITH " + ",\n".join(ctes) + f" SELECT c_name, round(rank, 3) AS rank FROM ({ranks}) JOIN stop USING (i) JOIN customer ON c_custkey = id"


@query(_converged_sql(0.0001))
def graph_pagerank_tol(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = graph.pagerank_until(_accounts(spark, sf_dir), 0.0001)
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return ranks.join(names, "id").select("c_name", F.round("rank", 3).alias("rank"))


_LOCAL = "links AS (SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer a ON a.c_custkey = o_custkey JOIN customer b ON b.c_custkey = l_suppkey WHERE a.c_acctbal > 0 AND b.c_acctbal > 0)"


@query(_pagerank_sql(_LOCAL) + f"SELECT c_name, round(rank, 5) AS rank FROM (SELECT * FROM r{ITERATIONS} ORDER BY round(rank, 5) DESC, id LIMIT 5) JOIN customer ON c_custkey = id")
def graph_filtered_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best five accounts of the graph among customers with a positive balance."""
    solvent = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), "c_name")
    links = _accounts(spark, sf_dir)
    kept = links.join(solvent, links.src == solvent.id, "left_semi").join(solvent, links.dst == solvent.id, "left_semi")
    ranks = graph.pagerank(kept, ITERATIONS).withColumn("rank", F.round("rank", 5))
    best = ranks.orderBy(F.desc("rank"), "id").limit(5)
    return best.join(solvent, "id").select("c_name", "rank")


_TRADE = (
    "trade AS (SELECT c_nationkey AS src, s_nationkey AS dst, sum(l_extendedprice) AS v FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey "
    "JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2), links AS (SELECT src, dst FROM trade)"
)


@query(f"WITH RECURSIVE {_TRADE}, tc AS (SELECT src, dst FROM links UNION SELECT tc.src, links.dst FROM tc JOIN links ON tc.dst = links.src) SELECT src, dst FROM tc")
def graph_transitive_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of trade between nations."""
    o, li, c, s = (table(spark, sf_dir, n) for n in ("orders", "lineitem", "customer", "supplier"))
    sold = li.join(o, li.l_orderkey == o.o_orderkey).join(c, c.c_custkey == o.o_custkey).join(s, s.s_suppkey == li.l_suppkey)
    trade = materialise(sold.groupBy(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).agg(F.sum("l_extendedprice").alias("v")))
    return graph.transitive_closure(trade.select("src", "dst"))


# a second graph: parts (even ids) and suppliers (odd ids) linked by the lines that sell one of the other


def _deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"), F.col("l_linenumber").cast("double").alias("weight"))


_DEALS = "deals AS (SELECT l_partkey * 2 AS src, l_suppkey * 2 + 1 AS dst, CAST(l_linenumber AS DOUBLE) AS weight FROM lineitem), both_ways AS (SELECT src, dst, weight FROM deals UNION SELECT dst, src, weight FROM deals)"


def _components_sql(rounds: int = 16) -> str:
    ctes = [_DEALS, "c0 AS (SELECT DISTINCT src AS id, src AS c FROM both_ways)"]
    for i in range(rounds):
        ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT id, min(c) AS c FROM (SELECT id, c FROM c{i} UNION ALL SELECT dst, c FROM c{i} JOIN both_ways ON src = id) GROUP BY id)")
    return "WITH " + ", ".join(ctes) + f" SELECT id, c AS component FROM c{rounds}"


@query(_components_sql())
def graph_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.components(_deals(spark, sf_dir))


def _sssp_sql(rounds: int = 40) -> str:
    ctes = [_DEALS, "d0 AS (SELECT src AS id, 0.0::DOUBLE AS d FROM both_ways GROUP BY src ORDER BY count(*) DESC, src LIMIT 1)"]
    for i in range(rounds):
        ctes.append(
            f"d{i + 1} AS MATERIALIZED (SELECT id, min(d) AS d FROM (SELECT id, d FROM d{i} UNION ALL SELECT dst, d + weight FROM d{i} JOIN both_ways ON src = id) GROUP BY id)"
        )
    return "WITH " + ", ".join(ctes) + f" SELECT id, d AS distance FROM d{rounds}"


@query(_sssp_sql())
def graph_sssp(spark: SparkSession, sf_dir: str) -> DataFrame:
    deals = _deals(spark, sf_dir)
    both = materialise(deals.union(deals.select("dst", "src", "weight")).distinct())
    busiest = both.groupBy("src").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "src").first()
    return graph.shortest_paths(both, busiest.src)


@query(
    f"WITH {ACCOUNTS}, p AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM links WHERE src <> dst), "
    "t AS (SELECT x.a, x.b, z.b AS c FROM p x JOIN p y ON x.b = y.a JOIN p z ON z.a = x.a AND z.b = y.b) "
    "SELECT id, count(*) AS n FROM (SELECT unnest([a, b, c]) AS id FROM t) GROUP BY id"
)
def graph_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.triangles(_accounts(spark, sf_dir))


@query(f"WITH {ACCOUNTS} SELECT dst AS id, count(*) AS n, round(avg(a.c_acctbal), 4) AS mean FROM links JOIN customer a ON a.c_custkey = src JOIN customer b ON b.c_custkey = dst WHERE a.c_acctbal > b.c_acctbal GROUP BY dst")
def graph_neighbor_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"))
    return graph.neighbour_average(_accounts(spark, sf_dir), vertices).withColumn("mean", F.round("mean", 4))


# metrics


_RANKED = (
    "t AS (SELECT user_id, event_type, sum(value) AS score, count(*) AS n FROM events GROUP BY 1, 2), m AS (SELECT user_id, avg(n) AS mean FROM t GROUP BY 1), "
    "r AS (SELECT t.*, n > mean AS hit, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type) AS rank FROM t JOIN m USING (user_id)), "
    "h AS (SELECT *, CAST(sum(CAST(hit AS INT)) OVER (PARTITION BY user_id ORDER BY rank) AS DOUBLE) AS hits, CAST(sum(CAST(hit AS INT)) OVER (PARTITION BY user_id) AS BIGINT) AS total FROM r)"
)


@query(
    f"WITH {_RANKED}, u AS (SELECT user_id, sum(CAST(hit AS INT)) FILTER (rank <= 2) / 2 AS p2, sum(CASE WHEN hit THEN hits / rank ELSE 0 END) / any_value(total) AS ap, "
    "sum(CASE WHEN hit AND rank <= 3 THEN 1 / log2(rank + 1) ELSE 0 END) / sum(CASE WHEN rank <= least(3, total) THEN 1 / log2(rank + 1) ELSE 0 END) AS ndcg FROM h WHERE total > 0 GROUP BY user_id) "
    "SELECT count(*) AS users, round(avg(p2), 6) AS precision_2, round(avg(ap), 6) AS map, round(avg(ndcg), 6) AS ndcg_3 FROM u"
)
def metric_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of a user ranked by value; those above the mean count of the user are relevant."""
    totals = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("score"), F.count("*").alias("n"))
    user = Window.partitionBy("user_id")
    ranked = user.orderBy(F.desc("score"), "event_type")
    r = totals.withColumn("hit", (F.col("n") > F.avg("n").over(user)).cast("int")).withColumn("rank", F.row_number().over(ranked))
    r = r.withColumn("hits", F.sum("hit").over(user.orderBy("rank"))).withColumn("total", F.sum("hit").over(user)).where("total > 0")
    gain = 1 / F.log2(F.col("rank") + 1)
    per = r.groupBy("user_id").agg(
        (F.sum(F.when(F.col("rank") <= 2, F.col("hit")).otherwise(0)) / 2).alias("p2"),
        (F.sum(F.col("hit") * F.col("hits") / F.col("rank")) / F.max("total")).alias("ap"),
        (F.sum(F.when(F.col("rank") <= 3, F.col("hit") * gain).otherwise(0)) / F.sum(F.when(F.col("rank") <= F.least(F.lit(3), "total"), gain).otherwise(0))).alias("ndcg"),
    )
    return per.agg(F.count("*").alias("users"), F.round(F.avg("p2"), 6).alias("precision_2"), F.round(F.avg("ap"), 6).alias("map"), F.round(F.avg("ndcg"), 6).alias("ndcg_3"))


@query(
    "WITH p AS (SELECT quality AS label, n_chars, CAST(n_chars > 1000 AS INT) AS prediction FROM documents JOIN labels USING (doc_id)), "
    "r AS (SELECT label, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS rk FROM p), "
    "a AS (SELECT (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc FROM r) "
    "SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn, "
    "count(*) FILTER (label = 0 AND prediction = 0) AS tn, round(count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (prediction = 1), 6) AS prec, "
    "round(count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1), 6) AS recall, round(any_value(auc), 6) AS auc FROM p, a"
)
def metric_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality predicted from the length of a text."""
    p = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(F.col("quality").alias("label"), "n_chars")
    per_value = p.groupBy("n_chars").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    curve = st.cumulative(per_value, "n_chars", "pos", "neg")
    good, yes = F.col("label") == 1, F.col("n_chars") > 1000

    def count(c):
        return F.sum(c.cast("long"))

    cells = p.agg(count(good & yes).alias("tp"), count(~good & yes).alias("fp"), count(good & ~yes).alias("fn"), count(~good & ~yes).alias("tn"))
    area = curve.agg((F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)) / (F.sum("pos") * F.sum("neg"))).alias("auc"))
    return cells.crossJoin(F.broadcast(area)).select(
        "tp", "fp", "fn", "tn", F.round(F.col("tp") / (F.col("tp") + F.col("fp")), 6).alias("prec"), F.round(F.col("tp") / (F.col("tp") + F.col("fn")), 6).alias("recall"), F.round("auc", 6).alias("auc")
    )


@query(
    "SELECT round(sqrt(avg(power(y - p, 2))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, round(1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)), 6) AS r2 "
    "FROM (SELECT l_extendedprice AS y, l_quantity * p_retailprice AS p FROM lineitem JOIN part ON p_partkey = l_partkey)"
)
def metric_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    y, p = F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice")
    joined = li.join(part, li.l_partkey == part.p_partkey).select(y.alias("y"), (y - p).alias("e"))
    square = F.sum(F.col("e") * F.col("e"))
    return joined.agg(
        F.round(F.sqrt(square / F.count("*")), 4).alias("rmse"), F.round(F.avg(F.abs("e")), 4).alias("mae"), F.round(1 - square / (F.var_pop("y") * F.count("*")), 6).alias("r2")
    )


# statistics


@query(
    "WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS rx, "
    "rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS ry FROM lineitem) "
    "SELECT count(*) AS n, round(avg(x), 6) AS mean, round(var_samp(x), 6) AS variance, min(x) AS low, max(x) AS high, count(*) FILTER (x <> 0) AS nonzero, round(sqrt(sum(x * x)), 4) AS l2, "
    "round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM r"
)
def stat_summary_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    rx, ry = st.ranks(li, "x", "rx"), st.ranks(li, "y", "ry")
    x = F.col("x")
    return li.join(rx, "x").join(ry, "y").agg(
        F.count("*").alias("n"), F.round(F.avg(x), 6).alias("mean"), F.round(F.var_samp(x), 6).alias("variance"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.count(F.when(x != 0, 1)).alias("nonzero"), F.round(F.sqrt(F.sum(x * x)), 4).alias("l2"), F.round(F.corr("x", "y"), 6).alias("pearson"), F.round(F.corr("rx", "ry"), 6).alias("spearman"),
    )


@query(
    "WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS o FROM lineitem GROUP BY 1, 2), e AS (SELECT *, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM c) "
    "SELECT round(sum(power(o - e, 2) / e), 6) AS statistic, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS freedom FROM e"
)
def stat_chi_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b")).agg(F.count("*").alias("o"))
    a, b = cells.groupBy("a").agg(F.sum("o").alias("ra")), cells.groupBy("b").agg(F.sum("o").alias("cb"))
    total = cells.agg(F.sum("o").alias("all"))
    joined = cells.join(a, "a").join(b, "b").crossJoin(F.broadcast(total)).withColumn("e", F.col("ra") * F.col("cb") / F.col("all"))
    gap = F.col("o") - F.col("e")
    return joined.agg(F.round(F.sum(gap * gap / F.col("e")), 6).alias("statistic"), ((F.count_distinct("a") - 1) * (F.count_distinct("b") - 1)).alias("freedom"))


@query(
    "WITH m AS (SELECT avg(value) AS mean, count(*) AS n FROM events), f AS (SELECT value, rank() OVER (ORDER BY value) - 1 AS below, count(*) OVER (PARTITION BY value) AS here FROM events) "
    "SELECT round(max(greatest(abs(1 - exp(-value / mean) - CAST(below AS DOUBLE) / n), abs(CAST(below + here AS DOUBLE) / n - (1 - exp(-value / mean))))), 6) AS statistic FROM f, m"
)
def stat_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of the event values from an exponential distribution with their mean."""
    events = table(spark, sf_dir, "events").select("value", F.lit(1).alias("n"))
    steps = st.cumulative(events, "value", "n")
    moments = events.agg(F.avg("value").alias("mean"), F.count("*").alias("total"))
    cdf = 1 - F.exp(-F.col("value") / F.col("mean"))
    gap = F.greatest(F.abs(cdf - F.col("before_n") / F.col("total")), F.abs((F.col("before_n") + F.col("n")) / F.col("total") - cdf))
    return steps.crossJoin(F.broadcast(moments)).agg(F.round(F.max(gap), 6).alias("statistic"))


POINTS = (1.0, 5.0, 10.0, 50.0, 100.0)


@query(
    "SELECT point, round(sum(exp(-power((point - value) / 3.0, 2) / 2)) / (count(*) * 3.0 * sqrt(2 * pi())), 8) AS density FROM events, (SELECT unnest([1.0, 5.0, 10.0, 50.0, 100.0])::DOUBLE AS point) GROUP BY point"
)
def stat_kernel_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaussian density at some points, all in one aggregation of the sample."""
    scaled = [(p, (F.lit(p) - F.col("value")) / 3.0) for p in POINTS]
    cells = [
        F.struct(F.lit(p).alias("point"), F.round(F.sum(F.exp(-z * z / 2)) / (F.count("*") * 3.0 * F.sqrt(2 * F.pi())), 8).alias("density"))
        for p, z in scaled
    ]
    return table(spark, sf_dir, "events").agg(F.array(*cells).alias("c")).select(F.inline("c"))


@query()
def gen_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random columns beside the rows of a table: uniform, normal, log-normal, exponential."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.rand(11).alias("u"), F.randn(12).alias("z"))
    return rows.groupBy("l_returnflag").agg(
        F.avg("u").alias("uniform"), F.avg("z").alias("normal"), F.avg(F.exp("z")).alias("lognormal"), F.avg(-F.log(1 - F.col("u"))).alias("exponential")
    )


_GRAM = "v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), g AS (SELECT a.i, b.i AS j, sum(a.x * b.x) AS g FROM v a JOIN v b USING (vec_id) GROUP BY 1, 2)"


@query(f"WITH {_GRAM} SELECT i, j, round(g, 5) AS g FROM g")
def matrix_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = st.gram(table(spark, sf_dir, "embeddings"), "embedding", 64)
    return rows.select("i", F.posexplode("row").alias("j", "g")).withColumn("g", F.round("g", 5))


@query(f"WITH {_GRAM} SELECT g.i, g.j, round(g.g / sqrt(x.g * y.g), 5) AS cosine FROM g JOIN g x ON x.i = g.i AND x.j = g.i JOIN g y ON y.i = g.j AND y.j = g.j WHERE g.i < g.j")
def job_column_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(st.gram(table(spark, sf_dir, "embeddings"), "embedding", 64))
    return st.column_cosines(rows).withColumn("cosine", F.round("cosine", 5))


@query()
def matrix_svd(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = st.singular_values(st.gram(table(spark, sf_dir, "embeddings"), "embedding", 64), 5)
    return spark.createDataFrame(list(enumerate(values)), "k int, value double")


def _cells(spark: SparkSession, matrix, name: str) -> DataFrame:
    """A small matrix as ``(i, j, name)``."""
    return spark.createDataFrame([(i, j, float(x)) for i, row in enumerate(matrix) for j, x in enumerate(row)], f"i int, j int, {name} double")


@query(f"WITH {_GRAM} SELECT i, j, round(g, 5) AS g FROM g")
def matrix_qr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R of the QR factors of the embeddings, shown by its transpose times itself, which is the Gram matrix."""
    r = matrix.r_factor(table(spark, sf_dir, "embeddings"), "embedding", 64)
    return _cells(spark, r.T @ r, "g").withColumn("g", F.round("g", 5))


@query("SELECT a.range::INTEGER AS i, b.range::INTEGER AS j, CASE WHEN a.range = b.range THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS g FROM range(64) a, range(64) b")
def matrix_q_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of Q are perpendicular and of length one."""
    q_rows, _ = matrix.tall_qr(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    rows = st.gram(q_rows, "q", 64).select("i", F.posexplode("row").alias("j", "g"))
    return rows.withColumn("g", F.round(F.col("g"), 6) + F.lit(0.0))


@query("SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INTEGER AS i, round(unnest(embedding)::DOUBLE, 4) AS x FROM embeddings")
def matrix_singular_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left vectors, values and right vectors multiplied together are the embeddings again."""
    left, values, right = matrix.svd(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64, 64)
    back = matrix.times(left, "vec_id", "u", (right * values).T, "row")
    return back.select("vec_id", F.posexplode("row").alias("i", "x")).withColumn("x", F.round("x", 4))


@query(
    "WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) "
    "SELECT a.i::INTEGER AS i, b.i::INTEGER AS j, round(covar_samp(a.x, b.x), 8) AS cov FROM v a JOIN v b USING (vec_id) GROUP BY 1, 2"
)
def matrix_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, matrix.covariance(table(spark, sf_dir, "embeddings"), "embedding", 64), "cov").withColumn("cov", F.round("cov", 8))


@query(
    "WITH v AS (SELECT unnest([l_quantity / 50, l_extendedprice / 100000, l_discount * 10, l_tax * 12, l_linenumber / 7])::DOUBLE AS x, unnest(range(5)) AS i, r FROM (SELECT *, row_number() OVER () AS r FROM lineitem)), "
    "g AS (SELECT a.i, b.i AS j, sum(a.x * b.x) AS g FROM v a JOIN v b USING (r) GROUP BY 1, 2) "
    "SELECT g.i::INTEGER AS i, g.j::INTEGER AS j, round(g.g / sqrt(x.g * y.g), 5) AS cosine, TRUE AS close, TRUE AS sampled FROM g JOIN g x ON x.i = g.i AND x.j = g.i JOIN g y ON y.i = g.j AND y.j = g.j WHERE g.i < g.j"
)
def job_column_cosine_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarities of columns of the lines from a sample of the products: each within a tenth of the exact value, with fewer products than rows."""
    columns = F.array(F.col("l_quantity") / 50, F.col("l_extendedprice") / 100000, F.col("l_discount") * 10, F.col("l_tax") * 12, F.col("l_linenumber") / 7)
    lines = table(spark, sf_dir, "lineitem").select(F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("key"), columns.alias("row"))
    exact = st.column_cosines(materialise(st.gram(lines, "row", 5)))
    estimate = matrix.sampled_column_cosines(lines, "key", "row", 5, 0.01, seed=1).withColumnRenamed("cosine", "estimate")
    close = F.abs(F.col("estimate") - F.col("cosine")) <= 0.1
    return exact.join(estimate, ["i", "j"]).select("i", "j", F.round("cosine", 5).alias("cosine"), close.alias("close"), (F.col("products") < lines.count()).alias("sampled"))


_BASKET = "b AS (SELECT DISTINCT l_orderkey AS o, p_type AS t FROM lineitem JOIN part ON p_partkey = l_partkey)"


@query(
    f"WITH {_BASKET}, s AS (SELECT t, count(*) AS n FROM b GROUP BY 1), p AS (SELECT x.t AS a, y.t AS c, count(*) AS n FROM b x JOIN b y ON x.o = y.o AND x.t <> y.t GROUP BY 1, 2) "
    "SELECT p.a AS antecedent, p.c AS consequent, p.n, round(p.n / s.n, 6) AS confidence FROM p JOIN s ON s.t = p.a WHERE p.n / s.n >= 0.5"
)
def job_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules between part types of an order; an order has a handful of lines."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    baskets = li.join(part, li.l_partkey == part.p_partkey).groupBy("l_orderkey").agg(F.collect_set("p_type").alias("types"))
    baskets = materialise(baskets)
    single = baskets.select(F.explode("types").alias("antecedent")).groupBy("antecedent").agg(F.count("*").alias("base"))
    pairs = baskets.select(F.explode("types").alias("antecedent"), "types").select("antecedent", F.explode("types").alias("consequent"))
    counted = pairs.where("antecedent <> consequent").groupBy("antecedent", "consequent").agg(F.count("*").alias("n"))
    confidence = F.col("n") / F.col("base")
    return counted.join(single, "antecedent").where(confidence >= 0.5).select("antecedent", "consequent", "n", F.round(confidence, 6).alias("confidence"))

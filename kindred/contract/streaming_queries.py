"""Streaming jobs, run over files to their end so that batch SQL can check them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.contract import sqltext as q
from kindred.contract.registry import query
from kindred.operators.keywords import postings
from kindred.session import materialise, work_dir
from kindred.sources.articles import table
from kindred.streaming import jobs, state
from kindred.streaming.models import logistic, nearest, stream_kmeans, stream_logistic
from kindred.streaming.runs import run_append, run_batches, run_complete, stream, stream_files, stream_table
from kindred.streaming.sinks import run_rows

_WORDS = "(SELECT unnest(list_filter(regexp_split_to_array(lower({t}.text), '[^a-z]+'), lambda w: w <> '')) AS word FROM {t})"


def words_sql(name: str) -> str:
    return _WORDS.format(t=name)


def stamp(c: str):
    """A time as UTC text, whatever the session time zone is."""
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm")


@query(f"SELECT word, count(*) AS n FROM {words_sql('conversations')} GROUP BY 1")
def st_wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_complete(jobs.word_counts(stream_table(spark, sf_dir, "conversations")))


def _register_sources() -> None:
    for fmt, options in (("json", {}), ("csv", {"header": True}), ("orc", {})):
        def source(spark: SparkSession, sf_dir: str, fmt: str = fmt, options: dict = options) -> DataFrame:
            rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
            return run_append(stream_files(rows, fmt, **options).where("event_type = 'click'"))

        source.__name__ = f"st_source_{fmt}"
        query("SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")(source)


_register_sources()


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def st_source_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("value"))
    return run_complete(stream_files(rows, "text").groupBy("value").agg(F.count("*").alias("n")))


@query("SELECT event_id, value, event_type FROM events WHERE event_type <> 'error'")
def st_sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per event type; the errors' folder is left out by its name."""
    found = run_append(stream_table(spark, sf_dir, "events").select("event_id", "value", "event_type"), partition_by=["event_type"])
    return found.where("event_type <> 'error'")


def _events(spark: SparkSession, sf_dir: str, delay: str = "1 hour") -> DataFrame:
    return jobs.timed(stream_table(spark, sf_dir, "events"), delay)


_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query(
    "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, event_type, n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, event_type, count(*) AS n FROM events GROUP BY 1, 2) "
    f"WHERE s + INTERVAL 1 HOUR <= {_CLOSED}"
)
def st_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_append(jobs.window_counts(_events(spark, sf_dir), "1 hour", None, "event_type"))
    return found.withColumn("start", stamp("start"))


def _sliding_sql(size: int, slide: int, keys: str = "") -> str:
    cols = f", {keys}" if keys else ""
    return (
        f"SELECT strftime(s, '%Y-%m-%d %H:%M') AS start{cols}, count(*) AS n FROM (SELECT *, unnest(list_transform(range(0, {size // slide}), "
        f"lambda i: time_bucket(INTERVAL {slide} MINUTE, ts) - i * INTERVAL {slide} MINUTE)) AS s FROM events) WHERE s + INTERVAL {size} MINUTE <= {_CLOSED} GROUP BY s{cols}"
    )


@query(_sliding_sql(120, 30, "event_type"))
def st_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_append(jobs.window_counts(_events(spark, sf_dir), "2 hours", "30 minutes", "event_type"))
    return found.withColumn("start", stamp("start"))


@query(
    "SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M') AS start, strftime(max(ts) + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M') AS \"end\", count(*) AS n FROM ("
    "SELECT *, sum(CAST(gap AS INT)) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 3 HOUR, true) AS gap FROM events)) "
    f"GROUP BY user_id, s HAVING max(ts) + INTERVAL 3 HOUR <= {_CLOSED}"
)
def st_session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_append(jobs.sessions(_events(spark, sf_dir), "user_id", "3 hours"))
    return found.withColumn("start", stamp("start")).withColumn("end", stamp("end"))


@query(
    "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, n FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS s, count(*) AS n FROM events WHERE event_type <> 'error' "
    "OR time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY > (SELECT max(ts) - INTERVAL 10 DAY FROM events WHERE event_type <> 'error') GROUP BY 1) "
    "WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 DAY FROM events)"
)
def st_watermark_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors arrive in a second run: those of windows behind the watermark are dropped, the others count.

    Both runs share a checkpoint, so the second one continues where the first one stopped.
    """
    folder, out, checkpoint = work_dir(spark), work_dir(spark), work_dir(spark)
    events = table(spark, sf_dir, "events")

    def daily() -> DataFrame:
        return jobs.window_counts(jobs.timed(stream(spark, folder), "10 days"), "1 day", None)

    events.where("event_type <> 'error'").write.mode("append").parquet(folder)
    run_append(daily(), out, checkpoint)
    events.where("event_type = 'error'").write.mode("append").parquet(folder)
    return run_append(daily(), out, checkpoint).withColumn("start", stamp("start"))


@query("SELECT DISTINCT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M') AS start, user_id, event_type FROM events")
def st_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_append(jobs.first_per_window(_events(spark, sf_dir), "1 day", "user_id", "event_type"))
    return found.select(stamp("w.start").alias("start"), "user_id", "event_type")


_SENTIMENT = (
    "sentiment AS (SELECT word, CAST(sum(2 * quality - 1) AS BIGINT) AS score FROM (SELECT doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w <> ''))) AS word "
    "FROM documents) JOIN labels USING (doc_id) GROUP BY 1)"
)


def _sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(word, score)``: labelled documents vote for their words."""
    seen = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("word"))
    votes = seen.where("word <> ''").join(table(spark, sf_dir, "labels"), "doc_id")
    return materialise(votes.groupBy("word").agg(F.sum(2 * F.col("quality") - 1).alias("score")))


@query(f"WITH {_SENTIMENT} SELECT word, score, n, score * n AS weighted FROM (SELECT word, count(*) AS n FROM {words_sql('conversations')} GROUP BY 1) JOIN sentiment USING (word)")
def st_stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = jobs.words(stream_table(spark, sf_dir, "conversations"))
    counts = words.join(_sentiment(spark, sf_dir), "word").groupBy("word", "score").agg(F.count("*").alias("n"))
    return run_complete(counts).withColumn("weighted", F.col("score") * F.col("n")).orderBy(F.desc("weighted"), "word")


def _causes(spark: SparkSession, sf_dir: str):
    events = _events(spark, sf_dir)
    return events.where("event_type = 'error'"), _events(spark, sf_dir).where("event_type = 'purchase'")


@query(
    "SELECT a.event_id AS cause_id, b.event_id AS effect_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR "
    "WHERE a.event_type = 'error' AND b.event_type = 'purchase'"
)
def st_stream_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_append(jobs.follow_ups(*_causes(spark, sf_dir), "1 HOUR"))


@query(
    "WITH a AS (SELECT * FROM events WHERE event_type = 'error'), b AS (SELECT * FROM events WHERE event_type = 'purchase'), "
    "closed AS (SELECT least((SELECT max(ts) FROM a), (SELECT max(ts) FROM b)) - INTERVAL 2 HOUR AS t) "
    "SELECT a.event_id AS cause_id, b.event_id AS effect_id FROM a LEFT JOIN b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR "
    "WHERE b.event_id IS NOT NULL OR a.ts < (SELECT t FROM closed)"
)
def st_stream_stream_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Causes without an effect come out once the watermark passes their time span."""
    return run_append(jobs.follow_ups(*_causes(spark, sf_dir), "1 HOUR", "left"))


@query(f"SELECT word, count(*) AS n FROM (SELECT * FROM {words_sql('benchmark')} UNION ALL SELECT * FROM {words_sql('conversations')}) GROUP BY 1")
def st_stateful_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals whose state starts from the counts of a batch table."""
    seed = materialise(jobs.word_counts(table(spark, sf_dir, "benchmark")))
    out = work_dir(spark)
    with state.own_state(spark):
        totals = state.running_totals(jobs.words(stream_table(spark, sf_dir, "conversations")), seed)
        run_batches(totals, "update", lambda batch, _: batch.write.mode("append").parquet(out))
    # totals only grow; words that the stream has not brought keep their seed
    return spark.read.schema(totals.schema).parquet(out).unionByName(seed.select("word", "n")).groupBy("word").agg(F.max("n").alias("n"))


@query(
    "SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M') AS start, count(*) AS n, (epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000) // 1000 AS seconds FROM ("
    "SELECT *, sum(CAST(gap AS INT)) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 3 HOUR, true) AS gap FROM events)) "
    f"GROUP BY user_id, s HAVING max(ts) + INTERVAL 3 HOUR <= {_CLOSED}"
)
def st_timed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions kept as own state and closed by timers on event time."""
    with state.own_state(spark):
        found = run_append(state.closed_sessions(_events(spark, sf_dir), 3 * 3_600_000))
    utc = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_millis("start").cast("timestamp_ntz")), "yyyy-MM-dd HH:mm")
    return found.select("user_id", utc.alias("start"), "n", F.floor((F.col("last") - F.col("start")) / 1000).alias("seconds"))


@query("SELECT event_id, event_type, value FROM events WHERE value > 10")
def st_foreach_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row by row into a sink of our own that takes every partition of a batch once."""
    out = work_dir(spark)
    run_rows(stream_table(spark, sf_dir, "events").where("value > 10").select("event_id", "event_type", "value"), out)
    return spark.read.schema("event_id long, event_type string, value double").json(f"{out}/*.json")


@query("SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def st_update_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own state per user and day, kept by Spark between batches until the watermark passes the day."""

    events = _events(spark, sf_dir).select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", "ts")
    totals = state.daily_totals(events)
    out = work_dir(spark)
    run_batches(totals, "update", lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out))
    newest = spark.read.parquet(out).groupBy("user_id", "day").agg(F.max_by(F.struct("n", "total"), "batch").alias("s"))
    return newest.select("user_id", "day", "s.n", F.round("s.total", 2).alias("total"))


@query("SELECT role, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY 1")
def st_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL inside every batch; the partial results of the batches add up."""
    out = work_dir(spark)

    def count_roles(batch: DataFrame, number: int) -> None:
        batch.createOrReplaceTempView("batch_rows")
        counted = batch.sparkSession.sql("SELECT role, count(*) AS n, sum(length(text)) AS chars FROM batch_rows GROUP BY role")
        counted.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_batches(stream_table(spark, sf_dir, "conversations"), "append", count_roles)
    return spark.read.parquet(out).groupBy("role").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))


@query(_sliding_sql(60, 15, "event_type"))
def st_click_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_append(jobs.window_counts(_events(spark, sf_dir), "60 minutes", "15 minutes", "event_type"))
    return found.withColumn("start", stamp("start"))


@query(
    "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, zip, n, errors, errors / n > 0.05 AS flagged FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS s, CAST(json_extract(props, '$.k') AS INT) AS zip, count(*) AS n, "
    f"count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2) WHERE s + INTERVAL 1 DAY <= {_CLOSED}"
)
def st_click_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("zip", F.from_json("props", "k int")["k"])
    found = run_append(jobs.error_rate(events, "1 day", F.col("event_type") == "error", "zip"))
    return found.withColumn("start", stamp("start")).withColumn("flagged", F.col("errors") / F.col("n") > 0.05)


@query(
    "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, users FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, count(DISTINCT user_id) AS users FROM events GROUP BY 1)"
)
def st_click_active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user once per window in the stream; the table of them is counted."""
    seen = run_append(jobs.first_per_window(_events(spark, sf_dir), "1 hour", "user_id"))
    return seen.groupBy(stamp("w.start").alias("start")).agg(F.count("*").alias("users"))


@query("SELECT c_mktsegment, event_type, count(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2")
def st_click_known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    joined = stream_table(spark, sf_dir, "events").join(known, "user_id")
    return run_complete(joined.groupBy("c_mktsegment", "event_type").agg(F.count("*").alias("n")))


@query("SELECT count(*) AS n FROM (SELECT text FROM conversations UNION ALL SELECT text FROM benchmark) WHERE contains(text, 'the')")
def st_grep_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = stream_table(spark, sf_dir, "conversations").select("text").union(stream_table(spark, sf_dir, "benchmark").select("text"))
    return run_complete(texts.where(F.contains("text", F.lit("the"))).groupBy().agg(F.count("*").alias("n")))


@query(
    f"WITH ex AS (SELECT DISTINCT word FROM {words_sql('benchmark')}) SELECT CASE WHEN ex.word IS NULL THEN w.word ELSE '<dropped>' END AS word, count(*) AS n FROM {words_sql('conversations')} w "
    "LEFT JOIN ex USING (word) GROUP BY 1"
)
def st_excluded_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts without the words of an exclusion list, and how many were dropped."""
    excluded = materialise(jobs.words(table(spark, sf_dir, "benchmark")).distinct().withColumn("out", F.lit(True)))
    words = jobs.words(stream_table(spark, sf_dir, "conversations")).join(excluded, "word", "left")
    kept = F.when(F.col("out").isNull(), F.col("word")).otherwise("<dropped>")
    return run_complete(words.groupBy(kept.alias("word")).agg(F.count("*").alias("n")))


@query("SELECT k % 10 AS residue, count(*) AS n FROM (SELECT o_orderkey AS k FROM orders UNION ALL SELECT event_id FROM events) GROUP BY 1")
def st_residue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = stream_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    keys = keys.union(stream_table(spark, sf_dir, "events").select("event_id"))
    return run_complete(keys.groupBy((F.col("k") % 10).alias("residue")).agg(F.count("*").alias("n")))


@query(
    "SELECT na, nb, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t FROM (SELECT count(*) FILTER (event_type = 'view') AS na, count(*) FILTER (event_type = 'click') AS nb, "
    "avg(value) FILTER (event_type = 'view') AS ma, avg(value) FILTER (event_type = 'click') AS mb, var_samp(value) FILTER (event_type = 'view') AS va, var_samp(value) FILTER (event_type = 'click') AS vb FROM events)"
)
def st_ab_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Welch statistic from running moments per label."""
    moments = stream_table(spark, sf_dir, "events").where("event_type IN ('view', 'click')").groupBy("event_type").agg(
        F.count("*").alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v")
    )
    per = run_complete(moments)

    def of(label: str, c: str):
        return F.max(F.when(F.col("event_type") == label, F.col(c)))

    wide = per.agg(of("view", "n").alias("na"), of("click", "n").alias("nb"), of("view", "m").alias("ma"), of("click", "m").alias("mb"), of("view", "v").alias("va"), of("click", "v").alias("vb"))
    return wide.selectExpr("na", "nb", "round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t")


@query(q.with_(q.ARTICLES, q.index(fields=["content"])) + "SELECT keyword, doc_id, score FROM idx")
def st_index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New documents extend the long index by append."""
    docs = stream_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return run_append(postings(docs, fields=["content"])).select("keyword", "doc_id", "score")


@query()
def st_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stream_table(spark, sf_dir, "embeddings").select(F.col("embedding").alias("vec"))
    centres = stream_kmeans(vectors, 5)
    found = table(spark, sf_dir, "embeddings").groupBy(nearest(F.col("embedding"), centres).alias("cluster"))
    return found.agg(F.count("*").alias("n"))


@query()
def st_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on one stream, applied to another: does a vector carry one of the lower five labels?"""
    label = (F.col("label") < 5).cast("double")
    train = stream_table(spark, sf_dir, "embeddings").select(F.col("embedding").alias("vec"), label.alias("label"))
    weights = stream_logistic(train)
    scored = stream_table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), logistic(F.col("embedding"), weights).alias("p"))
    return run_append(scored).groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("p"), 4).alias("mean_p"))

"""Streaming transformations: streaming DataFrame in, streaming DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def words(texts: DataFrame, text: str = "text") -> DataFrame:
    return texts.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("word")).where("word <> ''")


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    return words(texts, text).groupBy("word").agg(F.count("*").alias("n"))


def timed(events: DataFrame, delay: str) -> DataFrame:
    """Events with a proper timestamp and a watermark; times without a zone are UTC."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    return events.withColumn("ts", local.cast("timestamp")).withWatermark("ts", delay)


def window_counts(events: DataFrame, size: str, slide: str | None, *keys: str) -> DataFrame:
    """``(start, keys, n)`` per time window; tumbling without ``slide``."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("start"), *keys, "n"
    )


def sessions(events: DataFrame, key: str, gap: str) -> DataFrame:
    """``(key, start, end, n)`` of event runs without a pause of ``gap``."""
    return events.groupBy(key, F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n")).select(
        key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n"
    )


def first_per_window(events: DataFrame, size: str, *keys: str) -> DataFrame:
    """Each key once per window; the watermark bounds the state."""
    return (
        events.select(F.window("ts", size).alias("w"), "ts", *keys)
        .select(F.col("w"), *keys, F.col("w.end").alias("until"))
        .dropDuplicates([*keys, "w"])
    )


def follow_ups(causes: DataFrame, effects: DataFrame, within: str, how: str = "inner") -> DataFrame:
    """Pairs of a cause and a later effect of the same user within a time span; both sides watermarked."""
    a = causes.select(F.col("event_id").alias("cause_id"), F.col("user_id").alias("cause_user"), F.col("ts").alias("cause_ts"))
    b = effects.select(F.col("event_id").alias("effect_id"), F.col("user_id").alias("effect_user"), F.col("ts").alias("effect_ts"))
    on = (
        (F.col("cause_user") == F.col("effect_user"))
        & (F.col("effect_ts") > F.col("cause_ts"))
        & (F.col("effect_ts") <= F.col("cause_ts") + F.expr(f"INTERVAL {within}"))
    )
    return a.join(b, on, how).select("cause_id", "effect_id")


def error_rate(events: DataFrame, size: str, is_error: Column, *keys: str) -> DataFrame:
    """``(start, keys, n, errors)`` per window."""
    return events.groupBy(F.window("ts", size).alias("w"), *keys).agg(
        F.count("*").alias("n"), F.sum(is_error.cast("long")).alias("errors")
    ).select(F.col("w.start").alias("start"), *keys, "n", "errors")

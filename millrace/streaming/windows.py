"""Event time and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numbers import fixed_text
from millrace.functions.times import clock
from millrace.operators.aggregates import mean_of


def with_event_time(df: DataFrame, value: Column, into: str = "event_time", delay: str | None = None) -> DataFrame:
    """Name the time of the event; with ``delay``, also how late rows may come.

    A watermark needs a timestamp with a zone, so one without is taken as UTC.
    """
    stamped = df.withColumn(into, value.cast("timestamp"))
    return stamped if delay is None else stamped.withWatermark(into, delay)


def with_window(df: DataFrame, size: str, slide: str | None = None, time: str = "event_time") -> DataFrame:
    """Add the bounds ``window_start`` and ``window_end`` of every window a row is in."""
    return (df.withColumn("_w", F.window(time, size, slide or size))
            .withColumn("window_start", F.col("_w.start").cast("timestamp_ntz"))
            .withColumn("window_end", F.col("_w.end").cast("timestamp_ntz"))
            .drop("_w"))


def drop_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once within the watermark's delay: a sender's retries disappear, and state stays bounded."""
    return df.dropDuplicatesWithinWatermark(keys)


def window_means(df: DataFrame, keys: list[str], value: Column, size: str, slide: str | None = None,
                 time: str = "event_time", mean: str = "mean") -> DataFrame:
    """Mean per key and window, from partial sums."""
    window = F.window(time, size, slide or size)
    grouped = df.groupBy(window.alias("_w"), *keys).agg(mean_of(value).alias(mean))
    return with_bounds(grouped, keys, mean)


def window_counts(df: DataFrame, keys: list[str], size: str, slide: str | None = None, time: str = "event_time",
                  count: str = "n") -> DataFrame:
    window = F.window(time, size, slide or size)
    grouped = df.groupBy(window.alias("_w"), *keys).agg(F.count(F.lit(1)).alias(count))
    return with_bounds(grouped, keys, count)


def with_bounds(grouped: DataFrame, keys: list[str], *values: str) -> DataFrame:
    return grouped.select(
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_w.end").cast("timestamp_ntz").alias("window_end"), *keys, *values)


def low_mean_alerts(means: DataFrame, key: str, below: float, mean: str = "mean") -> DataFrame:
    """Windows whose mean is under the bound, with the alert text for the crew."""
    # The words of the alert.
    text = F.concat(
        F.lit("\U0001f6a8 [TECHNICAL ALERT] | Window: "), clock(F.col("window_start")),
        F.lit(" - "), clock(F.col("window_end")), F.lit(" | Transformer: "), F.col(key),
        F.lit(" | Average Voltage: "), fixed_text(F.col(mean), 1),
        F.lit("V | ACTION: Dispatch crew immediately."))
    return means.filter(F.col(mean) < below).withColumn("message", text)

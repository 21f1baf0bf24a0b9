"""Queries that run a stream to its end and read what it wrote."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.functions.records import row_json
from millrace.operators.aggregates import latest_per_key
from millrace.plans.race_stream import windowed_lines
from millrace.queries.registry import query, table
from millrace.session import scratch_path
from millrace.sinks.keyed_log import merge_levels, read_current, upsert_batch
from millrace.streaming.runs import (
    open_rows, stream_files, to_sinks, wait_all, write_stream_batches, write_stream_files, write_stream_upserts)
from millrace.streaming.sealed import read_late, read_sealed, sealed_windows
from millrace.streaming.state import final_windows, late_rows, latest_rows, windows_and_late
from millrace.streaming.windows import window_counts, window_means, with_event_time, with_window


def _source(sf_dir, name="events"):
    """A pattern, so that a table may be one file or a folder of files."""
    return f"{sf_dir}/{{{name}}}.parquet"


def _stream(spark, sf_dir, name="events"):
    return stream_files(spark, _source(sf_dir, name), table(spark, sf_dir, name).schema)


@query("""
SELECT event_id, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end
FROM events
""")
def stream_event_time(spark, sf_dir):
    """Event time and window bounds as data, through the batch or stream switch."""
    schema = table(spark, sf_dir, "events").schema
    rows = open_rows(spark, _source(sf_dir), schema, streaming=True)
    timed = with_window(with_event_time(rows, F.col("ts"), delay="1 hour"), "1 hour")
    path = scratch_path(spark, "event-time")
    wait_all(write_stream_files(timed.select("event_id", "window_start", "window_end"), f"{path}/out", f"{path}/state",
                                once=True))
    return spark.read.parquet(f"{path}/out")


SLIDING_SQL = """
SELECT s AS window_start, s + INTERVAL '60 minutes' AS window_end, event_type,
       round(avg(value / 7), 9) AS mean
FROM (SELECT event_type, value, time_bucket(INTERVAL '30 minutes', ts) - shift AS s
      FROM events CROSS JOIN (VALUES (INTERVAL '0 minutes'), (INTERVAL '30 minutes')) AS o(shift))
GROUP BY s, event_type
"""


@query(f"SELECT * FROM ({SLIDING_SQL}) WHERE mean < 6")
def stream_sliding_avg(spark, sf_dir):
    """Sliding means in update mode, kept as a keyed log; low windows are picked from the final means."""
    timed = with_event_time(_stream(spark, sf_dir), F.col("ts"), delay="2 hours")
    means = window_means(timed, ["event_type"], F.col("value") / 7, "60 minutes", "30 minutes")
    path = scratch_path(spark, "sliding")
    wait_all(write_stream_upserts(means, f"{path}/out", f"{path}/state", once=True))
    current = read_current(spark, f"{path}/out", ["window_start", "event_type"])
    return current.withColumn("mean", F.round("mean", 9)).filter("mean < 6").select(
        "window_start", "window_end", "event_type", "mean")


@query(SLIDING_SQL)
def window_sliding_batch(spark, sf_dir):
    """The same windows over the table as a batch."""
    timed = with_event_time(table(spark, sf_dir, "events"), F.col("ts"))
    means = window_means(timed, ["event_type"], F.col("value") / 7, "60 minutes", "30 minutes")
    return means.withColumn("mean", F.round("mean", 9))


@query("""
SELECT 'events' AS stream, strftime(time_bucket(INTERVAL '1 day', ts), '%Y%m%d-%H%M%S') AS w, count(*) AS n
FROM events GROUP BY 2
UNION ALL
SELECT 'orders', strftime(epoch_ms(floor(epoch_ms(o_orderdate) / 31536000000)::BIGINT * 31536000000), '%Y%m%d-%H%M%S'),
       count(*)
FROM orders GROUP BY 2
""")
def stream_tumbling_files(spark, sf_dir):
    """Two streams at once, each into files with one folder per tumbling window."""
    path = scratch_path(spark, "tumbling")
    running = []
    for name, time, fields, size in (("events", "ts", ["event_id", "user_id"], "1 day"),
                                     ("orders", "o_orderdate", ["o_orderkey"], "365 days")):
        lines = windowed_lines(_stream(spark, sf_dir, name), row_json(fields), size, time)
        running.append(write_stream_files(lines, f"{path}/{name}", f"{path}/state-{name}", "text", "w", once=True))
    wait_all(*running)
    counts = [spark.read.text(f"{path}/{name}").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(name).alias("stream"), F.col("w").cast("string").alias("w"), "n")
              for name in ("events", "orders")]
    return counts[0].unionByName(counts[1])


@query("""
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type, n
FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
WHERE window_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'
""")
def stream_late_data(spark, sf_dir):
    """Append mode: a window appears once the watermark has passed its end."""
    timed = with_event_time(_stream(spark, sf_dir), F.col("ts"), delay="1 hour")
    counts = window_counts(timed, ["event_type"], "1 hour")
    path = scratch_path(spark, "late")
    wait_all(write_stream_files(counts, f"{path}/out", f"{path}/state", once=True))
    return spark.read.parquet(f"{path}/out")


@query("""
SELECT 'alerts' AS sink, event_id FROM events WHERE value > 100
UNION ALL SELECT 'copy', event_id FROM events
""")
def stream_two_sinks(spark, sf_dir):
    """Every micro-batch to two sinks; each batch has its own folder, so a replay replaces it."""
    path = scratch_path(spark, "two-sinks")

    def alerts(batch, batch_id):
        upsert_batch(batch.filter("value > 100"), f"{path}/alerts", batch_id)

    def copy(batch, batch_id):
        upsert_batch(batch, f"{path}/copy", batch_id)

    rows = _stream(spark, sf_dir).select("event_id", "value")
    wait_all(write_stream_batches(rows, to_sinks(alerts, copy), f"{path}/state", once=True))
    parts = [spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("sink"), "event_id")
             for name in ("alerts", "copy")]
    return parts[0].unionByName(parts[1])


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1
""")
def stream_latest(spark, sf_dir):
    """The latest event per user, merged batch by batch."""
    path = scratch_path(spark, "latest")

    def merge(batch, batch_id):
        upsert_batch(latest_per_key(batch, ["user_id"], ["ts", "event_id"]), f"{path}/out", batch_id)

    rows = _stream(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    wait_all(write_stream_batches(rows, merge, f"{path}/state", once=True))
    return read_current(spark, f"{path}/out", ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


def _in_turns(spark, sf_dir, path, turns, start):
    """The events in ``turns`` parts by id, each landed and streamed to its end by a new query from the same checkpoint."""
    events = table(spark, sf_dir, "events")
    for turn in range(turns):
        events.filter(F.pmod("event_id", F.lit(turns)) == turn).write.mode("append").parquet(f"{path}/in")
        wait_all(start(stream_files(spark, f"{path}/in", events.schema)))


@query("""
SELECT user_id, ts, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1
""")
def stream_latest_state(spark, sf_dir):
    """The latest event per user from keyed state, over a restart and with rows that come late."""
    path = scratch_path(spark, "latest-state")

    def start(rows):
        latest = latest_rows(rows.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "ts", "1 hour", timedelta(days=3))
        return write_stream_upserts(latest, f"{path}/out", f"{path}/state", once=True)

    _in_turns(spark, sf_dir, path, 2, start)
    return read_current(spark, f"{path}/out", ["user_id"], ["ts", "event_id"]).select("user_id", "ts", "event_id", "event_type")


# What the watermark is when a turn begins: the latest time of the turns before, less the delay.
TURNS_SQL = """
t AS (SELECT *, event_id % {turns} AS turn, time_bucket(INTERVAL '{size}', ts) AS w FROM events),
m AS (SELECT a.turn, max(b.ts) - INTERVAL '1 hour' AS mark FROM (SELECT DISTINCT turn FROM t) a LEFT JOIN t b ON b.turn < a.turn GROUP BY 1),
j AS (SELECT t.*, coalesce(w + INTERVAL '{size}' <= mark, false) AS late FROM t JOIN m USING (turn)),
z AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM t)
"""


@query(f"""
WITH {TURNS_SQL.format(turns=2, size="1 hour")}
SELECT 'window' AS kind, event_type, w AS window_start, count(*) AS n, round(sum(value), 6) AS total, NULL::BIGINT AS event_id
FROM j, z WHERE NOT late AND w + INTERVAL '1 hour' <= z.mark GROUP BY event_type, w
UNION ALL SELECT 'late', event_type, w, 1, round(value, 6), event_id FROM j WHERE late
UNION ALL SELECT 'all rows', NULL, NULL, count(*), NULL, NULL FROM t
""")
def stream_late_rows(spark, sf_dir):
    """Final windows, the rows that came after them, and as a check the number of rows in windows, late and in open windows."""
    path = scratch_path(spark, "late-rows")

    def start(rows):
        found = windows_and_late(rows, ["event_type"], F.col("value"), timedelta(hours=1), "1 hour", "ts")
        return write_stream_files(found, f"{path}/out", f"{path}/state", once=True)

    _in_turns(spark, sf_dir, path, 2, start)
    windows = final_windows(spark, f"{path}/out", ["event_type"])
    late = late_rows(spark, f"{path}/out")
    closed = windows.select(F.lit("window").alias("kind"), "event_type", "window_start", "n", F.round("total", 6).alias("total"),
                            F.lit(None).cast("long").alias("event_id"))
    start_of = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600) * 3600).cast("timestamp_ntz")
    missed = late.select(F.lit("late"), "event_type", start_of, F.lit(1).cast("long"), F.round("value", 6), "event_id")
    end = table(spark, sf_dir, "events").agg((F.max("ts") - F.expr("INTERVAL 1 HOUR")).alias("mark"))
    open_rows_left = table(spark, sf_dir, "events").crossJoin(F.broadcast(end)).filter(start_of + F.expr("INTERVAL 1 HOUR") > F.col("mark"))
    still = open_rows_left.join(late.select("event_id"), "event_id", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    parts = [windows.agg(F.sum("n").alias("n")), late.agg(F.count(F.lit(1)).alias("n")), still]
    total = parts[0].union(parts[1]).union(parts[2]).agg(F.sum("n").alias("n"))
    none = F.lit(None)
    return closed.union(missed).union(total.select(
        F.lit("all rows"), none.cast("string"), none.cast("timestamp_ntz"), "n", none.cast("double"), none.cast("long")))


@query(f"""
WITH {TURNS_SQL.format(turns=2, size="1 day")}
SELECT 'sealed' AS kind, strftime(w, '%Y%m%d-%H%M%S') AS w, count(*) AS n, sum(event_id)::BIGINT AS ids
FROM j, z WHERE NOT late AND w + INTERVAL '1 day' <= z.mark GROUP BY 2
UNION ALL SELECT 'late', NULL, count(*), sum(event_id)::BIGINT FROM j WHERE late
""")
def stream_sealed_windows(spark, sf_dir):
    """Files by window that are finished, and what came after they were."""
    path = scratch_path(spark, "sealed")
    write = sealed_windows(f"{path}/out", F.col("event_id").cast("string"), "ts", timedelta(days=1), timedelta(hours=1))
    _in_turns(spark, sf_dir, path, 2, lambda rows: write_stream_batches(rows, write, f"{path}/state", once=True))
    measures = [F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("long")).alias("ids")]
    sealed = read_sealed(spark, f"{path}/out").groupBy("w").agg(*measures).select(F.lit("sealed").alias("kind"), "w", "n", "ids")
    late = read_late(spark, f"{path}/out").agg(*measures)
    return sealed.unionByName(late.select(F.lit("late").alias("kind"), F.lit(None).cast("string").alias("w"), "n", "ids"))


@query("""
SELECT user_id, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1
""")
def sink_log_levels(spark, sf_dir):
    """The current rows of a keyed log of five batches, merged by twos into levels on the way."""
    path, events = scratch_path(spark, "levels"), table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    for batch_id in range(5):
        upsert_batch(events.filter(F.pmod("event_id", F.lit(5)) == batch_id), path, batch_id)
        merge_levels(spark, path, ["user_id"], ["ts", "event_id"], fan=2)
    return read_current(spark, path, ["user_id"], ["ts", "event_id"])

"""Race topics as streams: to files and a second topic, to a keyed table, to a relational table."""

from __future__ import annotations

import argparse
import importlib
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.records import decode_text, parse_json
from millrace.operators.aggregates import latest_per_key
from millrace.schemas import RACE_EVENT, TELEMETRY_MESSAGE, TELEMETRY_TABLE
from millrace.session import build_session
from millrace.sinks.keyed_log import merge_levels, read_current, upsert_batch
from millrace.sinks.relational import Database, create_table, telemetry_fault, telemetry_rows, write_upserts
from millrace.sinks.staged_writer import Target, write_staged
from millrace.sources.kafka import decode_records, read_topic, with_random_key, write_topic
from millrace.sources.paths import spark_path, use_endpoint
from millrace.streaming.runs import to_sinks, wait_all, write_stream_batches
from millrace.streaming.sealed import sealed_windows
from millrace.streaming.state import latest_rows
from millrace.streaming.windows import with_event_time, with_window

LAP_TEXT = "completes lap"  # fixed value: the text that marks a finished lap
KEY_PREFIX = "simple_key:"  # fixed value: how keys are named in the key-value table
LAP_ORDER = ["timestamp", "Timestamp_s", "EventID"]
LAP_MEMORY = timedelta(days=1)        # how long a helicopter without laps is remembered
WINDOW = timedelta(seconds=5)


def lap_values(records: DataFrame) -> DataFrame:
    """``key, value`` of finished laps: the helicopter, and the record's text as it came.

    The text is parsed once, for the filter, the key and the order.
    """
    text = decode_text(F.col("value"))
    parsed = records.select("timestamp", text.alias("value"), parse_json(text, RACE_EVENT).alias("_event"))
    laps = parsed.filter(F.contains("_event.Details", F.lit(LAP_TEXT)) & (F.col("_event.HelicopterID") != ""))
    return laps.select(F.concat(F.lit(KEY_PREFIX), "_event.HelicopterID").alias("key"), "value", "timestamp",
                       "_event.Timestamp_s", "_event.EventID")


def latest_laps(records: DataFrame) -> DataFrame:
    """The last lap per helicopter, as repeated writes to a key-value store leave it."""
    return latest_per_key(lap_values(records), ["key"], LAP_ORDER)


def read_laps(spark: SparkSession, root: str) -> DataFrame:
    return read_current(spark, f"{root}/laps", ["key"], [*LAP_ORDER, "batch_id"]).select("key", "value")


def windowed_lines(rows: DataFrame, line: Column, size: str = "5 seconds", time: str = "timestamp") -> DataFrame:
    """Lines with the start of their window, for files in one folder per window."""
    lines = with_window(with_event_time(rows, F.col(time)), size)
    return lines.select(line.alias("value"), F.date_format("window_start", "yyyyMMdd-HHmmss").alias("w"))


def rejected_telemetry(records: DataFrame) -> DataFrame:
    """``value, reason`` of the messages that cannot be rows of the target table."""
    text = decode_text(F.col("value"))
    parsed = records.select(text.alias("message"), parse_json(text, TELEMETRY_MESSAGE).alias("_record")).select("message", "_record.*")
    return parsed.select(F.col("message").alias("value"), telemetry_fault(parsed).alias("reason")).filter("reason IS NOT NULL")


def start(events: DataFrame, telemetry: DataFrame, root: str, checkpoints: str,
          once: bool = False, database: Database | None = None, delay: timedelta = timedelta(minutes=1), fan: int = 8,
          staged_with: str | None = None) -> list[StreamingQuery]:
    """Start all streams over two frames of ``key, value, timestamp`` records.

    Both topics go to files by window, which are sealed ``delay`` after its end (rows
    after that are kept apart), finished laps from state to a table by key, and
    telemetry to a table with the layout of the relational target, and to the
    relational ``database`` itself if there is one. Messages that cannot be rows of
    it are kept with the reason in ``telemetry_rejects``, a folder per batch. Every
    ``fan`` batches of a table are merged. With ``staged_with``, how the database's
    driver marks a value in a statement, a batch reaches it whole or not at all.
    """
    text = decode_text(F.col("value"))
    if database is not None:
        create_table(database, TELEMETRY_TABLE, "id")

    def save_laps(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, f"{root}/laps", batch_id)
        merge_levels(batch.sparkSession, f"{root}/laps", ["key"], [*LAP_ORDER, "batch_id"], fan)

    def save_telemetry(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(telemetry_rows(decode_records(batch, TELEMETRY_MESSAGE)), f"{root}/telemetry_table", batch_id)
        merge_levels(batch.sparkSession, f"{root}/telemetry_table", ["id"], fan=fan)

    def save_rejects(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(rejected_telemetry(batch), f"{root}/telemetry_rejects", batch_id)

    def save_rows(batch: DataFrame, batch_id: int) -> None:
        rows = telemetry_rows(decode_records(batch, TELEMETRY_MESSAGE))
        if staged_with is None:
            write_upserts(rows, database, "id")
        else:
            write_staged(rows, Target(database, TELEMETRY_TABLE, "id", staged_with))

    saves = [save_telemetry, save_rejects] + ([save_rows] if database is not None else [])
    def to_windows(records: DataFrame, name: str) -> StreamingQuery:
        return write_stream_batches(records, sealed_windows(f"{root}/{name}", text, "timestamp", WINDOW, delay), f"{checkpoints}/{name}", once)

    laps = latest_rows(lap_values(events), ["key"], LAP_ORDER, "timestamp", f"{delay // timedelta(seconds=1)} seconds", LAP_MEMORY)
    return [
        to_windows(events, "events"),
        to_windows(telemetry, "telemetry"),
        write_stream_batches(laps, save_laps, f"{checkpoints}/laps", once, "update"),
        write_stream_batches(telemetry, to_sinks(*saves), f"{checkpoints}/telemetry_table", once),
    ]


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--brokers", required=True)
    parser.add_argument("--events-topic", required=True)
    parser.add_argument("--telemetry-topic", required=True)
    parser.add_argument("--copy-topic", help="also copy the events to this topic")
    parser.add_argument("--output", required=True, help="root of files and tables")
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--start", default="latest", choices=["latest", "earliest"])
    parser.add_argument("--records-per-batch", type=int)
    parser.add_argument("--delay-seconds", type=int, default=60, help="how long after its end a window is sealed")
    parser.add_argument("--endpoint", help="address of an S3-compatible store for s3:// outputs")
    parser.add_argument("--connect", help="module:function that opens a DB-API connection, for telemetry in a database")
    parser.add_argument("--table", default="telemetry", help="the table there")
    parser.add_argument("--staged-with", help="the driver's mark for a value, as %%s or ?: load each batch through a staging table, whole or not at all")
    parser.add_argument("--connections", type=int, default=8, help="how many tasks may write to it at once")
    args = parser.parse_args(argv)
    spark = build_session("race-stream")
    if args.endpoint:
        use_endpoint(spark, args.endpoint)
    database = None
    if args.connect:
        module, _, function = args.connect.partition(":")
        database = Database(getattr(importlib.import_module(module), function), args.table, args.connections)
    events, telemetry = (
        read_topic(spark, args.brokers, topic, args.start, max_records=args.records_per_batch)
        for topic in (args.events_topic, args.telemetry_topic))
    queries = start(events, telemetry, spark_path(args.output), args.checkpoints, database=database,
                    delay=timedelta(seconds=args.delay_seconds), staged_with=args.staged_with)
    if args.copy_topic:
        queries.append(write_topic(with_random_key(events, F.col("value")), args.brokers, args.copy_topic,
                                   f"{args.checkpoints}/copy"))
    wait_all(*queries)


if __name__ == "__main__":
    main()

"""Streams: equal to the batch, restartable, and strict about late rows."""

import functools
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions.records import row_json
from millrace.plans import race_stream
from millrace.sinks import relational
from millrace.sinks.keyed_log import read_current, upsert_batch
from millrace.streaming.runs import (
    open_rows, stream_files, to_sinks, wait_all, write_stream_batches, write_stream_files, write_stream_upserts)
from millrace.streaming.windows import drop_repeats, window_counts, window_means, with_event_time

READING = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType()),
                        T.StructField("ts", T.StringType())])


def land(folder, name, *rows):
    """Files are taken by their time of change, so each one is made a second younger than those before."""
    os.makedirs(f"{folder}/in", exist_ok=True)
    moment = 1_700_000_000 + len(os.listdir(f"{folder}/in"))
    with open(f"{folder}/in/{name}.json", "w") as out:
        out.writelines(json.dumps(dict(zip(READING.names, row))) + "\n" for row in rows)
    os.utime(f"{folder}/in/{name}.json", (moment, moment))


def timed(spark, folder, streaming=True, delay="1 minute"):
    options = {"files_per_trigger": 1} if streaming else {}
    rows = open_rows(spark, f"{folder}/in", READING, streaming, fmt="json", **options)
    return with_event_time(rows, F.col("ts"), delay=delay if streaming else None)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_update_mode_log_equals_batch_after_restart(spark, folder):
    def run():
        means = window_means(timed(spark, folder), ["id"], F.col("v"), "60 seconds", "30 seconds")
        wait_all(write_stream_upserts(means, f"{folder}/out", f"{folder}/state", once=True))
        return rows(read_current(spark, f"{folder}/out", ["window_start", "id"]), "window_start", "id", "mean")

    def batch():
        means = window_means(timed(spark, folder, streaming=False), ["id"], F.col("v"), "60 seconds", "30 seconds")
        return rows(means, "window_start", "id", "mean")

    land(folder, "a", ("x", 10, "2026-01-01 00:00:10"), ("y", 4, "2026-01-01 00:00:20"))
    land(folder, "b", ("x", 20, "2026-01-01 00:00:40"))
    assert run() == batch()
    land(folder, "c", ("x", 60, "2026-01-01 00:00:45"), ("y", 1, "2026-01-01 00:01:30"))
    assert run() == batch()   # a new query from the same checkpoint goes on where the first stopped


def test_late_rows_are_dropped(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 00:00:10"))
    land(folder, "b", ("x", 1, "2026-01-01 00:10:00"))   # the watermark moves to 00:09:00
    counts = window_counts(timed(spark, folder), ["id"], "1 minute")
    wait_all(write_stream_files(counts, f"{folder}/out", f"{folder}/state", once=True))
    land(folder, "c", ("x", 1, "2026-01-01 00:00:20"), ("x", 1, "2026-01-01 00:30:00"))
    counts = window_counts(timed(spark, folder), ["id"], "1 minute")
    wait_all(write_stream_files(counts, f"{folder}/out", f"{folder}/state", once=True))
    got = rows(spark.read.parquet(f"{folder}/out"), F.date_format("window_start", "HH:mm"), "n")
    assert got == [("00:00", 1), ("00:10", 1)]   # the late row is gone, the last window still open


def test_two_sinks_and_replay(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 00:00:10"), ("y", 500, "2026-01-01 00:00:20"))
    calls = []

    def high(batch, batch_id):
        calls.append(batch_id)
        upsert_batch(batch.filter("v > 100"), f"{folder}/high", batch_id)

    def everything(batch, batch_id):
        upsert_batch(batch, f"{folder}/all", batch_id)

    for checkpoint in ("one", "two"):   # the second run replays batch 0 from the start
        stream = stream_files(spark, f"{folder}/in", READING, "json")
        wait_all(write_stream_batches(stream, to_sinks(high, everything), f"{folder}/{checkpoint}", once=True))
    assert calls == [0, 0]
    assert spark.read.parquet(f"{folder}/high").count() == 1 and spark.read.parquet(f"{folder}/all").count() == 2


def test_failing_sink_fails_the_stream(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 00:00:10"))

    def broken(batch, batch_id):
        raise RuntimeError("no space")

    stream = stream_files(spark, f"{folder}/in", READING, "json")
    with pytest.raises(Exception, match="no space"):
        wait_all(write_stream_batches(stream, to_sinks(broken), f"{folder}/state", once=True))


def test_one_failure_ends_all_streams(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 00:00:10"))

    def broken(batch, batch_id):
        raise RuntimeError("no space")

    endless = write_stream_files(stream_files(spark, f"{folder}/in", READING, "json"), f"{folder}/out", f"{folder}/s1")
    failing = write_stream_batches(stream_files(spark, f"{folder}/in", READING, "json"), broken, f"{folder}/s2")
    with pytest.raises(Exception, match="no space"):
        wait_all(endless, failing)
    assert not endless.isActive


def test_windowed_files(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 00:00:04"), ("y", 2, "2026-01-01 00:00:05"))
    stream = stream_files(spark, f"{folder}/in", READING, "json")
    wait_all(write_stream_files(race_stream.windowed_lines(stream, row_json(["id", "v"]), "5 seconds", "ts"),
                                f"{folder}/out", f"{folder}/state", "text", "w", once=True))
    folders = {name for name in os.listdir(f"{folder}/out") if name.startswith("w=")}
    assert folders == {"w=20260101-000000", "w=20260101-000005"}
    assert rows(spark.read.text(f"{folder}/out"), "value") == [('{"id":"x","v":1}',), ('{"id":"y","v":2}',)]


def race_records(spark, folder, name, values):
    """Records shaped like a topic's, as a stream over files; one file per record."""
    os.makedirs(f"{folder}/{name}")
    for i, value in enumerate(values):
        with open(f"{folder}/{name}/{i}.json", "w") as out:
            out.write(json.dumps({"value": json.dumps(value), "timestamp": f"2026-01-01T00:00:{4 + i:02d}Z"}) + "\n")
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("timestamp", T.TimestampType())])
    return stream_files(spark, f"{folder}/{name}", schema, "json", files_per_trigger=1).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "timestamp")


class FolderConnection:
    """A stand-in for a database connection that tasks can open: what it commits is a file of its own."""

    def __init__(self, path):
        self.path, self.rows = path, []

    def cursor(self):
        return self

    def execute(self, statement):
        self.rows.append([statement])

    def executemany(self, statement, batch):
        self.rows += [[statement, *map(str, row)] for row in batch]

    def commit(self):
        os.makedirs(self.path, exist_ok=True)
        with open(f"{self.path}/{uuid.uuid4().hex}", "w") as out:
            out.writelines(json.dumps(row) + "\n" for row in self.rows)
        self.rows = []

    def rollback(self):
        self.rows = []

    def close(self):
        pass


def test_race_streams(spark, folder):
    def event(number, moment, helicopter, details):
        return {"EventID": number, "RaceID": "r", "Timestamp_s": moment, "EventType": "x", "Details": details,
                "HelicopterID": helicopter, "Impact": "None", "Extra": 1}

    events = [event("e1", 5, "HEL001", "HEL001 completes lap 1"), event("e2", 9, "HEL001", "HEL001 completes lap 2"),
              event("e3", 9, "HEL001", "HEL001 overtakes HEL002"), event("e4", 9, "", "HEL003 completes lap 1"),
              event("e5", 9, "HEL001", None)]
    record = {"HelicopterID": "HEL001", "RaceID": "r", "LapNumber": 1, "Time_s": 9.3, "Speed_km_h": 253.1,
              "Altitude_m": 60.0, "FuelLevel_percentage": 99.9, "EngineTemp_c": 85.3, "RotorRPM": 420, "Latitude": 34.05,
              "Longitude": -118.24}
    wait_all(*race_stream.start(
        race_records(spark, folder, "events_in", events),
        race_records(spark, folder, "telemetry_in", [record, record, dict(record, HelicopterID=None), dict(record, Speed_km_h=1e9)]),
        f"{folder}/out", f"{folder}/state", once=True, database=relational.Database(functools.partial(FolderConnection, f"{folder}/db"), "t", 3)))

    assert {name for name in os.listdir(f"{folder}/out/events") if name.startswith("w=")} == {
        "w=20260101-000000", "w=20260101-000005"}
    assert sorted(json.loads(r["value"])["EventID"] for r in spark.read.text(f"{folder}/out/events").collect()) == [
        "e1", "e2", "e3", "e4", "e5"]
    assert spark.read.text(f"{folder}/out/telemetry").count() == 4
    laps = race_stream.read_laps(spark, f"{folder}/out").collect()
    assert [(r["key"], json.loads(r["value"])) for r in laps] == [("simple_key:HEL001", events[1])]
    stored = read_current(spark, f"{folder}/out/telemetry_table", ["id"]).collect()   # the repeat is one row
    assert [(float(r["EngineTemp_c"]), float(r["Speed_km_h"]), float(r["Time_s"])) for r in stored] == [(85.3, 253.1, 9.3)]
    rejects = spark.read.parquet(f"{folder}/out/telemetry_rejects").collect()
    assert sorted(r["reason"] for r in rejects) == ["a measure is out of range", "no helicopter, or no record"]
    written = [json.loads(line) for name in sorted(os.listdir(f"{folder}/db")) for line in open(f"{folder}/db/{name}")]
    assert [x for x in written if x[0].startswith("CREATE TABLE IF NOT EXISTS t (id VARCHAR(255) PRIMARY KEY")]
    rows_of = [x for x in written if x[0].startswith("INSERT INTO t (id, HelicopterID")]
    assert len({x[1] for x in rows_of}) == 1 and {x[2] for x in rows_of} == {"HEL001"}


def test_repeats_are_dropped(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 00:00:10"), ("x", 1, "2026-01-01 00:00:10"))
    land(folder, "b", ("x", 1, "2026-01-01 00:00:20"), ("y", 1, "2026-01-01 00:00:20"))
    once = drop_repeats(timed(spark, folder), ["id"]).select("id")
    wait_all(write_stream_files(once, f"{folder}/out", f"{folder}/state", once=True))
    assert rows(spark.read.parquet(f"{folder}/out"), "id") == [("x",), ("y",)]

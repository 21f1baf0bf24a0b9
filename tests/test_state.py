"""Keyed state, late rows, sealed windows: equal to the batch over restarts and replays."""

import os
from datetime import timedelta

from pyspark.sql import functions as F

from millrace.sinks.keyed_log import read_current
from millrace.sinks.manifests import SharedFiles, newest
from millrace.streaming.runs import stream_files, wait_all, write_stream_batches, write_stream_files, write_stream_upserts
from millrace.streaming.sealed import read_late, read_sealed, sealed_windows
from millrace.streaming.state import final_windows, late_rows, latest_rows, windows_and_late
from tests.test_streams import READING, land

HOUR = timedelta(hours=1)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def readings(spark, folder):
    return stream_files(spark, f"{folder}/in", READING, "json").withColumn("ts", F.col("ts").cast("timestamp"))


def run_latest(spark, folder, keep=HOUR):
    latest = latest_rows(readings(spark, folder), ["id"], ["ts", "v"], "ts", "1 minute", keep)
    wait_all(write_stream_upserts(latest, f"{folder}/out", f"{folder}/state", once=True))
    return rows(read_current(spark, f"{folder}/out", ["id"], ["ts", "v"]), "id", "v")


def test_latest_from_state_over_restarts_and_late_rows(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 10:00:00"), ("x", 2, "2026-01-01 10:00:05"), ("y", 7, "2026-01-01 10:00:00"), (None, 5, "2026-01-01 10:00:00"))
    assert run_latest(spark, folder) == [("x", 2), ("y", 7), (None, 5)]
    # a late row that loses, a late row of a new key, a tie in time decided by the value, and a row without a time
    land(folder, "b", ("x", 9, "2026-01-01 09:00:00"), ("z", 4, "2026-01-01 08:00:00"), ("y", 8, "2026-01-01 10:00:00"), ("w", 3, None))
    got = run_latest(spark, folder)
    assert got == [("w", 3), ("x", 2), ("y", 8), ("z", 4), (None, 5)]
    batches = len([name for name in os.listdir(f"{folder}/out") if name.startswith("batch_id=")])
    land(folder, "c", ("x", 1, "2026-01-01 09:30:00"))   # nothing changes, so nothing is put out
    assert run_latest(spark, folder) == got
    newer = [b for b in os.listdir(f"{folder}/out") if b.startswith("batch_id=") and int(b[9:]) >= batches]
    assert all(spark.read.parquet(f"{folder}/out/{b}").count() == 0 for b in newer)


def test_idle_keys_are_forgotten_and_the_table_stays_right(spark, folder):
    land(folder, "a", ("x", 1, "2026-01-01 10:00:00"))
    run_latest(spark, folder, timedelta(minutes=5))
    land(folder, "b", ("y", 2, "2026-01-02 10:00:00"))      # the watermark passes the memory of x
    run_latest(spark, folder, timedelta(minutes=5))
    land(folder, "c", ("x", 0, "2026-01-01 09:00:00"), ("y", 3, "2026-01-02 10:00:01"))
    assert run_latest(spark, folder, timedelta(minutes=5)) == [("x", 1), ("y", 3)]


def test_kept_and_late_rows_are_all_rows(spark, folder):
    def run():
        found = windows_and_late(readings(spark, folder), ["id"], F.col("v"), timedelta(minutes=1), "1 minute", "ts", salts=3)
        wait_all(write_stream_files(found, f"{folder}/out", f"{folder}/state", once=True))

    land(folder, "a", *[("x", v, f"2026-01-01 00:00:{v:02d}") for v in range(40)], ("y", None, "2026-01-01 00:00:59"))
    land(folder, "b", ("x", 1, "2026-01-01 00:05:00"))
    run()
    land(folder, "c", ("x", 100, "2026-01-01 00:00:20"), ("q", 5, None), ("x", 2, "2026-01-01 00:04:01"), ("x", 3, "2026-01-01 00:05:30"))
    run()
    land(folder, "d", ("end", 0, "2026-01-01 09:00:00"))
    run()
    windows = rows(final_windows(spark, f"{folder}/out", ["id"]), F.date_format("window_start", "HH:mm"), "id", "n", "total")
    # 00:04 was still open when its row came: the watermark stood at 00:04
    assert windows == [("00:00", "x", 40, 780.0), ("00:00", "y", 1, None), ("00:04", "x", 1, 2.0), ("00:05", "x", 2, 4.0)]
    late = late_rows(spark, f"{folder}/out")
    assert late.columns == READING.names and sorted(late.toPandas()["v"]) == [5, 100]
    kept = sum(n for _, _, n, _ in windows)
    assert kept + late.count() + 1 == sum(len(open(f"{folder}/in/{f}").readlines()) for f in os.listdir(f"{folder}/in") if f.endswith(".json"))


def test_sealed_windows_never_grow(spark, folder):
    write = sealed_windows(f"{folder}/out", F.concat("id", F.col("v").cast("string")), "ts", timedelta(seconds=5), timedelta(seconds=10))

    def run(checkpoint="state"):
        wait_all(write_stream_batches(readings(spark, folder), write, f"{folder}/{checkpoint}", once=True))
        return rows(read_sealed(spark, f"{folder}/out"), "w", "value")

    land(folder, "a", ("x", 1, "2026-01-01 00:00:04"), ("x", 2, "2026-01-01 00:00:05"))
    assert run() == [] and not read_late(spark, f"{folder}/out").count()
    land(folder, "b", ("x", 3, "2026-01-01 00:00:01"), ("x", 4, "2026-01-01 00:00:15"))   # seals the first window
    first = run()
    assert first == [("20260101-000000", "x1"), ("20260101-000000", "x3")]
    land(folder, "c", ("x", 5, "2026-01-01 00:00:02"), ("x", 6, "2026-01-01 00:00:06"), ("x", 7, None), ("x", 8, "2026-01-01 00:01:00"))
    second = run()
    assert second[:2] == first and second[2:] == [("20260101-000005", "x2"), ("20260101-000005", "x6"), ("20260101-000015", "x4")]
    assert rows(read_late(spark, f"{folder}/out"), "value") == [("x5",), ("x7",)]


def test_a_replayed_batch_of_sealed_windows_changes_nothing(spark, folder):
    path = f"{folder}/out"
    write = sealed_windows(path, F.col("id"), "ts", timedelta(seconds=5), timedelta(0))

    def batch(*values):
        return spark.createDataFrame(values, "id string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))

    first = batch(("a", "2026-01-01 00:00:01"), ("b", "2026-01-01 00:00:07"))
    write(first, 0)
    before = rows(spark.read.text(path), "value", "w", "batch_id"), newest(SharedFiles(spark), f"{path}/_progress")
    files = SharedFiles(spark)
    files.delete(f"{path}/_progress/{0:012d}.json")       # killed before the last step, then run again
    write(first, 0)
    write(first, 0)
    assert (rows(spark.read.text(path), "value", "w", "batch_id"), newest(files, f"{path}/_progress")) == before
    write(batch(("late", "2026-01-01 00:00:02"), ("c", "2026-01-01 00:00:08")), 1)
    write(first.limit(0), 2)
    assert rows(read_sealed(spark, path), "value") == [("a",)] and rows(read_late(spark, path), "value") == [("late",)]
    assert newest(files, f"{path}/_progress")[0] == 2

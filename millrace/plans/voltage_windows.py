"""Sliding voltage averages per transformer, with alerts on low ones. Batch or stream."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from millrace.functions.times import parse_iso
from millrace.schemas import MONITORING
from millrace.session import build_session
from millrace.sinks.files import write_lines
from millrace.streaming.runs import open_rows, write_stream_files
from millrace.streaming.windows import low_mean_alerts, window_means, with_event_time


def voltage_alerts(readings: DataFrame, size: str = "60 seconds", slide: str = "30 seconds", below: float = 200,
                   delay: str | None = None) -> DataFrame:
    timed = with_event_time(readings, parse_iso(F.col("ts")), delay=delay)
    return low_mean_alerts(window_means(timed, ["id"], F.col("v"), size, slide), "id", below)


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder of JSON Lines with id, v, ts")
    parser.add_argument("--output", required=True)
    parser.add_argument("--streaming", action="store_true")
    parser.add_argument("--checkpoint", help="needed with --streaming")
    parser.add_argument("--delay", default="0 seconds", help="how late a reading may come")
    args = parser.parse_args(argv)
    spark = build_session("voltage-windows")
    readings = open_rows(spark, args.input, MONITORING, args.streaming, fmt="json")
    if args.streaming:
        alerts = voltage_alerts(readings, delay=args.delay)
        write_stream_files(alerts.select(F.col("message").alias("value")), args.output, args.checkpoint,
                           fmt="text").awaitTermination()
    else:
        write_lines(voltage_alerts(readings), F.col("message"), args.output)


if __name__ == "__main__":
    main()

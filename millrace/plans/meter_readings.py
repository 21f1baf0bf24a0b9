"""Validate meter readings and fan them out into alerts, anomalies and the silver history."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from millrace.functions.records import row_json
from millrace.functions.text import csv_line
from millrace.operators.clean import concat_rows, fan_out
from millrace.operators.routing import over_limit_message
from millrace.session import build_session
from millrace.sources.files import read_lines
from millrace.sources.meter_csv import parse_readings

# The two columns every silver line ends with.
SOURCE, COMPANY = "SmartGrid-V1", "My-Company"


def branch_lines(readings: DataFrame, limit: float = 10.0) -> DataFrame:
    """``branch, line``: a reading appears once for every branch it belongs to."""
    branched = fan_out(readings, {
        "alerts": F.col("kwh") > limit,
        "anomalies": F.col("kwh") == 0.0,
        "history": F.lit(True)})
    silver = csv_line(*[F.col(name) for name in readings.columns], F.lit(SOURCE), F.lit(COMPANY))
    line = (F.when(F.col("branch") == "alerts", over_limit_message(F.col("id"), F.col("kwh"), limit))
            .when(F.col("branch") == "anomalies", row_json(readings.columns))
            .otherwise(silver))
    return branched.select("branch", line.alias("value"))


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True, help="gets one folder per branch, and one for rejects")
    parser.add_argument("--limit", type=float, default=10.0)
    args = parser.parse_args(argv)
    spark = build_session("meter-readings")
    valid, rejected = parse_readings(read_lines(spark, args.input))
    everything = concat_rows(branch_lines(valid, args.limit), rejected.withColumn("branch", F.lit("rejects")))
    everything.write.mode("overwrite").partitionBy("branch").text(args.output)


if __name__ == "__main__":
    main()

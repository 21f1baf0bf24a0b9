"""Landed forecasts to flat, date-partitioned Parquet."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from millrace.operators.joins import lookup_join
from millrace.schemas import CITIES
from millrace.session import build_session, stored
from millrace.sinks.files import write_ingestion
from millrace.sources.files import CORRUPT, read_csv
from millrace.sources.weather import flatten_forecasts, read_responses


def forecasts(responses: DataFrame, cities: DataFrame, run_time: str) -> DataFrame:
    """All forecast points of known cities; ``complete`` is false for malformed ones."""
    known = cities.select(F.col("city_name").alias("city"), F.col("country_code").alias("country"))
    points = flatten_forecasts(responses, F.lit(run_time).cast("timestamp"))
    return lookup_join(points, known, ["city"], "inner")


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--cities", required=True)
    parser.add_argument("--responses", required=True, help="folder with city=<name> folders of JSON")
    parser.add_argument("--run-time", required=True, help="UTC time of the run, e.g. 2026-01-31T06:00:00")
    parser.add_argument("--output", required=True)
    parser.add_argument("--rejects", required=True)
    args = parser.parse_args(argv)
    spark = build_session("weather-forecast")
    points = forecasts(read_responses(spark, args.responses), read_csv(spark, args.cities, CITIES), args.run_time)
    points = stored(points, "points")  # both outputs come from one parse
    run_date = args.run_time[:10]
    write_ingestion(points.filter("complete").drop("complete", CORRUPT), args.output, run_date)
    write_ingestion(points.filter("NOT complete"), args.rejects, run_date)


if __name__ == "__main__":
    main()

"""Staged customer load: archive, normalise, enrich, load. A rerun goes on at the first stage that is out of date."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from millrace.functions.numbers import to_double, to_int, whole_part
from millrace.functions.records import map_lookup
from millrace.functions.text import title
from millrace.plans.stages import Source, Stage, run_stages
from millrace.schemas import RAW_CUSTOMERS
from millrace.session import build_session
from millrace.sinks.files import archive
from millrace.sinks.tables import as_table
from millrace.sources.files import read_csv

# Location codes and their time zones.
TIME_ZONES = {
    "US_NY": "America/New York",
    "GB_LDN": "Europe/London",
    "US_CA": "America/Los Angeles",
    "FR_PAR": "Europe/Paris",
}


def normalise(raw: DataFrame) -> DataFrame:
    return raw.select(
        title(F.col("name_raw")).alias("name"),
        F.col("location_code").alias("country_city_code"),
        to_int(F.col("user_id")).alias("user_id"),
        to_double(F.col("order_value")).alias("order_value"),
        to_int(F.col("is_active_flag")).alias("is_active_flag"))


def enrich(customers: DataFrame, high_value_above: int = 100) -> DataFrame:
    return customers.withColumns({
        "timezone": map_lookup(F.col("country_city_code"), TIME_ZONES, "Unknown"),
        "is_high_value": whole_part(F.col("order_value")) > high_value_above})


def customer_stages(high_value_above: int = 100) -> list[Stage]:
    return [Stage("kept", lambda raw: raw, ("raw",)), Stage("normalised", normalise, ("kept",)),
            Stage("enriched", enrich, ("normalised",), {"high_value_above": high_value_above})]


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--archive", required=True, help="root folder of the raw copies")
    parser.add_argument("--run-id", required=True)
    parser.add_argument("--table", required=True, help="warehouse table to load")
    parser.add_argument("--table-path")
    parser.add_argument("--work", help="root folder of the stages' results; the archive's by default")
    parser.add_argument("--high-value-above", type=int, default=100)
    args = parser.parse_args(argv)
    spark = build_session("customer-etl")
    source = Source("raw", args.input, lambda session, path: read_csv(session, path, RAW_CUSTOMERS))
    run = run_stages(spark, args.work or f"{args.archive}/_work", [source], customer_stages(args.high_value_above))
    if "kept" in run.executed:
        archive(spark.read.parquet(run.paths["kept"]), args.archive, args.run_id)
    as_table(spark.read.parquet(run.paths["enriched"]), args.table, args.table_path)


if __name__ == "__main__":
    main()

"""Seeds, staging views, the daily monitoring table and its checks."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import trimmed_text
from millrace.functions.times import day_of, parse_timestamp
from millrace.operators import quality
from millrace.operators.aggregates import any_flag, mean_of, total_of
from millrace.schemas import METERS_SEED, READINGS_SEED
from millrace.session import build_session, stored
from millrace.sinks.tables import build_models
from millrace.sources.seeds import load_seed

# The customer categories and the voltage below which there is a risk.
CATEGORIES = ["RESIDENTIAL", "COMMERCIAL", "INDUSTRIAL"]
LOW_VOLTAGE = 200


def stage_meters(seed: DataFrame) -> DataFrame:
    return seed.select(
        trimmed_text(F.col("id_meter")).alias("meter_id"),
        F.col("location").cast("string").alias("location_name"),
        F.upper(F.col("customer_type").cast("string")).alias("customer_category"),
        parse_timestamp(F.col("installation_date")).alias("installation_date"))


def stage_readings(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("reading_id").cast("string").alias("reading_id"),
        F.col("meter_id").cast("string").alias("meter_id"),
        F.col("voltage").try_cast("double").alias("voltage"),
        F.col("kwh_consumption").try_cast("double").alias("consumption"),
        parse_timestamp(F.col("recorded_at")).alias("registration_date"))


def daily_monitoring(readings: DataFrame, meters: DataFrame, low_voltage: float = LOW_VOLTAGE) -> DataFrame:
    """Average voltage, total consumption and a low-voltage flag per place, meter and day.

    Readings are reduced to one row per meter and day before they meet the meters:
    the join then sees few rows, and a meter with a third of all readings has been
    pre-aggregated by every task that read it.
    """
    per_meter = readings.groupBy("meter_id", day_of(F.col("registration_date")).alias("day")).agg(
        mean_of(F.col("voltage")).alias("voltage_average"),
        total_of(F.col("consumption")).alias("consumption_total"),
        any_flag(F.col("voltage") < low_voltage).alias("there_was_a_voltage_drop"))
    return per_meter.join(meters.select("meter_id", "location_name"), "meter_id").select(
        "location_name", "meter_id", "day", "voltage_average", "consumption_total", "there_was_a_voltage_drop")


def consumption_per_key(readings: DataFrame, key: str, value: Column) -> DataFrame:
    """Accumulated consumption."""
    return readings.groupBy(key).agg(total_of(value).alias("total"))


def stability(readings: DataFrame, key: str, value: Column) -> DataFrame:
    """How far values spread per key: the least stable keys have the widest spread."""
    return readings.groupBy(key).agg(
        F.min(value).alias("lowest"), F.max(value).alias("highest"), (F.max(value) - F.min(value)).alias("spread"))


def widest(parts: DataFrame, key: str) -> DataFrame:
    """The stability of a coarser key from that of a finer one, so that few rows go through the join between them."""
    return parts.groupBy(key).agg(F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
                                  (F.max("highest") - F.min("lowest")).alias("spread"))


def meter_checks() -> list[quality.Check]:
    return [quality.unique("meter_id"), quality.not_null("meter_id"),
            quality.accepted_values("customer_category", CATEGORIES)]


def reading_checks() -> list[quality.Check]:
    return [quality.unique("reading_id"), quality.not_null("reading_id"), quality.not_null("voltage"),
            quality.accepted_range("consumption", low=0),
            quality.no_rows_where("voltage_is_positive", "voltage", F.col("voltage") <= 0)]


def mart_checks() -> list[quality.Check]:
    return [quality.not_null("meter_id"), quality.accepted_values("there_was_a_voltage_drop", [0, 1])]


MODELS = {
    "stg_meters": ("view", lambda spark: stage_meters(spark.table("meters"))),
    "stg_readings": ("view", lambda spark: stage_readings(spark.table("readings"))),
    "fct_daily_monitoring": (
        "table", lambda spark: daily_monitoring(spark.table("stg_readings"), spark.table("stg_meters")),
        ("stg_readings", "stg_meters")),
}


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--meters", required=True)
    parser.add_argument("--readings", required=True)
    parser.add_argument("--tables", required=True, help="root folder of the tables")
    args = parser.parse_args(argv)
    spark = build_session("daily-mart")
    load_seed(spark, args.meters, METERS_SEED, "meters", f"{args.tables}/seed_meters")
    load_seed(spark, args.readings, READINGS_SEED, "readings", f"{args.tables}/seed_readings")
    build_models(spark, MODELS, args.tables)
    for model, checks in (("stg_meters", meter_checks()), ("stg_readings", reading_checks()),
                          ("fct_daily_monitoring", mart_checks())):
        report = stored(quality.run_checks(spark.table(model), checks), "checks")  # a row per check, shown and judged
        report.show(truncate=False)
        if quality.choose_route(report) != quality.NORMAL_FLOW:
            raise SystemExit(f"checks failed: {model}")


if __name__ == "__main__":
    main()

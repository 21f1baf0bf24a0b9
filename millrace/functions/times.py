"""Time columns. All parsing assumes the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"  # fixed value: the format of the readings


def parse_iso(value: Column, pattern: str = ISO_FORMAT) -> Column:
    """ISO text with a zone; NULL where it does not parse."""
    return F.try_to_timestamp(value, F.lit(pattern))


def parse_timestamp(value: Column) -> Column:
    """The SQL cast to timestamp; NULL where it does not parse."""
    return value.try_cast("timestamp")


def day_of(value: Column) -> Column:
    """Start of the day, without a zone."""
    return F.date_trunc("day", value).cast("timestamp_ntz")


def clock(value: Column) -> Column:
    return F.date_format(value, "HH:mm:ss")


def iso_day(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def plus_seconds(value: Column, seconds: Column) -> Column:
    return value + F.make_interval(secs=seconds)


def lap_of(elapsed_s: Column, lap_s: int = 300) -> Column:
    """The lap a moment belongs to: 300 s is still lap 1, 300.1 s is lap 2."""
    return F.greatest(F.lit(1), F.ceil(elapsed_s / F.lit(lap_s))).cast("int")

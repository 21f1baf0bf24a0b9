"""Hand-made CSV of meter readings: parsed from raw lines, rejects kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numbers import to_double, to_int
from millrace.functions.text import fields, strip
from millrace.operators.clean import split_valid

HEADER_MARK = "id_meter"  # fixed value: a line with this text is the header


def parse_readings(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid readings, and the rejected lines as they came.

    A reading is valid when it has five fields, a timestamp, and numbers where
    numbers belong (consumption may be neither empty nor the text NULL).
    """
    body = lines.filter(~F.contains("value", F.lit(HEADER_MARK)))
    # explode of one list: the line is split once, not once more for every use of a field
    split = body.select("value", F.explode(F.array(fields(F.col("value")))).alias("f"))

    def text(position: int) -> Column:
        return F.get("f", F.lit(position))

    parsed = split.select(
        "value",
        (text(1) != "").alias("timed"),
        F.lower(strip(text(0))).alias("id"),
        strip(text(1)).alias("ts"),
        to_double(strip(text(2))).alias("kwh"),
        to_int(strip(text(3))).alias("v"),
        strip(text(4)).alias("status"))
    complete = (F.col("timed") & F.col("kwh").isNotNull() & F.col("v").isNotNull() & F.col("status").isNotNull())
    valid, rejected = split_valid(parsed, complete)
    return valid.drop("value", "timed"), rejected.select("value")

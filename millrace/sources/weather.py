"""Landed weather responses: nested JSON, one folder per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.schemas import FORECAST_RESPONSE
from millrace.sources.files import CORRUPT


def read_responses(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All responses below ``path``; a ``city=<name>`` folder becomes the column ``city``.

    ``multi_line`` is for files that hold one response over several lines. A response that cannot be parsed is kept as
    text in ``_corrupt_record``, which is NULL for the others.
    """
    kept = T.StructType([*FORECAST_RESPONSE.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(kept).option("basePath", path).option("multiLine", multi_line)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def flatten_forecasts(responses: DataFrame, ingestion_at: Column) -> DataFrame:
    """One row per forecast point, next to the outer columns of the response.

    A missing chance of rain counts as 0. A point without its ``main`` block or
    without any ``weather`` entry keeps NULLs and is marked as not ``complete``, and
    so is the one row of a response that has no points or could not be parsed.
    """
    outer = [name for name in responses.columns if name != "list"]
    points = responses.select(*outer, F.explode_outer("list").alias("p"))
    sky = F.get("p.weather", F.lit(0))
    return points.select(
        *outer,
        F.col("p.dt_txt").alias("forecast_time"),
        F.col("p.main.temp").alias("temp"),
        F.col("p.main.temp_min").alias("temp_min"),
        F.col("p.main.temp_max").alias("temp_max"),
        F.col("p.main.humidity").alias("humidity"),
        sky["main"].alias("weather_main"),
        sky["description"].alias("weather_description"),
        F.col("p.wind.speed").alias("wind_speed"),
        F.coalesce("p.pop", F.lit(0.0)).alias("precipitation_probability"),
        ingestion_at.alias("ingestion_at"),
        (F.col("p.main").isNotNull() & sky.isNotNull() & F.col("p.wind").isNotNull()).alias("complete"))

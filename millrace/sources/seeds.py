"""Seed files as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from millrace.sources.files import read_csv


def load_seed(spark: SparkSession, csv_path: str, schema: T.StructType, name: str, table_path: str) -> DataFrame:
    """Full refresh: the CSV replaces whatever the table held before."""
    read_csv(spark, csv_path, schema).write.mode("overwrite").parquet(table_path)
    table = spark.read.parquet(table_path)
    table.createOrReplaceTempView(name)
    return table

"""Kafka in and out. The connector package is not part of Spark's own jars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.records import decode_text, encode_text, parse_json, row_json
from millrace.sources.files import require_connector

PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13"


def read_options(brokers: str, topic: str, start: str = "latest", per_trigger: int | None = None) -> dict[str, str]:
    """Reader options; ``start`` is ``latest`` or ``earliest``."""
    if start not in ("latest", "earliest"):
        raise ValueError(f"start must be latest or earliest: {start}")
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": start}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_topic(spark: SparkSession, brokers: str, topic: str, start: str = "latest", streaming: bool = True,
               max_records: int | None = None) -> DataFrame:
    """Records as ``key, value`` bytes with Kafka's ``timestamp``.

    ``max_records`` cuts a batch read off. A stream has no total to cut; there it
    is the size of one micro-batch.
    """
    require_connector(spark, "kafka", PACKAGE)
    options = read_options(brokers, topic, start if streaming else "earliest", max_records if streaming else None)
    reader = spark.readStream if streaming else spark.read
    records = reader.format("kafka").options(**options).load()
    return records.limit(max_records) if max_records is not None and not streaming else records


def decode_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The JSON value as columns; the bytes are parsed once. Other columns than key and value stay."""
    others = [name for name in records.columns if name not in ("key", "value")]
    parsed = records.select(*others, parse_json(decode_text(F.col("value")), schema).alias("_record"))
    return parsed.select(*others, "_record.*")


def encode_records(rows: DataFrame) -> DataFrame:
    """Rows as ``key, value`` bytes: a random key, the row as JSON."""
    return with_random_key(rows, encode_text(row_json(rows.columns)))


def with_random_key(rows: DataFrame, value: Column) -> DataFrame:
    return rows.select(encode_text(F.uuid()).alias("key"), value.alias("value"))


def write_topic(records: DataFrame, brokers: str, topic: str, checkpoint: str):
    """Start a streaming write of ``key, value`` records to a topic."""
    require_connector(records.sparkSession, "kafka", PACKAGE)
    return (records.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())

"""Avro schema files as Spark schemas."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, types as T

# The Avro type names.
PRIMITIVES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}
LOGICAL = {
    "timestamp-micros": T.TimestampType(),
    "timestamp-millis": T.TimestampType(),
    "date": T.DateType(),
}


def load_avro_schema(spark: SparkSession, path: str) -> dict:
    """The schema file, from any file system Spark can read."""
    text = spark.read.text(path, wholetext=True).first()
    return parse_avro_schema(text["value"] if text else "")


def parse_avro_schema(text: str) -> dict:
    schema = json.loads(text)
    if not isinstance(schema, dict):
        raise ValueError("an Avro schema file must hold one record")
    return schema


def struct_from_avro(schema: dict) -> T.StructType:
    """The Spark schema of an Avro record."""
    return T.StructType([T.StructField(f["name"], *_kind(f["type"])) for f in schema["fields"]])


def _kind(declared) -> tuple[T.DataType, bool]:
    """The Spark type and whether it may be NULL."""
    if isinstance(declared, list):
        present = [branch for branch in declared if branch != "null"]
        if len(present) != 1 or len(present) == len(declared):
            raise NotImplementedError(f"union of several types: {declared}")
        return _kind(present[0])[0], True
    if isinstance(declared, str):
        if declared not in PRIMITIVES:
            raise NotImplementedError(f"Avro type: {declared}")
        return PRIMITIVES[declared], False
    logical = declared.get("logicalType")
    if logical == "decimal":
        return T.DecimalType(declared["precision"], declared.get("scale", 0)), False
    if logical in LOGICAL:
        return LOGICAL[logical], False
    kind = declared["type"]
    if kind == "record":
        return struct_from_avro(declared), False
    if kind == "enum":
        return T.StringType(), False
    if kind == "array":
        item, nullable = _kind(declared["items"])
        return T.ArrayType(item, nullable), False
    if kind == "map":
        value, nullable = _kind(declared["values"])
        return T.MapType(T.StringType(), value, nullable), False
    return _kind(kind)

"""Struct, map, JSON and byte columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def struct_without(names: list[str], dropped: list[str]) -> Column:
    """One struct of the named columns, less the dropped ones."""
    return F.struct(*[F.col(name) for name in names if name not in dropped])


def map_lookup(key: Column, mapping: dict, default) -> Column:
    """A constant map as a column expression, with a default for unknown keys."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def default_key(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def required_key(value: Column, message: str) -> Column:
    """The value itself; a row without it (NULL or empty) fails the job."""
    missing = value.isNull() | (value.cast("string") == "")
    return F.when(missing, F.raise_error(F.lit(message))).otherwise(value)


def decode_text(value: Column) -> Column:
    return value.cast("string")


def encode_text(value: Column) -> Column:
    return value.cast("binary")


def parse_json(value: Column, schema: T.StructType) -> Column:
    """``from_json`` that keeps ``85.3`` for an integer field: parse wide, then cast.

    Spark gives NULL when an integer field holds a decimal number, so integer
    fields are read as doubles and cut to integers afterwards. Only for 64-bit
    fields would that lose digits; they are read as text instead.
    """
    parsed = F.from_json(value, widened(schema))
    return narrowed(parsed, schema)


def widened(schema: T.StructType) -> T.StructType:
    """The schema to read JSON with: integers as doubles, 64-bit integers as text."""
    return T.StructType([T.StructField(f.name, _wide_type(f.dataType)) for f in schema])


def _wide_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.LongType):
        return T.StringType()
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.DoubleType()
    return kind


def narrow_column(column: Column, kind: T.DataType) -> Column:
    """Cast one widened column back to its declared type."""
    if isinstance(kind, T.LongType):
        return F.coalesce(column.try_cast("bigint"), column.try_cast("double").try_cast("bigint"))
    return column.try_cast(kind) if _wide_type(kind) != kind else column


def narrowed(parsed: Column, schema: T.StructType) -> Column:
    fields = [narrow_column(parsed.getField(f.name), f.dataType).alias(f.name) for f in schema]
    return F.when(parsed.isNotNull(), F.struct(*fields))


def row_json(names: list[str]) -> Column:
    """The named columns as one JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*[F.col(name) for name in names]))


def stable_id(*columns: Column) -> Column:
    """A repeatable row id: the same record always gets the same one.

    Each part is written with its length, and NULL as a mark of its own, so different records have different ids.
    """
    parts = [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
             for text in (column.cast("string") for column in columns)]
    return F.sha2(F.concat(*parts), 256)

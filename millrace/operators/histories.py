"""Nested, sorted histories per key in lists of bounded length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.running import running_totals

CHUNK_ROWS = 100_000


def place_in_chunks(df: DataFrame, keys: list[str], order_by: list, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add the ``chunk`` of a row: its position among its key's rows, cut every ``chunk_rows``."""
    placed = running_totals(df, keys, order_by, count="_position")
    chunk = F.floor((F.col("_position") - 1) / F.lit(chunk_rows)).cast("bigint")
    return placed.withColumn("chunk", chunk).drop("_position")


def chunk_entry(order_by: list, items: list[str]) -> Column:
    return F.struct(F.struct(*order_by).alias("at"), F.struct(*items).alias("item"))


def collect_entries(entries: DataFrame, keys: list[str], lists: list[str]) -> DataFrame:
    """Gather the entries of every list column per key and chunk, in order."""
    gathered = entries.groupBy(*keys, "chunk").agg(
        *[F.sort_array(F.collect_list(name)).alias(name) for name in lists])
    return gathered.select(*keys, "chunk", *[F.col(name).getField("item").alias(name) for name in lists])


def collect_chunks(df: DataFrame, keys: list[str], order_by: list, items: list[str], into: str,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per key the rows sorted by ``order_by`` as a list of structs of ``items``.

    A key's list is cut every ``chunk_rows`` rows: it goes on in the rows with ``chunk`` 1, 2 and so on, at every size of
    the table, and nothing is dropped.
    """
    placed = place_in_chunks(df, keys, order_by, chunk_rows)
    return collect_entries(placed.select(*keys, "chunk", chunk_entry(order_by, items).alias(into)), keys, [into])

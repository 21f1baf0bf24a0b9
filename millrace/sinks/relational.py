"""Upserts into a relational database, in batches from the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.records import stable_id
from millrace.schemas import TELEMETRY_TABLE

SPARK_TYPES = {"VARCHAR(255)": "string", "INTEGER": "int", "NUMERIC(10,5)": "decimal(10,5)",
               "NUMERIC(10,3)": "decimal(10,3)"}


def telemetry_fault(telemetry: DataFrame) -> Column:
    """Why a record cannot be a row of the target table, or NULL."""
    misfit = F.lit(False)
    for name, kind in TELEMETRY_TABLE.items():
        if name in telemetry.columns:
            misfit |= F.col(name).isNotNull() & F.col(name).try_cast(SPARK_TYPES[kind]).isNull()
    return F.when(F.coalesce("HelicopterID", F.lit("")) == "", "no helicopter, or no record").when(misfit, "a measure is out of range")


def telemetry_rows(telemetry: DataFrame) -> DataFrame:
    """Telemetry in the layout of the target table, with a repeatable id.

    Records with a fault are left out; ``telemetry_fault`` tells them apart for the rejects.
    """
    keyed = telemetry.filter(telemetry_fault(telemetry).isNull())
    keyed = keyed.withColumn("id", stable_id(F.col("RaceID"), F.col("HelicopterID"), F.col("Time_s")))
    return keyed.select(*[
        F.col(name).try_cast(SPARK_TYPES[kind]).alias(name) for name, kind in TELEMETRY_TABLE.items()])


def create_table_statement(table: str, columns: dict[str, str], key: str) -> str:
    body = ", ".join(f"{name} {kind}{' PRIMARY KEY' if name == key else ''}" for name, kind in columns.items())  # no such column, no key
    return f"CREATE TABLE IF NOT EXISTS {table} ({body})"


def upsert_statement(table: str, columns: list[str], key: str, mark: str = "%s") -> str:
    """One parametrised insert that overwrites the row with the same key."""
    changes = ", ".join(f"{name} = EXCLUDED.{name}" for name in columns if name != key)
    return (f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join([mark] * len(columns))}) "
            f"ON CONFLICT ({key}) DO UPDATE SET {changes}")


def upsert_rows(rows: Iterable, connect: Callable, statement: str, batch_size: int = 1000) -> None:
    """The work of one task: one connection, one commit per batch, errors propagate.

    A failed task is run again by Spark; repeating it is harmless because the key
    of a row never changes.
    """
    connection = connect()
    try:
        cursor = connection.cursor()
        for chunk in batched(rows, batch_size):
            try:
                cursor.executemany(statement, [tuple(row) for row in chunk])
                connection.commit()
            except Exception:
                connection.rollback()
                raise
        cursor.close()
    finally:
        connection.close()


@dataclass(frozen=True)
class Database:
    """Where upserts go. ``connect`` opens a DB-API connection, on the driver and inside tasks.

    ``connections`` is how many tasks write at once: what the database can take, not a property of the data.
    """

    connect: Callable
    table: str
    connections: int
    batch_size: int = 1000


def create_table(database: Database, columns: dict[str, str], key: str) -> None:
    """Issue the statement of the target table, once, from the driver."""
    connection = database.connect()
    try:
        cursor = connection.cursor()
        cursor.execute(create_table_statement(database.table, columns, key))
        connection.commit()
    finally:
        connection.close()


def write_upserts(df: DataFrame, database: Database, key: str) -> None:
    """Upsert all rows. Rows of one key go through one connection, so tasks do not wait for each other's locks."""
    statement, connect, batch_size = upsert_statement(database.table, df.columns, key), database.connect, database.batch_size
    df.repartition(database.connections, key).foreachPartition(
        lambda rows: upsert_rows(rows, connect, statement, batch_size))


def append_jdbc(df: DataFrame, url: str, table: str, columns: dict[str, str] | None = None, batch_size: int = 1000,
                properties: dict | None = None) -> None:
    """Plain batched append through Spark's own JDBC writer, for a staging table."""
    writer = df.write.mode("append").option("batchsize", batch_size)
    if columns:
        writer = writer.option("createTableColumnTypes", ", ".join(f"{n} {k}" for n, k in columns.items()))
    writer.jdbc(url, table, properties=properties or {})

"""Rows into a relational table in one step: the tasks fill a staging table, the end of the job moves the rows over.

It is a Python data source. Each task attempt marks its staging rows and hands the mark to the driver; only when all tasks
have ended well are the rows of those marks upserted, in one transaction, and removed from staging. A job that fails, or a
task that is run twice, leaves the target as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from millrace.operators.joins import one_per_key
from millrace.sinks.relational import Database, create_table_statement

JOB, ATTEMPT = "load_job", "load_attempt"  # the columns that mark staging rows
MARKS_PER_STATEMENT = 500


@dataclass
class Attempt(WriterCommitMessage):
    mark: str
    rows: int


@dataclass(frozen=True)
class Target:
    """``columns`` are the SQL types of the table's columns; ``parameter`` is how the driver marks a value in a statement."""

    database: Database
    columns: dict[str, str]
    key: str
    parameter: str = "%s"

    @property
    def staging(self) -> str:
        return f"{self.database.table}_staging"

    def statements(self) -> list[str]:
        """What makes both tables, if they are missing."""
        marked = {JOB: "VARCHAR(64)", ATTEMPT: "VARCHAR(64)", **self.columns}
        return [create_table_statement(self.database.table, self.columns, self.key), create_table_statement(self.staging, marked, "")]

    def move(self, marks: int) -> str:
        names, p = ", ".join(self.columns), self.parameter
        changes = ", ".join(f"{name} = EXCLUDED.{name}" for name in self.columns if name != self.key)
        action = f"DO UPDATE SET {changes}" if changes else "DO NOTHING"
        return (f"INSERT INTO {self.database.table} ({names}) SELECT {names} FROM {self.staging} "
                f"WHERE {JOB} = {p} AND {ATTEMPT} IN ({', '.join([p] * marks)}) ON CONFLICT ({self.key}) {action}")

    def work(self, do) -> None:
        """One transaction of a connection of its own."""
        connection = self.database.connect()
        try:
            try:
                do(connection.cursor())
                connection.commit()
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()


class StagedWriter(DataSourceWriter):
    def __init__(self, target: Target, names: list[str]):
        self.target, self.names, self.job = target, names, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Attempt:
        target, mark, rows = self.target, uuid.uuid4().hex, 0
        places = [self.names.index(name) for name in target.columns]
        columns = [JOB, ATTEMPT, *target.columns]
        statement = f"INSERT INTO {target.staging} ({', '.join(columns)}) VALUES ({', '.join([target.parameter] * len(columns))})"
        for chunk in batched(iterator, target.database.batch_size):
            values = [(self.job, mark, *[row[p] for p in places]) for row in chunk]
            target.work(lambda cursor: cursor.executemany(statement, values))
            rows += len(values)
        return Attempt(mark, rows)

    def commit(self, messages: list[Attempt | None]) -> None:
        marks = [m.mark for m in messages if m is not None and m.rows]

        def move(cursor) -> None:
            for some in batched(marks, MARKS_PER_STATEMENT):
                cursor.execute(self.target.move(len(some)), (self.job, *some))
            self._forget(cursor)

        self.target.work(move)

    def abort(self, messages: list[Attempt | None]) -> None:
        self.target.work(self._forget)

    def _forget(self, cursor) -> None:
        cursor.execute(f"DELETE FROM {self.target.staging} WHERE {JOB} = {self.target.parameter}", (self.job,))


def staged_source(target: Target) -> type[DataSource]:
    """The data source class of one target: a connection cannot be told in string options."""

    class StagedTable(DataSource):
        @classmethod
        def name(cls) -> str:
            return "millrace_staged_table"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            if overwrite:
                raise ValueError("rows are upserted; use append mode")
            return StagedWriter(target, schema.names)

    return StagedTable


def write_staged(df: DataFrame, target: Target) -> None:
    """Upsert all rows at once or none. Of several rows of a key one is taken, the least by all its columns.

    At most ``database.connections`` tasks write at a time. Columns the table lacks are left out.
    """
    def create(cursor) -> None:
        for statement in target.statements():
            cursor.execute(statement)

    target.work(create)
    spark = df.sparkSession
    spark.dataSource.register(staged_source(target))
    rows = one_per_key(df.select(*target.columns), [target.key])
    rows.repartition(target.database.connections, target.key).write.format("millrace_staged_table").mode("append").save()

"""Functions that make any number of rows of each row, with a beginning and an end, as steps of a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, types as T
from pyspark.sql.pandas.types import to_arrow_schema

MADE_AT_ONCE = 10_000


class RowMaker:
    """What a user writes: one object per task, or per key where rows are grouped.

    ``process`` gives the rows made of one row, each a tuple in the order of ``made``; ``finish`` those that are left at the
    end, with ``None`` for the columns that were to be kept (with keys, the last row's).
    """

    made: T.StructType

    def process(self, row: Row) -> Iterable[tuple]:
        raise NotImplementedError

    def finish(self) -> Iterable[tuple]:
        return ()


def table_function(maker: Callable[[], RowMaker], made: T.StructType, keep: list[str], keys: list[str] | None = None,
                   order_by: list[str] | None = None) -> Callable[[DataFrame], DataFrame]:
    """A step for ``DataFrame.transform``: ``keep`` and the columns of ``made``, from the rows of the frame.

    The schema follows from the frame at hand, and rows go to and from Python in Arrow batches; the columns to keep are
    never made Python objects. Without ``keys`` rows are handled where they lie and nothing is shuffled. With ``keys`` each
    key's rows come to one object, in ``order_by``; they pass by one at a time, so what it holds is up to it, but one key's
    rows are one task's work: add a column to ``keys`` that splits hot ones, if the function allows it.
    """
    def step(df: DataFrame) -> DataFrame:
        fields = {f.name: f.dataType for f in df.schema}
        schema = T.StructType([*[T.StructField(name, fields[name]) for name in keep], *made])
        rows = df
        if keys:
            rows = df.repartition(*map(quoted, keys)).sortWithinPartitions(*map(quoted, [*keys, *(order_by or ())]))
        return rows.mapInArrow(_run(maker, fields, list(keep), list(keys or ()), to_arrow_schema(schema)), schema)

    return step


def _run(maker: Callable[[], RowMaker], fields: dict[str, T.DataType], keep: list[str], keys: list[str], schema: pa.Schema):
    to_row = Row(*fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values = [], []         # of the rows made: where their row is among those at hand (none for finish without keys), and what is in them
        at_hand = [pa.nulls(0, kind) for kind in schema.types[:len(keep)]]

        def made() -> pa.RecordBatch:
            kept = [column.take(pa.array(at, pa.int64())) for column in at_hand]
            columns = list(zip(*values, strict=True)) or [()] * (len(schema) - len(keep))
            found = pa.record_batch([*kept, *[pa.array(x, kind) for x, kind in zip(columns, schema.types[len(keep):], strict=True)]], schema=schema)
            at.clear()
            values.clear()
            return found

        current, key = None if keys else maker(), None
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(k) for k in range(len(fields))]
            held = [_python(column, kind) for column, kind in zip(columns, fields.values(), strict=True)]
            names = list(fields)
            # the last row of the batch before, which what its key leaves at the end goes with, then this batch
            at_hand = [pa.concat_arrays([last.slice(max(0, len(last) - 1)).cast(kind), columns[names.index(name)].cast(kind)])
                       for name, last, kind in zip(keep, at_hand, schema.types[:len(keep)], strict=True)]
            first = len(at_hand[0]) - len(batch) if keep else 0
            of_keys = [held[names.index(name)] for name in keys]
            for number, row in enumerate(zip(*held, strict=True), first):
                if keys:
                    now = tuple(column[number - first] for column in of_keys)
                    if current is None or not _same(now, key):
                        for new in current.finish() if current else ():
                            at.append(number - 1)
                            values.append(tuple(new))
                        current, key = maker(), now
                for new in current.process(to_row(*row)):
                    at.append(number)
                    values.append(tuple(new))
                    if len(values) == MADE_AT_ONCE:
                        yield made()
            yield made()
        for new in current.finish() if current else ():
            at.append(len(at_hand[0]) - 1 if keys and keep else None)
            values.append(tuple(new))
        yield made()

    return run


def _same(a: tuple, b: tuple) -> bool:
    return a == b or all(x == y or (x != x and y != y) for x, y in zip(a, b, strict=True))   # NaN is one key


def _python(column: pa.Array, kind: T.DataType) -> list:
    """The values as Spark gives them to Python: rows, dictionaries, times without a zone."""
    return [_value(x, kind) for x in column.to_pylist()] if _converted(kind) else column.to_pylist()


def _converted(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.MapType, T.TimestampType)) or isinstance(kind, T.ArrayType) and _converted(kind.elementType)


def _value(x, kind: T.DataType):
    if x is None:
        return None
    if isinstance(kind, T.StructType):
        return Row(*kind.names)(*[_value(x[f.name], f.dataType) for f in kind])
    if isinstance(kind, T.MapType):
        return {_value(k, kind.keyType): _value(v, kind.valueType) for k, v in x}
    if isinstance(kind, T.ArrayType):
        return [_value(v, kind.elementType) for v in x]
    return x.replace(tzinfo=None) if isinstance(kind, T.TimestampType) else x


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


class Lines(RowMaker):
    """The lines of a text that have a word: their number from 1, words and characters."""

    made = T.StructType().add("line", "integer").add("words", "integer").add("chars", "integer")

    def __init__(self, text: str):
        self.text = text

    def process(self, row):
        for number, line in enumerate((row[self.text] or "").split("\n"), 1):
            words = len(line.split(" ")) - line.split(" ").count("")
            if words:
                yield number, words, len(line)


class Sessions(RowMaker):
    """Stretches of rows with no gap over ``gap_seconds`` between them: first and last time, and the number of rows."""

    made = T.StructType().add("first", "timestamp_ntz").add("last", "timestamp_ntz").add("n", "integer")

    def __init__(self, time: str, gap_seconds: float):
        self.time, self.gap, self.open = time, gap_seconds, None

    def process(self, row):
        moment = row[self.time]
        if moment is None:
            return
        if self.open and (moment - self.open[1]).total_seconds() > self.gap:
            yield self.open
            self.open = None
        first, _, n = self.open or (moment, moment, 0)
        self.open = (first, moment, n + 1)

    def finish(self):
        if self.open:
            yield self.open
